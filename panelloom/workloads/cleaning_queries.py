"""Ingest, schema, conversion, quality and row-cleaning queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions import dates as D
from panelloom.functions import parsing as P
from panelloom.operators import cleaning as E
from panelloom.operators import convert as V
from panelloom.operators import quality as Q
from panelloom.operators import schema as S
from panelloom.operators.measures import category_map
from panelloom.plans import cleaners
from panelloom.sources import extracts as X
from panelloom.workloads.registry import cte, query

# --------------------------------------------------------------------------
# Sources
# --------------------------------------------------------------------------


def _with_preamble(columns: list[str], lines: int):
    """Arrow batches of one task, with a preamble and a header line in front."""

    def prefix(batches):
        import pyarrow as pa

        first = [f"export info {i}, not data" for i in range(lines)] + [",".join(columns)]
        started = False
        for batch in batches:
            if batch.num_rows and not started:
                started = True
                yield pa.RecordBatch.from_arrays([pa.array(first)], schema=batch.schema)
            yield batch

    return prefix


def write_extract(df: DataFrame, path: str, preamble: int) -> str:
    """Store ``df`` as delimited text files, each with its own preamble and header."""
    cells = [F.concat(F.lit('"'), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"')) for c in df.columns]
    return write_lines(df.select(F.concat_ws(",", *cells).alias("value")), df.columns, path, preamble)


def write_lines(lines: DataFrame, columns: list[str], path: str, preamble: int) -> str:
    lines.mapInArrow(_with_preamble(columns, preamble), "value string").write.text(path)
    return path


@query(
    "ingest_text_first",
    "o_orderkey:text o_custkey:text o_orderstatus:text note:text",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
              CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
              CASE WHEN o_orderstatus = 'F' THEN concat('a, b ', o_orderpriority) END AS note
       FROM orders""",
)
def ingest_text_first(t):
    """Two header layouts with a three-line preamble, written from the orders and read back."""
    orders = t.table("orders")
    finished = F.col("o_orderstatus") == "F"
    folder = t.scratch("ingest")
    note = F.concat(F.lit("a, b "), F.col("o_orderpriority")).alias("note")
    write_extract(orders.filter(finished).select("o_orderkey", "o_custkey", note), f"{folder}/finished", 3)
    write_extract(orders.filter(~finished).select("o_custkey", "o_orderstatus", "o_orderkey"), f"{folder}/open", 3)
    return X.load_source(t.spark, X.SourceSpec(folder, "*.txt", recursive=True, preamble=3))


@query(
    "ingest_spanning_records",
    "o_orderkey:text note:text o_orderstatus:text",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
              CASE o_orderkey % 4
                   WHEN 0 THEN concat('first, line', chr(10), 'of "', o_orderpriority, '"', chr(10), chr(10), 'last')
                   WHEN 1 THEN concat('a 5" pipe of ', o_orderpriority) WHEN 2 THEN o_orderpriority END AS note
       FROM orders""",
)
def ingest_spanning_records(t):
    """Cells with line breaks and doubled quotes, stray quotes in bare cells, and bare cells, in one header layout."""
    note = """CASE o_orderkey % 4
                   WHEN 0 THEN concat('"first, line', chr(10), 'of ""', o_orderpriority, '""', chr(10), chr(10), 'last"')
                   WHEN 1 THEN concat('a 5" pipe of ', o_orderpriority) WHEN 2 THEN o_orderpriority ELSE '' END"""
    lines = t.table("orders").selectExpr(f"concat(o_orderkey, ',', {note}, ',', o_orderstatus) AS value")
    folder = t.scratch("spanning")
    write_lines(lines, ["o_orderkey", "note", "o_orderstatus"], f"{folder}/all", 2)
    return X.fitting(X.load_source(t.spark, X.SourceSpec(folder, "*.txt", recursive=True, preamble=2)))


@query(
    "union_fill",
    "id:long name:text segment:text balance:money",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
       UNION ALL SELECT p_partkey, p_name, NULL, p_retailprice FROM part""",
)
def union_fill(t):
    return X.union_fill(
        [
            t.table("customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment"),
            t.table("supplier").selectExpr("s_acctbal AS balance", "s_suppkey AS id", "s_name AS name"),
            None,
            t.table("part").selectExpr("p_name AS name", "p_partkey AS id", "p_retailprice AS balance"),
        ]
    )


@query(
    "enrich_orders_left_chain",
    "l_orderkey:long l_linenumber:long price_x:money price_y:money o_custkey:long name:text",
    """SELECT l_orderkey, l_linenumber, l_extendedprice AS price_x, o_totalprice AS price_y, o_custkey, c_name AS name
       FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus <> 'P'
       LEFT JOIN customer ON o_custkey = c_custkey""",
)
def enrich_orders_left_chain(t):
    lines = t.table("lineitem").selectExpr("l_orderkey", "l_linenumber", "l_extendedprice AS price")
    header = t.table("orders").filter("o_orderstatus <> 'P'")
    header = header.selectExpr("o_orderkey AS order_no", "o_totalprice AS price", "o_custkey")
    partner = (
        t.table("orders")
        .filter("o_orderstatus <> 'P'")
        .join(t.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .selectExpr("o_orderkey AS order_id", "c_name AS name")
    )
    out = X.enrich_orders(lines, header, partner, "l_orderkey", "order_no", "order_id")
    return out.withColumnsRenamed({"price.x": "price_x", "price.y": "price_y"})


@query(
    "contacts_drop_pii",
    "c_custkey:long c_mktsegment:text c_nationkey:long",
    "SELECT c_custkey, c_mktsegment, c_nationkey FROM customer",
)
def contacts_drop_pii(t):
    return X.drop_columns_like(t.table("customer"), ["c_name", "c_acctbal", "not_there"])


@query(
    "category_map_distinct",
    "category_group:text category:text",
    """SELECT DISTINCT 't_software' AS category_group, p_type AS category FROM part
       UNION SELECT 't_hw_mt_standalone', p_brand FROM part
       UNION SELECT 't_services', o_orderpriority FROM orders
       UNION SELECT * FROM (VALUES ('t_other_miss', 'Other'), ('t_spare_parts', 'Spare part'), ('t_spare_parts', 'Spare parts'))""",
)
def category_map_distinct(t):
    sources = {
        "t_software": (t.table("part"), "p_type"),
        "t_hw_mt_standalone": (t.table("part"), "p_brand"),
        "t_services": (t.table("orders"), "o_orderpriority"),
    }
    return category_map(sources, {"t_other_miss": ["Other"], "t_spare_parts": ["Spare part", "Spare parts"]})


# --------------------------------------------------------------------------
# Schema
# --------------------------------------------------------------------------


@query(
    "ensure_columns",
    "o_orderkey:long n_calls:long o_orderstatus:text",
    "SELECT o_orderkey, 0 AS n_calls, o_orderstatus FROM orders",
)
def ensure_columns(t):
    return S.ensure_columns(t.table("orders"), ["n_calls", "o_orderstatus"], 0)


@query("drop_empty_columns", "id:long maybe_id:text note:text", "SELECT id, maybe_id, note FROM v_messy")
def drop_empty_columns(t):
    out = S.drop_empty_columns(t.view("v_messy"))
    if "empty_col" in out.columns:
        raise AssertionError("an empty column was kept")
    return out


@query(
    "ids_as_string",
    "customer_id:text account_id:text country:text",
    """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_nationkey AS VARCHAR) AS account_id, n_name AS country
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def ids_as_string(t):
    joined = t.table("customer").join(t.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return S.ids_as_string(joined.selectExpr("c_custkey AS customer_id", "c_nationkey AS account_id", "n_name AS country"))


# --------------------------------------------------------------------------
# Conversion
# --------------------------------------------------------------------------


@query(
    "parse_timestamp_multi",
    "id:long time_text:ts",
    "SELECT id, strptime(time_text, '%d/%m/%Y %H:%M:%S') AS time_text FROM v_messy_times",
)
def parse_timestamp_multi(t):
    return V.parse_timestamps(t.view("v_messy_times"), ["time_text"])


cte(
    "dates_clean",
    """SELECT id, date_text AS raw, trim(regexp_replace(regexp_replace(regexp_replace(date_text, '[^0-9./: -]', '', 'g'), '[./]', '-', 'g'), '\\s+', ' ', 'g')) AS date_text
       FROM v_messy""",
)


@query(
    "parse_date_multi",
    "id:long date_text:date other_text:date",
    """SELECT a.id, CAST(try_strptime(a.date_text, '%d-%m-%Y') AS DATE) AS date_text,
              CAST(try_strptime(trim(replace(regexp_replace(b.date_text, '[^0-9./: -]', '', 'g'), '/', '-')), '%Y-%m-%d') AS DATE) AS other_text
       FROM dates_clean a JOIN v_messy_times b USING (id)""",
)
def parse_date_multi(t):
    other = t.view("v_messy_times").selectExpr("id", "date_text AS other_text")
    messy = t.view("v_messy").select("id", "date_text").join(other, "id")
    return V.parse_dates(messy, ["date_text", "other_text"])


@query(
    "parse_date_by_file",
    "id:long file:text day:date other:date day_unparsed:text other_unparsed:text",
    """SELECT o_orderkey AS id,
              CASE WHEN year(o_orderdate) < 1994 THEN 'a' WHEN year(o_orderdate) < 1998 THEN 'b' ELSE 'c' END AS file,
              CASE WHEN o_orderkey % 50 <> 7 THEN CAST(o_orderdate AS DATE) END AS day, CAST(o_orderdate AS DATE) AS other,
              CASE WHEN o_orderkey % 50 = 7 THEN 'unknown' END AS day_unparsed, CAST(NULL AS VARCHAR) AS other_unparsed
       FROM orders""",
)
def parse_date_by_file(t):
    """A source that wrote its dates in three layouts, one after the other; the last file has under a tenth of the rows."""
    orders = t.table("orders").selectExpr("o_orderkey AS id", "CAST(o_orderdate AS DATE) AS d", "year(o_orderdate) AS y")
    messy = orders.selectExpr(
        "id",
        "CASE WHEN y < 1994 THEN 'a' WHEN y < 1998 THEN 'b' ELSE 'c' END AS file",
        """CASE WHEN id % 50 = 7 THEN 'unknown' WHEN y < 1994 THEN date_format(d, 'yyyy-MM-dd')
                WHEN y < 1998 THEN date_format(d, 'dd.MM.yyyy') ELSE date_format(d, 'MM/dd/yyyy') END AS day""",
        "date_format(d, 'dd/MM/yyyy') AS other",
    )
    return V.convert_by_group(messy, V.ConversionSpec(dates=("day", "other")), "file")


@query(
    "excel_serial_date",
    "id:long serial_text:date maybe_id:text",
    "SELECT id, DATE '1899-12-30' + CAST(serial_text AS INT) AS serial_text, maybe_id FROM v_messy",
)
def excel_serial_date(t):
    return V.excel_serial_to_date(t.view("v_messy"), ["serial_text", "maybe_id"])


@query(
    "excel_serial_timestamp",
    "id:long serial_text:ts",
    """SELECT id, CAST(DATE '1899-12-30' AS TIMESTAMP)
              + to_seconds(CAST(round(TRY_CAST(serial_text AS DOUBLE) * 86400) AS BIGINT)) AS serial_text
       FROM v_messy_times""",
)
def excel_serial_timestamp(t):
    return V.excel_serial_to_timestamp(t.view("v_messy_times"), ["serial_text"])


cte(
    "numbers",
    """SELECT id, CASE WHEN contains(amount_text, '%') THEN v / 100 ELSE v END AS amount FROM (
         SELECT id, amount_text, TRY_CAST(regexp_replace(regexp_replace(trim(regexp_replace(amount_text, '[%$€£¥]', '', 'g')),
                  ',([0-9]{1,2})$', '.\\1'), '[^0-9.-]', '', 'g') AS DOUBLE) AS v
         FROM v_messy)""",
)


@query("parse_numeric_messy", "id:long amount_text:ratio", "SELECT id, amount AS amount_text FROM numbers")
def parse_numeric_messy(t):
    return V.parse_numbers(t.view("v_messy"), ["amount_text"])


@query(
    "parse_boolean",
    "id:long flag_text:bool",
    """SELECT id, CASE WHEN lower(trim(flag_text)) IN ('true', 't', 'yes', 'y', '1', 'x', 'checked', 'selected', 'on') THEN TRUE
              WHEN lower(trim(flag_text)) IN ('false', 'f', 'no', 'n', '0', '', 'unchecked', 'unselected', 'off') THEN FALSE END AS flag_text
       FROM v_messy""",
)
def parse_boolean(t):
    return V.parse_booleans(t.view("v_messy"), ["flag_text"])


@query(
    "to_category",
    "id:long flag_text:text note:text",
    "SELECT id, nullif(trim(flag_text), '') AS flag_text, nullif(trim(note), '') AS note FROM v_messy",
)
def to_category(t):
    return V.to_category(t.view("v_messy"), ["flag_text", "note"])


@query(
    "calendar_week_split",
    "id:long case_year:long case_calendar_week:long",
    """SELECT id, CAST(split_part(cw_text, '/', 1) AS BIGINT) AS case_year,
              CAST(split_part(cw_text, '/', 2) AS BIGINT) AS case_calendar_week FROM v_messy""",
)
def calendar_week_split(t):
    return V.parse_calendar_week(t.view("v_messy"), "cw_text", "case")


@query(
    "conversion_report",
    "column:text reading:text non_null:long valid:long nulls_introduced:long success_pct:ratio examples:text",
    """WITH f AS (SELECT flag_text AS v, count(*) AS n FROM v_messy WHERE lower(trim(flag_text)) = 'maybe' GROUP BY 1),
            d AS (SELECT date_text AS v FROM v_messy_times WHERE try_strptime(trim(replace(regexp_replace(date_text, '[^0-9./: -]', '', 'g'), '/', '-')), '%Y-%m-%d') IS NULL AND date_text IS NOT NULL),
            m AS (SELECT count(*) AS n FROM v_messy)
       SELECT 'amount_text' AS "column", 'number' AS reading, n AS non_null, n AS valid, 0 AS nulls_introduced, 100.0 AS success_pct, NULL AS examples FROM m
       UNION ALL SELECT 'flag_text', 'boolean', n, n - (SELECT sum(n) FROM f), (SELECT sum(n) FROM f), 100.0 * (n - (SELECT sum(n) FROM f)) / n, (SELECT string_agg(v, ' | ' ORDER BY v) FROM f) FROM m
       UNION ALL SELECT 'note', 'text', n, 0, 0, 0, NULL FROM m
       UNION ALL SELECT 'date_text', 'date:ymd', (SELECT count(date_text) FROM v_messy_times), (SELECT count(date_text) FROM v_messy_times) - (SELECT count(*) FROM d),
              (SELECT count(*) FROM d), 100.0 * ((SELECT count(date_text) FROM v_messy_times) - (SELECT count(*) FROM d)) / (SELECT count(date_text) FROM v_messy_times),
              (SELECT string_agg(DISTINCT v, ' | ') FROM d) FROM m""",
)
def conversion_report(t):
    other = t.view("v_messy_times").select("id", "date_text")
    messy = t.view("v_messy").select("id", "amount_text", "flag_text", F.regexp_replace("note", "[0-9]", "").alias("note"))
    df = messy.join(other, "id")
    spec = V.ConversionSpec(numeric=("amount_text", "note"), logical=("flag_text",), dates=("date_text",))
    return V.conversion_report(df, V.plan_conversion(df, spec))


# --------------------------------------------------------------------------
# Quality
# --------------------------------------------------------------------------

_MESSY_COLUMNS = "id maybe_id date_text serial_text amount_text flag_text cw_text note empty_col".split()


@query(
    "missing_profile",
    "column:text missing_count:long missing_percent:ratio",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing_count,
                   round(100.0 * (count(*) - count({c})) / count(*), 2) AS missing_percent FROM v_messy"""
        for c in _MESSY_COLUMNS
    ),
)
def missing_profile(t):
    return Q.missing_profile(t.view("v_messy"))


@query(
    "id_distinct_profile",
    "column:text n_distinct:long",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_distinct FROM v_customers"""
        for c in ("customer_id", "customer_name", "customer_sap_id")
    ),
)
def id_distinct_profile(t):
    return Q.distinct_profile(t.view("v_customers"))


@query(
    "date_pair_consistency",
    "start_column:text end_column:text both_present:long violations:long violation_percent:ratio",
    """SELECT 'to_start_date' AS start_column, 'to_close_date' AS end_column, count(*) AS both_present,
              count(*) FILTER (to_start_date > to_close_date) AS violations,
              round(100.0 * count(*) FILTER (to_start_date > to_close_date) / count(*), 2) AS violation_percent FROM v_opportunities""",
)
def date_pair_consistency(t):
    return Q.date_order_check(t.view("v_opportunities"))


_LINE_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "numeric_summary",
    "column:text min:money q1:money median:money mean:money q3:money max:money n_missing:long",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", min({c}) AS min, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
                   avg({c}) AS mean, quantile_cont({c}, 0.75) AS q3, max({c}) AS max, count(*) - count({c}) AS n_missing FROM lineitem"""
        for c in _LINE_NUMBERS
    )
    + """ UNION ALL SELECT 'sc_reaction_time', min(sc_reaction_time), quantile_cont(sc_reaction_time, 0.25), quantile_cont(sc_reaction_time, 0.5),
           avg(sc_reaction_time), quantile_cont(sc_reaction_time, 0.75), max(sc_reaction_time), count(*) - count(sc_reaction_time) FROM v_cases""",
)
def numeric_summary(t):
    lines = Q.numeric_summary(t.table("lineitem"), _LINE_NUMBERS)
    return lines.unionByName(Q.numeric_summary(t.view("v_cases"), ["sc_reaction_time"]))


@query(
    "box_outliers",
    "o_orderpriority:text column:text q1:money median:money q3:money whisker_low:money whisker_high:money n_outliers:long",
    """WITH v AS (SELECT o_orderpriority, CASE WHEN o_orderkey % 50 = 0 THEN o_totalprice * 10 ELSE o_totalprice END AS v FROM orders),
            b AS (SELECT o_orderpriority, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM v GROUP BY 1)
       SELECT o_orderpriority, 'price' AS "column", q1, median, q3,
              min(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
              max(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
              count(*) FILTER (v NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
       FROM v JOIN b USING (o_orderpriority) GROUP BY ALL""",
)
def box_outliers(t):
    price = F.when(F.col("o_orderkey") % 50 == 0, F.col("o_totalprice") * 10).otherwise(F.col("o_totalprice"))
    return Q.box_stats(t.table("orders").select("o_orderpriority", price.alias("price")), ["price"], ["o_orderpriority"])


@query(
    "flag_date_inconsistency",
    "to_id:long date_inconsistency:bool",
    "SELECT to_id, coalesce(to_start_date > to_close_date, FALSE) AS date_inconsistency FROM v_opportunities",
)
def flag_date_inconsistency(t):
    return Q.flag_date_inconsistency(t.view("v_opportunities"), "to_start_date", "to_close_date")


@query(
    "row_completeness",
    "id:long data_quality_score:ratio",
    f"SELECT id, ({' + '.join(f'CAST({c} IS NOT NULL AS INT)' for c in _MESSY_COLUMNS)}) / 9.0 AS data_quality_score FROM v_messy",
)
def row_completeness(t):
    return Q.row_completeness(t.view("v_messy"))


@query(
    "cleaning_summary",
    "dataset:text rows_raw:long rows_cleaned:long status:text",
    """SELECT 'copies' AS dataset, (SELECT count(*) FROM v_order_copies) AS rows_raw,
              (SELECT count(DISTINCT to_id) FROM v_order_copies) AS rows_cleaned, 'success' AS status
       UNION ALL SELECT 'customers', (SELECT count(*) FROM v_customers), NULL, 'error'""",
)
def cleaning_summary(t):
    copies = t.view("v_order_copies")
    cleaned = E.dedupe_first(copies, ["to_id"], ["_line"])
    return Q.cleaning_summary({"copies": (copies, cleaned), "customers": (t.view("v_customers"), None)})


@query(
    "parse_warning_by_group",
    "year:long has_warnings:bool n_failed:long",
    """SELECT year(CAST(o_orderdate AS DATE)) AS year, bool_or(amount IS NULL OR flag_text = 'maybe') AS has_warnings,
              count(*) FILTER (amount IS NULL OR flag_text = 'maybe') AS n_failed
       FROM v_messy JOIN numbers USING (id) JOIN orders ON o_orderkey = id GROUP BY 1""",
)
def parse_warning_by_group(t):
    failed = P.number(F.col("amount_text")).isNull() | P.boolean(F.col("flag_text")).isNull()
    messy = t.view("v_messy").withColumn("failed", failed)
    years = t.table("orders").select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("year"))
    return Q.ingest_warnings(messy.join(years, "id"), "year", "failed")


# --------------------------------------------------------------------------
# Row cleaning and features
# --------------------------------------------------------------------------


@query(
    "squish_text",
    "id:long note:text date_text:text",
    """SELECT id, trim(regexp_replace(note, '\\s+', ' ', 'g')) AS note,
              trim(regexp_replace(date_text, '\\s+', ' ', 'g')) AS date_text FROM v_messy""",
)
def squish_text(t):
    return E.squish_text(t.view("v_messy"))


@query(
    "dedupe_first",
    "to_id:long to_start_date:date amount:money status:text",
    "SELECT * FROM v_order_copies QUALIFY row_number() OVER (PARTITION BY to_id ORDER BY _line) = 1",
)
def dedupe_first(t):
    return E.dedupe_first(t.view("v_order_copies"), ["to_id"], ["_line"])


@query(
    "dedupe_composite",
    "status:text year:long amount:money _line:long",
    """SELECT status, year(to_start_date) AS year, amount, _line FROM v_order_copies
       QUALIFY row_number() OVER (PARTITION BY status, year(to_start_date) ORDER BY amount DESC, _line) = 1""",
)
def dedupe_composite(t):
    copies = t.view("v_order_copies").withColumns({"year": F.year("to_start_date"), "_worst": -F.col("amount")})
    return E.dedupe_by_available(copies, [["missing", "status"], ["status", "year"]], ["_worst", "_line"])


@query(
    "distinct_rows",
    "status:text year:long month:long",
    "SELECT DISTINCT status, year(to_start_date) AS year, month(to_start_date) AS month FROM v_order_copies",
)
def distinct_rows(t):
    rows = t.view("v_order_copies").select("status", F.year("to_start_date").alias("year"), F.month("to_start_date").alias("month"))
    return E.distinct_rows(rows)


@query(
    "date_parts",
    "event_id:long at_year:long at_quarter:long at_month:long at_day:long at_hour:long at_weekday:text at_time:text",
    """SELECT event_id, year(ts) AS at_year, quarter(ts) AS at_quarter, month(ts) AS at_month, day(ts) AS at_day,
              hour(ts) AS at_hour, dayname(ts) AS at_weekday, strftime(ts, '%H:%M:%S') AS at_time FROM v_activities""",
)
def date_parts(t):
    parts = ["year", "quarter", "month", "day", "hour", "weekday", "time"]
    return E.date_parts(t.view("v_activities"), "ts", "at", parts)


@query(
    "durations",
    "event_id:long minutes:ratio duration_suspicious:bool days:long",
    """SELECT event_id, epoch_us(ts - (CAST(day AS TIMESTAMP) + to_minutes(event_id % 700))) / 6e7 AS minutes,
              epoch_us(ts - (CAST(day AS TIMESTAMP) + to_minutes(event_id % 700))) / 6e7 < 0
                OR epoch_us(ts - (CAST(day AS TIMESTAMP) + to_minutes(event_id % 700))) / 6e7 > 480 AS duration_suspicious,
              day - DATE '2023-12-31' AS days FROM v_activities""",
)
def durations(t):
    start = F.timestamp_add("MINUTE", (F.col("event_id") % 700).cast("int"), F.col("day").cast("timestamp_ntz"))
    events = t.view("v_activities").withColumns({"start": start, "origin": F.lit("2023-12-31").cast("date")})
    return E.duration_days(E.duration_minutes(events, "start", "ts", "minutes"), "origin", "day", "days")


@query(
    "business_hours",
    "event_id:long mail_hours:bool activity_hours:bool",
    "SELECT event_id, hour(ts) BETWEEN 8 AND 17 AS mail_hours, hour(ts) BETWEEN 9 AND 17 AS activity_hours FROM v_activities",
)
def business_hours(t):
    events = E.business_hours_flag(t.view("v_activities"), "ts", 8, 17).withColumnRenamed("is_business_hours", "mail_hours")
    return events.withColumn("activity_hours", D.business_hours(F.col("ts"), 9, 17))


@query(
    "subject_features",
    "conv_id:long turn:long subject_length:long has_attachment:bool is_reply:bool subject_clean:text",
    """SELECT conv_id, turn, length(subject) AS subject_length, regexp_matches(lower(subject), 'attach|enclosed|pdf|doc|xls') AS has_attachment,
              regexp_matches(lower(subject), '^re:|^fw:|^fwd:') AS is_reply, regexp_replace(subject, '^(re:|fw:|fwd:)\\s*', '') AS subject_clean
       FROM v_mails""",
)
def subject_features(t):
    return E.subject_features(t.view("v_mails"))


@query(
    "expiry_status",
    "to_id:long warranty_status:text warranty_days_remaining:long",
    """SELECT to_id, CASE WHEN w IS NULL THEN 'unknown' WHEN w < DATE '1999-06-30' THEN 'expired' ELSE 'active' END AS warranty_status,
              w - DATE '1999-06-30' AS warranty_days_remaining
       FROM (SELECT to_id, CASE WHEN to_opportunity_status = 'Open' THEN NULL ELSE to_close_date END AS w FROM v_opportunities)""",
)
def expiry_status(t):
    ends = F.when(F.col("to_opportunity_status") != "Open", F.col("to_close_date"))
    return E.warranty_status(t.view("v_opportunities").withColumn("warranty_end", ends), "warranty_end", "1999-06-30")


_ITEMS = ("core_competency", "hardware_proximity", "competitor_count", "competitor_quality")


@query(
    "likert_scores",
    "respondent_id:long core_alignment_score:long competition_pressure:long",
    """SELECT respondent_id, core_competency + hardware_proximity AS core_alignment_score,
              competitor_count + competitor_quality AS competition_pressure FROM v_survey""",
)
def likert_scores(t):
    survey = t.view("v_survey")
    return E.likert_scores(survey, E.likert_columns(survey))


@query(
    "response_quality",
    "respondent_id:long straight_line_responses:bool response_range:long low_variance_responses:bool",
    """SELECT respondent_id,
              hardware_proximity = core_competency AND coalesce(competitor_count = core_competency, TRUE)
                AND competitor_quality = core_competency AS straight_line_responses,
              greatest(core_competency, hardware_proximity, competitor_count, competitor_quality)
                - least(core_competency, hardware_proximity, competitor_count, competitor_quality) AS response_range,
              greatest(core_competency, hardware_proximity, competitor_count, competitor_quality)
                - least(core_competency, hardware_proximity, competitor_count, competitor_quality) <= 1 AS low_variance_responses
       FROM v_survey""",
)
def response_quality(t):
    return E.response_quality(t.view("v_survey"), _ITEMS)


@query(
    "clean_opportunities",
    "to_id:text to_customer_id:text to_start_date:date to_close_date:date to_opportunity_status:text to_expected_value:money"
    " to_probability:money to_start_year:long to_close_quarter:long to_duration_in_days:long date_inconsistency:bool changed_on:ts",
    """SELECT CAST(to_id AS VARCHAR) AS to_id, CAST(to_customer_id AS VARCHAR) AS to_customer_id, to_start_date, to_close_date,
              to_opportunity_status, to_expected_value, CAST(to_id % 100 AS DOUBLE) AS to_probability, year(to_start_date) AS to_start_year,
              quarter(to_close_date) AS to_close_quarter, to_close_date - to_start_date AS to_duration_in_days,
              to_start_date > to_close_date AS date_inconsistency,
              CAST(DATE '1899-12-30' AS TIMESTAMP) + to_hours(CAST((35000 + to_id % 900) * 24 + 6 AS INTEGER)) AS changed_on
       FROM v_opportunities""",
)
def clean_opportunities(t):
    """The opportunities as a text extract with every row twice, put through the cleaner."""
    raw = t.view("v_opportunities").select(
        F.col("to_id").cast("string").alias("ID"),
        F.col("to_customer_id").cast("string").alias("Customer ID"),
        F.lit("  Some account ").alias("Account"),
        F.date_format("to_start_date", "dd.MM.yyyy").alias("Start Date"),
        F.date_diff("to_close_date", F.lit("1899-12-30").cast("date")).cast("string").alias("Close Date"),
        F.concat(F.lit(" "), "to_opportunity_status").alias("Opportunity Status"),
        F.format_string("$ %.2f", "to_expected_value").alias("Expected Value"),
        F.concat((F.col("to_id") % 100).cast("string"), F.lit(" %")).alias("Probability"),
        F.concat((F.col("to_id") % 900 + 35000).cast("string"), F.lit(".25")).alias("Changed On"),
        F.lit(None).cast("string").alias("Empty"),
        F.col("to_id").alias("_line"),
    )
    copies = raw.withColumn("_block", F.lit(0)).unionByName(raw.withColumn("_block", F.lit(1)))
    return cleaners.clean(t.stored("opportunities", copies), cleaners.OPPORTUNITIES, ["_line", "_block"])


@query(
    "clean_cases",
    "sc_case_number:text sc_customer_number:text case_year:long case_calendar_week:long sc_case_type:text sc_escalation:bool sc_reaction_time:money",
    """SELECT CAST(sc_case_number AS VARCHAR) AS sc_case_number, CAST(sc_customer_number AS VARCHAR) AS sc_customer_number, case_year,
              sc_case_number % 52 + 1 AS case_calendar_week, sc_case_type, sc_delayed_callbacks = 1 AS sc_escalation, sc_reaction_time
       FROM v_cases QUALIFY row_number() OVER (PARTITION BY sc_case_number ORDER BY case_year, sc_reaction_time, sc_case_type, sc_delayed_callbacks, sc_priority) = 1""",
)
def clean_cases(t):
    reaction = F.regexp_replace(F.format_string("%.1f", "sc_reaction_time"), "[.]", ",")
    raw = t.view("v_cases").select(
        F.col("sc_case_number").cast("string").alias("Case Number"),
        F.col("sc_customer_number").cast("string").alias("Customer Number"),
        F.concat_ws("/", F.col("case_year"), F.col("sc_case_number") % 52 + 1).alias("CW"),
        F.concat(F.col("sc_case_type"), F.lit("  ")).alias("Case Type"),
        F.when(F.col("sc_delayed_callbacks") == 1, "Y").otherwise("N").alias("Escalation"),
        F.when(F.col("sc_reaction_time").isNotNull(), reaction).alias("Reaction Time"),
        F.struct("case_year", "sc_reaction_time", "sc_case_type", "sc_delayed_callbacks", "sc_priority").alias("_line"),
    )
    return cleaners.clean(t.stored("cases", raw), cleaners.CASES, ["_line"])


@query(
    "clean_customers",
    "customer_account_id:text customer_sap_id:text customer_name:text",
    "SELECT CAST(customer_id AS VARCHAR) AS customer_account_id, customer_sap_id, customer_name FROM v_customers",
)
def clean_customers(t):
    """The customers as a text extract with padded names and every row twice."""
    raw = t.view("v_customers").select(
        F.col("customer_id").cast("string").alias("Account ID"),
        F.col("customer_sap_id").alias("SAP ID"),
        F.concat(F.lit("  "), "customer_name", F.lit(" ")).alias("Name"),
        F.col("customer_id").alias("_line"),
    )
    copies = raw.withColumn("_block", F.lit(0)).unionByName(raw.withColumn("_block", F.lit(1)))
    return cleaners.clean(t.stored("customers", copies), cleaners.CUSTOMERS, ["_line", "_block"])


@query(
    "clean_installed_base",
    "sis_equipment_number:text sis_customer_number:text sis_equipment_type:text sis_start_date:date construction_year:long"
    " construction_month:long construction_day:long sis_duration_years:money",
    """SELECT CAST(serial_number AS VARCHAR) AS sis_equipment_number, CAST(customer_id AS VARCHAR) AS sis_customer_number,
              equipment_type AS sis_equipment_type, CAST(delivery_date AS DATE) AS sis_start_date, year(delivery_date) AS construction_year,
              month(delivery_date) AS construction_month, day(delivery_date) AS construction_day,
              CASE WHEN serial_number % 9 <> 4 THEN serial_number % 30 + 0.5 END AS sis_duration_years
       FROM v_installed_base
       QUALIFY row_number() OVER (PARTITION BY serial_number ORDER BY delivery_date, equipment_type, equipment_group, customer_id) = 1""",
)
def clean_installed_base(t):
    """The installed base as a text extract: day-first dates, decimal commas, some durations that are no number."""
    years = F.concat((F.col("serial_number") % 30).cast("string"), F.lit(",5"))
    raw = t.view("v_installed_base").select(
        F.col("serial_number").cast("string").alias("Equipment Number"),
        F.col("customer_id").cast("string").alias("Customer Number"),
        F.concat(F.lit(" "), F.regexp_replace("equipment_type", " ", "   ")).alias("Equipment Type"),
        F.date_format("delivery_date", "dd.MM.yyyy").alias("Start up 1 date"),
        F.when(F.col("serial_number") % 9 != 4, years).otherwise("open").alias("Summe von Duration Years"),
        F.struct("delivery_date", "equipment_type", "equipment_group", "customer_id").alias("_line"),
    )
    return cleaners.clean(t.stored("installed_base", raw), cleaners.INSTALLED_BASE, ["_line"])


@query(
    "integrity_profile",
    "column:text status:text rows_before:long rows_after:long missing_count_before:long missing_count_after:long missing_percent_after:money"
    " min_after:money mean_after:money max_after:money violations_after:long",
    """WITH o AS (SELECT *, CASE WHEN to_id % 4 <> 0 THEN to_id % 900 + 0.5 END AS v,
                         CASE WHEN to_id % 6 <> 0 THEN to_close_date END AS e FROM v_opportunities),
            c AS (SELECT 'to_id' AS "column", 'both' AS status, 0 AS missing, 0 AS lost, NULL AS lo, NULL AS mean, NULL AS hi, NULL AS bad
                  UNION ALL SELECT 'to_start_date', 'both', 0, 0, (SELECT min(to_start_date - DATE '1970-01-01') FROM o),
                                   (SELECT avg(to_start_date - DATE '1970-01-01') FROM o), (SELECT max(to_start_date - DATE '1970-01-01') FROM o), NULL
                  UNION ALL SELECT 'to_close_date', 'both', (SELECT count(*) - count(e) FROM o), (SELECT count(*) - count(e) FROM o),
                                   (SELECT min(e - DATE '1970-01-01') FROM o), (SELECT avg(e - DATE '1970-01-01') FROM o), (SELECT max(e - DATE '1970-01-01') FROM o), NULL
                  UNION ALL SELECT 'to_expected_value', 'both', 0, (SELECT count(*) - count(v) FROM o), (SELECT min(v) FROM o), (SELECT avg(v) FROM o), (SELECT max(v) FROM o), NULL
                  UNION ALL SELECT 'empty', 'dropped', (SELECT count(*) FROM o), NULL, NULL, NULL, NULL, NULL
                  UNION ALL SELECT 'to_start_date > to_close_date', 'added', NULL, (SELECT count(*) - count(e) FROM o), NULL, NULL, NULL,
                                   (SELECT count(*) FILTER (to_start_date > e) FROM o))
       SELECT "column", status, CASE WHEN status <> 'added' THEN 2 * n END AS rows_before, CASE WHEN status <> 'dropped' THEN n END AS rows_after,
              2 * missing AS missing_count_before, lost AS missing_count_after, round(100.0 * lost / n, 2) AS missing_percent_after,
              lo AS min_after, mean AS mean_after, hi AS max_after, bad AS violations_after
       FROM c CROSS JOIN (SELECT count(*) AS n FROM o)""",
)
def integrity_profile(t):
    """The profile of opportunities as extracted, merged from the stored states of seven parts, beside that of the cleaned ones."""
    raw = t.view("v_opportunities").select(
        F.col("to_id").cast("string").alias("to_id"),
        F.date_format("to_start_date", "yyyy-MM-dd").alias("to_start_date"),
        F.when(F.col("to_id") % 6 != 0, F.date_format("to_close_date", "yyyy-MM-dd")).alias("to_close_date"),
        F.when(F.col("to_id") % 4 != 0, F.concat((F.col("to_id") % 900).cast("string"), F.lit(".5"))).otherwise("open").alias("to_expected_value"),
        F.lit(None).cast("string").alias("empty"),
        F.col("to_id").alias("_line"),
    )
    copies = t.stored("integrity", raw.withColumn("_block", F.lit(0)).unionByName(raw.withColumn("_block", F.lit(1))))
    parts = copies.withColumn("_part", F.col("_line") % 7).drop("_line", "_block")
    states = t.stored("integrity_states", Q.profile_states(parts, ["_part"]))
    cleaned = cleaners.clean(copies, cleaners.OPPORTUNITIES, ["_line", "_block"])
    before, after = Q.merge_states(states), Q.profile_states(cleaned)
    report = Q.compare_profiles(Q.integrity_profile(before), Q.integrity_profile(after))
    shown = ["to_id", "to_start_date", "to_close_date", "to_expected_value", "empty", "to_start_date > to_close_date"]
    return report.where(F.col("column").isin(shown))


@query(
    "clean_software_sales",
    "ts_customer_id:text ts_pur_date:date ts_year:long ts_generation:text ts_revenue:money",
    """SELECT CAST(ts_customer_id AS VARCHAR) AS ts_customer_id, make_date(ts_year, 3, 15) AS ts_pur_date, ts_year, ts_generation,
              CAST(floor(ts_revenue) AS BIGINT) + 0.5 AS ts_revenue FROM v_software_sales""",
)
def clean_software_sales(t):
    """Software sales as a text extract with foreign headers, day-first dates and decimal commas; equal sales stay apart."""
    raw = t.view("v_software_sales").select(
        F.col("ts_customer_id").cast("string").alias("endkunde"),
        F.concat(F.lit("15.03."), F.col("ts_year").cast("string")).alias("gultig_ab"),
        F.concat(F.lit(" "), F.regexp_replace("ts_generation", " ", "  ")).alias("x5_generation"),
        F.concat(F.floor("ts_revenue").cast("string"), F.lit(",5")).alias("umsatz"),
    )
    return cleaners.clean(t.stored("software_sales", raw), cleaners.SOFTWARE_SALES, ())


@query(
    "clean_meetings",
    "id:text account_id:text start_date_time:ts end_date_time:ts meeting_duration_minutes:ratio meeting_starting_year:long"
    " meeting_starting_month:long meeting_starting_day:long meeting_starting_time:text meeting_weekday:text",
    """SELECT CAST(event_id AS VARCHAR) AS id, CAST(account_id AS VARCHAR) AS account_id, s AS start_date_time,
              s + to_minutes(event_id % 700) AS end_date_time, event_id % 700 AS meeting_duration_minutes, year(s) AS meeting_starting_year,
              month(s) AS meeting_starting_month, day(s) AS meeting_starting_day, strftime(s, '%H:%M:%S') AS meeting_starting_time,
              dayname(s) AS meeting_weekday
       FROM (SELECT *, date_trunc('second', ts) AS s FROM v_activities WHERE activity_type = 'Meeting')""",
)
def clean_meetings(t):
    """Meetings as a text extract with every row twice."""
    raw = _activity_extract(t.view("v_activities").where("activity_type = 'Meeting'"))
    copies = raw.withColumn("_block", F.lit(0)).unionByName(raw.withColumn("_block", F.lit(1)))
    return cleaners.clean(t.stored("meetings", copies), cleaners.MEETINGS, ["_line", "_block"])


def _activity_extract(events):
    start = F.date_trunc("second", F.col("ts"))
    end = F.timestamp_add("MINUTE", (F.col("event_id") % 700).cast("int"), start)
    return events.select(
        F.col("event_id").cast("string").alias("ID"),
        F.concat(F.lit(" "), F.col("account_id").cast("string")).alias("Account ID"),
        F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("Start Date Time"),
        F.date_format(end, "yyyy-MM-dd HH:mm:ss").alias("End Date Time"),
        F.col("event_id").alias("_line"),
    )


@query(
    "clean_other_activities",
    "id:text account_id:text start_date_time:ts activity_duration_minutes:ratio activity_year:long activity_month:long activity_day:long"
    " activity_weekday:text activity_hour:long is_business_hours:bool",
    """SELECT CAST(event_id AS VARCHAR) AS id, CAST(account_id AS VARCHAR) AS account_id, s AS start_date_time,
              event_id % 700 AS activity_duration_minutes, year(s) AS activity_year, month(s) AS activity_month, day(s) AS activity_day,
              dayname(s) AS activity_weekday, hour(s) AS activity_hour, hour(s) BETWEEN 9 AND 17 AS is_business_hours
       FROM (SELECT *, date_trunc('second', ts) AS s FROM v_activities WHERE activity_type NOT IN ('Meeting', 'E-Mail'))""",
)
def clean_other_activities(t):
    raw = _activity_extract(t.view("v_activities").where("activity_type NOT IN ('Meeting', 'E-Mail')"))
    return cleaners.clean(t.stored("other_activities", raw), cleaners.OTHER_ACTIVITIES, ["_line"])


@query(
    "clean_mails",
    "id:text account_id:text sent_on:ts sent_year:long sent_month:long sent_day:long sent_time:text sent_weekday:text sent_hour:long"
    " is_business_hours:bool subject_length:long has_attachment:bool is_reply:bool",
    """SELECT CAST(event_id AS VARCHAR) AS id, CAST(account_id AS VARCHAR) AS account_id, s AS sent_on, year(s) AS sent_year, month(s) AS sent_month,
              day(s) AS sent_day, strftime(s, '%H:%M:%S') AS sent_time, dayname(s) AS sent_weekday, hour(s) AS sent_hour,
              hour(s) BETWEEN 8 AND 17 AS is_business_hours, length(subject) AS subject_length, event_id % 5 = 0 AS has_attachment, event_id % 3 = 0 AS is_reply
       FROM (SELECT *, date_trunc('second', ts) AS s,
                    concat(CASE WHEN event_id % 3 = 0 THEN 'RE: ' ELSE '' END, 'order ', event_id, CASE WHEN event_id % 5 = 0 THEN ' offer enclosed' ELSE '' END) AS subject
             FROM v_activities WHERE activity_type = 'E-Mail')""",
)
def clean_mails(t):
    """Mails as a text extract; subjects with doubled spaces."""
    reply, offer = F.when(F.col("event_id") % 3 == 0, "RE: ").otherwise(""), F.when(F.col("event_id") % 5 == 0, "  offer enclosed ").otherwise("")
    raw = t.view("v_activities").where("activity_type = 'E-Mail'").select(
        F.col("event_id").cast("string").alias("ID"),
        F.col("account_id").cast("string").alias("Account ID"),
        F.date_format(F.date_trunc("second", F.col("ts")), "yyyy-MM-dd HH:mm:ss").alias("Sent On"),
        F.concat(reply, F.lit("order  "), F.col("event_id").cast("string"), offer).alias("Subject"),
        F.col("event_id").alias("_line"),
    )
    return cleaners.clean(t.stored("mails", raw), cleaners.MAILS, ["_line"])


@query(
    "clean_registered_products",
    "id_reg_prod:text account_id_reg_prod:text completion_date_reg_prod:date completion_year:long completion_month:long completion_day:long"
    " warranty_end_date_reg_prod:date warranty_status:text warranty_days_remaining:long",
    """SELECT CAST(to_id AS VARCHAR) AS id_reg_prod, CAST(to_customer_id AS VARCHAR) AS account_id_reg_prod, to_start_date AS completion_date_reg_prod,
              year(to_start_date) AS completion_year, month(to_start_date) AS completion_month, day(to_start_date) AS completion_day,
              w AS warranty_end_date_reg_prod, CASE WHEN w IS NULL THEN 'unknown' WHEN w < DATE '1997-01-01' THEN 'expired' ELSE 'active' END AS warranty_status,
              w - DATE '1997-01-01' AS warranty_days_remaining
       FROM (SELECT *, CASE WHEN to_id % 7 <> 3 THEN to_close_date END AS w FROM v_opportunities)""",
)
def clean_registered_products(t):
    """Registered products as a text extract; some without a warranty."""
    raw = t.view("v_opportunities").select(
        F.col("to_id").cast("string").alias("ID reg prod"),
        F.col("to_customer_id").cast("string").alias("Account ID reg prod"),
        F.date_format("to_start_date", "dd.MM.yyyy").alias("Completion date reg prod"),
        F.when(F.col("to_id") % 7 != 3, F.date_format("to_close_date", "dd.MM.yyyy")).alias("Warranty end date reg prod"),
        F.col("to_id").alias("_line"),
    )
    return cleaners.clean(t.stored("registered_products", raw), cleaners.registered_products("1997-01-01"), ["_line"])


@query(
    "clean_quotes",
    "tq_id:text tq_customer_id:text tq_status:text tq_total_value:money tq_date:date tq_year:long",
    """SELECT CAST(to_id AS VARCHAR) AS tq_id, CAST(to_customer_id AS VARCHAR) AS tq_customer_id, to_opportunity_status AS tq_status,
              CASE WHEN to_id % 8 <> 5 THEN to_id % 900 + 0.25 END AS tq_total_value, to_start_date AS tq_date, year(to_start_date) AS tq_year
       FROM v_opportunities""",
)
def clean_quotes(t):
    """Quotes as a text extract with every row twice; some totals are no number."""
    total = F.concat(F.lit("$ "), (F.col("to_id") % 900).cast("string"), F.lit(".25"))
    raw = t.view("v_opportunities").select(
        F.col("to_id").cast("string").alias("ID"),
        F.col("to_customer_id").cast("string").alias("Customer ID"),
        F.concat(F.lit("  "), "to_opportunity_status").alias("Status"),
        F.when(F.col("to_id") % 8 != 5, total).otherwise("on request").alias("Total"),
        F.date_format("to_start_date", "dd.MM.yyyy").alias("Date"),
        F.col("to_id").alias("_line"),
    )
    copies = raw.withColumn("_block", F.lit(0)).unionByName(raw.withColumn("_block", F.lit(1)))
    return cleaners.clean(t.stored("quotes", copies), cleaners.QUOTES, ["_line", "_block"])


@query(
    "clean_missions",
    "mission_id:text case_number:text mission_year:long mission_calendar_week:long waiting_time_days:money missions_delayed:bool priority:text",
    """SELECT CAST(to_id AS VARCHAR) AS mission_id, CAST(to_customer_id AS VARCHAR) AS case_number, year(to_start_date) AS mission_year,
              to_id % 52 + 1 AS mission_calendar_week, CASE WHEN to_id % 9 <> 2 THEN to_id % 30 + 0.5 END AS waiting_time_days,
              to_id % 3 = 0 AS missions_delayed, CASE WHEN to_id % 4 = 0 THEN 'High' ELSE 'Default' END AS priority
       FROM v_opportunities""",
)
def clean_missions(t):
    """Missions as a text extract: calendar weeks, decimal commas, flags in words."""
    raw = t.view("v_opportunities").select(
        F.col("to_id").cast("string").alias("Mission ID"),
        F.col("to_customer_id").cast("string").alias("Case Number"),
        F.concat_ws("/", F.year("to_start_date"), F.col("to_id") % 52 + 1).alias("CW"),
        F.when(F.col("to_id") % 9 != 2, F.concat((F.col("to_id") % 30).cast("string"), F.lit(",5"))).alias("Waiting time days"),
        F.when(F.col("to_id") % 3 == 0, "Yes").otherwise("no").alias("Missions delayed"),
        F.when(F.col("to_id") % 4 == 0, "High ").otherwise(" Default").alias("Priority"),
        F.col("to_id").alias("_line"),
    )
    return cleaners.clean(t.stored("missions", raw), cleaners.MISSIONS, ["_line"])


@query(
    "clean_machine_orders",
    "sm_equipment_number:text sm_purchase_date:date purchase_year:long purchase_month:long purchase_day:long sm_net_value:money sm_document_currency:text",
    """SELECT CAST(to_id AS VARCHAR) AS sm_equipment_number, to_start_date AS sm_purchase_date, year(to_start_date) AS purchase_year,
              month(to_start_date) AS purchase_month, day(to_start_date) AS purchase_day, to_id % 900 + 0.75 AS sm_net_value, 'EUR' AS sm_document_currency
       FROM v_opportunities""",
)
def clean_machine_orders(t):
    """Machine orders as a text extract with foreign headers and every row twice; purchase dates in two layouts."""
    raw = t.view("v_opportunities").select(
        F.col("to_id").cast("string").alias("Equipmentnummer"),
        F.when(F.col("to_id") % 3 == 0, F.date_format("to_start_date", "yyyy-MM-dd")).otherwise(F.date_format("to_start_date", "dd.MM.yyyy")).alias("Anschaffungsdatum"),
        F.concat((F.col("to_id") % 900).cast("string"), F.lit(",75")).alias("Nettowert"),
        F.lit(" EUR").alias("Belegwahrung"),
        F.col("to_id").alias("_line"),
    )
    copies = raw.withColumn("_block", F.lit(0)).unionByName(raw.withColumn("_block", F.lit(1)))
    return cleaners.clean(t.stored("machine_orders", copies), cleaners.MACHINE_ORDERS, ["_line", "_block"])


@query(
    "clean_contacts",
    "id:text account_id:text function:text created_on:date data_quality_score:ratio",
    """SELECT CAST(to_id AS VARCHAR) AS id, CAST(to_customer_id AS VARCHAR) AS account_id, CASE WHEN to_id % 3 <> 0 THEN 'Head of purchase' END AS function,
              to_start_date AS created_on, CASE WHEN to_id % 3 <> 0 THEN 1.0 ELSE 0.75 END AS data_quality_score
       FROM v_opportunities""",
)
def clean_contacts(t):
    """Contacts as a text extract with every row twice; the share of filled columns is their quality."""
    raw = t.view("v_opportunities").select(
        F.col("to_id").cast("string").alias("ID"),
        F.col("to_customer_id").cast("string").alias("Account ID"),
        F.when(F.col("to_id") % 3 != 0, " Head  of purchase").alias("Function"),
        F.date_format("to_start_date", "dd.MM.yyyy").alias("Created On"),
        F.col("to_id").alias("_line"),
    )
    copies = raw.withColumn("_block", F.lit(0)).unionByName(raw.withColumn("_block", F.lit(1)))
    return cleaners.clean(t.stored("contacts", copies), cleaners.CONTACTS, ["_line", "_block"])
