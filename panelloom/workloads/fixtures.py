"""Business-like views over the test tables, written once in SQL both engines understand.

Every view reads its whole tables. Spark sees them as DataFrames through ``Tables``, the
oracles as common table expressions.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.sources.layers import read_layer, remove_at_exit, shared_folder, write_layer
from panelloom.sources.shared import size_of

BASE_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "conversations",
)

VIEWS = {
    "v_customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS main_sector,
               CASE WHEN c_acctbal >= 6000 THEN 'A' WHEN c_acctbal >= 2000 THEN 'B' ELSE 'C' END AS abc_classification,
               n_name AS country,
               CASE WHEN c_custkey % 10 = 0 THEN NULL
                    ELSE concat('S', CAST(c_custkey AS VARCHAR(20))) END AS customer_sap_id
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "v_opportunities": """
        SELECT o_orderkey AS to_id, o_custkey AS to_customer_id, CAST(o_orderdate AS DATE) AS to_start_date,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 120 - 5 AS INT) AS to_close_date,
               CASE WHEN o_orderstatus = 'F' THEN 'Won' WHEN o_orderstatus = 'O' THEN 'Open'
                    WHEN o_orderkey % 3 = 0 THEN 'Lost' WHEN o_orderkey % 3 = 1 THEN 'Lost (autom.)'
                    ELSE 'Not realized' END AS to_opportunity_status,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Accessories' WHEN '2' THEN 'Punching machine'
                    WHEN '3' THEN 'Laser machine' WHEN '4' THEN 'Software' ELSE 'Service' END AS to_product_category,
               o_totalprice AS to_expected_value
        FROM orders""",
    "v_software_sales": """
        SELECT o_custkey AS ts_customer_id, CAST(year(l_shipdate) AS BIGINT) AS ts_year,
               concat(p_type, ' ', p_brand) AS ts_generation, l_extendedprice * (1 - l_discount) AS ts_revenue
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "v_software_by_sap_id": """
        SELECT concat('S', CAST(o_custkey AS VARCHAR(20))) AS ts_customer_id,
               CAST(year(l_shipdate) AS BIGINT) AS ts_year,
               concat(p_type, ' ', p_brand, ' ', CAST(p_size AS VARCHAR(10))) AS ts_generation,
               l_extendedprice * (1 - l_discount) AS ts_revenue
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "v_cases": """
        SELECT l_orderkey * 10 + l_linenumber AS sc_case_number, o_custkey AS sc_customer_number,
               CAST(year(l_shipdate) AS BIGINT) AS case_year,
               CASE l_returnflag WHEN 'R' THEN 'Breakdown' WHEN 'A' THEN 'Complaint'
                    ELSE CASE WHEN l_linenumber = 1 THEN 'Failure' ELSE 'Inquiry' END END AS sc_case_type,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'High' WHEN '2' THEN 'High' WHEN '5' THEN 'Low'
                    ELSE 'Default' END AS sc_priority,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS sc_reaction_time,
               CASE WHEN l_tax > 0.06 THEN 1 ELSE 0 END AS sc_delayed_callbacks
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "v_cases_by_sap_id": """
        SELECT concat('S', CAST(sc_customer_number AS VARCHAR(20))) AS sc_customer_number, case_year, sc_case_type,
               sc_priority, sc_reaction_time, sc_delayed_callbacks
        FROM v_cases""",
    "v_missions": """
        SELECT o_custkey AS mission_id, CAST(year(l_shipdate) AS BIGINT) AS mission_year,
               l_quantity AS waiting_time_days,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount * 100 END AS working_time_h,
               CASE WHEN l_tax > 0.06 THEN 'Mission delayed' ELSE 'On time' END AS missions_delayed
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "v_installed_base": """
        SELECT l_orderkey * 10 + l_linenumber AS serial_number, o_custkey AS customer_id, l_shipdate AS delivery_date,
               CAST(year(l_shipdate) AS BIGINT) AS construction_year, p_type AS equipment_type, p_brand AS equipment_group
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "v_registered_products": """
        SELECT o_custkey AS customer_id, CAST(year(l_shipdate) AS BIGINT) AS completion_year,
               CASE l_returnflag WHEN 'A' THEN 'ERP Registered Product' WHEN 'N' THEN 'Manual Registered Product'
                    ELSE 'Registered Competitor Product' END AS category
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "v_activities": """
        SELECT event_id, user_id AS account_id, ts, CAST(ts AS DATE) AS day,
               CAST(1995 + event_id % 7 AS BIGINT) AS activity_year,
               CASE event_type WHEN 'purchase' THEN 'Meeting' WHEN 'click' THEN 'Phone Call' WHEN 'view' THEN 'E-Mail'
                    WHEN 'signup' THEN 'Letter' ELSE 'Fax' END AS activity_type,
               CASE WHEN event_id % 5 = 0 THEN 'Open' ELSE 'Completed' END AS status,
               CASE event_id % 4 WHEN 0 THEN 'Urgent' WHEN 1 THEN 'Normal' WHEN 2 THEN 'Low' ELSE NULL END AS priority,
               value AS duration_minutes
        FROM events""",
    "v_meetings": """
        SELECT event_id AS id, account_id, activity_year AS meeting_starting_year, status,
               duration_minutes AS meeting_duration_minutes, day
        FROM v_activities WHERE activity_type = 'Meeting'""",
    "v_mail_log": """
        SELECT event_id AS id, account_id, activity_year AS sent_year, priority, day
        FROM v_activities WHERE activity_type = 'E-Mail'""",
    "v_other_activities": """
        SELECT a.event_id AS id, c.c_name AS account, a.activity_year, a.activity_type AS acitivy_type
        FROM v_activities a LEFT JOIN customer c ON a.account_id = c.c_custkey
        WHERE a.activity_type NOT IN ('Meeting', 'E-Mail')""",
    "v_mails": """
        SELECT conv_id, turn,
               concat(CASE turn % 3 WHEN 0 THEN 're: ' WHEN 1 THEN 'FW: ' ELSE '' END, text) AS subject
        FROM conversations""",
    "v_survey": """
        SELECT p_partkey AS respondent_id, p_size % 7 + 1 AS core_competency,
               CAST(p_partkey % 7 + 1 AS INT) AS hardware_proximity,
               CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE (p_size + 3) % 7 + 1 END AS competitor_count,
               (p_size * 2) % 7 + 1 AS competitor_quality
        FROM part""",
    "v_messy": """
        SELECT o_orderkey AS id,
               CAST(CASE o_orderkey % 3 WHEN 0 THEN NULL ELSE o_orderkey END AS VARCHAR(20)) AS maybe_id,
               concat(' ', substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), 9, 2), '.',
                      substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), 6, 2), '.',
                      substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), 1, 4)) AS date_text,
               CAST(34700 + o_orderkey % 2000 AS VARCHAR(10)) AS serial_text,
               concat(CASE o_orderkey % 4 WHEN 0 THEN '$ ' ELSE '' END, CAST(o_orderkey % 900 + 100 AS VARCHAR(10)),
                      CASE o_orderkey % 4 WHEN 1 THEN ',50' WHEN 2 THEN '%' WHEN 3 THEN ' n/a' ELSE '' END) AS amount_text,
               CASE o_orderkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN ' X ' WHEN 3 THEN ''
                    ELSE 'maybe' END AS flag_text,
               concat(CAST(1995 + o_orderkey % 7 AS VARCHAR(4)), '/', CAST(o_orderkey % 52 + 1 AS VARCHAR(2))) AS cw_text,
               concat('  ', o_orderpriority, '   x ') AS note, CAST(NULL AS VARCHAR(10)) AS empty_col
        FROM orders""",
    "v_messy_times": """
        SELECT o_orderkey AS id,
               concat(substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), 9, 2), '/',
                      substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), 6, 2), '/',
                      substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), 1, 4), ' ',
                      CAST(10 + o_orderkey % 12 AS VARCHAR(2)), ':', CAST(10 + o_orderkey % 49 AS VARCHAR(2)), ':30') AS time_text,
               CASE o_orderkey % 5
                    WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10))
                    WHEN 1 THEN replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), '-', '/')
                    WHEN 2 THEN concat('on ', CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)))
                    WHEN 3 THEN 'not known' ELSE NULL END AS date_text,
               concat(CAST(34700 + o_orderkey % 2000 AS VARCHAR(10)), CASE o_orderkey % 4 WHEN 0 THEN '.25' WHEN 1 THEN '.5'
                      WHEN 2 THEN '' ELSE 'x' END) AS serial_text
        FROM orders""",
    "v_order_copies": """
        SELECT o_orderkey % 5000 AS to_id, CAST(o_orderdate AS DATE) AS to_start_date, o_orderkey AS _line,
               o_totalprice AS amount, o_orderstatus AS status
        FROM orders""",
}


LINES = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"

#: Bytes of line files that one task of a join by order should hold.
LINES_PER_TASK = 8 << 20


def _uses(sql: str, name: str) -> bool:
    return re.search(rf"\b{name}\b", sql) is not None


def _on_lines(sql: str) -> str:
    """A view of lines, over the stored join in place of the tables."""
    return sql.replace(LINES, "FROM lines")


class Tables:
    """The test tables of one scale factor and the views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._known: dict[str, DataFrame] = {}
        self._share_lines = False

    def table(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._known[name]

    def view(self, name: str) -> DataFrame:
        if name not in self._known:
            sql = VIEWS[name]
            if self._share_lines:
                sql = _on_lines(sql)
            inputs = {t: self.table(t) for t in BASE_TABLES if _uses(sql, t)}
            inputs |= {v: self.view(v) for v in VIEWS if v != name and _uses(sql, v)}
            if LINES in sql:
                inputs["lineitem"] = self._lines_by_order()
            if _uses(sql, "lines"):
                inputs["lines"] = self._lines()
            for source in inputs:
                sql = re.sub(rf"(FROM|JOIN) {source}\b", rf"\1 {{{source}}}", sql)
            self._known[name] = self.spark.sql(sql, **inputs)
        return self._known[name]

    def share_lines(self) -> Tables:
        """These tables with one stored join of lines and orders behind all views of lines.

        For queries that take several of these views: each would join the lines anew, as each reads
        other columns of them. Views asked for before are not kept.
        """
        shared = Tables(self.spark, self.sf_dir)
        shared._share_lines = True
        return shared

    def _lines_by_order(self) -> DataFrame:
        """The lines, dealt by order into tasks whose number grows with the files, so that the memory of
        a task that joins and counts them does not. Few lines are left to the join."""
        lines = self.table("lineitem")
        tasks = -(-size_of(self.spark, f"{self.sf_dir}/lineitem.parquet") // LINES_PER_TASK)
        return lines.repartition(tasks, "l_orderkey") if tasks > self.spark.sparkContext.defaultParallelism else lines

    def _lines(self) -> DataFrame:
        """The stored join of lines and orders, with the columns that views of lines read."""
        if "lines" not in self._known:
            sql = " ".join(_on_lines(v) for v in VIEWS.values() if LINES in v)
            lines = self._lines_by_order().join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            self._known["lines"] = self.stored("lines", lines.select(*[c for c in lines.columns if _uses(sql, c)]))
        return self._known["lines"]

    def scratch(self, name: str) -> str:
        """A fresh folder in the cluster's shared directory, removed when the program ends."""
        path = f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex}"
        remove_at_exit(self.spark, path)
        return path

    def stored(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written as a layer and read back, for steps that pass over it several times."""
        root = self.scratch(name)
        write_layer(df, root, "interim", name, compression="zstd")
        return read_layer(self.spark, root, "interim", name)
