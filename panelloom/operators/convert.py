"""Text-to-typed conversion decided per column from measured success rates.

``plan_conversion`` runs one aggregation that counts, for every column and candidate
reading, how many rows succeed. The resulting ``ConversionPlan`` is plain data; applying
it is a lazy projection.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from panelloom.functions import parsing as P
from panelloom.functions.logic import join_on_keys
from panelloom.functions.text import blank_to_null
from panelloom.sources.shared import stored

EARLIEST_DATE = "1900-01-01"
LATEST_SERIAL_DATE = "2050-12-31"


@dataclass(frozen=True)
class ConversionSpec:
    """Which columns should become what, and what counts as a success."""

    numeric: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    # Dates read value by value in any layout or as day numbers.
    mixed_dates: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()
    logical: tuple[str, ...] = ()
    category: tuple[str, ...] = ()
    latest_date: str = "2045-12-31"
    min_date_share: float = 0.10
    min_mixed_share: float = 0.5
    min_share: float = 0.05
    # Successes that accept a column whatever their share; only on request, as it depends on size.
    min_count: int | None = None
    min_timestamp_share: float = 0.05

    @property
    def columns(self) -> tuple[str, ...]:
        return self.timestamps + self.mixed_dates + self.dates + self.numeric + self.logical + self.category


@dataclass(frozen=True)
class ConversionPlan:
    """Chosen reading per column (``text`` means: left as it was) and the counts behind it."""

    spec: ConversionSpec
    chosen: Mapping[str, str]
    rows: int = 0
    non_null: Mapping[str, int] = field(default_factory=dict)
    successes: Mapping[tuple[str, str], int] = field(default_factory=dict)

    def apply(self, df: DataFrame, keep_unparsed: bool = False) -> DataFrame:
        """Lazy projection with the winning readings.

        With ``keep_unparsed`` each converted column that holds texts which were not read gets a
        companion ``<column>_unparsed`` with these (NULL elsewhere), so no value is lost.
        """
        changed = {c: reading for c, reading in self.chosen.items() if reading != "text"}
        if not changed:
            return df
        split = _split(df, changed)
        values = {c: _reading(c, reading) for c, reading in changed.items()}
        unread = [c for c in values if self.successes[c, self.chosen[c]] < self.non_null[c]] if keep_unparsed else []
        kept = {f"{c}_unparsed": F.when(values[c].isNull(), F.col(c)) for c in unread}
        typed = split.withColumns(values | kept)
        return typed.select(*df.columns, *kept)


_BY_NAME = {f"date:{x.name}": x for x in P.DATE_LAYOUTS} | {f"timestamp:{x.name}": x for x in P.TIMESTAMP_LAYOUTS}


def _split(df: DataFrame, readings: Mapping[str, str]) -> DataFrame:
    """Add the parts of date and timestamp texts as columns of their own, so that each text
    is taken apart once however many layouts look at it."""
    fields = {}
    for c, reading in readings.items():
        if reading.startswith("date:") or reading in ("mixed_dates", "any_date"):
            fields[f"_fields_{c}"] = P.date_fields(F.col(c))
        elif reading.startswith("timestamp:"):
            fields[f"_fields_{c}"] = P.timestamp_fields(F.col(c))
    return df.withColumns(fields) if fields else df


def _reading(column: str, reading: str) -> Column:
    """The typed value; layouts read the column's parts added by ``_split``."""
    text, fields = F.col(column), F.col(f"_fields_{column}")
    if reading.startswith("date:"):
        return _BY_NAME[reading].date(fields)
    if reading.startswith("timestamp:"):
        return _BY_NAME[reading].timestamp(fields)
    return {
        "text": lambda: text,
        "mixed_dates": lambda: _in_any_layout(fields),
        "any_date": lambda: F.coalesce(_in_any_layout(fields), F.when(_plausible_serial(P.serial_date(text)), P.serial_date(text))),
        "serial_date": lambda: P.serial_date(text),
        "number": lambda: P.number(text),
        "boolean": lambda: P.boolean(text),
        "category": lambda: blank_to_null(text),
    }[reading]()


def _in_any_layout(fields: Column) -> Column:
    """The date by the first layout that reads it.

    Only texts with a part that is not empty are tried, which loses none. The test is a function over an
    array: Spark keeps those, and what is read beside them, out of the one method per stage that would
    hold all layouts of all columns here and be too long (8,000 bytes) for the JVM to compile.
    """
    return F.when(_has_part(fields), F.coalesce(*[x.date(fields) for x in P.DATE_LAYOUTS]))


def _has_part(fields: Column) -> Column:
    return F.exists(fields["parts"], lambda part: part != "")


def _plausible_serial(value: Column) -> Column:
    return (value > F.lit(EARLIEST_DATE).cast("date")) & (value < F.lit(LATEST_SERIAL_DATE).cast("date"))


def _candidates(kind: str) -> list[str]:
    if kind == "dates":
        return [f"date:{x.name}" for x in P.DATE_LAYOUTS] + ["mixed_dates", "serial_date"]
    if kind == "mixed_dates":
        return ["any_date"]
    if kind == "timestamps":
        return [f"timestamp:{x.name}" for x in P.TIMESTAMP_LAYOUTS]
    return {"numeric": ["number"], "logical": ["boolean"], "category": ["category"]}[kind]


def _success(column: str, reading: str, spec: ConversionSpec, value: Column | None = None) -> Column:
    value = _reading(column, reading) if value is None else value
    if reading.startswith("date:") or reading == "any_date":
        low, high = F.lit(EARLIEST_DATE).cast("date"), F.lit(spec.latest_date).cast("date")
        return (value > low) & (value < high)
    if reading == "serial_date":
        return _plausible_serial(value)
    return value.isNotNull()


def _kinds(df: DataFrame, spec: ConversionSpec) -> dict[str, str]:
    """The kind of each text column that a spec names."""
    text = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    kinds = ("timestamps", "mixed_dates", "dates", "numeric", "logical", "category")
    return {c: kind for kind in kinds for c in getattr(spec, kind) if c in text}


def plan_conversion(df: DataFrame, spec: ConversionSpec) -> ConversionPlan:
    """Measure every candidate for every text column in one pass and pick the winners."""
    kinds = _kinds(df, spec)
    if not kinds:
        return ConversionPlan(spec, {})

    pairs = [(c, reading) for c, kind in kinds.items() for reading in _candidates(kind)]
    split = _split(df.select(*kinds), {c: _candidates(kind)[0] for c, kind in kinds.items()})
    # Each layout reads a text once; "in any layout" is then whether one of them did.
    laid_out = {(c, reading): f"_date{i}" for i, (c, reading) in enumerate(pairs) if reading.startswith("date:")}
    if laid_out:
        split = split.withColumns(
            {name: F.when(_has_part(F.col(f"_fields_{c}")), _reading(c, reading)) for (c, reading), name in laid_out.items()}
        )
    values = {pair: F.col(name) for pair, name in laid_out.items()}
    values |= {
        (c, "mixed_dates"): F.coalesce(*[F.col(name) for (of, _), name in laid_out.items() if of == c])
        for c, kind in kinds.items()
        if kind == "dates"
    }
    measured = split.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(kinds)],
        *[F.count_if(_success(c, reading, spec, values.get((c, reading)))).alias(f"s{i}") for i, (c, reading) in enumerate(pairs)],
    ).first()
    rows = measured["rows"]
    non_null = {c: measured[f"n{i}"] for i, c in enumerate(kinds)}
    successes = {pair: measured[f"s{i}"] for i, pair in enumerate(pairs)}
    chosen = {c: _choose(c, kind, rows, non_null[c], successes, spec) for c, kind in kinds.items()}
    return ConversionPlan(spec, chosen, rows, non_null, successes)


def _choose(column, kind, rows, non_null, successes, spec) -> str:
    count = {reading: successes[column, reading] for reading in _candidates(kind)}
    share = {reading: n / non_null if non_null else 0.0 for reading, n in count.items()}
    if kind == "timestamps":
        return next((reading for reading in count if share[reading] > spec.min_timestamp_share), "text")
    if kind == "dates":
        for reading in count:
            if reading.startswith("date:") and share[reading] > spec.min_date_share:
                return reading
        return next((reading for reading in ("mixed_dates", "serial_date") if share[reading] > spec.min_share), "text")
    (reading, n), = count.items()
    if kind == "mixed_dates":
        return reading if share[reading] > spec.min_mixed_share else "text"
    enough = spec.min_count is not None and n > spec.min_count
    return reading if enough or share[reading] > spec.min_share else "text"


def _share_needed(kind: str, reading: str, spec: ConversionSpec) -> float:
    if kind == "timestamps":
        return spec.min_timestamp_share
    if kind == "mixed_dates":
        return spec.min_mixed_share
    return spec.min_date_share if reading.startswith("date:") else spec.min_share


def layout_evidence(df: DataFrame, spec: ConversionSpec, by: str) -> DataFrame:
    """``by, column, reading, rank, needed, non_null, successes``: how often each candidate reads the
    texts of each group (a file, as a rule), in one aggregation. Groups seen apart are merged by
    ``merged_evidence``."""
    kinds = _kinds(df, spec)
    pairs = [(c, kind, k, reading) for c, kind in kinds.items() for k, reading in enumerate(_candidates(kind))]
    split = _split(df.select(by, *kinds), {c: _candidates(kind)[0] for c, kind in kinds.items()})
    counted = split.groupBy(by).agg(
        *[F.count(F.col(c)).alias(f"_n_{c}") for c in kinds],
        *[F.count_if(_success(c, reading, spec)).alias(f"_s{i}") for i, (c, _, _, reading) in enumerate(pairs)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(reading).alias("reading"),
            F.lit(k).alias("rank"),
            F.lit(_share_needed(kind, reading, spec)).alias("needed"),
            F.col(f"_n_{c}").alias("non_null"),
            F.col(f"_s{i}").alias("successes"),
        )
        for i, (c, kind, k, reading) in enumerate(pairs)
    ]
    return counted.select(by, F.explode(F.array(*rows)).alias("e")).select(by, "e.*")


def merged_evidence(evidence: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same counts for fewer groups, or for whole columns."""
    keys = [*by, "column", "reading", "rank", "needed"]
    return evidence.groupBy(*keys).agg(F.sum("non_null").alias("non_null"), F.sum("successes").alias("successes"))


def chosen_layouts(evidence: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by..., column, reading``: of the candidates that read a large enough share the layout that reads
    most (03/04 fits two layouts, its neighbours tell which); without a layout the first reading."""
    enough = evidence.where(F.col("successes") > F.col("needed") * F.col("non_null"))
    no_layout = ~F.col("reading").rlike("^(date|timestamp):")
    order = F.struct(no_layout.alias("a"), F.when(~no_layout, -F.col("successes")).alias("b"), "rank")
    return enough.groupBy(*by, "column").agg(F.min_by("reading", order).alias("reading"))


#: Groups whose choices are sent to every task; with more of them the join is left to the optimiser.
_FEW_GROUPS = 10_000


def convert_by_group(df: DataFrame, spec: ConversionSpec, by: str) -> DataFrame:
    """Typed columns whose reading is chosen for each group, as a source may change its layout from one file
    to the next; a group that shows none by itself follows the whole column.

    Each converted column has a companion ``<column>_unparsed`` with the texts that were not read.
    """
    kinds = _kinds(df, spec)
    if not kinds:
        return df
    evidence = stored(layout_evidence(df, spec, by), "layouts")
    own = chosen_layouts(evidence, [by])
    whole = {r["column"]: r["reading"] for r in chosen_layouts(merged_evidence(evidence)).collect()}
    used = {(r["column"], r["reading"]) for r in own.select("column", "reading").distinct().collect()} | set(whole.items())
    readings = {c: [r for r in _candidates(kind) if (c, r) in used] for c, kind in kinds.items()}
    readings = {c: found for c, found in readings.items() if found}
    choices = own.groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct("column", "reading"))).alias("_layouts"))
    few = len(evidence.select(by).distinct().limit(_FEW_GROUPS + 1).collect()) <= _FEW_GROUPS
    joined = join_on_keys(df, F.broadcast(choices) if few else choices, [by])
    split = _split(joined, {c: _candidates(kinds[c])[0] for c in readings})
    values = {}
    for c, found in readings.items():
        choice = F.coalesce(F.col("_layouts")[c], F.lit(whole.get(c)))
        values[c] = F.coalesce(*[F.when(choice == reading, _reading(c, reading)) for reading in found])
    kept = {f"{c}_unparsed": F.when(v.isNull(), F.col(c)) for c, v in values.items()}
    return split.withColumns(values | kept).select(*df.columns, *kept)


def convert_types(df: DataFrame, spec: ConversionSpec, keep_unparsed: bool = False) -> DataFrame:
    return plan_conversion(df, spec).apply(df, keep_unparsed)


def parse_dates(df: DataFrame, columns: Sequence[str], latest_date: str = "2045-12-31") -> DataFrame:
    return convert_types(df, ConversionSpec(dates=tuple(columns), latest_date=latest_date))


def parse_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return convert_types(df, ConversionSpec(timestamps=tuple(columns)))


def parse_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return convert_types(df, ConversionSpec(numeric=tuple(columns)))


def parse_booleans(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return convert_types(df, ConversionSpec(logical=tuple(columns)))


def to_category(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return convert_types(df, ConversionSpec(category=tuple(columns)))


def excel_serial_to_date(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Columns whose numbers all lie in the plausible day-number range become DATE."""
    columns = [c for c in columns if c in df.columns]
    numbers = {c: F.col(c).try_cast("double") for c in columns}
    stats = df.agg(
        *[F.min(n).alias(f"{c}_min") for c, n in numbers.items()],
        *[F.max(n).alias(f"{c}_max") for c, n in numbers.items()],
        *[F.count_if(F.col(c).isNotNull() & n.isNull()).alias(f"{c}_bad") for c, n in numbers.items()],
    ).first()
    serial = [
        c
        for c in columns
        if stats[f"{c}_bad"] == 0
        and stats[f"{c}_min"] is not None
        and stats[f"{c}_min"] > 10_000
        and stats[f"{c}_max"] < 50_000
    ]
    return df.withColumns({c: P.serial_date(F.col(c)) for c in serial}) if serial else df


def excel_serial_to_timestamp(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: P.serial_timestamp(F.col(c)) for c in columns if c in df.columns})


def parse_calendar_week(df: DataFrame, column: str, prefix: str) -> DataFrame:
    parts = P.calendar_week(F.col(column))
    return df.withColumns({f"{prefix}_year": parts["year"], f"{prefix}_calendar_week": parts["week"]})


def conversion_report(df: DataFrame, plan: ConversionPlan, examples: int = 5) -> DataFrame:
    """Per column: chosen reading, counts, success share and a few distinct failing texts.

    The counts come from the plan; the failing texts are the smallest ``examples`` distinct
    ones. The row-number filter is pushed below the shuffle, so a column with many failures
    sends only its top texts.
    """
    spark = df.sparkSession
    header = spark.createDataFrame(
        [
            (c, reading, plan.non_null[c], plan.successes.get((c, reading), 0))
            for c, reading in plan.chosen.items()
        ],
        "column string, reading string, non_null bigint, valid bigint",
    )
    changed = {c: reading for c, reading in plan.chosen.items() if reading != "text"}
    readings = [
        F.struct(F.lit(c).alias("column"), F.col(c).alias("text"), _reading(c, reading).isNull().alias("failed"))
        for c, reading in changed.items()
    ]
    summary = header.select(
        "*",
        F.when(F.col("reading") == "text", 0).otherwise(F.col("non_null") - F.col("valid")).cast("long").alias("nulls_introduced"),
        F.when(F.col("non_null") > 0, 100.0 * F.col("valid") / F.col("non_null")).alias("success_pct"),
    )
    if not readings:
        return summary.withColumn("examples", F.lit(None).cast("string"))
    failed = (
        _split(df.select(*changed), changed)
        .select(F.explode(F.array(*readings)).alias("r"))
        .select("r.*")
        .filter(F.col("failed") & F.col("text").isNotNull())
        .groupBy("column", "text")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    top = failed.withColumn("_rank", F.row_number().over(Window.partitionBy("column").orderBy("text")))
    shown = (
        top.filter(F.col("_rank") <= examples)
        .groupBy("column")
        .agg(F.array_join(F.sort_array(F.collect_list("text")), " | ").alias("examples"))
    )
    return summary.join(shown, "column", "left")
