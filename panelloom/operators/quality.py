"""Profiling and data-quality checks. Each profile is one pass over the data."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType

from panelloom.functions.logic import join_on_keys
from panelloom.operators.ranking import quantiles, to_long


def _stacked(wide: DataFrame, rows: Mapping[str, Sequence], fields: Sequence[str], key: str = "column") -> DataFrame:
    """Turn a one-row aggregate into one row per key without another pass."""
    structs = [
        F.struct(F.lit(name).alias(key), *[c.alias(f) for f, c in zip(fields, columns)])
        for name, columns in rows.items()
    ]
    return wide.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def missing_profile(df: DataFrame, top: int | None = None) -> DataFrame:
    """NULL count and share of every column (or the ``top`` ones), most affected first."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    )
    missing = {c: F.col("rows") - F.col(f"n{i}") for i, c in enumerate(df.columns)}
    out = _stacked(
        counts,
        {c: (m, F.when(F.col("rows") > 0, F.round(100.0 * m / F.col("rows"), 2))) for c, m in missing.items()},
        ("missing_count", "missing_percent"),
    ).orderBy(F.desc("missing_count"), "column")
    return out.limit(top) if top is not None else out


def distinct_profile(df: DataFrame, pattern: str = "id$|customer|account", approximate: bool = False) -> DataFrame:
    """Number of distinct values of id-like columns; NULL counts as one value."""
    columns = [c for c in df.columns if re.search(pattern, c, re.IGNORECASE)]
    count = F.approx_count_distinct if approximate else F.count_distinct
    wide = df.agg(
        *[count(F.col(c)).alias(f"d{i}") for i, c in enumerate(columns)],
        *[F.max(F.col(c).isNull().cast("long")).alias(f"m{i}") for i, c in enumerate(columns)],
    )
    values = {c: (F.col(f"d{i}") + F.coalesce(F.col(f"m{i}"), F.lit(0)),) for i, c in enumerate(columns)}
    return _stacked(wide, values, ("n_distinct",))


def date_pairs(df: DataFrame) -> list[tuple[str, str]]:
    """Every start-like x end-like pair among DATE columns named ``...date`` or ``...time``."""
    dates = [
        f.name for f in df.schema if isinstance(f.dataType, DateType) and re.search("date$|time$", f.name, re.IGNORECASE)
    ]
    starts = [c for c in dates if re.search("start|begin", c, re.IGNORECASE)]
    ends = [c for c in dates if re.search("end|close|finish", c, re.IGNORECASE)]
    return [(s, e) for s in starts for e in ends]


def date_order_check(df: DataFrame, pairs: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """Rows where the start lies after the end, for all pairs in one aggregation."""
    pairs = date_pairs(df) if pairs is None else list(pairs)
    wide = df.agg(
        *[F.count_if(F.col(s).isNotNull() & F.col(e).isNotNull()).alias(f"b{i}") for i, (s, e) in enumerate(pairs)],
        *[F.count_if(F.col(s) > F.col(e)).alias(f"v{i}") for i, (s, e) in enumerate(pairs)],
    )
    rows = {
        f"{s}|{e}": (
            F.lit(s),
            F.lit(e),
            F.col(f"b{i}"),
            F.col(f"v{i}"),
            F.when(F.col(f"b{i}") > 0, F.round(100.0 * F.col(f"v{i}") / F.col(f"b{i}"), 2)),
        )
        for i, (s, e) in enumerate(pairs)
    }
    fields = ("start_column", "end_column", "both_present", "violations", "violation_percent")
    return _stacked(wide, rows, fields, key="pair").drop("pair")


def type_profile(df: DataFrame, expected: Iterable[str] = ()) -> DataFrame:
    """Columns per type, plus expected columns that are absent (schema only, no job)."""
    counts: dict[str, int] = {}
    for f in df.schema:
        counts[f.dataType.simpleString()] = counts.get(f.dataType.simpleString(), 0) + 1
    rows = [("type", t, n) for t, n in counts.items()]
    rows += [("missing_column", c, 1) for c in expected if c not in df.columns]
    return df.sparkSession.createDataFrame(rows, "item string, name string, n bigint")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def numeric_summary(
    df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = (), approximate: bool = False
) -> DataFrame:
    """Min, quartiles (or estimates of them), mean, max and number of missing values per column (and group)."""
    columns = list(columns or numeric_columns(df))
    value = F.col("value")
    basic = (
        to_long(df, columns, by)
        .groupBy(*by, "column")
        .agg(
            F.min(value).alias("min"),
            F.avg(value).alias("mean"),
            F.max(value).alias("max"),
            F.count_if(value.isNull()).alias("n_missing"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )
    ranks = quantiles(df, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by, approximate)
    return join_on_keys(basic, ranks, [*by, "column"])


def box_stats(
    df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = (), approximate: bool = False
) -> DataFrame:
    """Quartiles, whisker ends (furthest value within 1.5 IQR) and outlier count."""
    columns = list(columns or numeric_columns(df))
    box = quantiles(df, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by, approximate)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    fences = box.withColumns({"low_fence": F.col("q1") - reach, "high_fence": F.col("q3") + reach})
    # Without groups the fences are one row per column name: bounded by the schema.
    side = F.broadcast(fences) if not by else fences
    long = to_long(df, columns, by).filter(F.col("value").isNotNull())
    value = F.col("value")
    inside = value.between(F.col("low_fence"), F.col("high_fence"))
    return (
        join_on_keys(long, side, [*by, "column"], "inner")
        .groupBy(*by, "column", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
    )


def flag_date_inconsistency(df: DataFrame, start: str, end: str, out: str = "date_inconsistency") -> DataFrame:
    return df.withColumn(out, F.coalesce(F.col(start) > F.col(end), F.lit(False)))


def row_completeness(df: DataFrame, out: str = "data_quality_score") -> DataFrame:
    """Share of columns with a value, per row."""
    present = sum((F.col(c).isNotNull().cast("int") for c in df.columns), F.lit(0))
    return df.withColumn(out, present / F.lit(float(len(df.columns))))


def cleaning_summary(datasets: Mapping[str, tuple[DataFrame | None, DataFrame | None]]) -> DataFrame:
    """Rows before and after cleaning per dataset; a dataset without result is an error."""
    parts = []
    for name, (raw, cleaned) in datasets.items():
        for stage, df in (("raw", raw), ("cleaned", cleaned)):
            if df is not None:
                counted = df.agg(F.count(F.lit(1)).alias("n"))
                parts.append(counted.select(F.lit(name).alias("dataset"), F.lit(stage).alias("stage"), "n"))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    rows = stacked.groupBy("dataset").agg(
        F.max(F.when(F.col("stage") == "raw", F.col("n"))).alias("rows_raw"),
        F.max(F.when(F.col("stage") == "cleaned", F.col("n"))).alias("rows_cleaned"),
    )
    return rows.withColumn("status", F.when(F.col("rows_cleaned").isNotNull(), "success").otherwise("error"))


def ingest_warnings(df: DataFrame, group: str, failed: str) -> DataFrame:
    """Whether any row of a source group failed to parse, and how many did."""
    return df.groupBy(group).agg(
        F.coalesce(F.bool_or(F.col(failed)), F.lit(False)).alias("has_warnings"),
        F.count_if(F.col(failed)).alias("n_failed"),
    )


def sample_values(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    """The ``n`` smallest distinct values over all rows: the same ones on every run."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column).limit(n)


def integrity_check(df: DataFrame, expected: Iterable[str] = ()) -> dict[str, DataFrame]:
    """The profiles that are taken before and after cleaning."""
    out = {
        "types": type_profile(df, expected),
        "missing": missing_profile(df),
        "distinct": distinct_profile(df) if any(re.search("id$|customer|account", c, re.I) for c in df.columns) else None,
        "dates": date_order_check(df) if date_pairs(df) else None,
        "numbers": numeric_summary(df) if numeric_columns(df) else None,
        "boxes": box_stats(df) if numeric_columns(df) else None,
    }
    return {name: profile for name, profile in out.items() if profile is not None}


def profile_states(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What the profiles of all columns need, from one scan: a row per column (and group ``by``).

    The states of parts (files, periods, runs) merge with ``merge_states``, so they are stored once per
    part and a new part is the only one that is read. ``distinct`` is a sketch; dates are days since
    1970 in ``low``, ``high`` and ``total``. A pair of dates has a row ``start > end``, where ``present``
    counts the rows that hold both.
    """
    numbers = {f.name: F.col(f"`{f.name}`").cast("double") for f in df.schema if isinstance(f.dataType, NumericType)}
    numbers |= {f.name: F.unix_date(F.col(f"`{f.name}`")).cast("double") for f in df.schema if isinstance(f.dataType, DateType)}
    rows: dict[str, dict] = {}
    for name in (c for c in df.columns if c not in by):
        column = F.col(f"`{name}`")
        rows[name] = {"present": F.count(column), "distinct": F.hll_sketch_agg(column.cast("string"))}
        if name in numbers:
            rows[name] |= {"low": F.min(numbers[name]), "high": F.max(numbers[name]), "total": F.sum(numbers[name])}
    for start, end in date_pairs(df):
        both = F.col(start).isNotNull() & F.col(end).isNotNull()
        rows[f"{start} > {end}"] = {"present": F.count_if(both), "violations": F.count_if(F.col(start) > F.col(end))}
    kinds = {"present": "long", "distinct": "binary", "low": "double", "high": "double", "total": "double", "violations": "long"}
    aggregates = [c.alias(f"{kind}{i}") for i, row in enumerate(rows.values()) for kind, c in row.items()]
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *aggregates)

    def state(i: int, row: dict) -> list:
        return [(F.col(f"{kind}{i}") if kind in row else F.lit(None)).cast(of).alias(kind) for kind, of in kinds.items()]

    structs = [F.struct(F.lit(name).alias("column"), F.col("rows"), *state(i, row)) for i, (name, row) in enumerate(rows.items())]
    return wide.select(*by, F.explode(F.array(*structs)).alias("r")).select(*by, "r.*")


def merge_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of parts as those of the whole (or of each group ``by``)."""
    sums = [F.sum(c).alias(c) for c in ("rows", "present", "total", "violations")]
    return states.groupBy(*by, "column").agg(*sums, F.hll_union_agg("distinct").alias("distinct"), F.min("low").alias("low"), F.max("high").alias("high"))


def integrity_profile(states: DataFrame) -> DataFrame:
    """Missing values, distinct values (estimated), range, mean and date order of each column."""
    rows, present = F.col("rows"), F.col("present")
    return states.select(
        "column",
        "rows",
        (rows - present).alias("missing_count"),
        F.when(rows > 0, F.round(100.0 * (rows - present) / rows, 2)).alias("missing_percent"),
        F.when(F.col("violations").isNull(), F.hll_sketch_estimate("distinct")).alias("n_distinct"),
        F.col("low").alias("min"),
        F.try_divide("total", "present").alias("mean"),
        F.col("high").alias("max"),
        "violations",
    )


def compare_profiles(before: DataFrame, after: DataFrame) -> DataFrame:
    """The profiles of a dataset before and after cleaning side by side; a column of one alone is
    ``added`` or ``dropped``."""
    sides = []
    for df, suffix in ((before, "_before"), (after, "_after")):
        sides.append(df.select("column", *[F.col(c).alias(c + suffix) for c in df.columns if c != "column"]))
    status = F.when(F.col("rows_before").isNull(), "added").when(F.col("rows_after").isNull(), "dropped").otherwise("both")
    return sides[0].join(sides[1], "column", "full").withColumn("status", status)
