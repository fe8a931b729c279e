"""Exact order statistics without putting a group into one task.

``percentile`` and a plain ``Window.orderBy`` both gather a group in one place. Here values are
first counted per distinct value, and the counts are dealt once into ranges of group and value, each
range to one partition, and stored. The ranges' totals are few small rows; running totals over them
say where each range begins within its group, and a value's own rank is found within its range. For
quantiles only the ranges that hold an asked position are ranked. As a range holds about equally many
distinct values whatever they are, neither a hot group nor a hot value nor a narrow spread makes a
large task. NaN counts as missing; infinities are ordinary values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.functions.logic import join_on_keys
from panelloom.sources.shared import stored


def _ranged(per_value: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Distinct values with the number of their range, ``_part``: a stored table, since the cuts are sampled
    anew whenever the rows are dealt."""
    parts = int(per_value.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = per_value.repartitionByRange(parts, *by, value)
    return stored(dealt.withColumn("_part", F.spark_partition_id()), "ranges")


def running_totals(
    df: DataFrame, by: Sequence[str], value: str, weights: Mapping[str, Column], positions: Sequence[float] | None = None
) -> DataFrame:
    """Totals up to and including each distinct value, per ``by`` group.

    One row per group and distinct value, with each weight summed for the value
    (``name``), running (``name_through``) and for the whole group (``name_total``). With
    ``positions`` (shares of the first weight) only ranges around these are ranked and returned.
    """
    names = list(weights)
    keys = [*by, "_part"]
    valued = df.filter(F.col(value).isNotNull() & ~F.isnan(value))
    per_value = _ranged(valued.groupBy(*by, value).agg(*[F.sum(w).alias(n) for n, w in weights.items()]), by, value)

    # At most a row per group and one more per partition.
    per_part = per_value.groupBy(*keys).agg(*[F.sum(n).alias(f"_{n}") for n in names])
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    below = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        *keys,
        *[f"_{n}" for n in names],
        *[F.coalesce(F.sum(f"_{n}").over(below), F.lit(0)).alias(f"{n}_below") for n in names],
        *[F.sum(f"_{n}").over(group).alias(f"{n}_total") for n in names],
    )
    if positions is not None:
        first, held, total = F.col(f"{names[0]}_below"), F.col(f"_{names[0]}"), F.col(f"{names[0]}_total")
        asked = F.lit(False)
        for p in positions:
            place = (total - 1) * F.lit(float(p))
            for at in (F.floor(place), F.ceil(place)):
                asked = asked | ((at >= first) & (at < first + held))
        offsets = offsets.where(asked)
    offsets = offsets.drop(*[f"_{n}" for n in names])

    within = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = join_on_keys(per_value, offsets, keys, "inner")
    return ranked.select(
        *by,
        value,
        *names,
        *[(F.sum(n).over(within) + F.col(f"{n}_below")).alias(f"{n}_through") for n in names],
        *[f"{n}_total" for n in names],
    )


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Mapping[str, float],
    by: Sequence[str] = (),
    approximate: bool = False,
) -> DataFrame:
    """Interpolated quantiles, one row per ``by`` group and column.

    ``probabilities`` maps output names to probabilities in [0, 1]; the value at
    position ``(n - 1) * p`` is interpolated between its two neighbours. ``approximate`` takes them
    from one mergeable sketch per group instead: one pass, no ranking, values of the data.
    """
    long = to_long(df, columns, by)
    if approximate:
        valued = long.filter(F.col("value").isNotNull())
        found = valued.groupBy(*by, "column").agg(F.percentile_approx("value", list(probabilities.values()), 10_000).alias("_q"))
        return found.select(*by, "column", *[F.col("_q")[i].alias(n) for i, n in enumerate(probabilities)])
    ranked = running_totals(long, [*by, "column"], "value", {"n": F.lit(1)}, list(probabilities.values()))
    first, last = F.col("n_through") - F.col("n"), F.col("n_through") - 1

    def at(position: Column) -> Column:
        return F.max(F.when(position.between(first, last), F.col("value")))

    aggregates = []
    for name, p in probabilities.items():
        position = (F.col("n_total") - 1) * F.lit(float(p))
        aggregates += [
            at(F.floor(position)).alias(f"_{name}_low"),
            at(F.ceil(position)).alias(f"_{name}_high"),
            F.max(position - F.floor(position)).alias(f"_{name}_part"),
        ]
    found = ranked.groupBy(*by, "column").agg(*aggregates)

    def between(name: str) -> Column:
        low, high, part = (F.col(f"_{name}_{x}") for x in ("low", "high", "part"))
        # Infinite neighbours have no difference.
        return F.when((part == 0) | (low == high), low).otherwise(low + (high - low) * part)

    return found.select(*by, "column", *[between(n).alias(n) for n in probabilities])


def to_long(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per row and column: ``by..., column, value`` with DOUBLE values; NaN is NULL."""
    wide = df.select(*by, *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    return wide.unpivot(list(by), list(columns), "column", "value")


def roc_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, per ``by`` group (label 1 is the event; ties count one half; NULL
    without events or without others)."""
    scored = df.select(*by, F.col(score).cast("double").alias("score"), F.col(label).cast("long").alias("label"))
    scored = scored.filter(F.col("label").isNotNull())
    ranked = running_totals(scored, by, "score", {"pos": F.col("label"), "neg": 1 - F.col("label")})
    won = F.col("pos") * (F.col("neg_through") - F.col("neg") / 2)
    return ranked.groupBy(*by).agg(
        F.max("pos_total").alias("n_pos"),
        F.max("neg_total").alias("n_neg"),
        F.try_divide(F.sum(won), F.max("pos_total") * F.max("neg_total")).alias("auc"),
    )
