"""Grouped summaries of a finished panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions.logic import join_on_keys
from panelloom.operators.quality import numeric_summary
from panelloom.operators.ranking import quantiles


def group_summary(
    panel: DataFrame, by: Sequence[str], metrics: Sequence[str], entity: str = "customer_id", approximate: bool = False
) -> DataFrame:
    """Rows, distinct entities, and mean / median / sd / min / max of each metric.

    The median is exact; ``approximate`` trades it for a one-pass sketch.
    """
    functions = {"mean": F.avg, "sd": F.stddev_samp, "min": F.min, "max": F.max}
    if approximate:
        functions["median"] = lambda c: F.percentile_approx(c, 0.5)
    statistics = {f"{m}_{name}": fn(m) for m in metrics for name, fn in functions.items()}
    counts = {"n_observations": F.count(F.lit(1))}
    if approximate:
        counts["n_customers"] = F.count_distinct(entity) + F.max(F.col(entity).isNull().cast("int"))
        return panel.groupBy(*by).agg(*[value.alias(name) for name, value in (counts | statistics).items()])
    # Entities are counted on their own: beside the statistics, each would carry all of these to the shuffle.
    entities = panel.select(*by, F.col(entity).alias("_entity")).distinct()
    n_customers = entities.groupBy(*by).agg(F.count(F.lit(1)).alias("n_customers"))
    out = panel.groupBy(*by).agg(*[value.alias(name) for name, value in (counts | statistics).items()])
    out = join_on_keys(out, n_customers, by).select(*by, *counts, "n_customers", *statistics)
    medians = quantiles(panel, metrics, {"median": 0.5}, by)
    wide = medians.groupBy(*by).agg(
        *[F.max(F.when(F.col("column") == m, F.col("median"))).alias(f"{m}_median") for m in metrics]
    )
    return join_on_keys(out, wide, by)


def event_study(panel: DataFrame, outcome: str, time: str = "time_to_treat", group: str = "treatment") -> DataFrame:
    """Mean outcome with standard error and 95 % band per event time and group."""
    stats = panel.groupBy(time, group).agg(
        F.avg(outcome).alias("outcome_mean"),
        (F.stddev_samp(outcome) / F.sqrt(F.count(F.lit(1)))).alias("outcome_se"),
        F.count(F.lit(1)).alias("n"),
    )
    half = 1.96 * F.col("outcome_se")
    return stats.withColumns({"ci_low": F.col("outcome_mean") - half, "ci_high": F.col("outcome_mean") + half})


KEY_VARIABLES = (
    "to_sum_val_opps_won",
    "to_number_of_opps",
    "customer_tenure",
    "sales_act_synchronous",
    "sales_act_asynchronous",
    "treatment",
    "time_to_treat",
)


def key_variable_summary(panel: DataFrame, columns: Sequence[str] = KEY_VARIABLES) -> DataFrame:
    present = [c for c in columns if c in panel.columns]
    summary = numeric_summary(panel, present)
    share = F.when(F.col("n_rows") > 0, F.round(100.0 * F.col("n_missing") / F.col("n_rows"), 1))
    return summary.select("column", "mean", "median", "min", "max", "n_missing", share.alias("missing_percent"))


def panel_metadata(panel: DataFrame, entity: str = "customer_id", period: str = "year") -> DataFrame:
    """One row describing the panel; treated customers are counted once each."""
    flags = panel.groupBy(entity).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("ever_treated").alias("treated"),
        F.min(period).alias("lo"),
        F.max(period).alias("hi"),
        F.max("country").alias("country"),
    )
    return flags.agg(
        F.sum("rows").alias("n_rows"),
        F.lit(len(panel.columns)).cast("long").alias("n_cols"),
        F.count(F.lit(1)).alias("n_customers"),
        F.count_if(F.col("treated") == 1).alias("n_treated"),
        F.min("lo").alias("first_year"),
        F.max("hi").alias("last_year"),
        F.count_distinct("country").alias("n_countries"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency and share of each value, NULL included."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("percent", F.round(100.0 * F.col("n") / total, 1))
