"""Analytic features within one entity, in period order.

All of them use the same partitioning and ordering, so Spark plans them on a single
exchange and sort. A window group is one entity's periods, never its raw rows.

Each feature exists twice: as columns (``*_columns``), to be put into one ``withColumns``
with others so that Spark evaluates them in a single Window operator, and as an operator
on a DataFrame.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.config import PanelKeys
from panelloom.functions.logic import flag

YEARLY = PanelKeys()


def cumulative_columns(columns: Mapping[str, str], keys: PanelKeys = YEARLY) -> dict[str, Column]:
    return {out: F.sum(F.coalesce(F.col(c), F.lit(0))).over(keys.history()) for c, out in columns.items()}


def cumulative(df: DataFrame, columns: Mapping[str, str], keys: PanelKeys = YEARLY) -> DataFrame:
    """Running sum per ``source -> output``; NULL counts as 0."""
    return df.withColumns(cumulative_columns(columns, keys))


def rolling_columns(
    columns: Mapping[str, str], k: int, keys: PanelKeys = YEARLY, null_as_zero: bool = False
) -> dict[str, Column]:
    out = {}
    for c, name in columns.items():
        value = F.coalesce(F.col(c), F.lit(0)) if null_as_zero else F.col(c)
        full = F.count(value).over(keys.trailing(k)) == k
        out[name] = F.when(full, F.avg(value).over(keys.trailing(k)))
    return out


def rolling_mean(
    df: DataFrame, columns: Mapping[str, str], k: int, keys: PanelKeys = YEARLY, null_as_zero: bool = False
) -> DataFrame:
    """Mean of the last ``k`` periods; NULL until ``k`` known values are in the frame."""
    return df.withColumns(rolling_columns(columns, k, keys, null_as_zero))


def lag_value(
    df: DataFrame, column: str, out: str, n: int = 1, default: object = None, keys: PanelKeys = YEARLY
) -> DataFrame:
    return df.withColumn(out, F.lag(column, n, default).over(keys.ordered()))


def first_period_columns(conditions: Mapping[str, Column], keys: PanelKeys = YEARLY) -> dict[str, Column]:
    period = F.col(keys.period)
    return {out: F.min(F.when(c, period)).over(keys.whole()) for out, c in conditions.items()}


def first_period_where(df: DataFrame, conditions: Mapping[str, Column], keys: PanelKeys = YEARLY) -> DataFrame:
    """First period in which a condition holds, on every row of the entity."""
    return df.withColumns(first_period_columns(conditions, keys))


def fill(df: DataFrame, columns: Iterable[str], direction: str = "down", keys: PanelKeys = YEARLY) -> DataFrame:
    """Carry the last known value forward (``down``), then also backward (``downup``)."""
    if direction not in ("down", "downup"):
        raise ValueError(f"unknown fill direction {direction!r}")
    out = {}
    for c in columns:
        filled = F.last(c, ignorenulls=True).over(keys.history())
        if direction == "downup":
            filled = F.coalesce(filled, F.first(c, ignorenulls=True).over(keys.future()))
        out[c] = filled
    return df.withColumns(out)


def periods_since_columns(
    columns: Mapping[str, str], default: int | None = None, keys: PanelKeys = YEARLY
) -> dict[str, Column]:
    out = {}
    for first, name in columns.items():
        distance = keys.distance(F.col(first))
        out[name] = distance if default is None else F.coalesce(distance, F.lit(default).cast("long"))
    return out


def periods_since(
    df: DataFrame, columns: Mapping[str, str], default: int | None = None, keys: PanelKeys = YEARLY
) -> DataFrame:
    """Periods between ``first period column -> output``; ``default`` where it is unknown."""
    return df.withColumns(periods_since_columns(columns, default, keys))


def ever_and_post_columns(columns: Mapping[str, tuple[str, str]], keys: PanelKeys = YEARLY) -> dict[str, Column]:
    out = {}
    for first, (ever, post) in columns.items():
        out[ever] = F.col(first).isNotNull()
        out[post] = flag(F.coalesce(F.col(keys.period) >= F.col(first), F.lit(False)))
    return out


def ever_and_post(df: DataFrame, columns: Mapping[str, tuple[str, str]], keys: PanelKeys = YEARLY) -> DataFrame:
    """Ever flag (boolean) and at-or-after flag (0/1) per first-period column."""
    return df.withColumns(ever_and_post_columns(columns, keys))
