"""Conditions and conditional aggregates with explicit NULL rules.

A condition built here is never NULL: a NULL input is "no". That matters as soon
as the condition is negated or stored.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def yes(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def is_one_of(column: Column, values: Iterable) -> Column:
    values = list(values)
    return yes(column.isin(*values)) if values else F.lit(False)


def matches(column: Column, pattern: str, ignore_case: bool = True) -> Column:
    return yes(column.rlike(f"(?i){pattern}" if ignore_case else pattern))


def contains_text(column: Column, text: str) -> Column:
    return yes(column.contains(text))


def count_rows() -> Column:
    return F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def sum_where(condition: Column, value: Column) -> Column:
    """Sum of ``value`` over the rows where the condition holds; 0 when there are none."""
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0.0))


def sum_or_zero(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0.0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, or 0 when the denominator is not positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 / 0 as BIGINT; NULL when the condition is NULL."""
    return condition.cast("int").cast("long")


def join_on_keys(left: DataFrame, right: DataFrame, columns: Iterable[str], how: str = "left") -> DataFrame:
    """Null-safe join that keeps one copy of the key columns."""
    columns = list(columns)
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in columns})
    condition = None
    for name in columns:
        pair = F.col(name).eqNullSafe(F.col(f"_right_{name}"))
        condition = pair if condition is None else condition & pair
    return left.join(renamed, condition, how).drop(*[f"_right_{c}" for c in columns])
