"""Calendar parts, durations and expiry. Whole-number results are BIGINT."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

_PARTS = {
    "year": lambda c: F.year(c).cast("long"),
    "quarter": lambda c: F.quarter(c).cast("long"),
    "month": lambda c: F.month(c).cast("long"),
    "day": lambda c: F.dayofmonth(c).cast("long"),
    "hour": lambda c: F.hour(c).cast("long"),
    "weekday": lambda c: F.dayname(c),
    "time": lambda c: F.date_format(c, "HH:mm:ss"),
}

_WEEKDAYS = {
    "Mon": "Monday",
    "Tue": "Tuesday",
    "Wed": "Wednesday",
    "Thu": "Thursday",
    "Fri": "Friday",
    "Sat": "Saturday",
    "Sun": "Sunday",
}


def date_parts(column: Column, prefix: str, parts: Iterable[str]) -> dict[str, Column]:
    """``{prefix}_{part}`` for each requested part."""
    out = {f"{prefix}_{part}": _PARTS[part](column) for part in parts}
    if f"{prefix}_weekday" in out:
        names = F.create_map(*[F.lit(x) for pair in _WEEKDAYS.items() for x in pair])
        out[f"{prefix}_weekday"] = names[out[f"{prefix}_weekday"]]
    return out


def duration_days(start: Column, end: Column) -> Column:
    return F.date_diff(end, start).cast("long")


def duration_minutes(start: Column, end: Column) -> Column:
    """Minutes between two timestamps, with fractions."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return micros / F.lit(60_000_000.0)


def suspicious_duration(minutes: Column, longest: float = 480.0) -> Column:
    return (minutes < 0) | (minutes > longest)


def business_hours(column: Column, first: int, last: int) -> Column:
    """Hour of day within ``first``..``last``, both included."""
    return F.hour(column).between(first, last)


def expiry(column: Column, as_of: Column) -> dict[str, Column]:
    return {
        "warranty_status": F.when(column.isNull(), "unknown").when(column < as_of, "expired").otherwise("active"),
        "warranty_days_remaining": F.date_diff(column, as_of).cast("long"),
    }
