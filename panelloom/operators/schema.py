"""Schema standardisation: names, renames, missing and empty columns, id types."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from panelloom.config import ROLES
from panelloom.functions import names as N


def snake_names(df: DataFrame) -> DataFrame:
    return df.toDF(*N.numbered(N.snake_name(c) for c in df.columns))


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*N.numbered(N.clean_name(c) for c in df.columns))


def clean_question_names(df: DataFrame) -> DataFrame:
    return df.toDF(*N.numbered(N.question_name(c) for c in df.columns))


def suffix_names(df: DataFrame, suffix: str) -> DataFrame:
    return df.toDF(*[f"{c}{suffix}" for c in df.columns])


def rename_existing(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename ``old -> new`` where ``old`` exists."""
    return df.withColumnsRenamed({old: new for old, new in mapping.items() if old in df.columns})


def label_questions(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Add or rename ``new -> pattern of the old name``; one column may feed two names."""
    sources = {}
    for new, pattern in mapping.items():
        hit = next((c for c in df.columns if re.fullmatch(pattern, c)), None)
        if hit is not None:
            sources[new] = hit
    kept = [c for c in df.columns if c not in sources.values()]
    return df.select(*kept, *[F.col(old).alias(new) for new, old in sources.items()])


def resolve_column(df: DataFrame, preferred: str, alternatives: Sequence[str] = ()) -> str | None:
    """First existing column out of the preferred name and its synonyms."""
    return next((c for c in (preferred, *alternatives) if c in df.columns), None)


def resolve_roles(df: DataFrame, dataset: str, required: Iterable[str] = ()) -> dict[str, str]:
    """Role -> column for every role of ``dataset`` that ``df`` can serve."""
    found = {}
    for role, candidates in ROLES[dataset].items():
        column = resolve_column(df, candidates[0], candidates[1:])
        if column is not None:
            found[role] = column
    missing = [role for role in required if role not in found]
    if missing:
        raise ValueError(f"{dataset}: no column for {missing}; available: {df.columns}")
    return found


def ensure_columns(df: DataFrame, columns: Iterable[str], default: object = 0) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    return df.withColumns({c: F.lit(default) for c in missing}) if missing else df


def drop_empty_columns(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Drop columns without a single value. One aggregation decides for all columns."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    keep = set(keep)
    return df.select(*[f"`{c}`" for c in df.columns if counts[c] > 0 or c in keep])


def ids_as_string(df: DataFrame, pattern: str = r"^customer.*id$|^to_customer_id$|^account_id$|^sap.id$") -> DataFrame:
    """Cast columns whose name matches to text, so that ids join across sources."""
    hits = [
        f.name
        for f in df.schema
        if re.search(pattern, f.name, re.IGNORECASE) and not isinstance(f.dataType, StringType)
    ]
    return df.withColumns({c: F.col(c).cast("string") for c in hits}) if hits else df


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]
