"""Text clean-up and mail-subject features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that hint at an attachment, and reply / forward prefixes.
ATTACHMENT_PATTERN = "attach|enclosed|pdf|doc|xls"
REPLY_PATTERN = "^re:|^fw:|^fwd:"
REPLY_PREFIX = r"^(re:|fw:|fwd:)\s*"


def squish(column: Column) -> Column:
    return F.trim(F.regexp_replace(column, r"\s+", " "))


def strip(column: Column) -> Column:
    return F.regexp_replace(column, r"^\s+|\s+$", "")


def blank_to_null(column: Column) -> Column:
    return F.nullif(strip(column), F.lit(""))


def subject_features(column: Column) -> dict[str, Column]:
    lowered = F.lower(column)
    return {
        "subject_length": F.length(column).cast("long"),
        "has_attachment": lowered.rlike(ATTACHMENT_PATTERN),
        "is_reply": lowered.rlike(REPLY_PATTERN),
        "subject_clean": F.regexp_replace(column, REPLY_PREFIX, ""),
    }
