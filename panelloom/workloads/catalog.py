"""All registered queries."""

from panelloom.workloads import cleaning_queries, panel_queries, summary_queries  # noqa: F401
from panelloom.workloads.registry import QUERIES

__all__ = ["QUERIES"]
