"""All queries and their SQL."""

from panelmill.plans import annotation_queries, assembly_queries, io_queries, nested_queries, queries, reconcile_queries, restore_queries, screen_queries, stage_queries, stream_queries, table_queries  # noqa: F401
from panelmill.plans.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
