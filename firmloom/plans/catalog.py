"""All registered queries."""

from firmloom.plans import frontier_queries, page_queries, record_queries, resolve_queries, store_queries  # noqa: F401
from firmloom.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
