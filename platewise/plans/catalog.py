"""All registered queries."""

from platewise.plans import model_queries, row_queries, source_queries, stream_queries, table_queries  # noqa: F401
from platewise.plans.registry import QUERIES

__all__ = ["QUERIES"]
