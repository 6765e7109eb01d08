"""Registered queries and the SQL that checks them."""

from . import check_queries, context_queries, evidence_queries, helper_queries, judge_queries, protocol_queries, stream_queries, table_queries, text_queries  # noqa: F401  they register their queries
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
