"""Registered queries. Importing this package registers them all."""

from chainframe.plans import compare_queries, match_queries, sources_queries, stream_queries, summary_queries
from chainframe.plans.registry import oracle_sql, queries

__all__ = ["compare_queries", "match_queries", "oracle_sql", "queries", "sources_queries", "stream_queries", "summary_queries"]
