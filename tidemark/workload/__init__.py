"""Queries over the supplied tables: one or more per operator, with their SQL twins."""

from tidemark.workload.registry import all_queries, all_sql

__all__ = ["all_queries", "all_sql"]
