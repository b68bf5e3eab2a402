"""Registered queries: the operators and plans run over adaptor views of the test tables."""

from tallybook.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
