"""All queries of this subpackage, and the SQL that each is checked against."""

from __future__ import annotations

from griyaflow.llm import canonical_queries, document_queries, overlap_queries, pii_queries, sample_queries, split_queries

_MODULES = (sample_queries, split_queries, overlap_queries, canonical_queries, document_queries, pii_queries)


def queries() -> dict:
    return {name: f for m in _MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
