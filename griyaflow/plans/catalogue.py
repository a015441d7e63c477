"""All queries of the core, and the SQL that each is checked against."""

from __future__ import annotations

from griyaflow.plans import assembly, cells, core_problems, extras, feeds, profiles, records, sampling

_MODULES = (core_problems, cells, profiles, sampling, records, assembly, extras, feeds)
FLAGSHIP = "p5_found"


def queries() -> dict:
    return {name: f for m in _MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
