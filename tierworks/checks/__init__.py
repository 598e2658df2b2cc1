"""Queries over the shared test tables and the SQL that proves them."""

from __future__ import annotations

from tierworks.checks import (
    change_queries, learned_queries, name_queries, synth_queries, tables_queries, text_queries,
)

_MODULES = [tables_queries, text_queries, change_queries, synth_queries, name_queries, learned_queries]


def queries() -> dict:
    return {name: query for m in _MODULES for name, query in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
