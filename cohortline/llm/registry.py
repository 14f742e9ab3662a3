"""Queries of this subpackage and the SQL some of them equal."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the same result for another engine."""
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function
    return register
