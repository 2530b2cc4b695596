"""Registry of queries: name, function of (spark, data directory), equivalent SQL and the operators it shows."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}
OPERATORS: dict[str, str] = {}


def query(operators: str, sql: str | None = None):
    """Register a query under its function's name."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        OPERATORS[f.__name__] = operators
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def covered() -> dict[str, list[str]]:
    """The queries that show each operator."""
    out: dict[str, list[str]] = {}
    for name, ids in OPERATORS.items():
        for i in ids.split():
            out.setdefault(i, []).append(name)
    return dict(sorted(out.items()))
