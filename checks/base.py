"""Registry of the checked queries and small helpers to write their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that must give the same rows."""

    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register


def num(value: float) -> str:
    """A double literal (a plain decimal literal would be a DECIMAL in the oracle)."""
    return f"cast('{value!r}' as double)"
