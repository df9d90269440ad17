"""Registration of named queries with their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortspark.sources.adapters import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, views: str = "", sql: str = "") -> Callable[[Query], Query]:
    """Registers a query; ``sql`` runs behind the named ``views``."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = with_views(views, sql) if views else sql
        return f

    return add
