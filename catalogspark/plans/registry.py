"""Registration of queries with the inventory ids they cover and their SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, list[str]] = {}


def query(ids: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name; ``ids`` names the inventory rows it exercises."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        COVERS[fn.__name__] = ids.split()
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register
