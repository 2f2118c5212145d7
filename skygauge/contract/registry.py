"""The query register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with the DuckDB SQL that must give the same rows."""
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            CHECK_SQL[function.__name__] = sql
        return function
    return register
