"""The table of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyweave.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and the SQL over the same tables that gives the same rows."""
    def register(function: Query) -> Query:
        def call(spark: SparkSession, folder: str) -> DataFrame:
            return function(prepare(spark), folder)

        QUERIES[name] = call
        if sql is not None:
            SQL[name] = sql
        return function

    return register
