"""The query catalogue: Spark queries over derived logs, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` it is only checked for running."""

    def keep(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return keep
