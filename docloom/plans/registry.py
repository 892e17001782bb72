"""Registry of queries: a name, a function (spark, folder) -> DataFrame, and SQL to check it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated function; without ``sql`` only its rows are checked."""

    def add(function):
        QUERIES[name] = function
        if sql is not None:
            CHECKS[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
