"""Queries and their SQL, registered side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from granary.runtime import shipped

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (t) -> DataFrame under its name, t reading a table by name."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = shipped(lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add
