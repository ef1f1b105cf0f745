"""Registered queries, each next to the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.context import Context, comparable, context

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``function(context) -> DataFrame`` under ``key``."""

    def add(function: Callable[[Context], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(function(context(spark, folder)))

        run.__name__ = key
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return function

    return add
