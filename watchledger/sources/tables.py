"""Stored tables and lazy views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def full_refresh(df: DataFrame, path: str, by: str | None = None) -> None:
    """Replace the whole table at ``path``, in one folder per value of ``by``.

    Rows are dealt by that column before they are written, so that a value has
    few files; a value with many rows is split over several tasks.
    """
    if by is None:
        df.write.mode("overwrite").parquet(path)
    else:
        df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(path)


def materialize_table(df: DataFrame, path: str, by: str | None = None) -> DataFrame:
    """Store ``df`` as a table and return a reader of it."""
    full_refresh(df, path, by)
    # Folder columns come last when read.
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` under a name without computing it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def table_ref(spark: SparkSession, path: str) -> DataFrame:
    """Read a table that another model stored."""
    return spark.read.parquet(path)


def with_audit_times(df: DataFrame) -> DataFrame:
    """Add the time of the build as ``created_at`` and ``updated_at``."""
    now = F.current_timestamp()
    return df.select("*", now.alias("created_at"), now.alias("updated_at"))
