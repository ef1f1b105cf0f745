"""A Spark session with the settings the jobs are planned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE picks the number of reducers, splits skewed join partitions and switches
# to broadcast joins by the sizes seen at run time. Recording the call site of
# every column expression costs more driver time than planning does. Adaptive
# execution merges small partitions but splits neither a sort nor a plain
# aggregate, so a job starts with many and has them merged to the advisory size.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "watchledger",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session; ``master`` is left to spark-submit if None."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {**DEFAULTS, **(extra or {})}
    if "spark.sql.shuffle.partitions" in (extra or {}):
        # A number that the caller asks for is where jobs start, too.
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = (
            (extra or {})["spark.sql.shuffle.partitions"]
        )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
