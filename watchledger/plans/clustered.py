"""Facts laid out for their common joins: by customer, and by bands of courses.

A clustered table is bucketed by customer, so that totals and joins by customer move
no rows, and has a folder per band of course keys, so that a filter by course leaves
the files of other bands unopened. Each band of a bucket is written by one task.

A fact has a row per customer, course and month, so a customer's rows are bounded by
the courses and months there are. A course may have any share of the rows: its band
is spread over all buckets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BAND = "course_band"
#: Rows that a bucket should hold, all bands together.
BUCKET_ROWS = 4_000_000
BANDS = 16


def buckets_for(rows: int) -> int:
    return max(1, math.ceil(rows / BUCKET_ROWS))


class ClusteredFact:
    """A clustered table below ``folder``; its layout is part of its path."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int, width: int):
        self.spark, self.buckets, self.width = spark, buckets, width
        self.path = f"{folder.rstrip('/')}/buckets={buckets}-width={width}"
        self.name = f"clustered_{hashlib.md5(self.path.encode()).hexdigest()}"

    @classmethod
    def write(
        cls, fact: DataFrame, folder: str, buckets: int, bands: int = BANDS
    ) -> "ClusteredFact":
        """Store ``fact``, which has customer_key and course_key, once.

        A table that is there already is refused. Rows without a course are in a band
        of their own, rows without a customer in one bucket.
        """
        high = fact.agg(F.max("course_key")).first()[0] or 0
        made = cls(fact.sparkSession, folder, buckets, math.ceil((high + 1) / bands))
        band = F.call_function("div", F.col("course_key"), F.lit(made.width))
        # The hash by which rows find their bucket.
        bucket = F.pmod(F.hash("customer_key"), F.lit(buckets))
        (
            fact.withColumn(BAND, band)
            .repartition(F.col(BAND), bucket)
            .write.partitionBy(BAND)
            .bucketBy(buckets, "customer_key")
            .sortBy("customer_key")
            .option("path", made.path)
            .saveAsTable(made.name)
        )
        return made

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> "ClusteredFact":
        """A table that an earlier application wrote."""
        pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/buckets=*")
        files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = [status.getPath().getName() for status in files.globStatus(pattern) or []]
        if len(found) != 1:
            raise ValueError(f"{folder} holds {len(found)} clustered tables")
        buckets, width = (int(part.partition("=")[2]) for part in found[0].split("-"))
        table = cls(spark, folder, buckets, width)
        if not spark.catalog.tableExists(table.name):
            stored = spark.read.parquet(table.path).drop(BAND).schema
            names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored)
            spark.sql(
                f"create table {table.name} ({names}, {BAND} bigint) using parquet"
                f" partitioned by ({BAND}) clustered by (customer_key) sorted by (customer_key)"
                f" into {buckets} buckets location '{table.path}'"
            )
            spark.sql(f"msck repair table {table.name}")
        return table

    def rows(self) -> DataFrame:
        return self.spark.table(self.name).drop(BAND)

    def of_courses(self, keys: Sequence[int]) -> DataFrame:
        """The rows of some courses; other bands are not opened."""
        bands = sorted({key // self.width for key in keys})
        table = self.spark.table(self.name)
        return table.where(F.col(BAND).isin(bands) & F.col("course_key").isin(list(keys))).drop(BAND)


def customer_months(fact: ClusteredFact) -> DataFrame:
    """Minutes and titles per customer and month, without an exchange."""
    return fact.rows().groupBy("customer_key", "consumption_month").agg(
        F.sum("total_minutes_consumed").alias("minutes"),
        F.count(F.lit(1)).alias("titles"),
        F.count_if("is_revenue_eligible").alias("paid_titles"),
    )


def course_months(fact: ClusteredFact, courses: Sequence[int]) -> DataFrame:
    """Minutes and viewers of some courses by month."""
    return fact.of_courses(courses).groupBy("course_key", "consumption_month").agg(
        F.sum("total_minutes_consumed").alias("minutes"),
        F.count(F.lit(1)).alias("viewers"),
    )
