"""Raw tables derived from an order database in Parquet.

The tables customer, orders, lineitem, part and nation are turned into the
text form that staging expects, with the dirt that real exports have: mixed
date formats, blank ids and names, refunds and duplicate customers. Which rows
get which dirt follows from their keys, so every row of the source is used.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Product text by order priority.
PRODUCTS = {
    "1-URGENT": "Professional Yearly Subscription",
    "2-HIGH": " professional monthly subscription ",
    "3-MEDIUM": "Yearly Subscription",
    "4-NOT SPECIFIED": "Monthly Subscription",
}
OTHER_PRODUCT = "Business Pack"

FIRST_LOAD = dt.datetime(1999, 1, 1)
SECOND_LOAD = dt.datetime(2001, 9, 1)
AS_OF = dt.date(2001, 6, 1)


class Commerce:
    """Raw tables of one source folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._readers: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """The source table; its footer is read for the schema only once."""
        if name not in self._readers:
            path = f"{self.folder}/{name}.parquet"
            self._readers[name] = self.spark.read.parquet(path)
        return self._readers[name]

    def orders(self, since: dt.date | None = None, before: dt.date | None = None) -> DataFrame:
        """Orders of all days, or of those from ``since`` on and ``before`` another."""
        orders, customer = _between(self.table("orders"), since, before), self.table("customer")
        nation = self.table("nation")
        key, price = F.col("o_orderkey"), F.col("o_totalprice")
        product = F.lit(OTHER_PRODUCT)
        for priority, text in PRODUCTS.items():
            product = F.when(F.col("o_orderpriority") == priority, text).otherwise(
                product
            )
        number = F.concat(F.lit("ORD-"), key.cast("string"), F.lit(" "))
        owner = F.when(key % 101 == 0, "  ").otherwise(F.col("o_custkey").cast("string"))
        net = F.when(key % 211 == 0, -price).otherwise(price)
        placed = orders.join(
            customer, F.col("o_custkey") == F.col("c_custkey")
        ).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        return placed.select(
            key.cast("string").alias("Order ID"),
            number.alias("Order Number"),
            _mixed(key, F.col("o_orderdate")).alias("Order Created At"),
            owner.alias("Customer ID"),
            product.alias("Line Items"),
            F.col("n_name").alias("Billing Address Country"),
            net.cast("decimal(12,2)").cast("string").alias("Net (USD)"),
        )

    def customers(self, before: dt.datetime | None = None) -> DataFrame:
        """Customers as known from the orders ``before`` a time, or from all."""
        orders = self.table("orders")
        if before is not None:
            edge = F.lit(before.isoformat(sep=" ")).cast("timestamp_ntz")
            orders = orders.where(F.col("o_orderdate") < edge)
        paid = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate"))
        totals = orders.groupBy(F.col("o_custkey").alias("k")).agg(
            F.min(paid).alias("paid"),
            F.min("o_orderdate").alias("any"),
            F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("spent"),
        )
        keys = self.table("customer").select(F.col("c_custkey").alias("k"))
        known = keys.join(totals, "k", "left")
        k, text = F.col("k"), F.col("k").cast("string")
        spent = F.col("spent").cast("decimal(20,2)").cast("string")
        copies = F.array(
            F.struct(text.alias("id"), spent.alias("spent")),
            F.when(k % 97 == 0, F.struct(F.lit("  ").alias("id"), spent.alias("spent"))),
            F.when(k % 500 == 0, F.struct(text.alias("id"), F.lit("1.00").alias("spent"))),
        )
        rows = known.select(
            _mixed(k, F.col("paid")).alias("First Paid Order Date"),
            _mixed(k, F.col("any")).alias("First Order Date"),
            F.explode(copies).alias("copy"),
        ).where("copy is not null")
        return rows.select(
            F.col("copy.id").alias("Customer ID"),
            "First Paid Order Date",
            "First Order Date",
            F.col("copy.spent").alias("Total Spent"),
        )

    def courses(self) -> DataFrame:
        kind = F.when(F.col("p_size") % 4 == 0, "Free").otherwise(" Paid")
        padded = F.concat(F.lit(" "), _title(), F.lit(" "))
        return self.table("part").select(
            padded.alias("Course Name"),
            kind.alias("Course Type"),
            F.col("p_brand").alias("Course Instructor"),
        )

    def consumption(self, since: dt.date | None = None, before: dt.date | None = None) -> DataFrame:
        """Watch rows of all months, or some, with the month as an extra column."""
        lines, orders = self.table("lineitem"), _between(self.table("orders"), since, before)
        part = self.table("part")
        watched = lines.join(
            orders, F.col("l_orderkey") == F.col("o_orderkey")
        ).join(part, F.col("l_partkey") == F.col("p_partkey"))
        blank = (F.col("l_orderkey") + F.col("l_linenumber")) % 503 == 0
        return watched.select(
            F.col("o_custkey").cast("string").alias("User ID"),
            F.when(blank, " ").otherwise(_title()).alias("Course Name"),
            (F.col("l_quantity") * 3).cast("int").cast("string").alias("Minutes Consumed"),
            F.trunc("o_orderdate", "month").alias("month"),
        )


def _between(orders: DataFrame, since: dt.date | None, before: dt.date | None) -> DataFrame:
    day = F.col("o_orderdate")
    if since is not None:
        orders = orders.where(day >= F.lit(since.isoformat()).cast("timestamp_ntz"))
    if before is not None:
        orders = orders.where(day < F.lit(before.isoformat()).cast("timestamp_ntz"))
    return orders


def _title() -> Column:
    return F.concat("p_name", F.lit(" #"), F.col("p_partkey").cast("string"))


def _mixed(key: Column, when: Column) -> Column:
    """Day-first text for even keys and ISO text for odd ones."""
    day_first = F.date_format(when, "dd/MM/yy HH:mm")
    iso = F.date_format(when, "yyyy-MM-dd HH:mm:ss")
    return F.when(key % 2 == 0, day_first).otherwise(iso)
