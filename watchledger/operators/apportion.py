"""Whole amounts dealt by weight, to the last unit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchledger.operators.groups import attach, sequence_in_group
from watchledger.scratch import Scratch


def apportion(
    df: DataFrame,
    keys: Sequence[str],
    amount: str,
    weight: str,
    name: str,
    settle: Sequence[str | Column],
    scratch: Scratch,
) -> DataFrame:
    """Add each row's part of its group's whole ``amount``, by largest remainder.

    Every row gets the whole part of amount * weight / total weight; the units left
    over go one each to the rows with the largest remainders, ties by ``settle``,
    which must tell rows of a group apart. So the parts of a group add up to its
    amount. Weights below zero and null count as 0, and a group whose weights are
    all 0 is dealt evenly. ``amount`` is the same on all rows of a group and not
    negative; products beyond a long fail.

    No window takes a group: rows are numbered by group and remainder in sorted
    ranges, and what is left over joins the one row per group. Columns whose names
    begin with ``__`` are taken.
    """
    weighed = df.withColumn(
        "__weight", F.greatest(F.coalesce(F.col(weight).cast("long"), F.lit(0)), F.lit(0))
    )
    rows = scratch.stage(weighed, f"{name}-weighed")
    totals = rows.groupBy(*keys).agg(
        F.sum("__weight").alias("__total"), F.count(F.lit(1)).alias("__members")
    )
    whole = attach(rows, totals, keys)
    even = F.col("__total") == 0
    part = F.when(even, 1).otherwise(F.col("__weight"))
    total = F.when(even, F.col("__members")).otherwise(F.col("__total"))
    product = F.col(amount) * part
    dealt = whole.select(
        *df.columns,
        F.call_function("div", product, total).alias("__floor"),
        (product % total).alias("__remainder"),
    )
    dealt = scratch.stage(dealt, f"{name}-dealt")
    left = dealt.groupBy(*keys).agg(
        (F.max(amount) - F.sum("__floor")).alias("__left")
    )
    placed = sequence_in_group(
        dealt, keys, [F.desc("__remainder"), *settle], scratch,
        sequence="__place", is_last="__last",
    )
    settled = attach(placed, left, keys)
    one = (F.col("__place") <= F.col("__left")).cast("long")
    return settled.select(*df.columns, (F.col("__floor") + one).alias(name))
