"""Dense numbering over a total order, without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchledger.scratch import Scratch

PART, INDEX, BEFORE = "__part", "__index", "__before"
ROW_BITS = 33  # monotonically_increasing_id: partition above, row number below


def number_rows(
    df: DataFrame,
    order: Sequence[str | Column],
    scratch: Scratch,
    name: str,
    ranges: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Add ``name`` = 1..n in the given order, which must identify a row.

    Columns given by name are sorted ascending with null last. Equal rows
    cannot be told apart by a range, so ``order`` should go on beyond the key
    where a key may repeat. ``ranges`` is what the partitions' borders are drawn
    by, ``order`` itself by default. It must never decrease along ``order``: the
    first letters of a long text will do. The driver samples these values.

    The rows are range-partitioned and sorted, then staged with their place
    inside the partition. A small table of partition sizes gives each
    partition's offset. Staging matters: a second evaluation could draw other
    range borders.
    """
    staged = stage_in_order(df, order, scratch, name, ranges)
    offsets = offsets_before(staged, F.count(F.lit(1)))
    numbered = staged.join(F.broadcast(offsets), PART)
    return numbered.select(
        (F.col(BEFORE) + F.col(INDEX) + 1).alias(name), *df.columns
    )


def stage_in_order(
    df: DataFrame,
    order: Sequence[str | Column],
    scratch: Scratch,
    name: str,
    ranges: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Sorted range partitions, staged with partition number and row index."""
    borders = _ascending(order if ranges is None else ranges)
    ordered = (
        df.repartitionByRange(*borders)
        .sortWithinPartitions(*_ascending(order))
        .withColumn(INDEX, F.monotonically_increasing_id())
        .withColumn(PART, F.shiftright(INDEX, ROW_BITS).cast("int"))
        .withColumn(INDEX, F.col(INDEX).bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
    )
    return scratch.stage(ordered, f"ordered-{name}")


def _ascending(order: Sequence[str | Column]) -> list[Column]:
    return [F.asc_nulls_last(o) if isinstance(o, str) else o for o in order]


def offsets_before(staged: DataFrame, weight: Column) -> DataFrame:
    """Per partition, the total weight of the partitions before it.

    One row per range partition, so its size is bounded by
    ``spark.sql.shuffle.partitions`` and safe to broadcast.
    """
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    weights = staged.groupBy(PART).agg(weight.alias("__weight"))
    total = F.coalesce(F.sum("__weight").over(earlier), F.lit(0))
    return weights.select(PART, total.cast("long").alias(BEFORE))
