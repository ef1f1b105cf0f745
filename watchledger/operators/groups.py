"""Per-group operators that survive a group holding much of the table.

A window would send each group to one task. Here totals are an aggregate that
is combined before its shuffle and joined back, sequences come from a numbering
over sorted ranges, and ranks from running counts of distinct values. No row
depends on the size of its group, so there is one plan for all sizes. Joins back
to the rows have no window above them, so adaptive execution can split the
partition of a frequent key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchledger.operators.numbering import (
    BEFORE,
    INDEX,
    PART,
    number_rows,
    offsets_before,
    stage_in_order,
)
from watchledger.scratch import Scratch

#: In tables of ranks: the rank's name, and the value ranked.
RANKED, VALUE = "__ranked", "__value"


def attach(df: DataFrame, per_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys of which null is one, adding the other columns."""
    renamed = per_key.withColumnsRenamed({k: f"__key_{k}" for k in keys})
    same = _all(df[k].eqNullSafe(renamed[f"__key_{k}"]) for k in keys)
    return df.join(renamed, same).drop(*[f"__key_{k}" for k in keys])


def group_total(
    df: DataFrame, keys: Sequence[str], value: str, name: str
) -> DataFrame:
    """Add the group's sum of ``value`` to each row. Reads ``df`` twice."""
    return attach(df, df.groupBy(*keys).agg(F.sum(value).alias(name)), keys)


def sequence_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    scratch: Scratch,
    sequence: str = "sequence",
    is_last: str = "is_last",
    lookup: DataFrame | None = None,
) -> DataFrame:
    """Add the row's number in its group and whether it is the group's last.

    ``order`` must be total within a group. All rows are numbered by keys and
    order; a group's first and last number give the rest. ``lookup`` is
    left-joined on the keys and must hold each key once. It is joined to the
    one row per group, not to the rows.
    """
    by_key = [F.asc_nulls_last(k) for k in keys]
    numbered = number_rows(df, [*by_key, *order], scratch, "__n")
    ends = numbered.groupBy(*keys).agg(
        F.min("__n").alias("__first"), F.max("__n").alias("__last")
    )
    if lookup is not None:
        ends = ends.join(lookup, list(keys), "left")
    with_ends = attach(numbered, scratch.stage(ends, "group-ends"), keys)
    placed = with_ends.select(
        "*",
        (F.col("__n") - F.col("__first") + 1).alias(sequence),
        (F.col("__n") == F.col("__last")).alias(is_last),
    )
    return placed.drop("__n", "__first", "__last")


def rank_in_group(
    df: DataFrame, keys: Sequence[str], metric: str, name: str, scratch: Scratch
) -> DataFrame:
    """Add the rank by ``metric`` descending, null first, with gaps after ties."""
    return ranks_in_group(df, keys, {name: metric}, scratch)


def ranks_in_group(
    df: DataFrame, keys: Sequence[str], metrics: Mapping[str, str], scratch: Scratch
) -> DataFrame:
    """Add a rank per entry of ``metrics``, from new name to numeric column.

    All metrics share one aggregate, one sort and one stored table of ranks.
    Reads ``df`` twice.
    """
    ranks = scratch.stage(_ranks_of_values(df, keys, metrics, scratch), "ranks")
    for name, metric in metrics.items():
        of_metric = ranks.where(F.col(RANKED) == name).select(
            *keys,
            F.col(VALUE).cast(df.schema[metric].dataType).alias(metric),
            F.col("__rank").alias(name),
        )
        df = attach(df, of_metric, [*keys, metric])
    return df


def _ranks_of_values(
    df: DataFrame, keys: Sequence[str], metrics: Mapping[str, str], scratch: Scratch
) -> DataFrame:
    """Rank of each distinct value: one more than the rows with a better one.

    Ties are counted together before anything is ordered, so a value shared by
    most rows is one row here. The running count is taken within range
    partitions. What it starts from, for a group and a partition, is kept in a
    small table: a row per partition and group in it.
    """
    same = _common_type(df, list(metrics.values()))
    listed = [
        F.struct(F.lit(name).alias(RANKED), F.col(metric).cast(same).alias(VALUE))
        for name, metric in metrics.items()
    ]
    group = [*keys, RANKED]
    values = (
        df.select(*keys, F.inline(F.array(*listed)))
        .groupBy(*group, VALUE)
        .agg(F.count(F.lit(1)).alias("__rows"))
    )
    order = [*group, F.desc_nulls_first(VALUE)]
    staged = stage_in_order(values, order, scratch, "ranks")

    pieces = staged.groupBy(PART, *group).agg(
        F.sum("__rows").alias("__rows"), F.min(INDEX).alias(INDEX)
    )
    pieces = scratch.stage(pieces, "rank-pieces")
    earlier = Window.partitionBy(PART).orderBy(INDEX).rowsBetween(Window.unboundedPreceding, -1)
    rows_before = F.coalesce(F.sum("__rows").over(earlier), F.lit(0))
    # A group's better rows begin with its first partition; a piece may be a later one.
    offsets = F.broadcast(offsets_before(pieces, F.sum("__rows")))
    placed = pieces.join(offsets, PART).select(
        PART, *group, (F.col(BEFORE) + rows_before).alias("__at"), F.col(BEFORE)
    )
    # A group has at most as many pieces as there are partitions.
    start = F.min("__at").over(Window.partitionBy(*group))
    shifts = placed.select(PART, *group, (F.col(BEFORE) - start + 1).alias("__shift"))
    better = F.coalesce(F.sum("__rows").over(earlier), F.lit(0))
    counted = staged.select(*group, VALUE, PART, better.alias("__better"))
    return attach(counted, shifts, [PART, *group]).select(
        *group, VALUE, (F.col("__better") + F.col("__shift")).alias("__rank")
    )


def _common_type(df: DataFrame, columns: Sequence[str]) -> str:
    """The type that holds all the columns' values without loss."""
    return df.select(F.coalesce(*columns).alias("v")).schema["v"].dataType.simpleString()


def _all(conditions) -> Column:
    return reduce(lambda left, right: left & right, conditions)
