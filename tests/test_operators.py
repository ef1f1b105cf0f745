import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from watchledger.operators import (
    accepted_values,
    group_total,
    keep_top,
    not_null,
    null_counts,
    number_rows,
    orphans,
    rank_in_group,
    scd2_merge,
    sequence_in_group,
    unique,
)

ROWS = 6000


@pytest.fixture
def skewed(spark):
    """A third of the rows in one group, a sixth without a group, heavy ties."""
    n = F.col("id")
    group = F.when(n % 3 == 0, 7).when(n % 6 == 1, None).otherwise(n % 400)
    return spark.range(ROWS).select(
        n,
        group.cast("long").alias("k"),
        F.when(n % 11 == 0, None).otherwise(n * 7919 % 97).alias("v"),
        (n * 31 % 5).alias("tie"),
    )


def same(left, right):
    key = lambda row: repr(row)
    assert left.columns == right.columns
    assert sorted(left.collect(), key=key) == sorted(right.collect(), key=key)


def test_number_rows_is_dense_and_ordered(skewed, scratch):
    got = number_rows(skewed, [F.desc_nulls_first("v"), "id"], scratch, "n")
    order = Window.orderBy(F.desc_nulls_first("v"), "id")
    same(got, skewed.select(F.row_number().over(order).cast("long").alias("n"), "*"))


def test_number_rows_of_nothing(skewed, scratch):
    assert number_rows(skewed.where("id < 0"), ["id"], scratch, "n").count() == 0


def test_number_rows_does_not_use_one_partition(skewed, scratch, plan_of):
    got = number_rows(skewed, ["id"], scratch, "n")
    wide = [line for line in plan_of(got).splitlines() if "SinglePartition" in line]
    # Only the table of partition sizes may pass through a single partition.
    assert len(wide) <= 1
    assert "BroadcastHashJoin" in plan_of(got)


def test_sequence_in_group(skewed, scratch):
    order = [F.asc_nulls_last("v"), F.asc("id")]
    window = Window.partitionBy("k").orderBy(*order)
    plain = skewed.select(
        "*",
        F.row_number().over(window).cast("long").alias("sequence"),
        F.lead(F.lit(1)).over(window).isNull().alias("is_last"),
    )
    same(sequence_in_group(skewed, ["k"], order, scratch), plain)


def test_lookup_of_groups(spark, skewed, scratch):
    """Every row gets its group's value; the null group and misses get none."""
    names = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    got = sequence_in_group(skewed, ["k"], [F.asc("id")], scratch, lookup=names)
    assert got.count() == ROWS
    wrong = F.col("k").isNull() | (F.col("k") >= 300)
    assert got.where(wrong & F.col("d").isNotNull()).isEmpty()
    assert got.where(~wrong & (~F.col("d").eqNullSafe(F.col("k") * 2))).isEmpty()


def test_total_of_groups(skewed):
    total = F.sum("v").over(Window.partitionBy("k")).alias("total")
    same(group_total(skewed, ["k"], "v", "total"), skewed.select("*", total))


@pytest.mark.parametrize("metric", ["v", "tie"])
def test_rank_in_groups(skewed, scratch, metric):
    window = Window.partitionBy("k").orderBy(F.desc_nulls_first(metric))
    plain = skewed.select("*", F.rank().over(window).cast("long").alias("place"))
    got = rank_in_group(skewed, ["k"], metric, "place", scratch)
    same(got.select(*plain.columns), plain)


def test_no_group_is_given_to_one_window_task(skewed, scratch, plan_of):
    order = [F.asc("id")]
    for df in (
        sequence_in_group(skewed, ["k"], order, scratch),
        group_total(skewed, ["k"], "v", "total"),
        rank_in_group(skewed, ["k"], "v", "place", scratch),
    ):
        windows = [x for x in plan_of(df).splitlines() if "Window [" in x]
        assert all("__part" in x for x in windows)


def test_keep_top_reduces_before_the_shuffle(skewed, plan_of):
    top = keep_top(skewed, ["k"], [F.desc_nulls_first("v"), F.desc("id")])
    plan = plan_of(top)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    want = {}
    for r in skewed.collect():
        rank = (r.v is None, r.v if r.v is not None else 0, r.id)
        want[r.k] = max(want.get(r.k, rank), rank)
    assert {r.k: r.id for r in top.collect()} == {k: v[2] for k, v in want.items()}


# -- history ---------------------------------------------------------------

LOAD = "customer_id long, spent int, paid string, first string"
T1, T2, T3 = (dt.datetime(2022, m, 1) for m in (1, 2, 3))


def merge(load, prior, when):
    return scd2_merge(load, prior, "customer_id", ["spent", "paid"], when)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_a_version_that_begins_later_is_refused(spark):
    kinds = "customer_id long, spent int, paid int"
    first = spark.createDataFrame([(1, 5, 0)], kinds)
    prior = merge(first, None, dt.datetime(2022, 6, 1))
    for when in (dt.datetime(2022, 5, 1), dt.datetime(2022, 6, 1)):
        with pytest.raises(Exception, match="begins at"):
            merge(spark.createDataFrame([(1, 6, 0)], kinds), prior, when).collect()


def test_history(spark, scratch):
    first = merge(
        spark.createDataFrame(
            [
                (1, 10, "a", "x"),  # spend will change
                (2, 20, "b", "x"),  # only the unchecked column will change
                (3, 30, "c", "x"),  # will be missing
                (4, None, "d", "x"),  # null will become a value
                (5, None, None, "x"),  # stays as it is
            ],
            LOAD,
        ),
        None,
        T1,
    )
    first = scratch.stage(first, "first")
    second = merge(
        spark.createDataFrame(
            [
                (1, 11, "a", "x"),
                (2, 20, "b", "y"),
                (4, 40, "d", "x"),
                (5, None, None, "x"),
                (6, 60, "f", "x"),
            ],
            LOAD,
        ),
        first,
        T2,
    )
    assert rows(second) == sorted(
        [
            (1, 10, "a", "x", T1, T2),
            (1, 11, "a", "x", T2, None),
            (2, 20, "b", "x", T1, None),
            (3, 30, "c", "x", T1, None),
            (4, None, "d", "x", T1, T2),
            (4, 40, "d", "x", T2, None),
            (5, None, None, "x", T1, None),
            (6, 60, "f", "x", T2, None),
        ],
        key=repr,
    )
    # Closed versions pass through a third load; going back opens a version.
    second = scratch.stage(second, "second")
    third = merge(spark.createDataFrame([(1, 10, "a", "x")], LOAD), second, T3)
    versions = [r for r in rows(third) if r[0] == 1]
    assert versions == [
        (1, 10, "a", "x", T1, T2),
        (1, 10, "a", "x", T3, None),
        (1, 11, "a", "x", T2, T3),
    ]
    assert third.count() == 9


# -- checks ----------------------------------------------------------------


def test_checks_find_planted_rows(spark):
    df = spark.createDataFrame(
        [(1, "A"), (1, "A"), (2, "B"), (None, "C"), (None, None)], "k long, t string"
    )
    assert rows(unique(df, "k")) == [(1, 2)]
    assert not_null(df, "k").count() == 2
    assert rows(null_counts(df, ["k", "t"])) == [("k", 2), ("t", 1)]
    assert rows(accepted_values(df, "t", ["A", "B"])) == [("C", 1)]
    parent = spark.createDataFrame([(1,), (None,)], "k long")
    assert rows(orphans(df, "k", parent, "k")) == [(2, 1)]
