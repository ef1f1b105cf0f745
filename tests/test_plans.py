"""What the physical plans must and must not contain.

Broadcasts by size are switched off, so that the plans are those of large
tables. Every plan that writes an intermediate table is looked at as well.
"""

import pytest

from pyspark.sql import functions as F

import watchledger.scratch
from watchledger.plans import facts, views
from watchledger.settings import Settings
from workload.context import Context

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plans(spark):
    """Plan texts by name: staged tables, and the views over them."""
    texts = {}
    stage = watchledger.scratch.Scratch.stage

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def recording(self, df, name):
        texts.setdefault(name, text(df))
        return stage(self, df, name)

    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.maxMetadataStringLength": "5000",
        "spark.sql.debug.maxToStringFields": "200",
    }
    for name, value in changed.items():
        spark.conf.set(name, value)
    watchledger.scratch.Scratch.stage = recording
    try:
        c = Context(spark, FOLDER, Settings())
        facts = c.fact_revenue_attribution, c.fact_order, c.fact_consumption
        attribution, orders, consumption = facts
        courses, customers = c.dim_course, c.dim_customer
        built = {
            "mrr": views.view_monthly_mrr_arr(attribution),
            "courses": c.view_course_revenue_monthly(),
            "royalties": views.view_instructor_royalties_monthly(attribution, courses),
            "status": views.view_customer_subscription_status(
                customers, orders, c.settings
            ),
            "trends": views.view_consumption_trends(consumption, courses),
        }
        texts.update({name: text(df) for name, df in built.items()})
    finally:
        watchledger.scratch.Scratch.stage = stage
        for name in changed:
            spark.conf.unset(name)
    return texts


def lines(plan, *words):
    return [x for x in plan.splitlines() if all(w in x for w in words)]


def test_no_cross_joins(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_only_bounded_tables_are_broadcast(plans):
    """With size-based broadcasts off, only partition offsets remain."""
    for name, plan in plans.items():
        for join in lines(plan, "BroadcastHashJoin"):
            assert "__part" in join, (name, join)


def test_one_partition_sees_only_months_or_partition_sizes(plans):
    for name, plan in plans.items():
        allowed = 1 if name == "mrr" or "__part" in plan else 0
        assert len(lines(plan, "Exchange SinglePartition")) <= allowed, name


def test_no_python_in_the_plans(plans):
    for name, plan in plans.items():
        for word in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
            assert word not in plan, name


def test_attribution_joins_months_before_rows(plans):
    """Totals and latest orders meet first; the rows join what is left once."""
    plan = plans["ordered-revenue_key"]
    assert len(lines(plan, "Exchange rangepartitioning")) == 1
    assert lines(plan, "WindowGroupLimit", "Partial")
    assert len(lines(plan, "FileScan", "total_minutes_consumed")) == 2


def test_watched_minutes_are_staged_once_and_read_twice(plans):
    assert len(lines(plans["ordered-consumption_key"], "FileScan", "total_minutes_consumed")) == 2
    assert len(lines(plans["matched-minutes"], "FileScan", "l_quantity")) == 1


def test_raw_orders_are_read_once(plans):
    assert len(lines(plans["ordered-__n"], "FileScan", "o_totalprice")) == 1
    assert not lines(plans["ordered-order_key"], "FileScan", "o_totalprice")


def test_no_window_takes_a_whole_group_of_facts(plans):
    for name in ("ordered-__n", "ordered-order_key", "ordered-consumption_key", "course-months"):
        assert all("__part" in x for x in lines(plans[name], "Window [")), name


def test_scans_are_pruned_and_filtered(plans):
    (scan,) = lines(plans["ordered-revenue_key"], "FileScan", "order_created_at")
    assert "In(subscription_type, [MONTHLY,YEARLY])" in scan.split("PushedFilters")[1]
    assert "line_items" not in scan and "net_amount_usd" not in scan
    (scan,) = lines(plans["mrr"], "FileScan")
    columns = scan.split("[", 1)[1].split("]", 1)[0]
    assert {c.split("#")[0] for c in columns.split(",")} == {
        "customer_key",
        "revenue_month",
        "subscription_monthly_value",
    }
    for scan in lines(plans["matched-minutes"], "FileScan", "l_quantity"):
        assert "l_shipdate" not in scan and "l_extendedprice" not in scan


def test_sums_are_combined_before_the_shuffle(plans):
    for name in ("matched-minutes", "course-months", "trends", "mrr"):
        assert lines(plans[name], "HashAggregate", "partial_sum"), name


def test_join_of_a_hot_user_is_split(spark):
    """One user holds a third of the rows, still after they are summed."""
    n = F.col("id")
    user = F.when(n % 3 == 0, 7).otherwise(n % 5000)
    watched = spark.range(300_000).select(
        user.cast("long").alias("user_id"),
        F.concat(F.lit("course "), (n % 100_000).cast("string")).alias("course_name"),
        F.lit("2022-10-01").cast("date").alias("consumption_month"),
        F.lit(5).alias("minutes_consumed"),
    )
    customers = spark.range(5000).select(
        (n + 1).alias("customer_key"), n.alias("customer_id"), F.lit(True).alias("is_current")
    )
    courses = spark.range(100_000).select(
        (n + 1).alias("course_key"),
        F.concat(F.lit("course "), n.cast("string")).alias("course_name"),
        F.lit(True).alias("is_revenue_generating"),
    )
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        df = facts.minutes_by_keys(watched, customers, courses)
        plan = df._jdf.queryExecution().executedPlan()
        rows = plan.execute().count()
    finally:
        for name in changed:
            spark.conf.unset(name)
    final = plan.toString().split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true) [user_id" in final
    assert rows == watched.select("user_id", "course_name").distinct().count()


def test_ranks_read_each_stored_table_twice_at_most(plans):
    """Both ranks share one sort; what they are joined to is read for them and once more."""
    scans = {name: len(lines(plans[name], "FileScan", f"-{stored}]")) for name, stored in (
        ("rank-pieces", "ordered-ranks"), ("ranks", "rank-pieces"), ("course_months", "ranks"))}
    assert len(lines(plans["ranks"], "FileScan", "ordered-ranks")) == 1
    assert len(lines(plans["rank-pieces"], "FileScan", "ordered-ranks")) == 1
    assert len(lines(plans["course_months"], "FileScan", "ranks,")) + scans["course_months"] <= 2
    assert len(lines(plans["course_months"], "FileScan", "-course-months")) == 1
    assert len(lines(plans["ordered-ranks"], "FileScan", "-course-months")) == 1
