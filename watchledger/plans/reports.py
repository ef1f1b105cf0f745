"""Report queries over the views and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchledger.plans import quality


def mrr_arr(view: DataFrame) -> DataFrame:
    return view.orderBy(F.desc("month"))


def top_courses(course_revenue: DataFrame, n: int = 10) -> DataFrame:
    best = [F.desc_nulls_first("total_revenue"), "month", "course_name"]
    return (
        course_revenue.select(
            "month",
            "course_name",
            "instructor",
            "total_revenue",
            "unique_students",
            "total_instructor_royalty",
        )
        .orderBy(*best)
        .limit(n)
    )


def instructor_totals(course_revenue: DataFrame) -> DataFrame:
    totals = course_revenue.groupBy("instructor").agg(
        F.round(F.sum("total_revenue"), 2).alias("total_revenue"),
        F.round(F.sum("total_instructor_royalty"), 2).alias(
            "total_instructor_royalty"
        ),
    )
    return totals.orderBy(F.desc_nulls_first("total_instructor_royalty"), "instructor")


def bad_attribution(attribution: DataFrame, n: int = 20) -> DataFrame:
    """The first customer-months whose shares miss 1."""
    rows = quality.attribution_sums(attribution).select(
        "customer_key", "revenue_month", "pct_sum", "revenue_sum", "row_count"
    )
    return rows.orderBy("revenue_month", "customer_key").limit(n)


def bad_tieout(attribution: DataFrame, n: int = 20) -> DataFrame:
    """The first customer-months whose revenue misses the monthly value."""
    rows = quality.revenue_ties_out(attribution)
    return rows.orderBy("revenue_month", "customer_key").limit(n)


def order_classes(orders: DataFrame) -> DataFrame:
    classes = ["subscription_type", "subscription_tier", "subscription_interval_months"]
    counted = orders.groupBy(*classes).agg(F.count(F.lit(1)).alias("order_count"))
    return counted.orderBy(F.desc("order_count"), *classes)


def eligibility(consumption: DataFrame) -> DataFrame:
    return (
        consumption.groupBy("is_revenue_eligible")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum("total_minutes_consumed").alias("total_minutes_consumed"),
        )
        .orderBy("is_revenue_eligible")
    )


def revenue_by_month(attribution: DataFrame) -> DataFrame:
    return (
        attribution.groupBy("revenue_month")
        .agg(F.round(F.sum("attributed_revenue"), 2).alias("total_attributed_revenue"))
        .orderBy("revenue_month")
    )


def course_sample(course_revenue: DataFrame, n: int = 10) -> DataFrame:
    first = [F.desc("month"), F.desc_nulls_first("total_revenue"), "course_name"]
    return course_revenue.orderBy(*first).limit(n)
