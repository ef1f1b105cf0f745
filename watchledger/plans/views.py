"""The five analytics views.

Customer counts use the grain of the facts: one row per customer, course and
month. Counting per course key therefore gives the number of customers. Where
several course keys share a title that no longer holds, so ``_per_course`` keeps
the customer in the key for those titles alone.

A view is lazy: defining one runs nothing and writes nothing. Ranks need more
than one pass, so ``course_months`` is a table of its own, one row per course and
month, and the view on top of it is a projection.

Ratios are computed after the final sort: sampling for the sort evaluates what
lies below it a second time.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchledger.functions import (
    half_up_ratio,
    half_up_ratio_wide,
    mean_of_amounts,
    minutes_to_hours,
    recency_status,
)
from watchledger.functions.amounts import cents
from watchledger.operators.groups import attach, ranks_in_group
from watchledger.scratch import Scratch
from watchledger.settings import Settings

TITLE = ("course_name", "course_type", "course_instructor")


def view_monthly_mrr_arr(attribution: DataFrame) -> DataFrame:
    """Recurring revenue, movements, growth and retention by month.

    The monthly value repeats on each course row of a customer and is summed
    over those rows, as the published figures do. Windows here see one row per
    customer and month, then one row per month, so calendars bound them.
    """
    per_customer = attribution.groupBy("revenue_month", "customer_key").agg(
        F.sum("subscription_monthly_value").cast("decimal(20,2)").alias("mrr")
    )
    by_month = Window.partitionBy("customer_key").orderBy("revenue_month")
    before = F.lag("mrr").over(by_month)
    with_before = per_customer.select("revenue_month", "mrr", before.alias("before"))

    mrr, prior = F.col("mrr"), F.col("before")
    is_new = prior.isNull()
    zero = F.lit(0).cast("decimal(20,2)")

    def total(of: Column, when: Column | None = None) -> Column:
        picked = of if when is None else F.when(when, of).otherwise(zero)
        return F.sum(picked).cast("decimal(24,2)")

    months = with_before.groupBy("revenue_month").agg(
        total(mrr).alias("mrr"),
        total(mrr, is_new).alias("new_mrr"),
        total(mrr - prior, mrr > prior).alias("expansion_mrr"),
        total(prior - mrr, mrr < prior).alias("contraction_mrr"),
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(is_new).alias("new_customers"),
        F.count_if(~is_new).alias("retained_customers"),
    )
    churned = F.lit(0).cast("decimal(12,2)")
    gained = F.col("new_mrr") + F.col("expansion_mrr")
    lost = churned + F.col("contraction_mrr")
    net_new = (gained - lost).cast("decimal(26,2)")
    last_month = Window.orderBy("revenue_month")
    mrr_before = F.lag("mrr").over(last_month)
    customers_before = F.lag("total_customers").over(last_month)
    retained = F.col("retained_customers").cast("decimal(20,0)")
    net_cents, mrr_cents = cents(net_new), cents(F.col("mrr"))
    hundred_customers = F.col("total_customers").cast("decimal(20,0)") * 100
    return months.select(
        F.col("revenue_month").alias("month"),
        "mrr",
        (F.col("mrr") * 12).cast("decimal(26,2)").alias("arr"),
        "new_mrr",
        churned.alias("churned_mrr"),
        "expansion_mrr",
        "contraction_mrr",
        net_new.alias("net_new_mrr"),
        half_up_ratio_wide(net_cents * 100, cents(mrr_before), 2).alias(
            "mrr_growth_rate_pct"
        ),
        "total_customers",
        "new_customers",
        "retained_customers",
        half_up_ratio_wide(retained * 100, customers_before, 2).alias(
            "customer_retention_rate_pct"
        ),
        half_up_ratio_wide(mrr_cents, hundred_customers, 2).alias("arpu"),
        half_up_ratio_wide(cents(gained), cents(lost), 2).alias("quick_ratio"),
    ).orderBy(F.desc("month"))


def course_months(
    attribution: DataFrame, courses: DataFrame, settings: Settings, scratch: Scratch
) -> DataFrame:
    """Totals, customers and ranks of each paid course by month, to be stored."""
    engaged = F.col("course_minutes_consumed") >= settings.engaged_minutes
    per_course = _per_course(
        attribution,
        courses.where(F.col("course_type") == "PAID"),
        "revenue_month",
        totals={
            "total_revenue": F.sum("attributed_revenue"),
            "total_minutes_consumed": F.sum("course_minutes_consumed"),
            "total_instructor_royalty": F.sum("instructor_royalty"),
            # A mean leaves null out: months without minutes have no revenue.
            "revenue_rows": F.count("attributed_revenue"),
            "minutes_rows": F.count("course_minutes_consumed"),
        },
        customers={"unique_students": F.lit(True), "students_1plus_hours": engaged},
        scratch=scratch,
    )
    metrics = {"revenue_rank": "total_revenue", "popularity_rank": "unique_students"}
    staged = scratch.stage(per_course, "course-months")
    return ranks_in_group(staged, ["month"], metrics, scratch)


def view_course_revenue_monthly(months: DataFrame) -> DataFrame:
    """Revenue, engagement and ranks over the stored ``course_months``."""
    revenue, students = F.col("total_revenue"), F.col("unique_students")
    minutes = F.col("total_minutes_consumed")
    engaged_100 = F.col("students_1plus_hours") * 100
    sorted_rows = months.orderBy(
        F.desc("month"), F.desc_nulls_first("total_revenue"), "course_name"
    )
    return sorted_rows.select(
        "month",
        "course_name",
        "course_type",
        F.col("course_instructor").alias("instructor"),
        "total_revenue",
        mean_of_amounts(revenue, F.col("revenue_rows")).alias(
            "avg_revenue_per_student"
        ),
        "total_minutes_consumed",
        minutes_to_hours(minutes).alias("total_hours_consumed"),
        half_up_ratio(minutes, F.col("minutes_rows"), 2).alias(
            "avg_minutes_per_student"
        ),
        "unique_students",
        "students_1plus_hours",
        half_up_ratio(engaged_100, students, 2).alias("engagement_rate_pct"),
        "total_instructor_royalty",
        "revenue_rank",
        "popularity_rank",
    )


def view_instructor_royalties_monthly(
    attribution: DataFrame, courses: DataFrame
) -> DataFrame:
    """Royalty of each instructor by month.

    A customer may watch several courses of one instructor. Rows are first
    reduced to instructor, month and customer, with the customer in the key so
    that no group is large, and then to instructor and month.
    """
    paid = courses.where(F.col("course_type") == "PAID").select("course_key", *TITLE)
    who = ["revenue_month", "course_instructor"]
    per_customer = (
        attribution.join(paid, "course_key")
        .groupBy(*who, "customer_key")
        .agg(
            F.sum("attributed_revenue").alias("revenue"),
            F.sum("instructor_royalty").alias("royalty"),
        )
    )
    per_month = per_customer.groupBy(*who).agg(
        F.sum("revenue").cast("decimal(24,2)").alias("total_course_revenue"),
        F.sum("royalty").cast("decimal(24,2)").alias("royalty_amount"),
        F.count(F.lit(1)).alias("unique_students"),
    )
    names = (
        attribution.groupBy("revenue_month", "course_key")
        .agg(F.lit(1).alias("one"))
        .join(paid, "course_key")
        .groupBy(*who)
        .agg(F.countDistinct("course_name").alias("courses_count"))
        .withColumnsRenamed({"revenue_month": "m", "course_instructor": "i"})
    )
    same = F.col("m").eqNullSafe(F.col("revenue_month")) & F.col("i").eqNullSafe(
        F.col("course_instructor")
    )
    return (
        per_month.join(names, same)
        .select(
            F.col("revenue_month").alias("month"),
            F.col("course_instructor").alias("instructor"),
            "courses_count",
            "total_course_revenue",
            "royalty_amount",
            "unique_students",
        )
        .orderBy(F.desc("month"), F.desc_nulls_first("royalty_amount"), "instructor")
    )


def view_customer_subscription_status(
    customers: DataFrame, orders: DataFrame, settings: Settings
) -> DataFrame:
    """Plan, monthly value and recency of each current customer.

    Only a latest order that is a subscription counts; a customer who bought
    something else last shows no plan.
    """
    latest = orders.where(
        F.col("is_latest_order")
        & F.col("subscription_type").isNotNull()
        & F.col("customer_key").isNotNull()
    ).select(
        "customer_key",
        F.col("order_created_at").alias("last_order_date"),
        F.col("subscription_type").alias("plan"),
        "monthly_value",
    )
    status = recency_status(
        F.col("last_order_date"), settings.as_of, settings.at_risk_days
    )
    nothing = F.lit(Decimal("0.00")).cast("decimal(12,2)")
    return (
        customers.where("is_current")
        .join(latest, "customer_key", "left")
        .select(
            "customer_id",
            F.coalesce("plan", F.lit("NONE")).alias("current_plan"),
            F.coalesce("monthly_value", nothing).alias("mrr"),
            F.col("first_order_date").alias("start_date"),
            "last_order_date",
            "total_spent",
            status.alias("status"),
        )
        .orderBy(F.desc_nulls_first("total_spent"), "customer_id")
    )


def view_consumption_trends(consumption: DataFrame, courses: DataFrame) -> DataFrame:
    """Minutes, hours and users of each course by month."""
    per_course = _per_course(
        consumption,
        courses,
        "consumption_month",
        totals={
            "total_minutes": F.sum("total_minutes_consumed"),
            "total_hours": F.sum("total_hours_consumed"),
        },
        customers={"unique_users": F.lit(True)},
    )
    mean = half_up_ratio(F.col("total_minutes"), F.col("unique_users"), 2)
    sorted_rows = per_course.orderBy(
        F.desc("month"), F.desc_nulls_first("total_minutes"), "course_name"
    )
    return sorted_rows.select(
        "month",
        "course_name",
        "course_type",
        F.col("course_instructor").alias("instructor"),
        "total_minutes",
        "unique_users",
        mean.alias("avg_minutes_per_user"),
        "total_hours",
    )


def _per_course(
    fact: DataFrame,
    courses: DataFrame,
    month: str,
    totals: dict[str, Column],
    customers: dict[str, Column],
    scratch: Scratch | None = None,
) -> DataFrame:
    """Additive totals, and customers that meet a condition, per course and month.

    Rows are grouped by a key for the title, the least of its course keys. The
    texts of the title join what is left. With ``scratch`` the first sums are staged.
    """
    titles = courses.select("course_key", *TITLE)
    keys = titles.groupBy(*TITLE).agg(
        F.min("course_key").alias("title_key"), (F.count(F.lit(1)) > 1).alias("shared")
    )
    known = attach(titles, keys, TITLE).select("course_key", "title_key", "shared")
    group = ["month", "title_key"]
    named = fact.withColumnRenamed(month, "month").join(known, "course_key")
    # The customer is in the key only where one may meet a title twice.
    rows = named.withColumn("who", F.when(F.col("shared"), F.col("customer_key")))
    counted = {}
    for name, met in customers.items():
        once = F.max(F.coalesce(met, F.lit(False)).cast("long"))
        counted[name] = F.when(F.col("shared"), once).otherwise(F.count_if(met))
    per_customer = _aggregate(rows, [*group, "shared", "who"], totals | counted)
    if scratch is not None:
        per_customer = scratch.stage(per_customer, "course-customers")
    again = {name: F.sum(name) for name in [*totals, *counted]}
    per_title = _aggregate(per_customer, group, again)
    return per_title.join(keys.drop("shared"), "title_key").select(
        "month", *TITLE, *totals, *counted
    )


def _aggregate(
    df: DataFrame, keys: Sequence[str], values: dict[str, Column]
) -> DataFrame:
    return df.groupBy(*keys).agg(*[v.alias(name) for name, v in values.items()])
