"""Orders, consumption and revenue attribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchledger.functions import (
    amortize_monthly,
    date_key,
    first_match,
    minutes_to_hours,
    month_start,
    share_4dp,
)
from watchledger.operators.groups import group_total, sequence_in_group
from watchledger.operators.keep import keep_top
from watchledger.operators.numbering import number_rows
from watchledger.scratch import Scratch
from watchledger.settings import Settings

# Words looked for in the product text, first match wins.
TYPE_WORDS = (("YEARLY", "YEARLY"), ("MONTHLY", "MONTHLY"))
TIER_WORDS = (("PROFESSIONAL", "PROFESSIONAL"), ("SUBSCRIPTION", "STANDARD"))
INTERVAL_WORDS = (("YEARLY", 12), ("MONTHLY", 1))
PAID_PLANS = ("MONTHLY", "YEARLY")

MONEY = "decimal(12,2)"


def fact_order(
    orders: DataFrame, customers: DataFrame, settings: Settings, scratch: Scratch
) -> DataFrame:
    """One row per order with its plan, monthly value and place in sequence.

    Orders are numbered by customer and time in sorted ranges, so that a
    customer may have any share of them; those without one are a group too.
    """
    key = ["customer_id"]
    order = [F.asc_nulls_last("order_created_at"), F.asc_nulls_last("order_id")]
    placed = sequence_in_group(
        orders,
        key,
        order,
        scratch,
        sequence="order_sequence",
        is_last="is_latest_order",
        lookup=customers.where("is_current").select("customer_key", "customer_id"),
    )
    # The id is the key; the rest only splits and settles repeated or null ids.
    total_order = ["order_id", "order_created_at", "customer_id", "order_number"]
    keyed = number_rows(placed, total_order, scratch, "order_key")

    return keyed.select(
        "order_key",
        "order_id",
        "order_number",
        "customer_key",
        *plan_columns(),
        (F.col("order_sequence") == 1).alias("is_first_order"),
        "is_latest_order",
        "order_sequence",
    )


def plan_columns() -> list[Column]:
    """What a staged order says of its date, product, plan and value."""
    text = F.col("line_items")
    plan = first_match(text, TYPE_WORDS)
    net = F.col("net_usd")
    monthly = F.when(plan == "YEARLY", amortize_monthly(net)).otherwise(net)
    return [
        date_key(F.col("order_created_at")).alias("date_key"),
        F.col("order_created_at"),
        text,
        F.col("billing_address_country").alias("billing_country"),
        plan.alias("subscription_type"),
        first_match(text, TIER_WORDS).alias("subscription_tier"),
        first_match(text, INTERVAL_WORDS).alias("subscription_interval_months"),
        net.alias("net_amount_usd"),
        monthly.cast(MONEY).alias("monthly_value"),
    ]


def minutes_by_keys(
    consumption: DataFrame, customers: DataFrame, courses: DataFrame
) -> DataFrame:
    """Minutes per customer, course and month, without rows that match neither.

    Watch rows are summed by their natural keys before they meet the
    dimensions: this shrinks them ahead of the joins and breaks up hot users
    and hot courses. What is left of the skew is in the joins alone, where
    adaptive execution splits large partitions.
    """
    minutes = consumption.groupBy("user_id", "course_name", "consumption_month").agg(
        F.sum("minutes_consumed").alias("total_minutes_consumed")
    )
    current = customers.where("is_current").select(
        "customer_key", F.col("customer_id").alias("user_id")
    )
    titles = courses.select("course_key", "course_name", "is_revenue_generating")
    matched = minutes.join(current, "user_id").join(titles, "course_name")
    return matched.drop("user_id", "course_name")


def fact_consumption(
    consumption: DataFrame,
    customers: DataFrame,
    courses: DataFrame,
    settings: Settings,
    scratch: Scratch,
) -> DataFrame:
    """Minutes per customer, course and month, with the share of the month."""
    group = ["customer_key", "consumption_month"]
    grain = ["customer_key", "course_key", "consumption_month"]
    with scratch.within("consumption-steps") as steps:
        matched = minutes_by_keys(consumption, customers, courses)
        matched = steps.stage(matched, "matched-minutes")
        total = group_total(matched, group, "total_minutes_consumed", "month_minutes")
        keyed = number_rows(total, grain, scratch, "consumption_key")
    spent = F.col("total_minutes_consumed")
    return keyed.select(
        "consumption_key",
        "customer_key",
        "course_key",
        date_key(F.col("consumption_month")).alias("date_key"),
        "consumption_month",
        "total_minutes_consumed",
        minutes_to_hours(spent).alias("total_hours_consumed"),
        F.lit(None).cast("long").alias("unique_sessions"),
        F.lit(None).cast("decimal(5,2)").alias("completion_percentage"),
        share_4dp(spent, F.col("month_minutes")).alias(
            "consumption_percentage_of_month"
        ),
        F.col("is_revenue_generating").alias("is_revenue_eligible"),
    )


def latest_paid_orders(orders: DataFrame) -> DataFrame:
    """The last subscription order with a value, per customer and month."""
    paid = orders.where(
        F.col("subscription_type").isin(*PAID_PLANS)
        & F.col("customer_key").isNotNull()
        & F.col("order_created_at").isNotNull()
        & (F.col("monthly_value") > 0)
    )
    dated = paid.select(
        "customer_key",
        month_start(F.col("order_created_at")).alias("consumption_month"),
        "order_created_at",
        "order_key",
        "subscription_type",
        F.col("monthly_value").alias("subscription_monthly_value"),
    )
    latest = [F.desc("order_created_at"), F.desc("order_key")]
    top = keep_top(dated, ["customer_key", "consumption_month"], latest)
    return top.drop("order_created_at")


def fact_revenue_attribution(
    orders: DataFrame, consumption: DataFrame, settings: Settings, scratch: Scratch
) -> DataFrame:
    """Each month's subscription value spread over the paid courses watched.

    Totals and orders have one row per customer and month each. They are
    joined first, and the rows of the months that are left join them once.
    """
    group = ["customer_key", "consumption_month"]
    paid = consumption.where("is_revenue_eligible").select(
        "customer_key",
        "course_key",
        "date_key",
        "consumption_month",
        F.col("total_minutes_consumed").alias("course_minutes_consumed"),
    )
    totals = paid.groupBy(*group).agg(
        F.sum("course_minutes_consumed").alias("total_paid_minutes_consumed")
    )
    months = totals.join(latest_paid_orders(orders), group)
    shared = paid.join(months, group)
    order = ["customer_key", "course_key", "order_key", "consumption_month"]
    keyed = number_rows(shared, order, scratch, "revenue_key")

    share = share_4dp(
        F.col("course_minutes_consumed"), F.col("total_paid_minutes_consumed")
    )
    shares = keyed.withColumn("attribution_percentage", share)
    # The share is rounded first; the royalty starts from the unrounded product.
    product = F.col("subscription_monthly_value") * F.col("attribution_percentage")
    royalty = product * F.lit(settings.royalty_rate)
    return shares.select(
        "revenue_key",
        "customer_key",
        "course_key",
        "order_key",
        "date_key",
        F.col("consumption_month").alias("revenue_month"),
        "subscription_type",
        "subscription_monthly_value",
        "course_minutes_consumed",
        "total_paid_minutes_consumed",
        "attribution_percentage",
        F.round(product, 2).cast(MONEY).alias("attributed_revenue"),
        F.round(royalty, 2).cast(MONEY).alias("instructor_royalty"),
        F.lit(False).alias("is_free_course"),
    )
