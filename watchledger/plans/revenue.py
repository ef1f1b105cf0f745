"""Revenue beyond the standing models: to the cent, by covered month, and over time.

Monthly value here counts once per customer and month, and a month is followed by
the month after it, whether or not the customer was there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchledger.functions import half_up_ratio_wide, month_start
from watchledger.functions.amounts import cents
from watchledger.operators.apportion import apportion
from watchledger.plans.facts import MONEY, PAID_PLANS
from watchledger.scratch import Scratch
from watchledger.settings import Settings

#: A month's value may change by so many per cent before it is reported.
ALERT_PCT = 20


# -- to the cent -------------------------------------------------------------


def exact_revenue(shared: DataFrame, settings: Settings, scratch: Scratch) -> DataFrame:
    """Each customer-month's value over its titles, adding up to the cent.

    ``shared`` has customer_key, course_key, revenue_month, order_key,
    subscription_monthly_value and course_minutes_consumed, a row per customer,
    title and month. Shares are not rounded before they are multiplied.
    """
    whole = shared.select(
        "customer_key",
        "course_key",
        "revenue_month",
        "order_key",
        "subscription_monthly_value",
        "course_minutes_consumed",
        cents(F.col("subscription_monthly_value")).cast("long").alias("value_cents"),
    )
    dealt = apportion(
        whole,
        ["customer_key", "revenue_month"],
        "value_cents",
        "course_minutes_consumed",
        "cents",
        [F.asc("course_key"), F.asc("order_key")],
        scratch,
    )
    revenue = (F.col("cents").cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY)
    return dealt.select(
        "customer_key",
        "course_key",
        "revenue_month",
        "order_key",
        "subscription_monthly_value",
        "course_minutes_consumed",
        revenue.alias("exact_revenue"),
        F.round(revenue * F.lit(settings.royalty_rate), 2).cast(MONEY).alias("instructor_royalty"),
    )


def tie_out_by_month(attribution: DataFrame, exact: DataFrame) -> DataFrame:
    """Per month: the value to hand out, what rounded shares and exact ones give."""
    month = ["revenue_month"]
    group = ["customer_key", *month]
    rounded = attribution.groupBy(*group).agg(
        F.max("subscription_monthly_value").alias("value"),
        F.coalesce(F.sum("attributed_revenue"), F.lit(0)).alias("rounded"),
    )
    to_cent = exact.groupBy(*month).agg(F.sum("exact_revenue").alias("exact_revenue"))
    off = F.count_if(F.col("rounded") != F.col("value"))
    per_month = rounded.groupBy(*month).agg(
        F.sum("value").alias("monthly_value"),
        F.sum("rounded").alias("rounded_revenue"),
        off.alias("customers_off"),
    )
    return per_month.join(to_cent, month)


# -- months covered by a plan ------------------------------------------------


def plan_months(orders: DataFrame) -> DataFrame:
    """The plan that covers a customer in a month, the one that started last.

    An order covers as many months as its interval has, from its own on. Orders of
    one customer, month and interval are reduced to the last one before they are
    spread over their months, and spread ones to the last one again, both with
    partial results ahead of the shuffle: no task sees all orders of a customer.
    """
    paid = orders.where(
        F.col("subscription_type").isin(*PAID_PLANS)
        & F.col("customer_key").isNotNull()
        & F.col("order_created_at").isNotNull()
        & (F.col("monthly_value") > 0)
        & (F.col("subscription_interval_months") > 0)
    )
    plan = F.struct(
        "order_created_at", "order_key", "subscription_type", "monthly_value"
    ).alias("plan")
    starts = (
        paid.select(
            "customer_key",
            month_start(F.col("order_created_at")).alias("start_month"),
            F.col("subscription_interval_months").alias("months"),
            plan,
        )
        .groupBy("customer_key", "start_month", "months")
        .agg(F.max("plan").alias("plan"))
    )
    offsets = F.explode(F.sequence(F.lit(0), F.col("months") - 1)).alias("offset")
    covered = starts.select("customer_key", "start_month", "plan", offsets)
    month = F.add_months("start_month", F.col("offset")).alias("revenue_month")
    latest = covered.groupBy("customer_key", month).agg(
        F.max(F.struct("plan", "offset")).alias("last")
    )
    return latest.select(
        "customer_key",
        "revenue_month",
        F.col("last.plan.order_key").alias("order_key"),
        F.col("last.plan.subscription_type").alias("subscription_type"),
        (F.col("last.offset") + 1).cast("long").alias("plan_month"),
        F.col("last.plan.monthly_value").alias("subscription_monthly_value"),
    )


def covered_revenue(
    consumption: DataFrame, covered: DataFrame, settings: Settings, scratch: Scratch
) -> DataFrame:
    """Every covered month's value over the paid titles watched in it, to the cent."""
    paid = consumption.where("is_revenue_eligible").select(
        "customer_key",
        "course_key",
        F.col("consumption_month").alias("revenue_month"),
        F.col("total_minutes_consumed").alias("course_minutes_consumed"),
    )
    shared = paid.join(covered, ["customer_key", "revenue_month"])
    return exact_revenue(shared, settings, scratch)


# -- over time ---------------------------------------------------------------


def customer_months(attribution: DataFrame) -> DataFrame:
    """Monthly value per customer and month, once however many titles were watched."""
    return attribution.groupBy("customer_key", F.col("revenue_month").alias("month")).agg(
        F.max("subscription_monthly_value").alias("mrr")
    )


def revenue_waterfall(months: DataFrame, scratch: Scratch) -> DataFrame:
    """How each month's value comes from the month before.

    ``months`` has customer_key, month and mrr, one row per customer and month.
    Each row meets the row of the month before, in a full outer join: without one a
    customer is new, or returned if there were months earlier; a row without a
    follower has churned a month later. Months in which nobody was active have a
    row as well. Opening, new, returned and expansion less contraction and churned
    is closing.
    """
    rows = scratch.stage(months, "customer-months")
    first = rows.groupBy("customer_key").agg(F.min("month").alias("first"))
    now = rows.join(first, "customer_key").select(
        "customer_key", "month", "mrr", (F.col("month") == F.col("first")).alias("is_first")
    )
    before = rows.select(
        "customer_key",
        F.add_months("month", F.lit(1)).alias("month"),
        F.col("mrr").alias("prior"),
    )
    pairs = now.join(before, ["customer_key", "month"], "full_outer")
    mrr, prior, zero = F.col("mrr"), F.col("prior"), F.lit(0).cast("decimal(12,2)")
    came, went = prior.isNull(), mrr.isNull()
    conditions: dict[str, tuple[Column, Column]] = {
        "opening_mrr": (~came, prior),
        "new_mrr": (came & F.col("is_first"), mrr),
        "returned_mrr": (came & ~F.col("is_first"), mrr),
        "expansion_mrr": (mrr > prior, mrr - prior),
        "contraction_mrr": (mrr < prior, prior - mrr),
        "churned_mrr": (went, prior),
        "closing_mrr": (~went, mrr),
    }
    counts = {
        "active_customers": ~went,
        "new_customers": came & F.col("is_first"),
        "returned_customers": came & ~F.col("is_first"),
        "churned_customers": went,
    }
    moved = pairs.groupBy("month").agg(
        *[
            F.sum(F.when(when, value).otherwise(zero)).cast("decimal(24,2)").alias(name)
            for name, (when, value) in conditions.items()
        ],
        *[F.count_if(when).alias(name) for name, when in counts.items()],
    )
    # Nothing is known of the month after the last one.
    ends = rows.agg(F.min("month").alias("low"), F.max("month").alias("high"))
    spine = ends.where("low is not null").select(
        F.explode(F.expr("sequence(low, high, interval 1 month)")).alias("month")
    )
    filled = spine.join(moved, "month", "left")
    change = cents(F.col("closing_mrr") - F.col("opening_mrr")) * 100
    full = filled.select(
        "month",
        *[F.coalesce(name, zero).cast("decimal(24,2)").alias(name) for name in conditions],
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in counts],
    ).withColumn("change_pct", half_up_ratio_wide(change, cents(F.col("opening_mrr")), 2))
    alert = F.coalesce(F.abs(F.col("change_pct")) > ALERT_PCT, F.lit(False))
    return full.withColumn("is_alert", alert).orderBy("month")


# -- cohorts -----------------------------------------------------------------

#: Months in one word of a customer's bitmap.
WORD_MONTHS = 60


def _month_number(month: Column) -> Column:
    return F.year(month) * 12 + F.month(month) - 1


def _month_of(number: Column) -> Column:
    return F.make_date(
        F.call_function("div", number, F.lit(12)).cast("int"), (number % 12 + 1).cast("int"), F.lit(1)
    )


def activity_bitmaps(active: DataFrame, month: str) -> DataFrame:
    """Per customer the months of activity as bits: words of ``WORD_MONTHS`` months.

    Bits are joined ahead of the shuffle, so one row per customer and word leaves a
    task, however often the customer was active. ``first`` is the first month.
    """
    number = _month_number(F.col(month))
    bit = F.expr(f"shiftleft(1L, cast(number % {WORD_MONTHS} as int))")
    words = (
        active.select("customer_key", number.alias("number"))
        .groupBy("customer_key", F.floor(F.col("number") / WORD_MONTHS).alias("word"))
        .agg(F.bit_or(bit).alias("bits"), F.min("number").alias("first"))
    )
    return words.groupBy("customer_key").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words"),
        F.min("first").alias("first"),
    )


def cohort_retention(active: DataFrame, month: str, scratch: Scratch) -> DataFrame:
    """How many customers of a first month were active so many months later.

    One scan of ``active``: the triangle is read from the bitmaps. Ages without
    anybody have a row too, up to the last month that is known.
    """
    bitmaps = scratch.stage(activity_bitmaps(active, month), "activity")
    high = F.expr(
        f"aggregate(map_entries(words), 0L, (m, e) -> greatest(m, e.key * {WORD_MONTHS}"
        f" + cast(length(bin(e.value)) as bigint) - 1))"
    )
    last = bitmaps.agg(F.max(high)).first()[0]  # one number
    ages = F.explode(F.sequence(F.lit(0), F.lit(last or 0) - F.col("first"))).alias("age")
    aged = bitmaps.select("first", "words", ages)
    at = F.col("first") + F.col("age")
    word = F.expr(f"element_at(words, cast(floor((first + age) / {WORD_MONTHS}) as bigint))")
    was = F.coalesce(
        F.call_function("getbit", word, (at % WORD_MONTHS).cast("int")).cast("long"), F.lit(0)
    )
    triangle = aged.groupBy("first", "age").agg(
        F.sum(was).alias("active_customers"), F.count(F.lit(1)).alias("cohort_customers")
    )
    share = half_up_ratio_wide(F.col("active_customers") * 100, F.col("cohort_customers"), 2)
    return triangle.select(
        _month_of(F.col("first")).alias("cohort_month"),
        F.col("age").cast("long").alias("age"),
        "cohort_customers",
        "active_customers",
        share.alias("retention_pct"),
    )


def cohort_revenue(attribution: DataFrame, orders: DataFrame) -> DataFrame:
    """Revenue by month of the first order of all, and months since.

    Rows are summed per customer and month before they meet the customer's first
    order. Customers in the fact have an order, so none is lost.
    """
    first = (
        orders.where(F.col("customer_key").isNotNull() & F.col("order_created_at").isNotNull())
        .groupBy("customer_key")
        .agg(month_start(F.min("order_created_at")).alias("cohort_month"))
    )
    spent = attribution.groupBy("customer_key", "revenue_month").agg(
        F.sum("attributed_revenue").alias("revenue")
    )
    age = _month_number(F.col("revenue_month")) - _month_number(F.col("cohort_month"))
    return (
        spent.join(first, "customer_key")
        .groupBy("cohort_month", age.cast("long").alias("age"))
        .agg(
            F.count(F.lit(1)).alias("paying_customers"),
            F.sum("revenue").cast("decimal(24,2)").alias("revenue"),
        )
    )
