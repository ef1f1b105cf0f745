"""Queries for the single operators, each over whole tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from watchledger import functions as L
from watchledger.operators import (
    group_total,
    keep_top,
    number_rows,
    orphans,
    rank_in_group,
    sequence_in_group,
    unique,
)
from watchledger.plans import facts, staging
from watchledger.plans.quality import SHARE_TOLERANCE
from watchledger.sources import seeds, tables
from workload.oracle_models import (
    cents,
    parsed,
    pick,
    ratio,
    share,
    show,
    sql,
)
from workload.registry import query

# -- sources and sinks -----------------------------------------------------


@query("scan_csv_seed", pick("raw_courses", "course_name course_type instructor"))
def scan_csv_seed(c):
    path = c.scratch.folder("courses-csv")
    seeds.write_csv_seed(c.raw.courses(), path)
    read = seeds.read_csv_seed(c.spark, path, seeds.SEED_COLUMNS["courses"])
    return seeds.select_renamed(
        read,
        {
            "Course Name": "course_name",
            "Course Type": "course_type",
            "Course Instructor": "instructor",
        },
    )


@query(
    "rename_quoted",
    sql("select order_id, order_number, country, net from raw_orders"),
)
def rename_quoted(c):
    names = {
        "Order ID": "order_id",
        "Order Number": "order_number",
        "Billing Address Country": "country",
        "Net (USD)": "net",
    }
    return seeds.select_renamed(c.raw.orders(), names)


@query("full_refresh", show("stg_courses"))
def full_refresh(c):
    """The second load replaces the first one whole."""
    path = c.scratch.folder("refreshed")
    tables.full_refresh(c.stg_courses.where("course_type = 'FREE'"), path)
    tables.full_refresh(c.stg_courses, path)
    return tables.table_ref(c.spark, path)


@query("materialize_table", show("stg_orders"))
def materialize_table(c):
    return tables.materialize_table(c.stg_orders, c.scratch.folder("stg_orders"))


@query("materialize_view", show("stg_courses"))
def materialize_view(c):
    tables.materialize_view(c.stg_courses, "stg_courses_view")
    return c.spark.sql("select * from stg_courses_view")


@query("table_ref", show("dim_course"))
def table_ref(c):
    path = c.scratch.folder("dim_course")
    tables.full_refresh(c.dim_course, path)
    return tables.table_ref(c.spark, path)


# -- projections, filters, predicates --------------------------------------


@query(
    "project",
    sql(
        "select customer_key, strftime(order_created_at,'%Y-%m-%d %H:%M:%S')"
        " as last_order_date, subscription_type as current_plan,"
        " cast(monthly_value as double) as mrr,"
        " cast(net_amount_usd as double) as net_amount_usd from fact_order"
    ),
)
def project(c):
    return c.fact_order.select(
        "customer_key",
        F.col("order_created_at").alias("last_order_date"),
        F.col("subscription_type").alias("current_plan"),
        F.col("monthly_value").alias("mrr"),
        "net_amount_usd",
    )


@query(
    "const_column",
    sql(
        "select user_id, course_name, cast(minutes_consumed as bigint)"
        " as minutes_consumed, '2022-10-01' as consumption_month,"
        " false as is_free_course, cast(0 as double) as churned_mrr"
        " from stg_consumption"
    ),
)
def const_column(c):
    stamped = staging.stg_consumption(c.raw.consumption(), dt.date(2022, 10, 1))
    return stamped.select(
        "*",
        F.lit(False).alias("is_free_course"),
        F.lit(0).cast("decimal(12,2)").alias("churned_mrr"),
    )


@query(
    "null_placeholder",
    pick(
        "dim_course",
        "course_key:k total_duration_minutes:k lesson_count:k enrollment_count:k",
    ),
)
def null_placeholder(c):
    return c.dim_course.select(
        "course_key", "total_duration_minutes", "lesson_count", "enrollment_count"
    )


@query(
    "case_flag",
    sql("select course_name, course_type = 'PAID' as is_paid from stg_courses"),
)
def case_flag(c):
    paid = F.when(F.col("course_type") == "PAID", True).otherwise(False)
    return c.stg_courses.select("course_name", paid.alias("is_paid"))


@query(
    "case_classify_like",
    pick("fact_order", "order_id:k subscription_type subscription_tier"),
)
def case_classify_like(c):
    text = F.col("line_items")
    return c.stg_orders.select(
        "order_id",
        L.first_match(text, facts.TYPE_WORDS).alias("subscription_type"),
        L.first_match(text, facts.TIER_WORDS).alias("subscription_tier"),
    )


@query("case_amount", pick("fact_order", "order_id:k monthly_value:d"))
def case_amount(c):
    plan, net = L.first_match(F.col("line_items"), facts.TYPE_WORDS), F.col("net_usd")
    amount = F.when(plan == "YEARLY", L.amortize_monthly(net)).otherwise(net)
    return c.stg_orders.select("order_id", amount.alias("monthly_value"))


@query(
    "case_recency_status",
    sql(
        "select order_id, case"
        " when order_created_at >= timestamp '2001-06-01' then 'ACTIVE'"
        " when order_created_at >= timestamp '2001-03-03' then 'AT_RISK'"
        " when order_created_at is not null then 'CHURNED' else 'UNKNOWN' end as status"
        " from stg_orders"
    ),
)
def case_recency_status(c):
    at = F.col("order_created_at")
    status = L.recency_status(at, c.settings.as_of, c.settings.at_risk_days)
    return c.stg_orders.select("order_id", status.alias("status"))


@query(
    "filter_not_blank",
    sql(
        "select user_id, course_name, minutes from raw_consumption"
        " where course_name is not null and trim(course_name) <> ''"
    ),
)
def filter_not_blank(c):
    names = {"User ID": "user_id", "Course Name": "course_name", "Minutes Consumed": "minutes"}
    named = seeds.select_renamed(c.raw.consumption(), names)
    return named.where(L.is_filled(F.col("course_name")))


@query(
    "filter_is_null_test",
    sql(
        "select order_id from fact_order"
        " where customer_key is null and subscription_type is not null"
    ),
)
def filter_is_null_test(c):
    plan, customer = F.col("subscription_type"), F.col("customer_key")
    return c.fact_order.where(customer.isNull() & plan.isNotNull()).select("order_id")


@query(
    "filter_in_list",
    pick(
        "fact_order",
        "order_id:k subscription_type",
        "where subscription_type in ('MONTHLY','YEARLY')",
    ),
)
def filter_in_list(c):
    kept = c.fact_order.where(F.col("subscription_type").isin(*facts.PAID_PLANS))
    return kept.select("order_id", "subscription_type")


@query(
    "filter_positive_amount",
    sql(
        "select order_id, cast(monthly_value as double) as monthly_value"
        " from fact_order where monthly_value > 0"
    ),
)
def filter_positive_amount(c):
    kept = c.fact_order.where(F.col("monthly_value") > 0)
    return kept.select("order_id", "monthly_value")


@query(
    "filter_flag",
    pick("fact_order", "order_id:k customer_key:k", "where is_latest_order"),
)
def filter_flag(c):
    return c.fact_order.where("is_latest_order").select("order_id", "customer_key")


@query(
    "filter_equals",
    pick("dim_course", "course_key:k course_name", "where course_type = 'PAID'"),
)
def filter_equals(c):
    paid = c.dim_course.where(F.col("course_type") == "PAID")
    return paid.select("course_key", "course_name")


# -- joins -----------------------------------------------------------------


def _current(c, *names):
    return c.dim_customer.where("is_current").select(*names)


@query("join_left_current_version", pick("fact_order", "order_id:k customer_key:k"))
def join_left_current_version(c):
    current = _current(c, "customer_key", "customer_id")
    orders = c.stg_orders.select("order_id", "customer_id")
    return orders.join(current, "customer_id", "left").drop("customer_id")


@query(
    "join_left_prefiltered",
    sql(
        "select user_id, course_name, cast(minutes_consumed as bigint)"
        " as minutes_consumed, customer_key from stg_consumption"
        " left join (select * from dim_customer where is_current)"
        " on customer_id = user_id"
    ),
)
def join_left_prefiltered(c):
    current = _current(c, "customer_key", F.col("customer_id").alias("user_id"))
    watched = c.stg_consumption.drop("consumption_month")
    return watched.join(current, "user_id", "left")


@query(
    "join_left_text_key",
    sql(
        "select user_id, course_name, cast(minutes_consumed as bigint)"
        " as minutes_consumed, course_key from stg_consumption"
        " left join (select course_key, course_name from dim_course"
        " where is_revenue_generating) using (course_name)"
    ),
)
def join_left_text_key(c):
    """Watch rows of free courses find no paid course and stay."""
    paid = c.dim_course.where("is_revenue_generating")
    titles = paid.select("course_key", "course_name")
    watched = c.stg_consumption.drop("consumption_month")
    return watched.join(titles, "course_name", "left")


@query(
    "join_drop_orphans",
    sql(
        "select customer_key, course_key, cast(minutes_consumed as bigint)"
        " as minutes_consumed from stg_consumption s"
        " join dim_customer c on c.customer_id = s.user_id and c.is_current"
        " join dim_course d on d.course_name = s.course_name"
    ),
)
def join_drop_orphans(c):
    current = _current(c, "customer_key", F.col("customer_id").alias("user_id"))
    titles = c.dim_course.select("course_key", "course_name")
    matched = c.stg_consumption.join(current, "user_id").join(titles, "course_name")
    return matched.select("customer_key", "course_key", "minutes_consumed")


_GROUP = ["customer_key", "consumption_month"]


@query(
    "join_self_aggregate",
    sql(
        "select consumption_key, cast(total_minutes_consumed as bigint)"
        " as total_minutes_consumed, cast(whole as bigint) as whole"
        " from fact_consumption join (select customer_key, consumption_month,"
        " sum(total_minutes_consumed) as whole from fact_consumption"
        " where is_revenue_eligible group by 1, 2)"
        " using (customer_key, consumption_month) where is_revenue_eligible"
    ),
)
def join_self_aggregate(c):
    paid = c.fact_consumption.where("is_revenue_eligible")
    total = group_total(paid, _GROUP, "total_minutes_consumed", "whole")
    return total.select("consumption_key", "total_minutes_consumed", "whole")


@query(
    "join_month_key",
    sql(
        "select consumption_key, order_key from fact_consumption f"
        " join latest_paid_orders o on o.customer_key = f.customer_key"
        " and o.month = f.consumption_month"
    ),
)
def join_month_key(c):
    latest = facts.latest_paid_orders(c.fact_order)
    joined = c.fact_consumption.join(latest, _GROUP)
    return joined.select("consumption_key", "order_key")


@query(
    "join_fact_dim",
    sql(
        "select revenue_key, course_name, course_instructor"
        " from fact_revenue_attribution join dim_course using (course_key)"
    ),
)
def join_fact_dim(c):
    titles = c.dim_course.select("course_key", "course_name", "course_instructor")
    rows = c.fact_revenue_attribution.select("revenue_key", "course_key")
    return rows.join(titles, "course_key").drop("course_key")


@query(
    "join_left_latest",
    sql(
        "select customer_id, order_id from dim_customer c"
        " left join (select * from fact_order where is_latest_order) o"
        " on o.customer_key = c.customer_key where c.is_current"
    ),
)
def join_left_latest(c):
    latest = c.fact_order.where("is_latest_order").select("customer_key", "order_id")
    current = _current(c, "customer_key", "customer_id")
    return current.join(latest, "customer_key", "left").drop("customer_key")


@query(
    "anti_join_orphans",
    sql(
        "select course_key as from_field, count(*) as n_records from dim_course"
        " where course_key not in (select course_key from fact_revenue_attribution)"
        " group by 1"
    ),
)
def anti_join_orphans(c):
    key = "course_key"
    return orphans(c.dim_course, key, c.fact_revenue_attribution, key)


# -- aggregations ----------------------------------------------------------

_FACT = "fact_revenue_attribution"


@query(
    "agg_sum",
    sql(
        "select customer_key, strftime(consumption_month,'%Y-%m-%d')"
        " as consumption_month, cast(sum(total_minutes_consumed) as bigint) as minutes"
        " from fact_consumption group by customer_key, 2"
    ),
)
def agg_sum(c):
    grouped = c.fact_consumption.groupBy(*_GROUP)
    return grouped.agg(F.sum("total_minutes_consumed").alias("minutes"))


@query(
    "agg_count",
    sql(
        "select subscription_type, count(*) as order_count from fact_order group by 1"
    ),
)
def agg_count(c):
    grouped = c.fact_order.groupBy("subscription_type")
    return grouped.agg(F.count("*").alias("order_count"))


@query(
    "agg_count_distinct",
    sql(
        "select strftime(consumption_month,'%Y-%m-%d') as month,"
        " count(distinct customer_key) as users from fact_consumption group by 1"
    ),
)
def agg_count_distinct(c):
    grouped = c.fact_consumption.groupBy(F.col("consumption_month").alias("month"))
    return grouped.agg(F.countDistinct("customer_key").alias("users"))


@query(
    "agg_count_distinct_if",
    sql(
        "select strftime(revenue_month,'%Y-%m-%d') as month,"
        " count(distinct case when course_minutes_consumed >= 60 then customer_key end)"
        f" as engaged from {_FACT} group by 1"
    ),
)
def agg_count_distinct_if(c):
    engaged = F.when(F.col("course_minutes_consumed") >= 60, F.col("customer_key"))
    grouped = c.fact_revenue_attribution.groupBy(F.col("revenue_month").alias("month"))
    return grouped.agg(F.countDistinct(engaged).alias("engaged"))


@query(
    "agg_sum_if",
    sql(
        "select strftime(revenue_month,'%Y-%m-%d') as month,"
        " cast(sum(case when subscription_type = 'YEARLY' then attributed_revenue"
        f" else 0 end) as double) as yearly_revenue from {_FACT} group by 1"
    ),
)
def agg_sum_if(c):
    yearly = F.when(
        F.col("subscription_type") == "YEARLY", F.col("attributed_revenue")
    ).otherwise(F.lit(Decimal("0.00")))
    grouped = c.fact_revenue_attribution.groupBy(F.col("revenue_month").alias("month"))
    return grouped.agg(F.sum(yearly).alias("yearly_revenue"))


@query(
    "agg_avg",
    sql(
        "select course_key, cast("
        + ratio(cents("revenue"), "n*100", 2)
        + " as double) as avg_revenue from (select course_key, count(attributed_revenue) as n,"
        f" sum(attributed_revenue) as revenue from {_FACT} group by 1)"
    ),
)
def agg_avg(c):
    grouped = c.fact_revenue_attribution.groupBy("course_key").agg(
        F.sum("attributed_revenue").alias("revenue"),
        F.count("attributed_revenue").alias("n"),
    )
    mean = L.mean_of_amounts(F.col("revenue"), F.col("n"))
    return grouped.select("course_key", mean.alias("avg_revenue"))


@query(
    "agg_max",
    sql(
        "select customer_key, max(subscription_type) as plan,"
        " cast(max(subscription_monthly_value) as double) as top_value"
        f" from {_FACT} group by 1"
    ),
)
def agg_max(c):
    return c.fact_revenue_attribution.groupBy("customer_key").agg(
        F.max("subscription_type").alias("plan"),
        F.max("subscription_monthly_value").alias("top_value"),
    )


@query(
    "agg_ratio_safe",
    sql(
        "select course_key, cast("
        + ratio("paid", "free", 2)
        + " as double) as paid_to_free from (select course_key,"
        " sum(case when is_revenue_eligible then total_minutes_consumed else 0 end)"
        " as paid, sum(case when is_revenue_eligible then 0 else"
        " total_minutes_consumed end) as free from fact_consumption group by 1)"
    ),
)
def agg_ratio_safe(c):
    """Paid over free minutes; null for a course without free minutes."""
    minutes, paid = F.col("total_minutes_consumed"), F.col("is_revenue_eligible")
    grouped = c.fact_consumption.groupBy("course_key").agg(
        F.sum(F.when(paid, minutes).otherwise(0)).alias("paid"),
        F.sum(F.when(~paid, minutes).otherwise(0)).alias("free"),
    )
    safe = L.half_up_ratio(F.col("paid"), F.col("free"), 2)
    return grouped.select("course_key", safe.alias("paid_to_free"))


@query(
    "agg_multi_key",
    sql(
        "select customer_key, course_key, strftime(consumption_month,'%Y-%m-%d')"
        " as consumption_month, minutes from consumption_by_month"
    ),
)
def agg_multi_key(c):
    current = _current(c, "customer_key", F.col("customer_id").alias("user_id"))
    titles = c.dim_course.select("course_key", "course_name")
    matched = c.stg_consumption.join(current, "user_id").join(titles, "course_name")
    grouped = matched.groupBy("customer_key", "course_key", "consumption_month")
    return grouped.agg(F.sum("minutes_consumed").alias("minutes"))


@query(
    "having_tolerance",
    sql(
        "select customer_key, cast(sum(attributed_revenue)"
        " - sum(subscription_monthly_value*attribution_percentage) as double) as gap"
        f" from {_FACT} group by 1 having abs(sum(attributed_revenue)"
        " - sum(subscription_monthly_value*attribution_percentage)) > 0.01"
    ),
)
def having_tolerance(c):
    """Customers whose rounded revenue drifts from the unrounded by over a cent."""
    exact = F.col("subscription_monthly_value") * F.col("attribution_percentage")
    gap = F.sum("attributed_revenue") - F.sum(exact)
    grouped = c.fact_revenue_attribution.groupBy("customer_key").agg(gap.alias("gap"))
    return grouped.where(F.abs("gap") > F.lit(Decimal(SHARE_TOLERANCE)))


@query(
    "having_duplicates",
    sql(
        "select customer_id as unique_field, count(*) as n_records"
        " from dim_customer group by 1 having count(*) > 1"
    ),
)
def having_duplicates(c):
    return unique(c.dim_customer, "customer_id")


@query(
    "agg_of_agg",
    sql(
        "select strftime(revenue_month,'%Y-%m-%d') as month,"
        " cast(sum(mrr) as double) as mrr, count(*) as customers"
        " from customer_mrr group by 1"
    ),
)
def agg_of_agg(c):
    per_customer = c.fact_revenue_attribution.groupBy(
        "customer_key", F.col("revenue_month").alias("month")
    ).agg(F.sum("subscription_monthly_value").alias("mrr"))
    return per_customer.groupBy("month").agg(
        F.sum("mrr").alias("mrr"), F.count("*").alias("customers")
    )


# -- windows ---------------------------------------------------------------


@query("surrogate_key_dense", pick("fact_order", "order_key:k order_id:k"))
def surrogate_key_dense(c):
    orders = c.stg_orders.select("order_id")
    return number_rows(orders, ["order_id"], c.scratch, "order_key")


@query("dedup_keep_top", pick("stg_customers", "customer_id:k total_spent:d"))
def dedup_keep_top(c):
    names = {"Customer ID": "customer_id", "Total Spent": "total_spent"}
    named = seeds.select_renamed(c.raw.customers(), names)
    typed = named.where(L.is_filled(F.col("customer_id"))).select(
        F.col("customer_id").cast("long").alias("customer_id"),
        F.col("total_spent").cast(staging.TOTAL_SPENT).alias("total_spent"),
    )
    return keep_top(typed, ["customer_id"], [F.desc_nulls_first("total_spent")])


def _sequenced(c):
    order = [F.asc_nulls_last("order_created_at"), F.asc_nulls_last("order_id")]
    orders = c.stg_orders.select("order_id", "customer_id", "order_created_at")
    return sequence_in_group(orders, ["customer_id"], order, c.scratch)


@query("first_in_group_flag", pick("fact_order", "order_id:k is_first_order"))
def first_in_group_flag(c):
    first = (F.col("sequence") == 1).alias("is_first_order")
    return _sequenced(c).select("order_id", first)


@query("latest_in_group_flag", pick("fact_order", "order_id:k is_latest_order"))
def latest_in_group_flag(c):
    return _sequenced(c).select("order_id", F.col("is_last").alias("is_latest_order"))


@query("sequence_in_group", pick("fact_order", "order_id:k order_sequence:k"))
def sequence_in_group_(c):
    return _sequenced(c).select("order_id", F.col("sequence").alias("order_sequence"))


@query(
    "latest_per_group_month",
    pick("latest_paid_orders", "customer_key:k month:day order_key:k"),
)
def latest_per_group_month(c):
    latest = facts.latest_paid_orders(c.fact_order)
    month = F.col("consumption_month").alias("month")
    return latest.select("customer_key", month, "order_key")


@query(
    "share_of_group",
    sql(
        "select consumption_key, cast("
        + share("m", "nullif(w,0)")
        + " as double) as share from (select consumption_key,"
        " cast(total_minutes_consumed as bigint) as m,"
        " cast(sum(total_minutes_consumed) over (partition by customer_key,"
        " consumption_month) as bigint) as w from fact_consumption)"
    ),
)
def share_of_group(c):
    value = "total_minutes_consumed"
    total = group_total(c.fact_consumption, _GROUP, value, "whole")
    part = L.share_4dp(F.col(value), F.col("whole"))
    return total.select("consumption_key", part.alias("share"))


@query(
    "lag_partition",
    sql(
        "select customer_key, strftime(revenue_month,'%Y-%m-%d') as revenue_month,"
        " cast(mrr as double) as mrr, cast(before as double) as before,"
        " strftime(month_before,'%Y-%m-%d') as month_before from customer_mrr"
    ),
)
def lag_partition(c):
    """A group has a row per month, so the calendar bounds its size."""
    per_customer = c.fact_revenue_attribution.groupBy(
        "customer_key", "revenue_month"
    ).agg(F.sum("subscription_monthly_value").alias("mrr"))
    window = Window.partitionBy("customer_key").orderBy("revenue_month")
    return per_customer.select(
        "*",
        F.lag("mrr").over(window).alias("before"),
        F.lag("revenue_month").over(window).alias("month_before"),
    )


@query(
    "lag_global_over_agg",
    sql(
        "select strftime(revenue_month,'%Y-%m-%d') as month,"
        " cast(sum(attributed_revenue) as double) as revenue,"
        " cast(lag(sum(attributed_revenue)) over (order by revenue_month) as double)"
        f" as before from {_FACT} group by revenue_month"
    ),
)
def lag_global_over_agg(c):
    """One row per month reaches the window."""
    months = c.fact_revenue_attribution.groupBy(
        F.col("revenue_month").alias("month")
    ).agg(F.sum("attributed_revenue").alias("revenue"))
    before = F.lag("revenue").over(Window.orderBy("month"))
    return months.select("*", before.alias("before"))


@query(
    "rank_over_aggregate",
    sql(
        "select strftime(revenue_month,'%Y-%m-%d') as month, course_key,"
        " cast(sum(attributed_revenue) as double) as revenue,"
        " rank() over (partition by revenue_month order by sum(attributed_revenue)"
        f" desc) as place from {_FACT} group by revenue_month, course_key"
    ),
)
def rank_over_aggregate(c):
    totals = c.fact_revenue_attribution.groupBy(
        F.col("revenue_month").alias("month"), "course_key"
    ).agg(F.sum("attributed_revenue").alias("revenue"))
    totals = c.scratch.stage(totals, "course-revenue")
    return rank_in_group(totals, ["month"], "revenue", "place", c.scratch)


# -- sorts and limits ------------------------------------------------------


@query(
    "sort_multi",
    pick("fact_revenue_attribution", "revenue_key:k revenue_month:day attributed_revenue:d"),
)
def sort_multi(c):
    rows = c.fact_revenue_attribution.select(
        "revenue_key", "revenue_month", "attributed_revenue"
    )
    best = F.desc_nulls_first("attributed_revenue")
    return rows.orderBy(F.desc("revenue_month"), best, "revenue_key")


@query(
    "top_n",
    sql(
        "select revenue_key, cast(attributed_revenue as double) as attributed_revenue"
        f" from (select * from {_FACT} order by attributed_revenue desc nulls first,"
        " revenue_key limit 10)"
    ),
)
def top_n(c):
    rows = c.fact_revenue_attribution.select("revenue_key", "attributed_revenue")
    best = F.desc_nulls_first("attributed_revenue")
    return rows.orderBy(best, "revenue_key").limit(10)


@query(
    "limit_only",
    sql(f"select * from (select revenue_key from {_FACT} order by revenue_key limit 10)"),
)
def limit_only(c):
    """Sorted by a unique key, so that any engine returns the same ten."""
    return c.fact_revenue_attribution.select("revenue_key").orderBy("revenue_key").limit(10)


# -- scalar functions ------------------------------------------------------


@query(
    "parse_mixed_timestamp",
    sql(
        "select order_id, created_at,"
        f" strftime({parsed('created_at')},'%Y-%m-%d %H:%M:%S') as parsed"
        " from raw_orders"
    ),
)
def parse_mixed_timestamp(c):
    names = {"Order ID": "order_id", "Order Created At": "created_at"}
    named = seeds.select_renamed(c.raw.orders(), names)
    return named.withColumn("parsed", L.parse_mixed_timestamp(F.col("created_at")))


@query(
    "cast_blank_to_null",
    sql(
        "select order_id, cast(nullif(trim(customer_id),'') as bigint) as customer_id"
        " from raw_orders"
    ),
)
def cast_blank_to_null(c):
    names = {"Order ID": "order_id", "Customer ID": "customer_id"}
    named = seeds.select_renamed(c.raw.orders(), names)
    filled = L.blank_to_null(F.col("customer_id")).try_cast("long")
    return named.withColumn("customer_id", filled)


@query(
    "cast_numeric",
    sql(
        "select cast(user_id as bigint) as user_id,"
        " cast(cast(minutes as integer) as bigint) as minutes,"
        " cast(cast(minutes as decimal(10,2)) as double) as exact from raw_consumption"
    ),
)
def cast_numeric(c):
    minutes = F.col("`Minutes Consumed`")
    return c.raw.consumption().select(
        F.col("`User ID`").cast("long").alias("user_id"),
        minutes.cast("int").alias("minutes"),
        minutes.cast("decimal(10,2)").alias("exact"),
    )


@query(
    "trim_text",
    sql("select trim(course_name) as course_name, instructor from raw_courses"),
)
def trim_text(c):
    return c.raw.courses().select(
        F.trim(F.col("`Course Name`")).alias("course_name"),
        F.trim(F.col("`Course Instructor`")).alias("instructor"),
    )


@query("upper_text", sql("select order_id, upper(line_items) as text from stg_orders"))
def upper_text(c):
    return c.stg_orders.select("order_id", F.upper("line_items").alias("text"))


@query(
    "like_contains",
    sql(
        "select order_id, upper(line_items) like '%YEARLY%' as yearly,"
        " upper(line_items) like '%MONTHLY%' as monthly from stg_orders"
    ),
)
def like_contains(c):
    text = F.upper("line_items")
    return c.stg_orders.select(
        "order_id",
        text.contains("YEARLY").alias("yearly"),
        text.contains("MONTHLY").alias("monthly"),
    )


@query(
    "date_key",
    sql(
        "select order_id, cast(strftime(order_created_at,'%Y%m%d') as bigint)"
        " as date_key from stg_orders"
    ),
)
def date_key(c):
    key = L.date_key(F.col("order_created_at"))
    return c.stg_orders.select("order_id", key.alias("date_key"))


@query(
    "month_trunc",
    sql(
        "select order_id, strftime(date_trunc('month',order_created_at),'%Y-%m-%d')"
        " as month from stg_orders"
    ),
)
def month_trunc(c):
    month = L.month_start(F.col("order_created_at"))
    return c.stg_orders.select("order_id", month.alias("month"))


@query(
    "date_minus_interval",
    sql(
        "select order_id, strftime(cast(order_created_at as date) - interval 90 day,"
        "'%Y-%m-%d') as edge from stg_orders"
    ),
)
def date_minus_interval(c):
    edge = F.date_sub(F.col("order_created_at").cast("date"), 90)
    return c.stg_orders.select("order_id", edge.alias("edge"))


@query(
    "round_half_up",
    sql(
        "select order_id, cast(cast(sign(c)*((abs(c)*25 + 5000)//10000) as decimal(18,0))"
        " * 0.01 as double) as quarter_percent from (select order_id,"
        " cast(net_usd*100 as bigint) as c from stg_orders)"
    ),
)
def round_half_up(c):
    """A quarter percent of each order, to cents; halves go away from zero."""
    product = F.col("net_usd") * F.lit(Decimal("0.0025"))
    return c.stg_orders.select("order_id", F.round(product, 2).alias("quarter_percent"))


@query(
    "minutes_to_hours",
    sql(
        "select user_id, course_name, cast("
        + ratio("minutes_consumed", "60", 2)
        + " as double) as hours from stg_consumption"
    ),
)
def minutes_to_hours(c):
    hours = L.minutes_to_hours(F.col("minutes_consumed"))
    return c.stg_consumption.select("user_id", "course_name", hours.alias("hours"))


@query(
    "nullif_zero",
    sql(
        "select p_partkey, cast(nullif(mod(p_size,4),0) as bigint) as divisor from part"
    ),
)
def nullif_zero(c):
    zero_free = F.nullif(F.col("p_size") % 4, F.lit(0))
    return c.raw.table("part").select("p_partkey", zero_free.alias("divisor"))


@query(
    "coalesce_default",
    sql(
        "select order_id, coalesce(subscription_type,'NONE') as plan,"
        " coalesce(customer_key,0) as customer_key from fact_order"
    ),
)
def coalesce_default(c):
    return c.fact_order.select(
        "order_id",
        F.coalesce("subscription_type", F.lit("NONE")).alias("plan"),
        F.coalesce("customer_key", F.lit(0)).alias("customer_key"),
    )


@query(
    "abs_diff",
    sql(
        "select revenue_key, cast(abs(attributed_revenue - subscription_monthly_value)"
        f" as double) as gap from {_FACT}"
    ),
)
def abs_diff(c):
    gap = F.abs(F.col("attributed_revenue") - F.col("subscription_monthly_value"))
    return c.fact_revenue_attribution.select("revenue_key", gap.alias("gap"))


@query(
    "now_audit",
    sql(
        "select cast(order_key as bigint) as order_key, true as stamped, true as equal,"
        " true as within_the_run from fact_order"
    ),
)
def now_audit(c):
    """What can be said of a clock: both stamps are there, alike, and of this run."""
    started = F.lit(dt.datetime.now(dt.timezone.utc) - dt.timedelta(minutes=1))
    created, updated = F.col("created_at"), F.col("updated_at")
    stamped = tables.with_audit_times(c.fact_order.select("order_key"))
    return stamped.select(
        "order_key",
        (created.isNotNull() & updated.isNotNull()).alias("stamped"),
        (created == updated).alias("equal"),
        ((created >= started) & (created <= F.current_timestamp())).alias("within_the_run"),
    )


@query(
    "amortize_monthly",
    sql(
        "select order_id, cast(cast(sign(c)*((2*abs(c)+12)//24) as decimal(18,0))*0.01"
        " as double) as monthly from (select order_id, cast(net_usd*100 as bigint) as c"
        " from stg_orders)"
    ),
)
def amortize_monthly(c):
    monthly = L.amortize_monthly(F.col("net_usd"))
    return c.stg_orders.select("order_id", monthly.alias("monthly"))
