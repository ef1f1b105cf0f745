"""Raw text tables cleaned and typed. All four stay lazy."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchledger.functions import blank_to_null, is_filled, parse_mixed_timestamp
from watchledger.operators.keep import keep_top
from watchledger.sources.seeds import select_renamed

# Wide enough for one customer who placed a large part of all orders.
TOTAL_SPENT = "decimal(18,2)"
ORDER_AMOUNT = "decimal(12,2)"


def stg_customers(raw: DataFrame) -> DataFrame:
    """One row per customer id, the one with the highest (or null) spend.

    Equal spends are settled by the two dates, so that a rerun keeps the same.
    """
    named = select_renamed(
        raw,
        {
            "Customer ID": "customer_id",
            "First Paid Order Date": "first_paid",
            "First Order Date": "first_order",
            "Total Spent": "total_spent",
        },
    )
    typed = named.where(is_filled(F.col("customer_id"))).select(
        F.col("customer_id").cast("long").alias("customer_id"),
        parse_mixed_timestamp(F.col("first_paid")).alias("first_paid_order_date"),
        parse_mixed_timestamp(F.col("first_order")).alias("first_order_date"),
        F.col("total_spent").cast(TOTAL_SPENT).alias("total_spent"),
    )
    best = [
        F.desc_nulls_first("total_spent"),
        F.desc_nulls_first("first_paid_order_date"),
        F.desc_nulls_first("first_order_date"),
    ]
    return keep_top(typed, ["customer_id"], best)


def stg_orders(raw: DataFrame) -> DataFrame:
    """One row per raw order; a blank customer becomes null."""
    named = select_renamed(
        raw,
        {
            "Order ID": "order_id",
            "Order Number": "order_number",
            "Order Created At": "created",
            "Customer ID": "customer_id",
            "Line Items": "line_items",
            "Billing Address Country": "billing_address_country",
            "Net (USD)": "net_usd",
        },
    )
    return named.select(
        F.col("order_id").cast("long").alias("order_id"),
        F.trim("order_number").alias("order_number"),
        parse_mixed_timestamp(F.col("created")).alias("order_created_at"),
        blank_to_null(F.col("customer_id")).cast("long").alias("customer_id"),
        F.trim("line_items").alias("line_items"),
        F.trim("billing_address_country").alias("billing_address_country"),
        F.col("net_usd").cast(ORDER_AMOUNT).alias("net_usd"),
    )


def stg_courses(raw: DataFrame) -> DataFrame:
    named = select_renamed(
        raw,
        {
            "Course Name": "name",
            "Course Type": "type",
            "Course Instructor": "instructor",
        },
    )
    return named.select(
        F.trim("name").alias("course_name"),
        F.upper(F.trim("type")).alias("course_type"),
        F.trim("instructor").alias("course_instructor"),
    )


def stg_consumption(raw: DataFrame, month: dt.date | Column) -> DataFrame:
    """Watch time with its month: a date for a one-month file, or a column."""
    if isinstance(month, dt.date):
        month = F.lit(month.isoformat()).cast("date")
    kept = raw.where(is_filled(F.col("`Course Name`")))
    return kept.select(
        F.col("`User ID`").cast("long").alias("user_id"),
        F.trim(F.col("`Course Name`")).alias("course_name"),
        F.col("`Minutes Consumed`").cast("int").alias("minutes_consumed"),
        month.alias("consumption_month"),
    )
