"""Customer history, customer dimension and course dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchledger.operators.history import VALID_FROM, VALID_TO, scd2_merge
from watchledger.operators.numbering import number_rows
from watchledger.scratch import Scratch


def snap_customer(
    customers: DataFrame, prior: DataFrame | None, load_time: dt.datetime
) -> DataFrame:
    """Customer versions; spend and first paid date decide what is a change."""
    return scd2_merge(
        customers,
        prior,
        key="customer_id",
        check=["total_spent", "first_paid_order_date"],
        load_time=load_time,
    )


def dim_course(courses: DataFrame, scratch: Scratch) -> DataFrame:
    """Courses numbered by name, overwritten on each load (type 1)."""
    order = ["course_name", "course_type", "course_instructor"]
    keyed = number_rows(courses, order, scratch, "course_key")
    paid = F.when(F.col("course_type") == "PAID", True).otherwise(False)
    return keyed.select(
        "course_key",
        *order,
        paid.alias("is_revenue_generating"),
        _placeholder("int", "total_duration_minutes"),
        _placeholder("int", "lesson_count"),
        _placeholder("int", "enrollment_count"),
    )


def dim_customer(snapshot: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per customer version (type 2)."""
    order = ["customer_id", VALID_FROM]
    keyed = number_rows(snapshot, order, scratch, "customer_key")
    return keyed.select(
        "customer_key",
        *_CUSTOMER_COLUMNS,
        _placeholder("string", "customer_status"),
        F.col(VALID_FROM).alias("effective_from_date"),
        F.col(VALID_TO).alias("effective_to_date"),
        F.col(VALID_TO).isNull().alias("is_current"),
    )


def dim_customer_scd1(customers: DataFrame, scratch: Scratch) -> DataFrame:
    """Variant without history: one current row per customer."""
    keyed = number_rows(customers, ["customer_id"], scratch, "customer_key")
    return keyed.select(
        "customer_key",
        *_CUSTOMER_COLUMNS,
        _placeholder("string", "customer_status"),
        F.col("first_order_date").alias("effective_from_date"),
        _placeholder("timestamp_ntz", "effective_to_date"),
        F.lit(True).alias("is_current"),
    )


_CUSTOMER_COLUMNS = (
    "customer_id",
    "first_paid_order_date",
    "first_order_date",
    "total_spent",
)


def _placeholder(kind: str, name: str):
    """A typed null column, kept for data that is not collected yet."""
    return F.lit(None).cast(kind).alias(name)
