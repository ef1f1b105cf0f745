"""Clustered facts and revenue of packs, on rows made by hand."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from watchledger.plans import packs
from watchledger.plans.clustered import ClusteredFact, course_months, customer_months

MONTH = dt.date(2022, 10, 1)
FACT = (
    "customer_key long, course_key long, consumption_month date, total_minutes_consumed long,"
    " is_revenue_eligible boolean"
)


def fact_rows():
    rows = [(i % 37, i % 100, MONTH, i, i % 3 == 0) for i in range(3000)]
    return rows + [(None, 5, MONTH, 1, True), (4, None, MONTH, 2, False)]


def sums(rows, place):
    out = {}
    for row in rows:
        out[row[place]] = out.get(row[place], 0) + row[3]
    return out


@pytest.fixture
def clustered(spark, scratch):
    fact = spark.createDataFrame(fact_rows(), FACT)
    return ClusteredFact.write(fact, scratch.folder("clustered"), buckets=4, bands=10)


def test_totals_by_customer_move_no_rows(clustered, plan_of):
    totals = customer_months(clustered)
    assert "Exchange" not in plan_of(totals)
    assert {r["customer_key"]: r["minutes"] for r in totals.collect()} == sums(fact_rows(), 0)


def test_courses_read_their_bands_only(clustered):
    some = [7, 12, 18]
    read = clustered.of_courses(some)
    opened = read.inputFiles()
    assert 0 < len(opened) < len(clustered.rows().inputFiles()) / 3
    assert {f.split("course_band=")[1].split("/")[0] for f in opened} == {"0", "1"}
    got = {r["course_key"]: r["minutes"] for r in course_months(clustered, some).collect()}
    assert got == {k: v for k, v in sums(fact_rows(), 1).items() if k in some}
    assert clustered.of_courses([]).count() == 0


def test_one_file_for_a_band_of_a_bucket(clustered):
    # Ten bands and rows without a course, in four buckets.
    assert len(clustered.rows().inputFiles()) <= 11 * 4


def test_a_later_application_finds_the_layout(spark, clustered, plan_of):
    spark.sql(f"drop table {clustered.name}")  # the files stay
    found = ClusteredFact.open(spark, clustered.path.rpartition("/")[0])
    assert (found.buckets, found.width) == (4, 10)
    assert "Exchange" not in plan_of(customer_months(found))
    assert sorted(map(str, found.rows().collect())) == sorted(
        map(str, spark.createDataFrame(fact_rows(), FACT).collect())
    )


def test_no_table_to_open(spark, scratch):
    with pytest.raises(ValueError):
        ClusteredFact.open(spark, scratch.folder("nothing"))


def test_an_empty_fact(spark, scratch):
    made = ClusteredFact.write(spark.createDataFrame([], FACT), scratch.folder("none"), 2)
    assert customer_months(made).count() == 0


# -- packs -----------------------------------------------------------------


def dealt(spark, scratch, orders, members, watched):
    found = packs.pack_revenue(
        spark.createDataFrame(
            orders, "order_key long, buyer_key long, revenue_month date, net_amount_usd decimal(12,2)"
        ),
        spark.createDataFrame(members, "group_id long, customer_key long"),
        spark.createDataFrame(
            watched, "customer_key long, consumption_month date, total_minutes_consumed long"
        ),
        scratch,
    )
    return {(r["order_key"], r["member_key"]): r["member_revenue"] for r in found.collect()}


def test_parts_of_a_pack(spark, scratch):
    d = Decimal
    orders = [(1, 10, MONTH, d("10.00")), (2, 10, dt.date(2022, 9, 1), d("10.00")),
              (3, 10, MONTH, d("-0.05")), (4, 99, MONTH, d("7.77")), (5, None, MONTH, d("1.00")),
              (6, 10, MONTH, d("0.00"))]
    members = [(1, 10), (1, 11), (1, 12), (2, 20)]
    watched = [(10, MONTH, 1), (11, MONTH, 1), (11, MONTH, 1), (20, MONTH, 9)]
    got = dealt(spark, scratch, orders, members, watched)
    assert got == {
        (1, 10): d("3.33"), (1, 11): d("6.67"), (1, 12): d("0.00"),
        (2, 10): d("3.34"), (2, 11): d("3.33"), (2, 12): d("3.33"),
        (3, 10): d("-0.02"), (3, 11): d("-0.03"), (3, 12): d("0.00"),
        (4, None): d("7.77"), (5, None): d("1.00"),
        (6, 10): d("0.00"), (6, 11): d("0.00"), (6, 12): d("0.00"),
    }


def test_a_group_of_many(spark, scratch):
    members = [(1, k) for k in range(5000)]
    watched = [(k, MONTH, (31 * k) % 17) for k in range(5000)]
    got = dealt(spark, scratch, [(1, 3, MONTH, Decimal("12345.67"))], members, watched)
    assert len(got) == 5000 and sum(got.values()) == Decimal("12345.67")


def test_packs_are_told_from_subscriptions(spark):
    rows = [(1, 1, dt.datetime(2022, 10, 5), " Business pack ", None, Decimal(5)),
            (2, 1, dt.datetime(2022, 10, 5), "Monthly Pack", "MONTHLY", Decimal(5)),
            (3, 1, dt.datetime(2022, 10, 5), "Lab", None, Decimal(5)),
            (4, 1, None, "Pack", None, None)]
    orders = spark.createDataFrame(
        rows,
        "order_key long, customer_key long, order_created_at timestamp_ntz, line_items string,"
        " subscription_type string, net_amount_usd decimal(12,2)",
    )
    found = packs.pack_orders(orders).select("order_key", F.col("revenue_month").cast("string"))
    assert [tuple(r) for r in found.collect()] == [(1, "2022-10-01")]
