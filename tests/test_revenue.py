"""Revenue to the cent, by covered month and over time, on rows made by hand."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from watchledger.operators.apportion import apportion
from watchledger.plans import revenue
from watchledger.settings import Settings

D = dt.date
ORDER = (
    "order_key long, customer_key long, order_created_at timestamp_ntz, subscription_type string,"
    " subscription_interval_months int, monthly_value decimal(12,2)"
)
FACT = "customer_key long, revenue_month date, subscription_monthly_value decimal(12,2)"


def at(text):
    return dt.datetime.fromisoformat(text)


def brute_parts(amount, weights):
    weights = [max(w or 0, 0) for w in weights]
    if not sum(weights):
        weights = [1] * len(weights)
    total = sum(weights)
    parts = [amount * w // total for w in weights]
    order = sorted(range(len(weights)), key=lambda i: (-(amount * weights[i] % total), i))
    for i in order[: amount - sum(parts)]:
        parts[i] += 1
    return parts


def test_parts_add_up_and_match_brute_force(spark, scratch):
    groups = {
        1: (100, [1, 1, 1]), 2: (0, [5, 5]), 3: (7, [0, 0, None]), 4: (1, [3]), 5: (10, [-5, 2, 2, None]),
        None: (12345, [7, 11, 13, 0]), 7: (99_999, [(31 * i) % 17 for i in range(3000)]),
    }
    rows = [(k, i, amount, w) for k, (amount, ws) in groups.items() for i, w in enumerate(ws)]
    df = spark.createDataFrame(rows, "k long, i long, amount long, w int")
    got = {(r.k, r.i): r.part for r in apportion(df, ["k"], "amount", "w", "part", ["i"], scratch).collect()}
    for k, (amount, weights) in groups.items():
        parts = brute_parts(amount, weights)
        assert [got[k, i] for i in range(len(weights))] == parts and sum(parts) == amount


def test_apportioning_has_no_window_over_groups(spark, scratch, plan_of):
    df = spark.createDataFrame([(1, 1, 5, 2)], "k long, i long, amount long, w int")
    plan = plan_of(apportion(df, ["k"], "amount", "w", "part", ["i"], scratch))
    assert all("__part" in x for x in plan.splitlines() if "Window [" in x)


def test_a_yearly_order_pays_twelve_months_and_the_last_start_wins(spark):
    orders = spark.createDataFrame(
        [
            (1, 1, at("2022-01-31T10:00:00"), "YEARLY", 12, Decimal("10.00")),
            (2, 1, at("2022-06-15T10:00:00"), "MONTHLY", 1, Decimal("30.00")),
            (3, 1, at("2022-06-15T10:00:00"), "MONTHLY", 1, Decimal("31.00")),
            (4, 2, at("2022-03-01T10:00:00"), "MONTHLY", 1, Decimal("0.00")),
            (5, None, at("2022-03-01T10:00:00"), "MONTHLY", 1, Decimal("9.00")),
            (6, 3, None, "MONTHLY", 1, Decimal("9.00")),
            (7, 4, at("2022-03-01T10:00:00"), None, None, Decimal("9.00")),
        ],
        ORDER,
    )
    rows = sorted(tuple(r) for r in revenue.plan_months(orders).collect())
    months = [D(2022, m, 1) for m in range(1, 13)]
    assert [r[1] for r in rows] == months and {r[0] for r in rows} == {1}
    assert [(r[2], r[4]) for r in rows] == [(1, m) if m != 6 else (3, 1) for m in range(1, 13)]


def test_many_orders_of_one_customer_are_reduced_before_the_shuffle(spark, plan_of):
    n = F.col("id")
    orders = spark.range(100_000).select(
        n.alias("order_key"),
        F.lit(7).cast("long").alias("customer_key"),
        (F.lit("2020-01-01").cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, cast(id % 500000 as int), 0)")).alias("order_created_at"),
        F.lit("YEARLY").alias("subscription_type"),
        F.lit(12).alias("subscription_interval_months"),
        F.lit("5.00").cast("decimal(12,2)").alias("monthly_value"),
    )
    covered = revenue.plan_months(orders)
    plan = plan_of(covered)
    assert "Join" not in plan and "Window" not in plan
    assert plan.count("partial_max") == 2
    assert covered.count() == 3 + 11


def test_waterfall_tells_gaps_churn_and_returns_apart(spark, scratch):
    rows = [
        (1, D(2022, 1, 1), 10), (1, D(2022, 2, 1), 15), (1, D(2022, 3, 1), 12),  # grows, shrinks
        (2, D(2022, 1, 1), 20), (2, D(2022, 3, 1), 20),  # away in February
        (3, D(2022, 2, 1), 7),  # leaves for good
        (4, D(2022, 6, 1), 5),  # after months without anybody
    ]
    fact = spark.createDataFrame([(c, m, Decimal(v)) for c, m, v in rows for _ in range(2)], FACT)
    made = revenue.revenue_waterfall(revenue.customer_months(fact), scratch).collect()
    by_month = {r.month: r for r in made}
    assert sorted(by_month) == [D(2022, m, 1) for m in range(1, 7)]
    names = "opening_mrr new_mrr returned_mrr expansion_mrr contraction_mrr churned_mrr closing_mrr".split()
    assert {m.month: [int(r[n]) for n in names] for m, r in by_month.items()} == {
        1: [0, 30, 0, 0, 0, 0, 30], 2: [30, 7, 0, 5, 0, 20, 22], 3: [22, 0, 20, 0, 3, 7, 32],
        4: [32, 0, 0, 0, 0, 32, 0], 5: [0, 0, 0, 0, 0, 0, 0], 6: [0, 5, 0, 0, 0, 0, 5],
    }
    for r in made:
        assert r.opening_mrr + r.new_mrr + r.returned_mrr + r.expansion_mrr - r.contraction_mrr - r.churned_mrr == r.closing_mrr
    assert [r.is_alert for r in sorted(made)] == [False, True, True, True, False, False]
    assert by_month[D(2022, 3, 1)].returned_customers == 1 and by_month[D(2022, 4, 1)].churned_customers == 2


def test_waterfall_of_nothing(spark, scratch):
    assert revenue.revenue_waterfall(revenue.customer_months(spark.createDataFrame([], FACT)), scratch).collect() == []


def test_cohorts_are_read_from_bits(spark, scratch, plan_of):
    rows = [(1, D(2020, 11, 1)), (1, D(2020, 12, 1)), (1, D(2026, 2, 1)), (2, D(2020, 11, 1)), (3, D(2021, 1, 1))]
    active = spark.createDataFrame([r for r in rows for _ in range(3)], "customer_key long, m date")
    got = {(r.cohort_month, r.age): (r.active_customers, r.cohort_customers, str(r.retention_pct))
           for r in revenue.cohort_retention(active, "m", scratch).collect()}
    assert len(got) == 64 + 62
    assert got[D(2020, 11, 1), 0] == (2, 2, "100.00") and got[D(2020, 11, 1), 1] == (1, 2, "50.00")
    assert got[D(2020, 11, 1), 63] == (1, 2, "50.00") and got[D(2021, 1, 1), 61] == (0, 1, "0.00")
    assert sum(a for a, _, _ in got.values()) == 5
    assert "partial_bit_or" in plan_of(revenue.activity_bitmaps(active, "m"))


def test_covered_revenue_ties_out(spark, scratch):
    watched = spark.createDataFrame(
        [(1, c, D(2022, m, 1), 10 * c + m, c != 3) for c in (1, 2, 3) for m in (1, 2, 3)],
        "customer_key long, course_key long, consumption_month date, total_minutes_consumed long, is_revenue_eligible boolean",
    )
    orders = spark.createDataFrame(
        [(1, 1, at("2022-01-05T00:00:00"), "YEARLY", 12, Decimal("10.01"))], ORDER
    )
    made = revenue.covered_revenue(watched, revenue.plan_months(orders), Settings(), scratch)
    sums = made.groupBy("revenue_month").agg(F.sum("exact_revenue").alias("s"), F.count(F.lit(1)).alias("n"))
    assert {(r.s, r.n) for r in sums.collect()} == {(Decimal("10.01"), 2)} and sums.count() == 3


@pytest.mark.parametrize("minutes", [[0, 0, 0], [1, 0, 5]])
def test_months_without_minutes_are_dealt_evenly(spark, scratch, minutes):
    shared = spark.createDataFrame(
        [(1, i, D(2022, 1, 1), 9, Decimal("1.00"), m) for i, m in enumerate(minutes)],
        "customer_key long, course_key long, revenue_month date, order_key long,"
        " subscription_monthly_value decimal(12,2), course_minutes_consumed long",
    )
    made = revenue.exact_revenue(shared, Settings(), scratch).orderBy("course_key").collect()
    assert [int(r.exact_revenue * 100) for r in made] == brute_parts(100, minutes)
