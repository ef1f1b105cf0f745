"""Hand-made rows for every case the models have to get right."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchledger.plans import dimensions, facts, quality, reports, staging, views
from watchledger.settings import Settings
from watchledger.sources.seeds import SEED_COLUMNS

OCT = dt.date(2022, 10, 1)
LOAD = dt.datetime(2022, 10, 31)
SETTINGS = Settings()
YEARLY, MONTHLY, PACK = "Yearly Subscription", " monthly subscription ", "Business Pack"


def raw(spark, table, rows):
    names = SEED_COLUMNS[table]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.createDataFrame(rows, schema)


class Shop:
    """All models over a few raw rows."""

    def __init__(self, spark, scratch, customers, orders, courses, consumption):
        self.scratch = scratch
        raws = {
            "customers": [(*c, *[None] * (4 - len(c))) for c in customers],
            "orders": [
                (id_, f"N{id_} ", at, who, text, " IN ", net)
                for id_, at, who, text, net in orders
            ],
            "courses": [(*c, "Ann") if len(c) == 2 else c for c in courses],
        }
        frames = {t: raw(spark, t, rows) for t, rows in raws.items()}
        names = [*SEED_COLUMNS["consumption"], "month"]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        rows = [(*w, "2022-10-01") if len(w) == 3 else w for w in consumption]
        watched = spark.createDataFrame(rows, schema)
        self.stg_customers = staging.stg_customers(frames["customers"])
        self.stg_orders = staging.stg_orders(frames["orders"])
        self.stg_courses = staging.stg_courses(frames["courses"])
        self.stg_consumption = staging.stg_consumption(
            watched, F.col("month").cast("date")
        )

    def build(self, settings=SETTINGS):
        snap = dimensions.snap_customer(self.stg_customers, None, LOAD)
        self.customer = dimensions.dim_customer(snap, self.scratch)
        self.course = dimensions.dim_course(self.stg_courses, self.scratch)
        self.order = facts.fact_order(
            self.stg_orders, self.customer, settings, self.scratch
        )
        self.consumption = facts.fact_consumption(
            self.stg_consumption, self.customer, self.course, settings, self.scratch
        )
        self.attribution = facts.fact_revenue_attribution(
            self.order, self.consumption, settings, self.scratch
        )
        return self


def tuples(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


@pytest.fixture
def worked_example(spark, scratch):
    return Shop(
        spark,
        scratch,
        customers=[("1",)],
        orders=[("10", "2022-10-05 13:45:00", "1", YEARLY, "150.00")],
        courses=[("A", "Paid"), ("B", "Paid"), ("C", "Free")],
        consumption=[("1", "A", "120"), ("1", "B", "480"), ("1", "C", "120")],
    ).build()


def test_worked_example(worked_example):
    shop = worked_example
    assert tuples(
        shop.attribution.join(shop.course, "course_key"),
        "course_name",
        "course_minutes_consumed",
        "total_paid_minutes_consumed",
        "attribution_percentage",
        "attributed_revenue",
        "instructor_royalty",
    ) == [
        ("A", 120, 600, D("0.2000"), D("2.50"), D("0.50")),
        ("B", 480, 600, D("0.8000"), D("10.00"), D("2.00")),
    ]
    shares = tuples(shop.consumption, "consumption_percentage_of_month")
    assert shares == [(D("0.1667"),), (D("0.1667"),), (D("0.6667"),)]
    (mrr,) = views.view_monthly_mrr_arr(shop.attribution).collect()
    # The monthly value counts once per course row, as published.
    assert (mrr.mrr, mrr.arr, mrr.arpu) == (D("25.00"), D("300.00"), D("25.00"))
    assert (mrr.new_mrr, mrr.total_customers, mrr.new_customers) == (D("25.00"), 1, 1)
    assert mrr.mrr_growth_rate_pct is None and mrr.quick_ratio is None
    (royalty,) = views.view_instructor_royalties_monthly(
        shop.attribution, shop.course
    ).collect()
    assert tuple(royalty) == (OCT, "Ann", 2, D("12.50"), D("2.50"), 1)


def test_customers_are_cleaned_and_deduplicated(spark):
    rows = raw(
        spark,
        "customers",
        [
            ("1", "05/10/95 13:45", "2022-10-05 13:45:00", "10.00"),
            ("1", "n-a", "n/a", "20.005"),
            ("2", None, None, "99.00"),
            ("2", None, None, None),
            ("  ", None, None, "5.00"),
            (None, None, None, "5.00"),
            (" 3 ", "2022-10-05", "", "0"),
        ],
    )
    got = staging.stg_customers(rows)
    assert tuples(got, "customer_id", "total_spent") == [
        (1, D("20.01")),
        (2, None),
        (3, D("0.00")),
    ]
    by_id = {r.customer_id: r for r in got.collect()}
    assert by_id[1].first_paid_order_date is None
    assert by_id[3].first_paid_order_date == dt.datetime(2022, 10, 5)


def test_a_malformed_id_fails(spark):
    rows = raw(spark, "customers", [("x7", None, None, "1")])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_customers(rows).collect()


def test_staging_of_courses_and_consumption(spark):
    rows = raw(spark, "courses", [(" a : b ", " paid", " Ann "), ("a: b", "FREE", None)])
    assert tuples(staging.stg_courses(rows), "*") == [
        ("a : b", "PAID", "Ann"),
        ("a: b", "FREE", None),
    ]
    rows = raw(spark, "consumption", [("1", " A ", "5"), ("1", "  ", "5"), ("1", None, "5")])
    assert tuples(staging.stg_consumption(rows, OCT), "*") == [(1, "A", 5, OCT)]


def test_orders_are_classified(spark, scratch):
    texts = [
        ("Pro yearly and monthly", "YEARLY", None, 12, "10.00"),
        ("PROFESSIONAL monthly", "MONTHLY", "PROFESSIONAL", 1, "120.00"),
        ("Yearly Subscription", "YEARLY", "STANDARD", 12, "10.00"),
        ("Some Subscription", None, "STANDARD", None, "120.00"),
        ("Business Pack", None, None, None, "120.00"),
    ]
    shop = Shop(
        spark,
        scratch,
        customers=[("1",)],
        orders=[
            (str(i), "2022-10-05", "1", text, "120")
            for i, (text, *_) in enumerate(texts)
        ],
        courses=[],
        consumption=[],
    ).build()
    names = ["subscription_type", "subscription_tier", "subscription_interval_months"]
    rows = shop.order.orderBy("order_id").select("line_items", *names, "monthly_value")
    want = [(*t[:4], D(t[4])) for t in texts]
    assert [tuple(r) for r in rows.collect()] == want


@pytest.fixture
def busy_shop(spark, scratch):
    return Shop(
        spark,
        scratch,
        customers=[("1",), ("2",), ("3",), ("4",)],
        orders=[
            # Two in a month: the later one counts, on a tie the higher id.
            ("10", "2022-10-05 10:00:00", "1", MONTHLY, "10.00"),
            ("11", "2022-10-05 10:00:00", "1", MONTHLY, "20.00"),
            ("12", "2022-10-04 10:00:00", "1", MONTHLY, "30.00"),
            # The latest order is a refund.
            ("20", "2022-10-01 10:00:00", "2", MONTHLY, "10.00"),
            ("21", "2022-10-09 10:00:00", "2", MONTHLY, "-10.00"),
            # The latest order is no subscription.
            ("30", "2022-09-01 10:00:00", "3", MONTHLY, "10.00"),
            ("31", "2022-10-01 10:00:00", "3", PACK, "99.00"),
            # A date that cannot be read sorts last, so it is the latest.
            ("40", "2022-10-02 10:00:00", "4", MONTHLY, "10.00"),
            ("41", "n/a", "4", MONTHLY, "11.00"),
            # Nobody's orders stay in the fact.
            ("50", "2022-10-02 10:00:00", "  ", MONTHLY, "5.00"),
            ("51", "2022-10-03 10:00:00", None, MONTHLY, "5.00"),
            ("60", "2022-10-03 10:00:00", "999", MONTHLY, "5.00"),
        ],
        courses=[("A", "Paid"), ("Z", "Paid")],
        consumption=[
            ("1", "A", "60"),
            ("2", "A", "30"),
            ("2", "A", "29"),
            ("3", "A", "10"),  # only a pack in October
            ("4", "A", "0"),  # no minutes to share
            ("1", "unknown", "5"),
            ("999", "A", "5"),
            ("1", "Z", "7", "2022-11-01"),  # no order in that month
        ],
    )


def test_order_sequence(busy_shop):
    order = busy_shop.build().order
    names = ["order_id", "order_sequence", "is_first_order", "is_latest_order"]
    assert tuples(order, *names) == [
        (10, 2, False, False),
        (11, 3, False, True),
        (12, 1, True, False),
        (20, 1, True, False),
        (21, 2, False, True),
        (30, 1, True, False),
        (31, 2, False, True),
        (40, 1, True, False),
        (41, 2, False, True),
        (50, 1, True, False),
        (51, 2, False, True),
        (60, 1, True, True),
    ]
    keys = tuples(order, "order_key", "order_id", "customer_key")
    ids = [10, 11, 12, 20, 21, 30, 31, 40, 41, 50, 51, 60]
    owner = dict(zip(ids, [1, 1, 1, 2, 2, 3, 3, 4, 4, None, None, None]))
    assert sorted(keys) == [(n + 1, id_, owner[id_]) for n, id_ in enumerate(ids)]


def test_attribution_cases(busy_shop):
    shop = busy_shop.build()
    assert tuples(shop.consumption, "customer_key", "total_minutes_consumed") == [
        (1, 60),
        (1, 7),
        (2, 59),
        (3, 10),
        (4, 0),
    ]
    rows = shop.attribution.join(shop.order, "order_key")
    got = tuples(rows, "order_id", "attribution_percentage", "attributed_revenue")
    assert got == [
        (11, D("1.0000"), D("20.00")),
        (20, D("1.0000"), D("10.00")),
        (40, None, None),
    ]


def test_customer_status(busy_shop):
    shop = busy_shop.build()
    view = views.view_customer_subscription_status(shop.customer, shop.order, SETTINGS)
    assert tuples(view, "customer_id", "current_plan", "mrr", "status") == [
        (1, "MONTHLY", D("20.00"), "ACTIVE"),
        (2, "MONTHLY", D("-10.00"), "ACTIVE"),
        (3, "NONE", D("0.00"), "UNKNOWN"),
        (4, "MONTHLY", D("11.00"), "UNKNOWN"),
    ]


def test_reports_of_the_busy_shop(busy_shop):
    shop = busy_shop.build()
    classes = tuples(reports.order_classes(shop.order), "*")
    assert classes == [("MONTHLY", "STANDARD", 1, 11), (None, None, None, 1)]
    assert tuples(reports.eligibility(shop.consumption), "*") == [(True, 5, 136)]
    months = tuples(reports.revenue_by_month(shop.attribution), "*")
    assert months == [(OCT, D("30.00"))]


def attribution_rows(spark, rows):
    """(customer, course, month, value, minutes, revenue) as an attribution fact."""
    return spark.createDataFrame(
        [
            (
                n,
                c,
                k,
                dt.date(2022, m, 1),
                D(value),
                minutes,
                rev and D(rev),
                rev and D(rev) / 5,
            )
            for n, (c, k, m, value, minutes, rev) in enumerate(rows)
        ],
        "revenue_key long, customer_key long, course_key long, revenue_month date,"
        " subscription_monthly_value decimal(12,2), course_minutes_consumed long,"
        " attributed_revenue decimal(12,2), instructor_royalty decimal(12,2)",
    )


def test_movements_between_months(spark):
    """A customer back after a gap counts as retained; the lag is by row."""
    rows = attribution_rows(
        spark,
        [
            (1, 1, 1, "10.00", 60, "10.00"),
            (2, 1, 1, "20.00", 60, "20.00"),
            (1, 1, 2, "15.00", 60, "15.00"),
            (2, 1, 3, "5.00", 60, "5.00"),
            (3, 1, 3, "1.00", 60, "1.00"),
        ],
    )
    march, february, january = views.view_monthly_mrr_arr(rows).collect()
    assert january.mrr == D("30.00") and january.mrr_growth_rate_pct is None
    assert february.expansion_mrr == D("5.00")
    assert february.mrr_growth_rate_pct == D("16.67")
    assert february.customer_retention_rate_pct == D("50.00")
    assert february.quick_ratio is None
    assert (march.new_mrr, march.contraction_mrr) == (D("1.00"), D("15.00"))
    assert march.net_new_mrr == D("-14.00")
    assert march.mrr_growth_rate_pct == D("-93.33")
    assert (march.retained_customers, march.new_customers) == (1, 1)
    assert march.customer_retention_rate_pct == D("100.00")
    assert (march.quick_ratio, march.arpu) == (D("0.07"), D("3.00"))
    assert march.churned_mrr == 0


COURSES = "course_key long, course_name string, course_type string, course_instructor string"


def course_revenue(rows, courses, scratch):
    """The view over its stored table."""
    months = views.course_months(rows, courses, SETTINGS, scratch)
    return views.view_course_revenue_monthly(months)


def test_course_revenue_ranks_and_engagement(spark, scratch):
    rows = attribution_rows(
        spark,
        [
            (1, 1, 10, "9.00", 59, "5.00"),
            (2, 1, 10, "9.00", 60, "5.00"),
            (1, 2, 10, "9.00", 61, "10.00"),
            (1, 3, 10, "9.00", 61, "1.01"),
            (2, 3, 10, "9.00", 61, "1.00"),
            (3, 3, 10, "9.00", 61, "1.00"),
            (1, 4, 10, "9.00", 61, "1.00"),
        ],
    )
    courses = spark.createDataFrame(
        [(k, name, kind, "Ann") for k, name, kind in [
            (1, "A", "PAID"), (2, "B", "PAID"), (3, "C", "PAID"), (4, "F", "FREE")]],
        COURSES,
    )
    view = course_revenue(rows, courses, scratch)
    names = ["course_name", "revenue_rank", "popularity_rank", "unique_students"]
    names += ["students_1plus_hours", "engagement_rate_pct", "avg_revenue_per_student"]
    names += ["total_hours_consumed", "avg_minutes_per_student"]
    assert [tuple(r) for r in view.select(*names).collect()] == [
        ("A", 1, 2, 2, 1, D("50.00"), D("5.00"), D("1.98"), D("59.50")),
        ("B", 1, 3, 1, 1, D("100.00"), D("10.00"), D("1.02"), D("61.00")),
        ("C", 3, 1, 3, 3, D("100.00"), D("1.00"), D("3.05"), D("61.00")),
    ]


def test_means_leave_out_null_revenue(spark, scratch):
    """A month without minutes has no share, hence no revenue to average."""
    rows = attribution_rows(
        spark,
        [
            (1, 1, 10, "9.00", 90, "5.00"),
            (2, 1, 10, "9.00", 0, None),
            (2, 2, 10, "9.00", 0, None),
        ],
    )
    courses = spark.createDataFrame(
        [(1, "A", "PAID", "x"), (2, "B", "PAID", "x")], COURSES
    )
    view = course_revenue(rows, courses, scratch)
    names = ["course_name", "total_revenue", "avg_revenue_per_student"]
    names += ["avg_minutes_per_student", "unique_students", "revenue_rank"]
    # Null sorts first descending, so the course without revenue ranks first.
    assert [tuple(r) for r in view.select(*names).collect()] == [
        ("B", None, None, D("0.00"), 1, 1),
        ("A", D("5.00"), D("5.00"), D("45.00"), 2, 2),
    ]


def test_customers_are_counted_once_when_course_names_repeat(spark, scratch):
    """Two keys for one title: the same customer watched both."""
    rows = attribution_rows(
        spark,
        [
            (1, 1, 10, "9.00", 30, "5.00"),
            (1, 2, 10, "9.00", 90, "4.00"),
            (2, 2, 10, "9.00", 10, "1.00"),
        ],
    )
    twice = [(1, "A", "PAID", None), (2, "A", "PAID", None)]
    courses = spark.createDataFrame(twice, COURSES)
    (row,) = course_revenue(rows, courses, scratch).collect()
    assert (row.unique_students, row.students_1plus_hours) == (2, 1)
    assert row.total_revenue == D("10.00") and row.avg_revenue_per_student == D("3.33")
    assert row.avg_minutes_per_student == D("43.33")
    (royalty,) = views.view_instructor_royalties_monthly(rows, courses).collect()
    assert (royalty.instructor, royalty.courses_count) == (None, 1)
    assert royalty.unique_students == 2


def test_hours_of_trends_add_up_rounded_rows(spark, scratch):
    shop = Shop(
        spark,
        scratch,
        customers=[("1",), ("2",)],
        orders=[],
        courses=[("A", "Free")],
        consumption=[("1", "A", "10"), ("2", "A", "10")],
    ).build()
    (row,) = views.view_consumption_trends(shop.consumption, shop.course).collect()
    # 0.17 + 0.17, where rounding the sum would give 0.33.
    assert row.total_hours == D("0.34")
    assert (row.unique_users, row.avg_minutes_per_user) == (2, D("10.00"))


def test_second_version_is_the_current_one(spark, scratch):
    first = staging.stg_customers(raw(spark, "customers", [("1", None, None, "5")]))
    second = staging.stg_customers(raw(spark, "customers", [("1", None, None, "6")]))
    old = scratch.stage(dimensions.snap_customer(first, None, LOAD), "old")
    later = LOAD + dt.timedelta(days=1)
    dim = dimensions.dim_customer(
        dimensions.snap_customer(second, old, later), scratch
    )
    names = ["customer_key", "total_spent", "effective_to_date", "is_current"]
    assert tuples(dim, *names) == [
        (1, D("5.00"), later, False),
        (2, D("6.00"), None, True),
    ]
    scd1 = dimensions.dim_customer_scd1(second, scratch)
    assert tuples(scd1, "customer_key", "customer_id", "is_current") == [(1, 1, True)]


def test_checks_find_planted_faults(spark):
    good = (D("1.0000"), D("10.00"), D("2.00"))
    rows = [
        (1, 1, 1, D("0.5000"), D("10.00"), D("5.00"), D("1.00")),  # shares miss 1
        (2, 2, 1, D("1.0000"), D("10.00"), D("9.00"), D("1.80")),  # no tie-out
        (3, 3, 1, *good[:2], D("10.00"), D("2.02")),  # wrong royalty
        (4, 4, 2, D("1.0000"), D("10.00"), D("10.00"), D("2.00")),  # free course
        (5, 5, 1, D("1.0000"), D("-10.00"), D("-10.00"), D("-2.00")),  # negative
        (5, 6, 1, D("1.0000"), D("10.00"), None, None),  # repeated key, null
    ]
    fact = spark.createDataFrame(
        rows,
        "revenue_key long, customer_key long, course_key long,"
        " attribution_percentage decimal(9,4), subscription_monthly_value decimal(12,2),"
        " attributed_revenue decimal(12,2), instructor_royalty decimal(12,2)",
    ).withColumn("revenue_month", F.lit("2022-10-01").cast("date"))
    courses = spark.createDataFrame([(1, "A", "PAID", "x"), (2, "B", "FREE", "x")], COURSES)
    assert tuples(quality.attribution_sums(fact), "customer_key") == [(1,)]
    assert tuples(quality.revenue_ties_out(fact), "customer_key") == [(1,), (2,)]
    assert tuples(quality.royalty_rate(fact), "revenue_key") == [(3,)]
    assert tuples(quality.free_courses_in_revenue(fact, courses), "revenue_key") == [(4,)]
    assert tuples(quality.negative_revenue(fact), "revenue_key") == [(5,)]
    results = quality.revenue_checks(fact)
    summary = quality.summary(results).first()
    assert (summary.total_checks, summary.passed, summary.failed) == (4, 0, 4)
    assert summary.pass_rate == 0.0
    details = {r.check_name: r.details for r in summary.results}
    assert details == {
        "not_null_attributed_revenue": "1 null values found",
        "unique_revenue_key": "1 duplicate values found",
        "attribution_sums_to_one": "1 customer-months with incorrect attribution sum",
        "revenue_ties_out": "2 customer-months with revenue mismatch",
    }
    assert reports.bad_attribution(fact).first().row_count == 1
    assert reports.bad_tieout(fact, 1).count() == 1
    nothing = quality.summary(results.where("false")).first()
    assert (nothing.total_checks, nothing.pass_rate) == (0, 0.0)


def test_dates_that_do_not_exist_are_counted(spark):
    dates = ["31/02/22 10:00", "05/10/22 25:00", "12-10-2022", "05/10/22 10:00", "", None, "n a"]
    customers = raw(spark, "customers", [(str(i), d, "2022-10-05", "1") for i, d in enumerate(dates)])
    orders = raw(spark, "orders", [("1", "N", "n/a", "1", "x", "IN", "1")])
    found = quality.unparsed_dates({"customers": customers, "orders": orders})
    assert tuples(found, "table_name", "column_name", "unparsed") == [
        ("customers", "First Order Date", 0),
        ("customers", "First Paid Order Date", 3),
        ("orders", "Order Created At", 1),
    ]
