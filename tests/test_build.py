"""From CSV files to checked tables."""

import csv
import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from watchledger.plans import build, dimensions
from watchledger.plans import ledger
from watchledger.plans.history import PARTS, customer_history
from watchledger.plans.ledger import LEDGER, LOAD_TESTS
from watchledger.settings import Settings
from watchledger.sources import (
    full_refresh,
    materialize_table,
    materialize_view,
    read_csv_seed,
    table_ref,
)
from watchledger.sources.seeds import REJECTED, SEED_COLUMNS, write_csv_seed

FIRST = {
    "customers": [
        ["1", "05/10/22 13:45", "2022-10-01 08:00:00", "150.00"],
        ["2", "", "", "12.00"],
        [" ", "", "", "3.00"],
    ],
    "orders": [
        ["10", "N10", "05/10/22 13:45", "1", "Yearly Subscription", "IN", "150.00"],
        ["11", "N11", "2022-10-06 09:00:00", "2", "Monthly Subscription", "US", "12"],
        ["12", "N12", "2022-10-07 09:00:00", "", "Lab, 10 seats", "US", "99"],
    ],
    "courses": [
        [" Terraform : Cloud ", "Paid", "Ann"],
        ["Terraform: Cloud", "Paid", "Ann"],
        ['The "free" one, with a comma', "Free", "Bob"],
    ],
    "consumption": [
        ["1", "Terraform : Cloud", "120"],
        ["1", "Terraform: Cloud", "480"],
        ["1", 'The "free" one, with a comma', "120"],
        ["2", "Terraform: Cloud", "5"],
        ["2", "  ", "5"],
    ],
}


def write(folder, tables):
    folder.mkdir()
    for name, rows in tables.items():
        with open(folder / f"{name}.csv", "w", newline="") as f:
            out = csv.writer(f)
            out.writerow(SEED_COLUMNS[name])
            out.writerows(rows)
    return str(folder)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("build")
    raw = build.read_seeds(spark, write(base / "seeds", FIRST), Settings())
    when = dt.datetime(2022, 11, 1)
    return build.build_warehouse(
        spark, raw, str(base / "out"), when, as_views=True
    ), base


def test_tables_and_views(spark, built):
    result, _ = built
    counts = {r.table_name: r.row_count for r in result.row_counts().collect()}
    assert counts == {
        "stg_customers": 2,
        "stg_orders": 3,
        "stg_courses": 3,
        "stg_consumption": 4,
        "snap_customer": 2,
        "dim_course": 3,
        "dim_customer": 2,
        "fact_order": 3,
        "fact_consumption": 4,
        "fact_revenue_attribution": 3,
        "course_months": 2,
        "view_monthly_mrr_arr": 1,
        "view_course_revenue_monthly": 2,
        "view_instructor_royalties_monthly": 1,
        "view_customer_subscription_status": 2,
        "view_consumption_trends": 3,
    }
    assert all(r.passed for r in result.checks.collect())
    # Views answer plain SQL, as do the tables.
    (top,) = spark.sql(
        "select course_name, total_revenue from view_course_revenue_monthly"
        " order by total_revenue desc limit 1"
    ).collect()
    assert (top.course_name, str(top.total_revenue)) == ("Terraform: Cloud", "22.00")
    audit = spark.sql("select count(created_at) as n from fact_order").first()
    assert audit.n == 3


def seeds(spark, base, name, **changed):
    return build.read_seeds(spark, write(base / name, {**FIRST, **changed}), Settings())


def versions(load):
    rows = load.tables["dim_customer"].orderBy("customer_key").collect()
    return [(r.customer_id, str(r.total_spent), r.is_current) for r in rows]


def test_loads_follow_one_another_in_one_warehouse(spark, tmp_path):
    out = str(tmp_path / "out")
    day = dt.datetime(2022, 11, 1)
    first = build.build_warehouse(spark, seeds(spark, tmp_path, "s1"), out, day)
    assert build.loads(spark, out)[-1].endswith(first.folder.rsplit("/", 1)[1])

    spent = [["1", "05/10/22 13:45", "", "175.00"]]
    changed = seeds(spark, tmp_path, "s2", customers=spent)
    broken = seeds(spark, tmp_path, "s3", orders=[["x", "N", "n/a", "1", "Pack", "IN", "1"]])
    with pytest.raises(Exception):
        build.build_warehouse(spark, broken, out, day + dt.timedelta(1))
    # The failed load is not complete, and the one before is as it was.
    assert len(build.loads(spark, out)) == 1
    assert customer_history(spark, build.loads(spark, out)[-1]).count() == 2

    later = build.build_warehouse(spark, changed, out, day + dt.timedelta(2))
    assert versions(later) == [(1, "150.00", False), (1, "175.00", True), (2, "12.00", True)]
    # Facts point at the current version.
    keys = later.tables["fact_order"].where("customer_key is not null")
    assert {r.customer_key for r in keys.collect()} == {2, 3}
    assert len(build.loads(spark, out)) == 2
    with pytest.raises(FileExistsError):
        build.build_warehouse(spark, changed, out, day)
    assert versions(first) == [(1, "150.00", True), (2, "12.00", True)]


def test_loads_out_of_order_are_refused(spark, tmp_path):
    out, day = str(tmp_path / "out"), dt.datetime(2022, 11, 1)
    raw = seeds(spark, tmp_path, "s")
    build.build_warehouse(spark, raw, out, day)
    for when in (day - dt.timedelta(1), day - dt.timedelta(seconds=1)):
        with pytest.raises(ValueError, match="comes before"):
            build.build_warehouse(spark, raw, out, when)
    assert len(list((tmp_path / "out").iterdir())) == 1


def test_closed_versions_are_written_once_and_read_by_readers_only(spark, tmp_path, monkeypatch):
    """Three loads; the third merges with the open versions of the second alone."""
    out, day = str(tmp_path / "out"), dt.datetime(2022, 11, 1)
    merged, merge = [], dimensions.scd2_merge

    def watched(load, prior, **how):
        merged.append(prior.inputFiles() if prior is not None else [])
        return merge(load, prior, **how)

    monkeypatch.setattr(dimensions, "scd2_merge", watched)
    for i, spent in enumerate(("150.00", "160.00", "170.00")):
        rows = [["1", "05/10/22 13:45", "", spent], ["2", "", "", "12.00"]]
        raw = seeds(spark, tmp_path, f"s{i}", customers=rows)
        last = build.build_warehouse(spark, raw, out, day + dt.timedelta(i))
    assert versions(last) == [
        (1, "150.00", False), (1, "160.00", False), (1, "170.00", True), (2, "12.00", True)
    ]
    assert not merged[0] and merged[1] and all("state=open" in f for f in merged[1] + merged[2])
    closed = sorted(p.parent.parent.name for p in (tmp_path / "out").glob("*/snap_customer/state=closed"))
    assert closed == ["load-20221102T000000", "load-20221103T000000"]
    own = spark.read.parquet(f"{last.folder}/snap_customer/state=closed")
    assert [str(r.total_spent) for r in own.collect()] == ["160.00"]


def test_history_that_would_be_replaced_is_refused(spark, tmp_path):
    out, day = str(tmp_path / "out"), dt.datetime(2022, 11, 1)
    folder = build.load_folder(out, day)
    rows = [(1, None, None, None, day, None)]
    kinds = "customer_id long, first_paid_order_date timestamp_ntz, first_order_date"
    kinds += " timestamp_ntz, total_spent decimal(18,2), dbt_valid_from timestamp_ntz,"
    kinds += " dbt_valid_to timestamp_ntz"
    spark.createDataFrame(rows, kinds).write.parquet(f"{folder}/snap_customer")
    own = table_ref(spark, f"{folder}/snap_customer")
    with pytest.raises(ValueError, match="history"):
        build.build_warehouse(spark, seeds(spark, tmp_path, "s"), out, day, history=own)
    assert own.count() == 1


def test_every_test_of_the_models_is_run(built):
    result, _ = built
    rows = result.tests.collect()
    kinds = Counter(r.kind for r in rows)
    assert kinds == {"unique": 11, "not_null": 26, "accepted_values": 3, "relationships": 5, "singular": 5}
    assert all(r.passed and r.failures == 0 for r in rows)


def test_a_failed_test_can_stop_the_build(spark, tmp_path):
    out, day = str(tmp_path / "out"), dt.datetime(2022, 11, 1)
    twice = [*FIRST["orders"], ["10", "N10", "2022-10-08 09:00:00", "2", "Pack", "IN", "5"]]
    raw = seeds(spark, tmp_path, "s", orders=twice)
    with pytest.raises(build.BuildFailed, match="unique stg_orders.order_id"):
        build.build_warehouse(spark, raw, out, day, stop_on_failure=True)
    assert build.loads(spark, out) == []
    kept = build.build_warehouse(spark, raw, out, day)
    failed = {(r.model, r.column): r.failures for r in kept.tests.where("not passed").collect()}
    assert failed == {("stg_orders", "order_id"): 1, ("fact_order", "order_id"): 1}


def test_the_ledger_is_taken_while_tables_are_written(spark, built):
    result, _ = built
    figures = {(r.table_name, r.measure): r.value for r in result.ledger.collect()}
    assert figures["fact_order", "rows"] == 3 and figures["fact_order", "net_amount_usd"] == 261
    assert figures["fact_consumption", "total_minutes_consumed"] == 725
    rows = {(r.table_name, r.measure): r for r in result.ledger.collect()}
    assert rows["fact_order", "rows"].latest == dt.datetime(2022, 10, 7, 9)
    assert {r.kind for r in result.load_tests.collect()} == {"volume"}
    assert all(r.passed for r in result.load_tests.collect())


def test_a_spike_fails_and_a_normal_load_does_not(spark):
    kinds = "load string, table_name string, measure string, value double, latest timestamp_ntz"
    usual = [("t", "rows", v) for v in (100.0, 104.0, 98.0, 101.0)] + [("u", "rows", 7.0)] * 4
    earlier = spark.createDataFrame(
        [(f"load-{i % 4}", t, m, v, None) for i, (t, m, v) in enumerate(usual)], kinds
    )

    def failed(*values):
        rows = [("load-9", t, "rows", v, None) for t, v in zip(("t", "u", "new"), values)]
        own = spark.createDataFrame(rows, kinds)
        tests = ledger.load_tests(own, earlier, dt.datetime(2022, 11, 1))
        return {r.model for r in tests.where("not passed").collect()}

    assert failed(103.0, 7.0, 5.0) == set() and failed(120.0, 8.0, 0.0) == set()
    assert failed(250.0, 7.0, 5.0) == {"t"} and failed(10.0, 12.0, 1e9) == {"t", "u"}


def test_stale_sources_warn_and_fail(spark):
    rows = [("a", dt.datetime(2022, 10, 31)), ("b", dt.datetime(2022, 10, 30, 12)), ("c", dt.datetime(2022, 10, 1)), ("d", None)]
    latest = spark.createDataFrame(rows, "table_name string, latest timestamp_ntz")
    hours = [dt.timedelta(hours=h) for h in (24, 48)]
    got = ledger.freshness(latest, dt.datetime(2022, 11, 1), *hours).collect()
    assert {r.table_name: (r.age_hours, r.level) for r in got} == {
        "a": (24, "pass"), "b": (36, "warn"), "c": (744, "error"), "d": (None, "error")
    }


def test_a_stale_source_can_stop_the_build(spark, tmp_path):
    limits = Settings(warn_after=dt.timedelta(days=1), error_after=dt.timedelta(days=40))
    raw = build.read_seeds(spark, write(tmp_path / "s", FIRST), limits)
    out, day = str(tmp_path / "out"), dt.datetime(2022, 11, 1)
    kept = build.build_warehouse(spark, raw, out, day, limits, stop_on_failure=True)
    fresh = {(r.model, r.column): r.passed for r in kept.load_tests.where("kind = 'freshness'").collect()}
    assert fresh["fact_order", "warn"] is False and fresh["fact_order", "error"] is True
    late = dt.datetime(2023, 1, 1)
    with pytest.raises(build.BuildFailed, match="freshness fact_order.error"):
        build.build_warehouse(spark, raw, out, late, limits, stop_on_failure=True)
    assert len(build.loads(spark, out)) == 1


def test_defining_the_views_runs_nothing(spark, built):
    result, _ = built
    t = result.tables
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("views", "define")
    try:
        views = build.analytics_views(
            t["fact_revenue_attribution"], t["fact_order"], t["fact_consumption"],
            t["dim_course"], t["dim_customer"], t["course_months"], Settings(),
        )
        assert len(views) == 5
        assert not tracker.getJobIdsForGroup("views")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_month_filter_reads_that_month_only(built, plan_of):
    result, base = built
    for name, month in (("fact_consumption", "consumption_month"), ("fact_revenue_attribution", "revenue_month")):
        fact = result.tables[name]
        plan = plan_of(fact.where(f"{month} = date'2022-10-01'"))
        assert f"PartitionFilters: [isnotnull({month}" in plan
        assert fact.count() == fact.where(f"{month} = date'2022-10-01'").count() > 0
        (load,) = (base / "out").iterdir()
        assert [p.name for p in (load / name).glob("*=*")] == [f"{month}=2022-10-01"]


def test_a_build_leaves_only_its_tables(built):
    result, base = built
    (load,) = (base / "out").iterdir()
    assert sorted(p.name for p in load.iterdir()) == sorted(
        [*result.tables, build.TESTS, PARTS, LEDGER, LOAD_TESTS]
    )


@pytest.mark.parametrize("columns", [SEED_COLUMNS["courses"], ["Course Type"]])
@pytest.mark.parametrize(
    "record", ["a,Paid", "a,Paid,b,c", '"a\nb",Paid,c', 'a,Paid,"b\nc,Paid,d"']
)
def test_records_that_do_not_fit_fail(spark, tmp_path, columns, record):
    path = tmp_path / "x.csv"
    path.write_text("Course Name,Course Type,Course Instructor\nx,Free,y\n" + record + "\n")
    with pytest.raises(Exception, match="does not fit|not closed"):
        read_csv_seed(spark, str(path), SEED_COLUMNS["courses"]).select(
            *[f"`{c}`" for c in columns]
        ).collect()


def test_rejects_are_kept_apart_and_breaks_read_on_request(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("Course Name,Course Type,Course Instructor\nx,Free,y\na,Paid\n")
    rows = read_csv_seed(spark, str(path), SEED_COLUMNS["courses"], rejects=True).collect()
    assert [r[REJECTED] for r in rows] == [None, "a,Paid"]
    path.write_text('Course Name,Course Type,Course Instructor\n"a\nb",Free,y\n')
    rows = read_csv_seed(spark, str(path), SEED_COLUMNS["courses"], multiline=True).collect()
    assert [tuple(r) for r in rows] == [("a\nb", "Free", "y")]


def test_catalogue_with_the_traits_of_a_real_one(spark, tmp_path):
    """48 rows, 36 paid, 14 instructors, near-equal and mis-encoded names."""
    names = [f"Course {i}, part \"{i % 3}\"" for i in range(45)]
    names += ["Terraform : Cloud", "Terraform: Cloud", " Caf\u00c3\u00a9 basics "]
    rows = [(n, "Free" if i % 4 == 0 else "Paid", f"T{i % 14}") for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in SEED_COLUMNS["courses"]))
    path = str(tmp_path / "c.csv")
    write_csv_seed(df, path)
    back = read_csv_seed(spark, path, SEED_COLUMNS["courses"])
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert back.where("`Course Type` = 'Paid'").count() == 36


def test_csv_header_is_checked(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("Course Title,Course Type,Course Instructor\na,Paid,b\n")
    with pytest.raises(Exception, match="header"):
        read_csv_seed(spark, str(path), SEED_COLUMNS["courses"]).collect()


@pytest.mark.parametrize("rejects", [False, True])
@pytest.mark.parametrize("rows", [(30, 1), (1, 30)])
def test_the_header_of_every_file_is_checked(spark, tmp_path, rows, rejects):
    folder = tmp_path / "x.csv"
    folder.mkdir()
    right, swapped = rows
    lines = ["Course Name,Course Type,Course Instructor"] + ["a,Paid,Ann"] * right
    (folder / "1.csv").write_text("\n".join(lines) + "\n")
    lines = ["Course Instructor,Course Name,Course Type"] + ["Bob,b,Free"] * swapped
    (folder / "2.csv").write_text("\n".join(lines) + "\n")
    with pytest.raises(Exception, match="header|2.csv"):
        read_csv_seed(spark, str(folder), SEED_COLUMNS["courses"], rejects=rejects).collect()
    (folder / "2.csv").write_text("\n".join(["Course Name,Course Type,Course Instructor", "b,Free,Bob"]))
    both = read_csv_seed(spark, str(folder), SEED_COLUMNS["courses"], rejects=rejects)
    assert both.count() == right + 1


def test_tables_are_replaced_and_views_are_lazy(spark, tmp_path):
    path = str(tmp_path / "t")
    full_refresh(spark.range(5), path)
    assert materialize_table(spark.range(3), path).count() == 3
    assert table_ref(spark, path).count() == 3
    failing = spark.range(1).select(F.raise_error(F.lit("computed")).alias("x"))
    materialize_view(failing, "lazy_view")
    with pytest.raises(Exception, match="computed"):
        spark.table("lazy_view").collect()
