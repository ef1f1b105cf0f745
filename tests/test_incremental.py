"""Loads by month against what one build over everything gives."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from watchledger.plans import build, incremental
from watchledger.plans.build import Raw
from watchledger.sources.seeds import SEED_COLUMNS

CUSTOMERS = [["1", "05/10/22 13:45", "", "150.00"], ["2", "", "", "12.00"]]
COURSES = [["Spark", "Paid", "Ann"], ["Kafka", "Paid", "Bob"], ["Intro", "Free", "Bob"]]
OCT, NOV, DEC = "2022-10-01", "2022-11-01", "2022-12-01"
DAY = dt.datetime(2022, 11, 1)


def order(order_id, when, customer, value, plan="Monthly Subscription"):
    return [order_id, f"N{order_id}", when, customer, plan, "IN", value]


def watched(user, course, minutes, month):
    return [user, course, minutes, month]


FIRST = {
    "customers": CUSTOMERS,
    "orders": [
        order("10", "05/10/22 13:45", "1", "150.00", "Yearly Subscription"),
        order("11", "2022-10-06 09:00:00", "2", "12"),
        order("12", "2022-10-07 09:00:00", "", "99", "Lab"),
        order("13", "2022-10-08 09:00:00", "9", "20"),
        order("20", "2022-11-06 09:00:00", "2", "14"),
    ],
    "courses": COURSES,
    "consumption": [
        watched("1", "Spark", "120", OCT), watched("1", "Kafka", "60", OCT),
        watched("2", "Spark", "5", OCT), watched("2", "Intro", "5", OCT),
        watched("2", "Kafka", "70", NOV), watched("9", "Spark", "7", NOV),
    ],
}
#: November again and whole, a new customer, a changed one, an order that changed.
SECOND = {
    "customers": [["1", "05/10/22 13:45", "", "175.00"], ["9", "", "2022-10-08 09:00:00", "20.00"]],
    "orders": [
        order("21", "2022-11-07 09:00:00", "1", "30"),
        order("20", "2022-11-06 09:00:00", "2", "15"),
        order("22", "2022-11-09 09:00:00", "9", "8"),
    ],
    "courses": [["Spark", "Paid", "Ann B."], ["Flink", "Paid", "Cy"]],
    "consumption": [
        watched("2", "Kafka", "75", NOV), watched("9", "Spark", "7", NOV), watched("9", "Spark", "1", NOV),
        watched("1", "Flink", "30", NOV), watched("1", "Spark", "60", NOV),
    ],
}
#: A late order of October and nothing else.
THIRD = {"customers": [], "courses": [], "consumption": [],
         "orders": [order("14", "2022-10-30 09:00:00", "2", "18")]}


def raw(spark, rows):
    frames = {}
    for name, columns in SEED_COLUMNS.items():
        kept = [*columns, "month"] if name == "consumption" else columns
        frames[name] = spark.createDataFrame(rows[name], ", ".join(f"`{c}` string" for c in kept))
    frames["consumption"] = frames["consumption"].withColumn("month", F.col("month").cast("date"))
    return Raw(**frames, month=F.col("month"))


@pytest.fixture(scope="module")
def three(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("increments")
    made = [
        incremental.add_load(spark, raw(spark, rows), str(out), DAY + dt.timedelta(i))
        for i, rows in enumerate((FIRST, SECOND, THIRD))
    ]
    return out, made


def everything():
    """What a single export after the third load holds."""
    orders = {o[0]: o for load in (FIRST, SECOND, THIRD) for o in load["orders"]}
    kept = [w for w in FIRST["consumption"] if w[3] == OCT]
    return {
        "customers": [SECOND["customers"][0], CUSTOMERS[1], SECOND["customers"][1]],
        "orders": list(orders.values()),
        "courses": [SECOND["courses"][0], *COURSES[1:], SECOND["courses"][1]],
        "consumption": kept + SECOND["consumption"],
    }


def shown(tables, name):
    """Rows with ids and names instead of keys."""
    customers = tables["dim_customer"].where("is_current").select("customer_key", "customer_id")
    courses = tables["dim_course"].select("course_key", "course_name")
    orders = tables["fact_order"].select("order_key", "order_id")
    df = tables[name].drop("created_at", "updated_at", "customer_id")
    for other, key in ((customers, "customer_key"), (courses, "course_key"), (orders, "order_key")):
        if key in df.columns and name != "fact_order":
            df = df.join(other, key, "left").drop(key)
    own = {"consumption_key", "revenue_key", "order_key", "customer_key", "course_key"}
    df = df.select(*sorted(set(df.columns) - own))
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_three_loads_give_what_one_build_gives(spark, three, tmp_path):
    _, made = three
    whole = build.build_warehouse(spark, raw(spark, everything()), str(tmp_path / "w"), DAY)
    for name in ("fact_order", "fact_consumption", "fact_revenue_attribution", "course_months"):
        assert shown(made[-1].tables, name) == shown(whole.tables, name), name


def test_a_load_writes_the_months_that_it_touches(three):
    out, made = three
    folders = [
        sorted(p.name.partition("=")[2] for p in (out / load.folder.rsplit("/", 1)[1] / name).glob("by_month=*"))
        for load in made
        for name in ("fact_consumption", "fact_revenue_attribution")
    ]
    # The second load also tells whose an order of October is.
    assert folders == [[OCT, NOV], [OCT, NOV], [NOV], [OCT, NOV], [], [OCT]]
    months = {p.month.isoformat(): p.part for p in made[-1].parts if p.table_name == "fact_consumption"}
    assert made[0].folder in months[OCT] and made[1].folder in months[NOV]


def test_other_months_are_not_read(spark, three, monkeypatch, tmp_path):
    """The fourth load brings December; its plans look at no file of a month before."""
    import shutil

    out, _ = three
    copy = tmp_path / "copy"
    shutil.copytree(out, copy)
    for parts in copy.glob("load-*/parts"):
        listed = spark.read.parquet(str(parts)).withColumn(
            "part", F.replace("part", F.lit(str(out)), F.lit(str(copy)))
        )
        rows = listed.collect()
        spark.createDataFrame(rows, listed.schema).coalesce(1).write.mode("overwrite").parquet(str(parts))
    read, table = [], incremental.Load.table

    def watching(self, name, months=None):
        df = table(self, name, months)
        if df is not None and name in incremental.MONTHLY:
            read.extend(df.inputFiles())
        return df

    monkeypatch.setattr(incremental.Load, "table", watching)
    rows = {**THIRD, "orders": [order("30", "2022-12-03 09:00:00", "1", "31")],
            "consumption": [watched("1", "Spark", "9", DEC)]}
    load = incremental.add_load(spark, raw(spark, rows), str(copy), DAY + dt.timedelta(9))
    assert read and all(f"by_month={DEC}" in f for f in read)
    assert {p.month.isoformat() for p in load.parts if p.table_name == "fact_consumption"} == {OCT, NOV, DEC}


def test_keys_go_on_and_open_versions_keep_theirs(three):
    _, made = three
    last = made[-1].tables
    for name, key in incremental.KEYS.items():
        keys = [r[0] for r in last[name].select(key).collect()]
        assert len(keys) == len(set(keys)) and None not in keys, name
    before = {r.customer_id: r.customer_key for r in made[0].tables["dim_customer"].collect()}
    rows = last["dim_customer"].collect()
    now = {r.customer_id: r.customer_key for r in rows if r.is_current}
    assert {c: now[c] for c in before} == before
    (closed,) = [r for r in rows if not r.is_current]
    assert (closed.customer_id, str(closed.total_spent)) == (1, "150.00")
    assert closed.customer_key > max(before.values())
    courses = {r.course_name: (r.course_key, r.course_instructor) for r in last["dim_course"].collect()}
    assert courses["Spark"][1] == "Ann B." and courses["Flink"][0] == 4
    high = {p.table_name: p.high for p in made[-1].parts if p.high is not None}
    assert high["dim_customer"] == 4 and high["dim_course"] == 4


def test_closed_versions_stay_in_the_load_that_closed_them(three):
    out, made = three
    parts = [p.part for p in made[-1].parts if p.table_name == "dim_customer"]
    assert [p.rsplit("=", 1)[1] for p in parts] == ["closed", "open"]
    assert made[1].folder in parts[0] and made[2].folder in parts[1]


def test_loads_out_of_order_and_failed_loads(spark, three, tmp_path):
    out = str(tmp_path / "w")
    incremental.add_load(spark, raw(spark, FIRST), out, DAY)
    with pytest.raises(ValueError, match="comes before"):
        incremental.add_load(spark, raw(spark, SECOND), out, DAY - dt.timedelta(1))
    broken = {**SECOND, "orders": [order("x", "n/a", "1", "1")]}
    with pytest.raises(Exception):
        incremental.add_load(spark, raw(spark, broken), out, DAY + dt.timedelta(1))
    assert len(build.loads(spark, out, incremental.PARTS)) == 1
    again = incremental.add_load(spark, raw(spark, SECOND), out, DAY + dt.timedelta(1))
    _, made = three
    for name in ("fact_order", "fact_revenue_attribution"):
        assert shown(again.tables, name) == shown(made[1].tables, name)
