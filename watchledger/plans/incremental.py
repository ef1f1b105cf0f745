"""Loads that write the months they touch and leave the others as they are.

A load brings the orders, titles, customers and watch rows that are new. Its folder
gets the months it touches, and a list of parts: per table, or per table and month,
the folder that holds it as of this load. Months that a load does not touch are
listed where they are, neither read nor written. A load is complete once its list
is committed; a load that failed is not listed anywhere and can be repeated.

Keys go on from the highest one so far. A customer's open version keeps its key for
good, and a version that closes moves to a new one: facts always point to the open
version, so those of untouched months stay right. Titles keep their keys by name,
orders by id.

What a load replaces: a month of watch rows by all rows that the load has of that
month, an order by its id, a title's type and instructor by its name. Orders of
customers with new orders are numbered again, wherever they are. Watch rows of
earlier months by users who become customers later, and earlier months of a title
whose type changes, are taken up when a load brings those months again.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from watchledger.functions import month_start
from watchledger.operators.groups import sequence_in_group
from watchledger.operators.history import VALID_FROM, VALID_TO
from watchledger.operators.keep import keep_top
from watchledger.operators.numbering import number_rows
from watchledger.plans import dimensions, facts, staging, views
from watchledger.plans.build import Raw, load_folder, loads, refuse_out_of_order
from watchledger.scratch import Scratch
from watchledger.settings import Settings
from watchledger.sources.tables import full_refresh, table_ref

#: The list of parts; it is written last.
PARTS = "parts"
#: Tables by month, and their column for it.
MONTHLY = {
    "fact_consumption": "consumption_month",
    "fact_revenue_attribution": "revenue_month",
    "course_months": "month",
}
KEYS = {
    "dim_customer": "customer_key",
    "dim_course": "course_key",
    "fact_order": "order_key",
    "fact_consumption": "consumption_key",
    "fact_revenue_attribution": "revenue_key",
}
_PART_SCHEMA = "table_name string, month date, part string, high long"
_FOLDER = "by_month"
_OPEN, _CLOSED = "open", "closed"


@dataclass
class Load:
    """The tables as of one load. ``parts`` has a row per table, month and folder."""

    spark: SparkSession
    folder: str
    parts: list = field(default_factory=list)

    def table(self, name: str, months: list[dt.date] | None = None) -> DataFrame | None:
        """A table, or some of its months; only their folders are looked at."""
        rows = [p for p in self.parts if p.table_name == name and p.part]
        if months is not None:
            rows = [p for p in rows if p.month in months]
        return self.spark.read.parquet(*[p.part for p in rows]) if rows else None

    def high(self, name: str) -> int:
        return max([p.high for p in self.parts if p.table_name == name and p.high], default=0)

    @property
    def tables(self) -> dict[str, DataFrame]:
        names = dict.fromkeys(p.table_name for p in self.parts)
        return {name: df for name in names if (df := self.table(name)) is not None}


def open_load(spark: SparkSession, folder: str) -> Load:
    """A complete load by its folder. The list has a row per table and month."""
    return Load(spark, folder, table_ref(spark, f"{folder}/{PARTS}").collect())


def add_load(
    spark: SparkSession,
    raw: Raw,
    warehouse: str,
    load_time: dt.datetime,
    settings: Settings = Settings(),
) -> Load:
    """Take in what is new and return the warehouse as of this load."""
    out = load_folder(warehouse, load_time)
    complete = loads(spark, warehouse, PARTS)
    refuse_out_of_order(out.rsplit("/", 1)[1], complete)
    before = open_load(spark, complete[-1]) if complete else Load(spark, "")
    with Scratch(spark) as scratch:
        step = _Step(spark, before, out, load_time, settings, scratch)
        customers = scratch.stage(staging.stg_customers(raw.customers), "customers")
        watched = scratch.stage(staging.stg_consumption(raw.consumption, raw.month), "watched")
        current = step.customers(customers)
        courses = step.courses(staging.stg_courses(raw.courses))
        orders, changed = step.orders(staging.stg_orders(raw.orders), current)
        watch_months = _months(watched, "consumption_month")
        # At most as many as the calendar has.
        order_months = _months(changed, "month")

        fact = facts.fact_consumption(watched, current, courses, settings, scratch)
        step.monthly("fact_consumption", fact, watch_months)
        touched = sorted({*watch_months, *order_months})
        shared = step.attribution(orders, touched)
        step.monthly("fact_revenue_attribution", shared, touched)
        attribution = step.now.table("fact_revenue_attribution", touched)
        if attribution is not None:
            ranked = views.course_months(attribution, courses, settings, scratch)
            step.monthly("course_months", ranked, touched)
        step.finish()
    return step.now


class _Step:
    """What one load adds to the one before."""

    def __init__(self, spark, before: Load, out: str, load_time, settings, scratch):
        self.spark, self.before, self.out = spark, before, out
        self.load_time, self.settings, self.scratch = load_time, settings, scratch
        self.now = Load(spark, out)

    # -- dimensions ----------------------------------------------------------

    def customers(self, customers: DataFrame) -> DataFrame:
        """Versions after this load; returns the open ones with their keys."""
        name = "dim_customer"
        parts = [p for p in self.before.parts if p.table_name == name]
        opened = [p.part for p in parts if p.part.endswith(f"={_OPEN}")]
        prior = self.spark.read.parquet(*opened) if opened else None
        if prior is None:
            versions = dimensions.snap_customer(customers, None, self.load_time)
            keyed = versions.withColumn("customer_key", F.lit(None).cast("long"))
        else:
            as_snapshot = prior.select(
                *customers.columns,
                F.col("effective_from_date").alias(VALID_FROM),
                F.col("effective_to_date").alias(VALID_TO),
            )
            versions = dimensions.snap_customer(customers, as_snapshot, self.load_time)
            keys = prior.select("customer_id", "customer_key")
            keyed = versions.join(keys, "customer_id", "left")
        is_open = F.col(VALID_TO).isNull()
        kept = F.when(is_open, F.col("customer_key"))
        rows = self._new_keys(
            keyed.withColumn("customer_key", kept), name, ["customer_id", VALID_FROM]
        )
        state = F.when(is_open, _OPEN).otherwise(_CLOSED)
        stored = rows.select(
            "customer_key",
            *customers.columns,
            F.lit(None).cast("string").alias("customer_status"),
            F.col(VALID_FROM).alias("effective_from_date"),
            F.col(VALID_TO).alias("effective_to_date"),
            is_open.alias("is_current"),
            state.alias("state"),
        )
        full_refresh(stored, f"{self.out}/{name}", by="state")
        closed = [p for p in parts if p.part.endswith(f"={_CLOSED}")]
        self.now.parts += closed
        for s in (_CLOSED, _OPEN):
            if _exists(self.spark, f"{self.out}/{name}/state={s}"):
                self._listed(name, f"{self.out}/{name}/state={s}")
        return self.spark.read.schema(stored.drop("state").schema).parquet(
            *[p.part for p in self.now.parts if p.part.endswith(f"={_OPEN}")]
        )

    def courses(self, courses: DataFrame) -> DataFrame:
        """Titles by name; a name of this load brings its type and instructor."""
        name, texts = "dim_course", ["course_name", "course_type", "course_instructor"]
        order = [F.desc_nulls_first(c) for c in texts[1:]]
        new = keep_top(courses, ["course_name"], order)
        prior = self.before.table(name)
        if prior is None:
            merged = new.withColumn("course_key", F.lit(None).cast("long"))
        else:
            old = prior.select("course_key", F.struct(*texts).alias("old"))
            same = F.col("old.course_name") == F.col("new.course_name")
            pairs = old.join(new.select(F.struct(*texts).alias("new")), same, "full_outer")
            merged = pairs.select("course_key", F.coalesce("new", "old").alias("c")).select(
                "course_key", "c.*"
            )
        rows = self._new_keys(merged, name, texts)
        paid = F.coalesce(F.col("course_type") == "PAID", F.lit(False))
        stored = rows.select("course_key", *texts, paid.alias("is_revenue_generating"))
        return self._whole(name, stored)

    # -- orders --------------------------------------------------------------

    def orders(self, orders: DataFrame, current: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(all orders, customer and month of those that are new or changed)."""
        name = "fact_order"
        latest = [
            F.desc_nulls_first(c)
            for c in ("order_created_at", "customer_id", "net_usd", "line_items", "order_number")
        ]
        named = orders.where("order_id is not null")
        single = keep_top(named, ["order_id"], latest).unionByName(
            orders.where("order_id is null")
        )
        new = single.select("order_id", "order_number", "customer_id", *facts.plan_columns())
        month = month_start(F.col("order_created_at")).alias("month")
        prior = self.before.table(name)
        if prior is None:
            merged = new.withColumn("order_key", F.lit(None).cast("long"))
            settled, moved = None, [new]
        else:
            ids = new.select("order_id").where("order_id is not null")
            columns = ["order_key", *new.columns]
            replaced = prior.join(ids, "order_id", "left_semi").select(*columns)
            left = prior.join(ids, "order_id", "left_anti")
            keys = replaced.select("order_id", "order_key")
            changed = new.join(keys, "order_id", "left")
            # Orders of customers that were not known when the orders came.
            found = left.where("customer_key is null and customer_id is not null").join(
                current.select("customer_id"), "customer_id", "left_semi"
            )
            moved = [new, replaced, found]
            who = _union([df.select("customer_id") for df in moved]).distinct()
            who = self.scratch.stage(who, "customers-with-new-orders")
            same = left["customer_id"].eqNullSafe(who["customer_id"])
            settled = left.join(who, same, "left_anti")
            again = left.join(who, same, "left_semi").select(*columns)
            merged = again.unionByName(changed)
        lookup = current.select("customer_key", "customer_id")
        placed = sequence_in_group(
            self.scratch.stage(merged, "orders"),
            ["customer_id"],
            [F.asc_nulls_last("order_created_at"), F.asc_nulls_last("order_id")],
            self.scratch,
            sequence="order_sequence",
            is_last="is_latest_order",
            lookup=lookup,
        ).withColumn("is_first_order", F.col("order_sequence") == 1)
        total_order = ["order_id", "order_created_at", "customer_id", "order_number"]
        rows = self._new_keys(placed, name, total_order)
        if settled is not None:
            rows = rows.unionByName(settled)
        changed = _union([df.select("customer_id", month) for df in moved])
        return self._whole(name, rows), changed

    # -- months --------------------------------------------------------------

    def attribution(self, orders: DataFrame, months: list[dt.date]) -> DataFrame | None:
        """The touched months' revenue; other months of the facts are not read."""
        consumption = self.now.table("fact_consumption", months)
        if consumption is None:
            return None
        first, day = min(months), F.col("order_created_at")
        # The first and last day reach the scan, the list of months is exact.
        last = (max(months).replace(day=1) + dt.timedelta(32)).replace(day=1)
        dated = orders.where(
            (day >= _at(first)) & (day < _at(last)) & month_start(day).isin(months)
        )
        return facts.fact_revenue_attribution(dated, consumption, self.settings, self.scratch)

    def monthly(self, name: str, df: DataFrame | None, months: list[dt.date]) -> None:
        """Store the touched months, and list the others where they are."""
        path = f"{self.out}/{name}"
        self.now.parts += [
            p for p in self.before.parts if p.table_name == name and p.month not in months
        ]
        if df is None or not months:
            return
        if name in KEYS:
            key, high = KEYS[name], self.before.high(name)
            df = df.withColumn(key, F.col(key) + high)
        full_refresh(df.withColumn(_FOLDER, F.col(MONTHLY[name])), path, by=_FOLDER)
        for month in months:
            folder = f"{path}/{_FOLDER}={month.isoformat()}"
            if _exists(self.spark, folder):
                self._listed(name, folder, month)

    def finish(self) -> None:
        """Write the list of parts with the highest key of each table."""
        rows = []
        for name in dict.fromkeys(p.table_name for p in self.now.parts):
            high = self.before.high(name)
            own = [p.part for p in self.now.parts if p.table_name == name and _in(p.part, self.out)]
            if name in KEYS and own:
                found = self.spark.read.parquet(*own).agg(F.max(KEYS[name])).first()[0]
                high = max(high, found or 0)
            rows += [
                (name, p.month, p.part, high if name in KEYS else None)
                for p in self.now.parts
                if p.table_name == name
            ]
        listed = self.spark.createDataFrame(rows, _PART_SCHEMA).coalesce(1)
        full_refresh(listed, f"{self.out}/{PARTS}")
        self.now = open_load(self.spark, self.out)

    # -- helpers -------------------------------------------------------------

    def _new_keys(self, df: DataFrame, name: str, order: list[str]) -> DataFrame:
        """Rows without a key get the next ones in order."""
        key, high = KEYS[name], self.before.high(name)
        rows = self.scratch.stage(df, f"{name}-rows")
        lacking = rows.where(F.col(key).isNull()).drop(key)
        numbered = number_rows(lacking, order, self.scratch, key)
        numbered = numbered.withColumn(key, F.col(key) + high)
        return rows.where(F.col(key).isNotNull()).unionByName(numbered)

    def _whole(self, name: str, df: DataFrame) -> DataFrame:
        full_refresh(df, f"{self.out}/{name}")
        self._listed(name, f"{self.out}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.out}/{name}")

    def _listed(self, name: str, part: str, month: dt.date | None = None) -> None:
        self.now.parts.append(Row(table_name=name, month=month, part=part, high=None))


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for df in frames[1:]:
        whole = whole.unionByName(df)
    return whole


def _months(df: DataFrame, column: str) -> list[dt.date]:
    rows = df.where(F.col(column).isNotNull()).select(column).distinct().collect()
    return sorted(row[0] for row in rows)


def _at(day: dt.date):
    return F.lit(day.isoformat()).cast("timestamp_ntz")


def _in(part: str, folder: str) -> bool:
    return part.startswith(f"{folder}/")


def _exists(spark: SparkSession, name: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
