"""Build every table and view in order.

Order: raw, staging, customer history, dimensions, facts, views, checks. The
history is part of the build because the customer dimension reads it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from watchledger.plans import dimensions, facts, quality, staging, views
from watchledger.plans.history import SNAPSHOT, add_versions
from watchledger.plans.ledger import LOAD_TESTS, Figures, load_tests, read_ledger, store_figures
from watchledger.scratch import Scratch, freed_shuffles
from watchledger.settings import Settings
from watchledger.sources.seeds import SEED_COLUMNS, read_csv_seed
from watchledger.sources.tables import (
    materialize_table,
    materialize_view,
    with_audit_times,
)

#: The history of the last complete load.
PREVIOUS = "previous"
#: The table with the results of the tests; it is written last.
TESTS = "build_tests"


@dataclass(frozen=True)
class Raw:
    """Raw text tables. ``month`` is a date, or a column of ``consumption``."""

    customers: DataFrame
    orders: DataFrame
    courses: DataFrame
    consumption: DataFrame
    month: dt.date | Column


@dataclass
class Built:
    """What a build produced, by name."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    views: dict[str, DataFrame] = field(default_factory=dict)
    checks: DataFrame | None = None
    tests: DataFrame | None = None
    ledger: DataFrame | None = None
    load_tests: DataFrame | None = None
    unparsed_dates: DataFrame | None = None
    folder: str = ""

    def row_counts(self) -> DataFrame:
        """One row per table and view with its number of rows."""
        counted = [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in {**self.tables, **self.views}.items()
        ]
        return quality.union_all(counted)


def read_seeds(
    spark: SparkSession,
    folder: str,
    settings: Settings = Settings(),
    names: Mapping[str, str] | None = None,
) -> Raw:
    """The four CSV files of a folder; ``names`` maps tables to other file names."""
    files = {table: table for table in SEED_COLUMNS} | dict(names or {})
    frames = {
        table: read_csv_seed(spark, f"{folder}/{files[table]}.csv", columns)
        for table, columns in SEED_COLUMNS.items()
    }
    return Raw(**frames, month=settings.consumption_month)


class BuildFailed(RuntimeError):
    """Tests failed in a build that was told to stop then."""


def loads(spark: SparkSession, warehouse: str, last: str = TESTS) -> list[str]:
    """Folders of the complete loads of a warehouse, oldest first.

    A load is complete once its last table, the results of its tests, is
    committed. A build that fails leaves no such file, so readers stay with the
    load before.
    """
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{warehouse}/load-*/{last}/_SUCCESS")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = done.getFileSystem(conf).globStatus(done) or []
    return sorted(status.getPath().getParent().getParent().toString() for status in found)


def refuse_out_of_order(name: str, complete: list[str]) -> None:
    """Fail if a load by this name would not come after all complete ones."""
    names = [folder.rsplit("/", 1)[1] for folder in complete]
    if name in names:
        raise FileExistsError(f"{name} is a complete load; give another load time")
    if names and name < names[-1]:
        raise ValueError(f"{names[-1]} is complete, and {name} comes before it")


def load_folder(warehouse: str, load_time: dt.datetime) -> str:
    return f"{warehouse.rstrip('/')}/load-{load_time:%Y%m%dT%H%M%S}"


def build_warehouse(
    spark: SparkSession,
    raw: Raw,
    warehouse: str,
    load_time: dt.datetime,
    settings: Settings = Settings(),
    history: DataFrame | str | None = PREVIOUS,
    as_views: bool = False,
    stop_on_failure: bool = False,
) -> Built:
    """Build one load in a folder of its own under ``warehouse``, and test it.

    ``history`` is the customer history to go on from: that of the last
    complete load by default, or a table from elsewhere, or None to start anew.
    Earlier loads are only read, and of the history only versions still open. A
    load that is complete is never written again. Loads come in order: a load time
    at or before that of a complete load is refused before anything is written.

    Each table's figures are compared with those of the loads before, and its latest
    event with the load time where the settings have limits (``load_tests``).

    With ``stop_on_failure`` a failed test raises ``BuildFailed`` and the load
    stays incomplete; otherwise the results are for the caller to look at.
    """
    out = load_folder(warehouse, load_time)
    name, complete = out.rsplit("/", 1)[1], loads(spark, warehouse)
    refuse_out_of_order(name, complete)
    if isinstance(history, str):
        history = complete[-1] if complete else None
    elif history is not None:
        if any(f"/{name}/" in file for file in history.inputFiles()):
            raise ValueError(f"the history lies in {out}, which this build replaces")
    built, figures = Built(folder=out), Figures()
    with Scratch(spark, free=True) as scratch:

        def store(
            name: str, df: DataFrame, audit: bool = True, by: str | None = None
        ) -> DataFrame:
            df = figures.watch(name, with_audit_times(df) if audit else df)
            with freed_shuffles(spark):
                built.tables[name] = materialize_table(df, f"{out}/{name}", by)
            return built.tables[name]

        lazy = {
            "stg_customers": staging.stg_customers(raw.customers),
            "stg_orders": staging.stg_orders(raw.orders),
            "stg_courses": staging.stg_courses(raw.courses),
            "stg_consumption": staging.stg_consumption(raw.consumption, raw.month),
        }
        # Raw text is read once here; facts and tests read what was stored.
        staged = dict(zip(lazy, _side_by_side(
            spark, *[partial(scratch.stage, df, name) for name, df in lazy.items()]
        )))
        customers, orders, courses, consumption = staged.values()

        def customer_dimension() -> DataFrame:
            snapshot = add_versions(spark, customers, out, load_time, history)
            built.tables[SNAPSHOT] = snapshot
            with scratch.within("dim_customer-steps") as steps:
                return store("dim_customer", dimensions.dim_customer(snapshot, steps))

        def course_dimension() -> DataFrame:
            with scratch.within("dim_course-steps") as steps:
                return store("dim_course", dimensions.dim_course(courses, steps))

        dim_customer, dim_course = _side_by_side(
            spark, customer_dimension, course_dimension
        )

        def orders_fact() -> DataFrame:
            with scratch.within("fact_order-steps") as steps:
                fact = facts.fact_order(orders, dim_customer, settings, steps)
                return store("fact_order", fact)

        def consumption_fact() -> DataFrame:
            with scratch.within("fact_consumption-steps") as steps:
                fact = facts.fact_consumption(
                    consumption, dim_customer, dim_course, settings, steps
                )
                return store("fact_consumption", fact, by="consumption_month")

        # One after the other: together they hold the most shuffle files of the build.
        fact_consumption = consumption_fact()
        fact_order = orders_fact()
        with scratch.within("attribution-steps") as steps:
            attribution = store(
                "fact_revenue_attribution",
                facts.fact_revenue_attribution(
                    fact_order, fact_consumption, settings, steps
                ),
                by="revenue_month",
            )
        with scratch.within("course_months-steps") as steps:
            months = store(
                "course_months",
                views.course_months(attribution, dim_course, settings, steps),
                audit=False,
            )
        built.views = {
            **lazy,
            **analytics_views(
                attribution,
                fact_order,
                fact_consumption,
                dim_course,
                dim_customer,
                months,
                settings,
            ),
        }
        tested = {**built.tables, **built.views, **staged}
        results = quality.build_tests(tested, scratch).coalesce(1)
        built.ledger = store_figures(figures, spark, out)
        odd = load_tests(
            built.ledger, read_ledger(spark, complete), load_time,
            settings.warn_after, settings.error_after,
        )
        built.load_tests = materialize_table(odd.coalesce(1), f"{out}/{LOAD_TESTS}")
        if stop_on_failure:
            results = results.cache()
            errors = built.load_tests.where("column != 'warn'")
            failing = results.unionByName(errors).where("not passed").collect()
            failed = [f"{r.kind} {r.model}.{r.column}" for r in failing]
            if failed:
                results.unpersist()
                raise BuildFailed("; ".join(sorted(failed)))
        built.tests = materialize_table(results, f"{out}/{TESTS}")
    built.checks = quality.revenue_checks(attribution)
    built.unparsed_dates = quality.unparsed_dates(
        {"customers": raw.customers, "orders": raw.orders}
    )
    if as_views:
        for name, df in {**built.tables, **built.views}.items():
            materialize_view(df, name)
    return built


def _side_by_side(
    spark: SparkSession, *jobs: Callable[[], DataFrame]
) -> list[DataFrame]:
    """Submit independent tables together, so that none waits for idle executors."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [job.result() for job in started]


def analytics_views(
    attribution: DataFrame,
    orders: DataFrame,
    consumption: DataFrame,
    courses: DataFrame,
    customers: DataFrame,
    months: DataFrame,
    settings: Settings,
) -> dict[str, DataFrame]:
    """The five views over stored tables."""
    return {
        "view_monthly_mrr_arr": views.view_monthly_mrr_arr(attribution),
        "view_course_revenue_monthly": views.view_course_revenue_monthly(months),
        "view_instructor_royalties_monthly": views.view_instructor_royalties_monthly(
            attribution, courses
        ),
        "view_customer_subscription_status": views.view_customer_subscription_status(
            customers, orders, settings
        ),
        "view_consumption_trends": views.view_consumption_trends(consumption, courses),
    }
