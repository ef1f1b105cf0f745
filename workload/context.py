"""The models over one source folder, built once per session."""

from __future__ import annotations

import atexit
import datetime as dt
from functools import cached_property

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchledger.plans import dimensions, facts, incremental, staging, views
from watchledger.plans.build import Raw
from watchledger.plans.quality import NOT_NULL_COLUMNS
from watchledger.scratch import Scratch
from watchledger.settings import Settings
from watchledger.sources.commerce import AS_OF, FIRST_LOAD, SECOND_LOAD, Commerce

#: From when on the second load sends orders, and whole months, once more.
ORDERS_AGAIN, MONTHS_AGAIN = dt.date(1998, 11, 15), dt.date(1998, 12, 1)

_contexts: dict[tuple[str, str], "Context"] = {}


class Context:
    """Staging stays lazy; history, dimensions and facts are stored tables."""

    def __init__(
        self, spark: SparkSession, folder: str, settings: Settings = Settings(as_of=AS_OF)
    ):
        self.spark, self.folder, self.settings = spark, folder, settings
        self.raw = Commerce(spark, folder)
        self.scratch = Scratch(spark, free=True)

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        return self.scratch.stage(df, name)

    @cached_property
    def raw_tables(self) -> Raw:
        return Raw(
            customers=self.raw.customers(),
            orders=self.raw.orders(),
            courses=self.raw.courses(),
            consumption=self.raw.consumption(),
            month=F.col("month"),
        )

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw.customers())

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw.orders())

    @cached_property
    def stg_courses(self) -> DataFrame:
        return staging.stg_courses(self.raw.courses())

    @cached_property
    def stg_consumption(self) -> DataFrame:
        return staging.stg_consumption(self.raw.consumption(), F.col("month"))

    @cached_property
    def first_snapshot(self) -> DataFrame:
        early = staging.stg_customers(self.raw.customers(before=FIRST_LOAD))
        first = dimensions.snap_customer(early, None, FIRST_LOAD)
        return self.stored(first, "first_snapshot")

    @cached_property
    def snap_customer(self) -> DataFrame:
        second = dimensions.snap_customer(
            self.stg_customers, self.first_snapshot, SECOND_LOAD
        )
        return self.stored(second, "snap_customer")

    @cached_property
    def dim_course(self) -> DataFrame:
        with self.scratch.within("dim_course-steps") as steps:
            return self.stored(dimensions.dim_course(self.stg_courses, steps), "dim_course")

    @cached_property
    def dim_customer(self) -> DataFrame:
        with self.scratch.within("dim_customer-steps") as steps:
            return self.stored(dimensions.dim_customer(self.snap_customer, steps), "dim_customer")

    @cached_property
    def fact_order(self) -> DataFrame:
        with self.scratch.within("fact_order-steps") as steps:
            built = facts.fact_order(self.stg_orders, self.dim_customer, self.settings, steps)
            return self.stored(built, "fact_order")

    @cached_property
    def fact_consumption(self) -> DataFrame:
        with self.scratch.within("fact_consumption-steps") as steps:
            built = facts.fact_consumption(
                self.stg_consumption, self.dim_customer, self.dim_course, self.settings, steps
            )
            return self.stored(built, "fact_consumption")

    @cached_property
    def fact_revenue_attribution(self) -> DataFrame:
        with self.scratch.within("fact_revenue_attribution-steps") as steps:
            built = facts.fact_revenue_attribution(
                self.fact_order, self.fact_consumption, self.settings, steps
            )
            return self.stored(built, "fact_revenue_attribution")

    @cached_property
    def faulty_attribution(self) -> DataFrame:
        """The attribution fact with faults in rows that their keys single out."""
        fact, key = self.fact_revenue_attribution, F.col("revenue_key")
        free = self.dim_course.where("course_type = 'FREE'")
        first = free.agg(F.min("course_key")).first()[0]
        columns = {
            "course_key": F.when(key % 11 == 0, F.lit(first)),
            "attribution_percentage": F.when(
                key % 5 == 0, F.col("attribution_percentage") + F.lit("0.5").cast("decimal(2,1)")
            ),
            "attributed_revenue": F.when(key % 7 == 0, -F.col("attributed_revenue")),
            "instructor_royalty": F.when(key % 3 == 0, F.col("instructor_royalty") + 1),
        }
        changed = [
            columns[c].otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in fact.columns
        ]
        return self.stored(fact.select(*changed), "faulty_attribution")

    @cached_property
    def course_months(self) -> DataFrame:
        with self.scratch.within("course_months-steps") as steps:
            built = views.course_months(
                self.fact_revenue_attribution, self.dim_course, self.settings, steps
            )
            return self.stored(built, "course_months")

    def view_course_revenue_monthly(self) -> DataFrame:
        return views.view_course_revenue_monthly(self.course_months)

    @cached_property
    def increments(self) -> list[incremental.Load]:
        """Two loads into one warehouse; the second brings some months again."""
        out = self.scratch.folder("increments")
        early = Raw(
            customers=self.raw.customers(before=FIRST_LOAD),
            orders=self.raw.orders(before=FIRST_LOAD.date()),
            courses=self.raw.courses(),
            consumption=self.raw.consumption(before=FIRST_LOAD.date()),
            month=F.col("month"),
        )
        late = Raw(
            customers=self.raw.customers(),
            orders=self.raw.orders(since=ORDERS_AGAIN),
            courses=self.raw.courses(),
            consumption=self.raw.consumption(since=MONTHS_AGAIN),
            month=F.col("month"),
        )
        return [
            incremental.add_load(self.spark, raw, out, when, self.settings)
            for raw, when in ((early, FIRST_LOAD), (late, SECOND_LOAD))
        ]

    def model_tables(self) -> dict[str, DataFrame]:
        """What the tests of a build look at."""
        return {name: self.tables[name] for name in NOT_NULL_COLUMNS}

    @property
    def tables(self) -> "Tables":
        return Tables(self)


class Tables:
    """Look tables up by name, building only those asked for."""

    def __init__(self, context: Context):
        self._context = context

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self._context, name)


def context(spark: SparkSession, folder: str) -> Context:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _contexts:
        _contexts[key] = Context(spark, folder)
    return _contexts[key]


@atexit.register
def drop_scratch() -> None:
    """Take the stored tables of this process's sessions away at its end."""
    active = SparkContext._active_spark_context
    for (app, _), c in _contexts.items():
        if active is not None and active.applicationId == app:
            c.scratch.drop()
    _contexts.clear()


def comparable(df: DataFrame) -> DataFrame:
    """Types that both engines render alike: long, double and text for dates."""
    return df.select(*[_plain(field) for field in df.schema.fields])


def _plain(field: T.StructField):
    column = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, T.DecimalType):
        column = column.cast("double")
    elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
        column = column.cast("long")
    elif isinstance(kind, T.DateType):
        column = F.date_format(column, "yyyy-MM-dd")
    elif isinstance(kind, T.TimestampNTZType):
        column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    return column.alias(field.name)
