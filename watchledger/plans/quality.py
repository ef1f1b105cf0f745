"""The data checks of the built tables.

Row checks return offending rows. The count checks give one row per check with
a number, a verdict and a text; ``summary`` adds those up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchledger.functions import parse_mixed_timestamp
from watchledger.operators import checks
from watchledger.scratch import Scratch
from watchledger.settings import Settings

# Tolerances, texts of the results, and the list of column tests.
SHARE_TOLERANCE = "0.01"
TIE_OUT_TOLERANCE = "0.05"
ROYALTY_TOLERANCE = "0.01"

NULLS_TEXT = "null values found"
DUPLICATES_TEXT = "duplicate values found"
SHARES_TEXT = "customer-months with incorrect attribution sum"
TIE_OUT_TEXT = "customer-months with revenue mismatch"

UNIQUE_COLUMNS = (
    ("stg_customers", "customer_id"),
    ("stg_orders", "order_id"),
    ("stg_courses", "course_name"),
    ("dim_course", "course_key"),
    ("dim_course", "course_name"),
    ("dim_customer", "customer_key"),
    ("dim_customer", "customer_id"),
    ("fact_order", "order_key"),
    ("fact_order", "order_id"),
    ("fact_consumption", "consumption_key"),
    ("fact_revenue_attribution", "revenue_key"),
)
NOT_NULL_COLUMNS = {
    "stg_customers": ("customer_id",),
    "stg_orders": ("order_id", "net_usd"),
    "stg_courses": ("course_name", "course_type"),
    "stg_consumption": ("user_id", "course_name", "minutes_consumed"),
    "dim_course": ("course_key", "course_name", "is_revenue_generating"),
    "dim_customer": ("customer_key", "customer_id", "is_current"),
    "fact_order": ("order_key", "order_id", "net_amount_usd"),
    "fact_consumption": (
        "consumption_key",
        "customer_key",
        "course_key",
        "total_minutes_consumed",
    ),
    "fact_revenue_attribution": (
        "revenue_key",
        "customer_key",
        "course_key",
        "attribution_percentage",
        "attributed_revenue",
    ),
}
ACCEPTED_VALUES = (
    ("stg_courses", "course_type", ("PAID", "FREE")),
    ("dim_course", "course_type", ("PAID", "FREE")),
    ("fact_revenue_attribution", "is_free_course", (False,)),
)
RELATIONSHIPS = (
    ("fact_order", "customer_key", "dim_customer"),
    ("fact_consumption", "customer_key", "dim_customer"),
    ("fact_consumption", "course_key", "dim_course"),
    ("fact_revenue_attribution", "customer_key", "dim_customer"),
    ("fact_revenue_attribution", "course_key", "dim_course"),
)

Tables = Mapping[str, DataFrame]


# -- column tests over all tables ------------------------------------------


def all_unique(tables: Tables, columns=UNIQUE_COLUMNS) -> DataFrame:
    """Repeated values of every tested column, one scan per table."""
    return union_all(repeated_values(tables, columns))


def repeated_values(tables: Tables, columns=UNIQUE_COLUMNS) -> list[DataFrame]:
    """The same, table by table."""
    by_model: dict[str, list[str]] = {}
    for model, column in columns:
        by_model.setdefault(model, []).append(column)
    found = []
    for model, names in by_model.items():
        texts = [F.col(n).cast("string").alias(n) for n in names]
        values = tables[model].select(*texts).unpivot([], names, "column_name", "unique_field")
        repeated = (
            values.where("unique_field is not null")
            .groupBy("column_name", "unique_field")
            .agg(F.count(F.lit(1)).alias("n_records"))
            .where("n_records > 1")
        )
        found.append(repeated.select(F.lit(model).alias("model_name"), "*"))
    return found


def all_null_counts(tables: Tables, columns=NOT_NULL_COLUMNS) -> DataFrame:
    """Null counts of every tested column, one pass per table."""
    found = [
        checks.null_counts(tables[model], names).select(
            F.lit(model).alias("model_name"), "column_name", "null_count"
        )
        for model, names in columns.items()
    ]
    return union_all(found)


def all_accepted(tables: Tables, columns=ACCEPTED_VALUES) -> DataFrame:
    found = [
        checks.accepted_values(tables[model], column, values).select(
            F.lit(model).alias("model_name"),
            F.lit(column).alias("column_name"),
            F.col("value_field").cast("string").alias("value_field"),
            "n_records",
        )
        for model, column, values in columns
    ]
    return union_all(found)


def all_orphans(tables: Tables, columns=RELATIONSHIPS) -> DataFrame:
    """Keys without a parent. A null key is no orphan."""
    found = [
        checks.orphans(tables[child], key, tables[parent], key).select(
            F.lit(child).alias("model_name"),
            F.lit(key).alias("column_name"),
            "from_field",
            "n_records",
        )
        for child, key, parent in columns
    ]
    return union_all(found)


# -- dates -------------------------------------------------------------------

# The raw columns that hold dates.
DATE_COLUMNS = {
    "customers": ("First Paid Order Date", "First Order Date"),
    "orders": ("Order Created At",),
}


def unparsed_dates(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Per raw date column, the texts with a date's separator that are no date.

    Parsing turns them into null, so nothing else tells them from a blank.
    """
    found = []
    for table, names in DATE_COLUMNS.items():
        counts = []
        for name in names:
            text = F.col(f"`{name}`")
            lost = text.rlike("[/-]") & parse_mixed_timestamp(text).isNull()
            counts.append(
                F.struct(F.lit(name).alias("column_name"), F.count_if(lost).alias("unparsed"))
            )
        counted = raw[table].agg(F.array(*counts).alias("counts"))
        rows = counted.select(F.explode("counts").alias("c")).select("c.*")
        found.append(rows.select(F.lit(table).alias("table_name"), "*"))
    return union_all(found)


# -- revenue checks --------------------------------------------------------


def _customer_months(attribution: DataFrame) -> DataFrame:
    return attribution.groupBy("customer_key", "revenue_month").agg(
        F.sum("attribution_percentage").alias("pct_sum"),
        F.sum("attributed_revenue").alias("revenue_sum"),
        F.max("subscription_monthly_value").alias("monthly_value"),
        F.count(F.lit(1)).alias("row_count"),
    )


def _off(left: Column, right: Column, tolerance: str) -> Column:
    return F.abs(left - right) > F.lit(tolerance).cast("decimal(6,4)")


def attribution_sums(attribution: DataFrame) -> DataFrame:
    """Customer-months whose shares do not add up to 1."""
    one = F.lit(1).cast("decimal(6,4)")
    months = _customer_months(attribution)
    bad = months.where(_off(F.col("pct_sum"), one, SHARE_TOLERANCE))
    return bad.withColumn("pct_sum", F.round("pct_sum", 4))


def revenue_ties_out(attribution: DataFrame) -> DataFrame:
    """Customer-months whose revenue does not add up to the monthly value."""
    revenue, value = F.col("revenue_sum"), F.col("monthly_value")
    bad = _customer_months(attribution).where(_off(revenue, value, TIE_OUT_TOLERANCE))
    return bad.select(
        "customer_key",
        "revenue_month",
        F.round(revenue, 2).alias("attributed_sum"),
        F.round(value, 2).alias("monthly_value"),
    )


def free_courses_in_revenue(attribution: DataFrame, courses: DataFrame) -> DataFrame:
    free = courses.where(F.col("course_type") == "FREE")
    titles = free.select("course_key", "course_name", "course_type")
    return attribution.select("revenue_key", "course_key").join(titles, "course_key")


def negative_revenue(attribution: DataFrame) -> DataFrame:
    bad = attribution.where(F.col("attributed_revenue") < 0)
    return bad.select("revenue_key", "attributed_revenue")


def royalty_rate(
    attribution: DataFrame, rate: Decimal = Settings.royalty_rate
) -> DataFrame:
    """Rows whose royalty is not the agreed part of the rounded revenue."""
    expected = F.round(F.col("attributed_revenue") * F.lit(rate), 2)
    rows = attribution.select(
        "revenue_key",
        "attributed_revenue",
        "instructor_royalty",
        expected.alias("expected_royalty"),
    )
    royalty = F.col("instructor_royalty")
    return rows.where(_off(royalty, F.col("expected_royalty"), ROYALTY_TOLERANCE))


# -- counted checks --------------------------------------------------------


def count_nulls(name: str, df: DataFrame, column: str) -> DataFrame:
    counted = df.agg(F.count_if(F.col(column).isNull()).alias("n"))
    return _verdict(counted, name, f"not_null_{column}", NULLS_TEXT)


def count_duplicates(name: str, df: DataFrame, column: str) -> DataFrame:
    """Number of values that occur more than once; here null is a value."""
    sizes = df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    counted = sizes.agg(F.count_if(F.col("rows") > 1).alias("n"))
    return _verdict(counted, name, f"unique_{column}", DUPLICATES_TEXT)


def count_bad_attribution(attribution: DataFrame) -> DataFrame:
    return _verdict(
        attribution_sums(attribution).agg(F.count(F.lit(1)).alias("n")),
        "fact_revenue_attribution",
        "attribution_sums_to_one",
        SHARES_TEXT,
    )


def count_bad_tieout(attribution: DataFrame) -> DataFrame:
    return _verdict(
        revenue_ties_out(attribution).agg(F.count(F.lit(1)).alias("n")),
        "fact_revenue_attribution",
        "revenue_ties_out",
        TIE_OUT_TEXT,
    )


def _bad_months(attribution: DataFrame) -> DataFrame:
    """One row: rows without revenue, and customer-months off in shares or revenue."""
    one = F.lit(1).cast("decimal(6,4)")
    months = attribution.groupBy("customer_key", "revenue_month").agg(
        F.sum("attribution_percentage").alias("pct_sum"),
        F.sum("attributed_revenue").alias("revenue_sum"),
        F.max("subscription_monthly_value").alias("monthly_value"),
        F.count_if(F.col("attributed_revenue").isNull()).alias("without"),
    )
    revenue, value = F.col("revenue_sum"), F.col("monthly_value")
    return months.agg(
        F.coalesce(F.sum("without"), F.lit(0)).alias("without"),
        F.count_if(_off(F.col("pct_sum"), one, SHARE_TOLERANCE)).alias("shares"),
        F.count_if(_off(revenue, value, TIE_OUT_TOLERANCE)).alias("tie_outs"),
    )


def revenue_checks(attribution: DataFrame) -> DataFrame:
    """The four standing checks on the attribution fact, from two scans of it.

    Null counts come with the customer-months; repeated keys need a scan of
    their own.
    """
    name = "fact_revenue_attribution"
    counted = _bad_months(attribution)
    checks_ = F.array(
        *[
            F.struct(F.lit(check).alias("check"), F.col(n).alias("n"), F.lit(text).alias("text"))
            for check, n, text in (
                ("not_null_attributed_revenue", "without", NULLS_TEXT),
                ("attribution_sums_to_one", "shares", SHARES_TEXT),
                ("revenue_ties_out", "tie_outs", TIE_OUT_TEXT),
            )
        ]
    )
    rows = counted.select(F.explode(checks_).alias("c")).select("c.*")
    by_month = rows.select(
        F.lit(name).alias("table_name"),
        F.col("check").alias("check_name"),
        (F.col("n") == 0).alias("passed"),
        F.concat_ws(" ", F.col("n").cast("string"), "text").alias("details"),
    )
    return by_month.unionByName(count_duplicates(name, attribution, "revenue_key"))


# -- the test stage of a build -----------------------------------------------


def build_tests(tables: Tables, scratch: Scratch | None = None) -> DataFrame:
    """One row per test of the built tables: kind, model, column, failures, passed.

    Counts of one table share a pass: nulls, values outside their lists, and
    the row conditions of the attribution fact. Both conditions on
    customer-months share another one. With ``scratch`` the tests run one after
    another: neither a plan nor the disk has to hold all of them and their shuffles.
    """
    fact = tables["fact_revenue_attribution"]
    expected = F.round(F.col("attributed_revenue") * F.lit(Settings.royalty_rate), 2)
    row_tests = {
        "fact_revenue_attribution": {
            ("singular", "non_negative_revenue"): F.col("attributed_revenue") < 0,
            ("singular", "royalty_rate"): _off(
                F.col("instructor_royalty"), expected, ROYALTY_TOLERANCE
            ),
        }
    }

    def staged(counts: DataFrame) -> DataFrame:
        return counts if scratch is None else scratch.stage(counts, "tests")

    found = []
    for model, names in NOT_NULL_COLUMNS.items():
        tests = {("not_null", name): F.col(name).isNull() for name in names}
        tests |= {
            ("accepted_values", column): ~F.col(column).isin(*values)
            for table, column, values in ACCEPTED_VALUES
            if table == model
        }
        found.append(_counted(tables[model], model, tests | row_tests.get(model, {})))
    repeated = union_all(
        [
            staged(values.groupBy("model_name", "column_name").count())
            for values in repeated_values(tables)
        ]
    )
    every = fact.sparkSession.createDataFrame(
        list(UNIQUE_COLUMNS), "model string, column string"
    )
    same = (F.col("model") == F.col("model_name")) & (F.col("column") == F.col("column_name"))
    found.append(
        every.join(repeated, same, "left").select(
            F.lit("unique").alias("kind"),
            "model",
            "column",
            F.coalesce("count", F.lit(0)).alias("failures"),
        )
    )
    for child, key, parent in RELATIONSHIPS:
        lost = checks.orphans(tables[child], key, tables[parent], key)
        found.append(_one("relationships", child, key, lost.agg(F.sum("n_records").alias("n"))))
    bad = _bad_months(fact)
    model = "fact_revenue_attribution"
    months = F.expr(
        "stack(2, 'attribution_sums_to_one', shares, 'revenue_ties_out', tie_outs)"
    ).alias("column", "n")
    found.append(
        bad.select(months).select(
            F.lit("singular").alias("kind"), F.lit(model).alias("model"), "column",
            F.col("n").alias("failures"),
        )
    )
    free = free_courses_in_revenue(fact, tables["dim_course"]).agg(F.count(F.lit(1)).alias("n"))
    found.append(_one("singular", model, "no_free_courses", free))
    return union_all([staged(f) for f in found]).withColumn("passed", F.col("failures") == 0)


def _counted(df: DataFrame, model: str, tests: Mapping[tuple[str, str], Column]) -> DataFrame:
    """How many rows meet each condition, from one pass."""
    names = [f"n{i}" for i in range(len(tests))]
    counts = df.agg(*[F.count_if(test).alias(n) for n, test in zip(names, tests.values())])
    rows = F.array(
        *[
            F.struct(
                F.lit(kind).alias("kind"),
                F.lit(model).alias("model"),
                F.lit(column).alias("column"),
                F.col(n).alias("failures"),
            )
            for n, (kind, column) in zip(names, tests)
        ]
    )
    return counts.select(F.explode(rows).alias("t")).select("t.*")


def _one(kind: str, model: str, column: str, counted: DataFrame) -> DataFrame:
    return counted.select(
        F.lit(kind).alias("kind"),
        F.lit(model).alias("model"),
        F.lit(column).alias("column"),
        F.coalesce("n", F.lit(0)).cast("long").alias("failures"),
    )


def summary(results: DataFrame) -> DataFrame:
    """Totals and pass rate over check results, with the details as a list."""
    total, passed = F.count(F.lit(1)), F.count_if(F.col("passed"))
    rate = F.when(total > 0, F.round(passed * 100 / total, 1)).otherwise(0.0)
    listed = F.array_sort(
        F.collect_list(F.struct("table_name", "check_name", "passed", "details"))
    )
    return results.agg(
        total.alias("total_checks"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        rate.alias("pass_rate"),
        listed.alias("results"),
    )


def _verdict(counted: DataFrame, table: str, check: str, text: str) -> DataFrame:
    return counted.select(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        (F.col("n") == 0).alias("passed"),
        F.concat_ws(" ", F.col("n").cast("string"), F.lit(text)).alias("details"),
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
