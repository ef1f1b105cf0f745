"""Queries for the models, reports and data checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from watchledger.operators import checks, not_null
from watchledger.plans import build, dimensions, quality, reports, views
from watchledger.sources.commerce import SECOND_LOAD
from workload.oracle_models import columns, pick, show, sql
from workload.registry import query

_OFF_SHARE = "abs(pct_sum - 1) > 0.01"
_OFF_TIE = "abs(revenue_sum - monthly_value) > 0.05"

# -- models ----------------------------------------------------------------

for _name in (
    "stg_customers",
    "stg_orders",
    "stg_courses",
    "stg_consumption",
    "dim_course",
    "dim_customer",
    "fact_order",
    "fact_consumption",
    "fact_revenue_attribution",
):
    query(_name, show(_name))(lambda c, name=_name: c.tables[name])


@query("scd2_snapshot", show("snap_customer"))
def scd2_snapshot(c):
    return dimensions.snap_customer(c.stg_customers, c.first_snapshot, SECOND_LOAD)


@query("dim_customer_scd1", show("dim_customer_scd1"))
def dim_customer_scd1(c):
    return dimensions.dim_customer_scd1(c.stg_customers, c.scratch)


@query("view_monthly_mrr_arr", show("view_monthly_mrr_arr"))
def view_monthly_mrr_arr(c):
    return views.view_monthly_mrr_arr(c.fact_revenue_attribution)


@query("view_course_revenue_monthly", show("view_course_revenue_monthly"))
def view_course_revenue_monthly(c):
    return c.view_course_revenue_monthly()


@query("view_instructor_royalties_monthly", show("view_instructor_royalties_monthly"))
def view_instructor_royalties_monthly(c):
    return views.view_instructor_royalties_monthly(
        c.fact_revenue_attribution, c.dim_course
    )


@query("view_customer_subscription_status", show("view_customer_subscription_status"))
def view_customer_subscription_status(c):
    return views.view_customer_subscription_status(
        c.dim_customer, c.fact_order, c.settings
    )


@query("view_consumption_trends", show("view_consumption_trends"))
def view_consumption_trends(c):
    return views.view_consumption_trends(c.fact_consumption, c.dim_course)


_BUILT = (
    "snap_customer",
    "dim_course",
    "dim_customer",
    "fact_order",
    "fact_consumption",
    "fact_revenue_attribution",
    "stg_customers",
    "stg_orders",
    "stg_courses",
    "stg_consumption",
    "view_monthly_mrr_arr",
    "view_course_revenue_monthly",
    "view_instructor_royalties_monthly",
    "view_customer_subscription_status",
    "view_consumption_trends",
)


def _built(c):
    """One build for the queries on it, after a first load for a history."""
    if not hasattr(c, "built"):
        c.built = build.build_warehouse(
            c.spark,
            c.raw_tables,
            c.scratch.folder("warehouse"),
            SECOND_LOAD,
            c.settings,
            history=c.first_snapshot,
        )
    return c.built


# Per table its rows, and the sums of keys and amounts that show their values.
_SUMS = {
    "snap_customer": "customer_id total_spent",
    "dim_course": "course_key",
    "dim_customer": "customer_key customer_id total_spent",
    "fact_order": "order_key order_id customer_key monthly_value order_sequence",
    "fact_consumption": "consumption_key customer_key course_key total_minutes_consumed",
    "fact_revenue_attribution": "revenue_key customer_key course_key order_key"
    " attributed_revenue instructor_royalty",
    "view_monthly_mrr_arr": "mrr new_mrr total_customers",
    "view_course_revenue_monthly": "total_revenue revenue_rank popularity_rank",
    "view_instructor_royalties_monthly": "royalty_amount courses_count unique_students",
    "view_customer_subscription_status": "customer_id mrr",
    "view_consumption_trends": "total_minutes unique_users",
}


def _sums_sql(name: str) -> str:
    added = " + ".join(
        f"coalesce(cast(sum(cast({column} as decimal(38,2))) as decimal(38,2)), 0)"
        for column in _SUMS.get(name, "").split()
    )
    return (
        f"select '{name}' as table_name, count(*) as row_count,"
        f" cast({added or '0'} as double) as checksum from {name}"
    )


@query("build_pipeline", sql(" union all ".join(map(_sums_sql, _BUILT))))
def build_pipeline(c):
    built = _built(c)
    found = []
    for name, df in {**built.tables, **built.views}.items():
        if name not in _BUILT:
            continue
        sums = [
            F.coalesce(F.sum(F.col(column).cast("decimal(28,2)")), F.lit(0))
            for column in _SUMS.get(name, "").split()
        ]
        total = sum(sums[1:], sums[0]) if sums else F.lit(0)
        counted = df.agg(
            F.count(F.lit(1)).alias("row_count"), total.cast("double").alias("checksum")
        ).select(F.lit(name).alias("table_name"), "row_count", "checksum")
        # One after another: neither a plan nor the disk has to hold all tables' shuffles.
        found.append(c.stored(counted, f"sums-{name}"))
    return quality.union_all(found)


def _test_sql(kind: str, model: str, column: str, failures: str) -> str:
    return (
        f"select '{kind}' as kind, '{model}' as model, '{column}' as \"column\","
        f" cast(n as bigint) as failures, n = 0 as passed from ({failures})"
    )


def _tests_sql() -> str:
    count, fact = "select count(*) as n from", "fact_revenue_attribution"
    parts = [
        _test_sql("not_null", m, c, f"{count} {m} where {c} is null")
        for m, names in quality.NOT_NULL_COLUMNS.items()
        for c in names
    ]
    for m, c in quality.UNIQUE_COLUMNS:
        repeated = f"select {c} from {m} where {c} is not null group by {c} having count(*) > 1"
        parts.append(_test_sql("unique", m, c, f"{count} ({repeated})"))
    for m, c, values in quality.ACCEPTED_VALUES:
        listed = ", ".join("false" if v is False else f"'{v}'" for v in values)
        parts.append(_test_sql("accepted_values", m, c, f"{count} {m} where {c} not in ({listed})"))
    for m, c, parent in quality.RELATIONSHIPS:
        lost = f"{count} {m} where {c} not in (select {c} from {parent})"
        parts.append(_test_sql("relationships", m, c, lost))
    singular = {
        "attribution_sums_to_one": f"{count} attribution_sums where {_OFF_SHARE}",
        "revenue_ties_out": f"{count} attribution_sums where {_OFF_TIE}",
        "no_free_courses": f"{count} {fact} join dim_course using (course_key)"
        " where course_type = 'FREE'",
        "non_negative_revenue": f"{count} {fact} where attributed_revenue < 0",
        "royalty_rate": f"{count} {fact} where abs(instructor_royalty - round("
        "cast(attributed_revenue as decimal(12,2)) * cast(0.20 as decimal(3,2)), 2)) > 0.01",
    }
    parts += [_test_sql("singular", fact, c, text) for c, text in singular.items()]
    return " union all ".join(parts)


@query("build_checks", sql(_tests_sql()))
def build_checks(c):
    return _built(c).tests


# -- reports ---------------------------------------------------------------

_VIEW = "view_course_revenue_monthly"


@query("report_mrr_arr", show("view_monthly_mrr_arr"))
def report_mrr_arr(c):
    return reports.mrr_arr(view_monthly_mrr_arr(c))


@query(
    "report_top_courses",
    pick(
        _VIEW,
        "month:day course_name instructor total_revenue:d unique_students:k"
        " total_instructor_royalty:d",
        f"order by {_VIEW}.total_revenue desc nulls first, {_VIEW}.month, course_name"
        " limit 10",
    ),
)
def report_top_courses(c):
    return reports.top_courses(c.view_course_revenue_monthly())


@query(
    "report_instructor_totals",
    sql(
        "select instructor, cast(sum(total_revenue) as double) as total_revenue,"
        " cast(sum(total_instructor_royalty) as double) as total_instructor_royalty"
        f" from {_VIEW} group by instructor"
    ),
)
def report_instructor_totals(c):
    return reports.instructor_totals(c.view_course_revenue_monthly())


_TIE_COLUMNS = (
    "customer_key, strftime(revenue_month,'%Y-%m-%d') as revenue_month,"
    " cast(revenue_sum as double) as attributed_sum,"
    " cast(monthly_value as double) as monthly_value"
)
_FIRST_20 = "order by attribution_sums.revenue_month, customer_key limit 20"


@query(
    "report_bad_attribution",
    pick(
        "faulty_sums",
        "customer_key:k revenue_month:day pct_sum:d revenue_sum:d row_count:k",
        f"where {_OFF_SHARE} order by faulty_sums.revenue_month, customer_key limit 20",
    ),
)
def report_bad_attribution(c):
    """Over the fact with planted faults; the fact itself has none."""
    return reports.bad_attribution(c.faulty_attribution)


@query(
    "report_bad_tieout",
    sql(f"select {_TIE_COLUMNS} from attribution_sums where {_OFF_TIE} {_FIRST_20}"),
)
def report_bad_tieout(c):
    return reports.bad_tieout(c.fact_revenue_attribution)


@query(
    "report_order_classes",
    sql(
        "select subscription_type, subscription_tier,"
        " cast(subscription_interval_months as bigint) as subscription_interval_months,"
        " count(*) as order_count from fact_order group by 1, 2, 3"
    ),
)
def report_order_classes(c):
    return reports.order_classes(c.fact_order)


@query(
    "report_eligibility",
    sql(
        "select is_revenue_eligible, count(*) as row_count,"
        " cast(sum(total_minutes_consumed) as bigint) as total_minutes_consumed"
        " from fact_consumption group by 1"
    ),
)
def report_eligibility(c):
    return reports.eligibility(c.fact_consumption)


@query(
    "report_revenue_by_month",
    sql(
        "select strftime(revenue_month,'%Y-%m-%d') as revenue_month,"
        " cast(sum(attributed_revenue) as double) as total_attributed_revenue"
        " from fact_revenue_attribution group by 1"
    ),
)
def report_revenue_by_month(c):
    return reports.revenue_by_month(c.fact_revenue_attribution)


@query(
    "report_course_sample",
    sql(
        "select " + columns(
            "month:day course_name course_type instructor total_revenue:d"
            " avg_revenue_per_student:d total_minutes_consumed:k"
            " total_hours_consumed:d avg_minutes_per_student:d unique_students:k"
            " students_1plus_hours:k engagement_rate_pct:d"
            " total_instructor_royalty:d revenue_rank:k popularity_rank:k"
        )
        + f" from (select * from {_VIEW} order by month desc,"
        " total_revenue desc nulls first, course_name limit 10)"
    ),
)
def report_course_sample(c):
    return reports.course_sample(c.view_course_revenue_monthly())


# -- data checks -----------------------------------------------------------


def _unique_sql(model: str, column: str) -> str:
    return (
        f"select '{model}' as model_name, '{column}' as column_name,"
        f" cast({column} as varchar) as unique_field, count(*) as n_records"
        f" from {model} where {column} is not null group by {column}"
        " having count(*) > 1"
    )


@query(
    "dq_unique",
    sql(" union all ".join(_unique_sql(m, c) for m, c in quality.UNIQUE_COLUMNS)),
)
def dq_unique(c):
    return quality.all_unique(c.tables)


@query(
    "dq_not_null",
    sql(
        " union all ".join(
            f"select '{m}' as model_name, '{col}' as column_name,"
            f" count(*) filter (where {col} is null) as null_count from {m}"
            for m, names in quality.NOT_NULL_COLUMNS.items()
            for col in names
        )
    ),
)
def dq_not_null(c):
    return quality.all_null_counts(c.tables)


@query(
    "dq_not_null_rows",
    pick("fact_order", "order_key:k order_id:k", "where customer_key is null"),
)
def dq_not_null_rows(c):
    return not_null(c.fact_order, "customer_key").select("order_key", "order_id")


def _accepted_sql(model: str, column: str, values: str) -> str:
    return (
        f"select '{model}' as model_name, '{column}' as column_name,"
        f" cast({column} as varchar) as value_field, count(*) as n_records"
        f" from {model} where {column} not in ({values}) group by {column}"
    )


@query(
    "dq_accepted_values",
    sql(
        " union all ".join(
            [
                _accepted_sql("stg_courses", "course_type", "'PAID','FREE'"),
                _accepted_sql("dim_course", "course_type", "'PAID','FREE'"),
                _accepted_sql("fact_revenue_attribution", "is_free_course", "false"),
                _accepted_sql("fact_order", "subscription_type", "'YEARLY'"),
            ]
        )
    ),
)
def dq_accepted_values(c):
    """The standing tests, and a narrower list that some rows must fail."""
    narrow = ("fact_order", "subscription_type", ("YEARLY",))
    return quality.all_accepted(c.tables, (*quality.ACCEPTED_VALUES, narrow))


def _orphan_sql(child: str, key: str, parent: str) -> str:
    return (
        f"select '{child}' as model_name, '{key}' as column_name,"
        f" cast({key} as bigint) as from_field, count(*) as n_records"
        f" from {child} where {key} not in (select {key} from {parent})"
        f" group by {key}"
    )


_REVERSED = ("dim_course", "course_key", "fact_revenue_attribution")


@query(
    "dq_relationships",
    sql(
        " union all ".join(
            _orphan_sql(*r) for r in (*quality.RELATIONSHIPS, _REVERSED)
        )
    ),
)
def dq_relationships(c):
    """The standing tests, and the courses that earned nothing."""
    return quality.all_orphans(c.tables, (*quality.RELATIONSHIPS, _REVERSED))


@query(
    "dq_relationships_where",
    sql(
        "select customer_key as from_field, count(*) as n_records from fact_order"
        " where customer_key is not null and customer_key not in"
        " (select customer_key from fact_revenue_attribution) group by 1"
    ),
)
def dq_relationships_where(c):
    kept = c.fact_order.where("customer_key is not null")
    key = "customer_key"
    return checks.orphans(kept, key, c.fact_revenue_attribution, key)


_NO_DATE = "31/02/22 10:00"


@query(
    "dq_unparsed_dates",
    sql(
        "select 'customers' as table_name, unnest(['First Paid Order Date',"
        " 'First Order Date']) as column_name, 0::bigint as unparsed union all"
        " select 'orders', 'Order Created At', count(*) from raw_orders"
        " where mod(cast(order_id as bigint), 103) = 0"
    ),
)
def dq_unparsed_dates(c):
    """Over raw orders of which some have a day that does not exist."""
    orders, number = c.raw.orders(), F.col("`Order ID`").cast("long")
    created = F.when(number % 103 == 0, _NO_DATE).otherwise(F.col("`Order Created At`"))
    orders = orders.withColumn("Order Created At", created)
    return quality.unparsed_dates({"customers": c.raw.customers(), "orders": orders})


@query(
    "dq_attribution_sums_to_one",
    pick(
        "faulty_sums",
        "customer_key:k revenue_month:day pct_sum:d",
        f"where {_OFF_SHARE}",
    ),
)
def dq_attribution_sums_to_one(c):
    bad = quality.attribution_sums(c.faulty_attribution)
    return bad.select("customer_key", "revenue_month", "pct_sum")


@query(
    "dq_revenue_ties_out",
    sql(f"select {_TIE_COLUMNS} from attribution_sums where {_OFF_TIE}"),
)
def dq_revenue_ties_out(c):
    return quality.revenue_ties_out(c.fact_revenue_attribution)


@query(
    "dq_no_free_courses",
    sql(
        "select revenue_key, course_key, course_name, course_type"
        " from faulty_attribution join dim_course using (course_key)"
        " where course_type = 'FREE'"
    ),
)
def dq_no_free_courses(c):
    return quality.free_courses_in_revenue(c.faulty_attribution, c.dim_course)


@query(
    "dq_non_negative_revenue",
    pick(
        "faulty_attribution",
        "revenue_key:k attributed_revenue:d",
        "where faulty_attribution.attributed_revenue < 0",
    ),
)
def dq_non_negative_revenue(c):
    return quality.negative_revenue(c.faulty_attribution)


@query(
    "dq_royalty_rate",
    sql(
        "select revenue_key, cast(attributed_revenue as double) as attributed_revenue,"
        " cast(instructor_royalty as double) as instructor_royalty,"
        " cast(expected as double) as expected_royalty"
        " from (select *, round(cast(attributed_revenue as decimal(12,2))"
        " * cast(0.20 as decimal(3,2)), 2) as expected from faulty_attribution)"
        " where abs(instructor_royalty - expected) > 0.01"
    ),
)
def dq_royalty_rate(c):
    return quality.royalty_rate(c.faulty_attribution)


def _verdict_sql(count: str, table: str, check: str, text: str) -> str:
    return (
        f"select '{table}' as table_name, '{check}' as check_name, n = 0 as passed,"
        f" n || ' {text}' as details from (select count(*) as n {count})"
    )


_FACT = "fact_revenue_attribution"
_BAD_SHARE = _verdict_sql(
    f"from attribution_sums where {_OFF_SHARE}",
    _FACT,
    "attribution_sums_to_one",
    quality.SHARES_TEXT,
)
_BAD_TIE = _verdict_sql(
    f"from attribution_sums where {_OFF_TIE}",
    _FACT,
    "revenue_ties_out",
    quality.TIE_OUT_TEXT,
)


def _nulls_sql(table: str, column: str) -> str:
    return _verdict_sql(
        f"from {table} where {column} is null",
        table,
        f"not_null_{column}",
        quality.NULLS_TEXT,
    )


def _dups_sql(table: str, column: str) -> str:
    return _verdict_sql(
        f"from (select {column} from {table} group by 1 having count(*) > 1)",
        table,
        f"unique_{column}",
        quality.DUPLICATES_TEXT,
    )


@query("dq_null_count", sql(_nulls_sql("fact_order", "customer_key")))
def dq_null_count(c):
    return quality.count_nulls("fact_order", c.fact_order, "customer_key")


@query("dq_dup_count", sql(_dups_sql("dim_customer", "customer_id")))
def dq_dup_count(c):
    return quality.count_duplicates("dim_customer", c.dim_customer, "customer_id")


@query("dq_attribution_count", sql(_BAD_SHARE))
def dq_attribution_count(c):
    return quality.count_bad_attribution(c.fact_revenue_attribution)


@query("dq_tieout_count", sql(_BAD_TIE))
def dq_tieout_count(c):
    return quality.count_bad_tieout(c.fact_revenue_attribution)


_FOUR = " union all ".join(
    [
        _nulls_sql(_FACT, "attributed_revenue"),
        _dups_sql(_FACT, "revenue_key"),
        _BAD_SHARE,
        _BAD_TIE,
    ]
)


@query(
    "dq_summary",
    sql(
        "select count(*) as total_checks, count(*) filter (where passed) as passed,"
        " count(*) filter (where not passed) as failed,"
        " round(100.0 * count(*) filter (where passed) / count(*), 1) as pass_rate,"
        " string_agg(check_name || ': ' || details, '; ' order by check_name) as results"
        f" from ({_FOUR})"
    ),
)
def dq_summary(c):
    """The details as text, which both engines render alike."""
    results = quality.revenue_checks(c.fact_revenue_attribution)
    listed = F.array_sort(
        F.transform("results", lambda r: F.concat(r["check_name"], F.lit(": "), r["details"]))
    )
    return quality.summary(results).withColumn("results", F.array_join(listed, "; "))


@query("dq_results", sql(_FOUR))
def dq_results(c):
    """The details behind the summary."""
    results = quality.revenue_checks(c.fact_revenue_attribution)
    return quality.summary(results).selectExpr("inline(results)")
