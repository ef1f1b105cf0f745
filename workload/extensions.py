"""Queries for what goes beyond the models: loads by month, and more."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from watchledger.plans import calendar, clustered, ledger, packs, revenue
from watchledger.sources.commerce import SECOND_LOAD
from workload import models
from workload.oracle_models import columns, ratio, sql
from workload.registry import query

# -- loads by month --------------------------------------------------------
#
# Keys are dealt in another order than in a full build, so rows are shown by the
# ids and names that the keys stand for.

_CUSTOMER = "join (select customer_key, customer_id from dim_customer) using (customer_key)"
_COURSE = "join (select course_key, course_name from dim_course) using (course_key)"
_ORDER = "join (select order_key, order_id from fact_order) using (order_key)"

_CONSUMPTION = (
    "customer_id:k course_name date_key:k consumption_month:day total_minutes_consumed:k"
    " total_hours_consumed:d consumption_percentage_of_month:d is_revenue_eligible"
)


def _named(load, df):
    customers = load.table("dim_customer").select("customer_key", "customer_id")
    courses = load.table("dim_course").select("course_key", "course_name")
    return df.join(customers, "customer_key").join(courses, "course_key")


def _picked(df, names: str):
    return df.select(*[word.partition(":")[0] for word in names.split()])


@query(
    "incremental_consumption",
    sql(f"select {columns(_CONSUMPTION)} from fact_consumption {_CUSTOMER} {_COURSE}"),
)
def incremental_consumption(c):
    load = c.increments[-1]
    return _picked(_named(load, load.table("fact_consumption")), _CONSUMPTION)


_ATTRIBUTION = (
    "customer_id:k course_name order_id:k revenue_month:day subscription_type"
    " subscription_monthly_value:d course_minutes_consumed:k total_paid_minutes_consumed:k"
    " attribution_percentage:d attributed_revenue:d instructor_royalty:d"
)


@query(
    "incremental_attribution",
    sql(
        f"select {columns(_ATTRIBUTION)} from fact_revenue_attribution"
        f" {_CUSTOMER} {_COURSE} {_ORDER}"
    ),
)
def incremental_attribution(c):
    load = c.increments[-1]
    orders = load.table("fact_order").select("order_key", "order_id")
    fact = load.table("fact_revenue_attribution").join(orders, "order_key")
    return _picked(_named(load, fact), _ATTRIBUTION)


_ORDERS = (
    "order_id:k order_number date_key:k order_created_at:ts subscription_type"
    " subscription_interval_months:k monthly_value:d is_first_order is_latest_order"
    " order_sequence:k"
)


@query(
    "incremental_orders",
    sql(
        f"select {columns(_ORDERS)}, c.customer_id as customer_id from fact_order left join"
        " (select customer_key, customer_id from dim_customer) c using (customer_key)"
    ),
)
def incremental_orders(c):
    load = c.increments[-1]
    customers = load.table("dim_customer").select("customer_key", "customer_id")
    orders = load.table("fact_order").drop("customer_id")
    named = orders.join(customers, "customer_key", "left")
    return _picked(named, _ORDERS + " customer_id")


_VERSIONS = (
    "customer_id:k first_paid_order_date:ts first_order_date:ts total_spent:d"
    " effective_from_date:ts effective_to_date:ts is_current"
)


@query("incremental_customers", sql(f"select {columns(_VERSIONS)} from dim_customer"))
def incremental_customers(c):
    return _picked(c.increments[-1].table("dim_customer"), _VERSIONS)


_MONTHS = (
    "month:day course_name course_type total_revenue:d unique_students:k"
    " students_1plus_hours:k total_instructor_royalty:d revenue_rank:k popularity_rank:k"
)


@query("incremental_course_months", sql(f"select {columns(_MONTHS)} from view_course_revenue_monthly"))
def incremental_course_months(c):
    return _picked(c.increments[-1].table("course_months"), _MONTHS)


# -- revenue to the cent ---------------------------------------------------

_EXACT_MODEL = """
  with weighed as (
    select customer_key, course_key, revenue_month, order_key, subscription_monthly_value,
      course_minutes_consumed, cast(subscription_monthly_value * 100 as bigint) as value_cents,
      cast(sum(course_minutes_consumed) over g as bigint) as total, count(*) over g as members
    from SHARED window g as (partition by customer_key, revenue_month)),
  dealt as (
    select *, case when total = 0 then 1 else course_minutes_consumed end as w,
      case when total = 0 then members else total end as t from weighed),
  placed as (
    select *, (value_cents * w) // t as floor_cents, row_number() over (
        partition by customer_key, revenue_month order by (value_cents * w) % t desc, course_key, order_key) as place
    from dealt)
  select customer_key, course_key, revenue_month, order_key, subscription_monthly_value, course_minutes_consumed,
    cast((floor_cents + case when place <= value_cents - sum(floor_cents) over (
      partition by customer_key, revenue_month) then 1 else 0 end) as decimal(12,0)) * 0.01 as exact_revenue
  from placed
"""
_EXACT = (
    "customer_key:k course_key:k revenue_month:day order_key:k subscription_monthly_value:d"
    " course_minutes_consumed:k exact_revenue:d"
)


def _exact_sql(shared: str, select: str) -> str:
    # The models that ``shared`` mentions come in front of all.
    return sql(f"select * from (with exact as ({_EXACT_MODEL.replace('SHARED', shared)}) {select})")


_ROYALTY = "cast(round(exact_revenue * cast(0.20 as decimal(3,2)), 2) as double) as instructor_royalty"


def _exact(c):
    if not hasattr(c, "exact"):
        made = revenue.exact_revenue(c.fact_revenue_attribution, c.settings, c.scratch)
        c.exact = c.stored(made, "exact_revenue")
    return c.exact


@query(
    "exact_apportionment",
    _exact_sql("fact_revenue_attribution", f"select {columns(_EXACT)}, {_ROYALTY} from exact"),
)
def exact_apportionment(c):
    return _exact(c)


@query(
    "exact_tie_out",
    _exact_sql(
        "fact_revenue_attribution",
        "select strftime(m.revenue_month, '%Y-%m-%d') as revenue_month,"
        " cast(monthly_value as double) as monthly_value, cast(rounded_revenue as double) as rounded_revenue,"
        " customers_off, cast(monthly_value as double) as exact_revenue"
        " from (select revenue_month, sum(v) as monthly_value, sum(r) as rounded_revenue,"
        " count(*) filter (v <> r) as customers_off from (select customer_key, revenue_month,"
        " max(subscription_monthly_value) as v, coalesce(sum(attributed_revenue), 0) as r"
        " from fact_revenue_attribution group by all) group by all) m",
    ),
)
def exact_tie_out(c):
    """The SQL says that the exact parts add up to the value of every month."""
    return revenue.tie_out_by_month(c.fact_revenue_attribution, _exact(c))


# -- months covered by a plan ----------------------------------------------

_COVERED = """
  (select customer_key, cast(date_trunc('month', order_created_at) + to_months(cast(i as int)) as date) as revenue_month,
     order_key, subscription_type, i + 1 as plan_month, monthly_value as subscription_monthly_value
   from (select *, unnest(range(0, subscription_interval_months)) as i from fact_order
         where subscription_type in ('MONTHLY', 'YEARLY') and customer_key is not null
           and order_created_at is not null and monthly_value > 0)
   qualify row_number() over (partition by customer_key, revenue_month
     order by order_created_at desc, order_key desc) = 1)"""


@query(
    "plan_months",
    sql(
        "select customer_key, strftime(revenue_month, '%Y-%m-%d') as revenue_month, order_key,"
        " subscription_type, plan_month, cast(subscription_monthly_value as double)"
        f" as subscription_monthly_value from {_COVERED}"
    ),
)
def plan_months(c):
    return revenue.plan_months(c.fact_order)


@query(
    "covered_revenue",
    _exact_sql(
        "(select p.customer_key, p.course_key, p.consumption_month as revenue_month, o.order_key,"
        " o.subscription_monthly_value, p.total_minutes_consumed as course_minutes_consumed"
        f" from fact_consumption p join {_COVERED} o on o.customer_key = p.customer_key"
        " and o.revenue_month = p.consumption_month where p.is_revenue_eligible)",
        f"select {columns(_EXACT)}, {_ROYALTY} from exact",
    ),
)
def covered_revenue(c):
    covered = revenue.plan_months(c.fact_order)
    return revenue.covered_revenue(c.fact_consumption, covered, c.settings, c.scratch)


# -- over time -------------------------------------------------------------

_WATERFALL = """
with cm as (
  select customer_key as k, revenue_month as m, max(subscription_monthly_value) as v
  from fact_revenue_attribution group by all),
spine as (
  select cast(unnest(generate_series(cast(min(m) as timestamp), cast(max(m) as timestamp), interval 1 month)) as date) as m
  from cm),
grid as (
  select s.m, c.k, a.v as now, b.v as before, c.first
  from spine s, (select k, min(m) as first from cm group by k) c
  left join cm a on a.k = c.k and a.m = s.m
  left join cm b on b.k = c.k and b.m = cast(s.m - interval 1 month as date)),
moved as (
  select m, coalesce(sum(before), 0) as opening_mrr,
    coalesce(sum(now) filter (before is null and m = first), 0) as new_mrr,
    coalesce(sum(now) filter (before is null and m > first), 0) as returned_mrr,
    coalesce(sum(now - before) filter (now > before), 0) as expansion_mrr,
    coalesce(sum(before - now) filter (now < before), 0) as contraction_mrr,
    coalesce(sum(before) filter (now is null), 0) as churned_mrr,
    coalesce(sum(now), 0) as closing_mrr,
    count(now) as active_customers,
    count(now) filter (before is null and m = first) as new_customers,
    count(now) filter (before is null and m > first) as returned_customers,
    count(before) filter (now is null) as churned_customers
  from grid group by m),
changed as (select *, CHANGE as change_pct from moved)
select strftime(m, '%Y-%m-%d') as month, cast(opening_mrr as double) as opening_mrr,
  cast(new_mrr as double) as new_mrr, cast(returned_mrr as double) as returned_mrr,
  cast(expansion_mrr as double) as expansion_mrr, cast(contraction_mrr as double) as contraction_mrr,
  cast(churned_mrr as double) as churned_mrr, cast(closing_mrr as double) as closing_mrr,
  active_customers, new_customers, returned_customers, churned_customers,
  cast(change_pct as double) as change_pct, coalesce(abs(change_pct) > 20, false) as is_alert
from changed
"""


@query(
    "revenue_waterfall",
    sql("select * from (" + _WATERFALL.replace(
        "CHANGE", ratio("cast((closing_mrr - opening_mrr) * 10000 as hugeint)", "cast(opening_mrr * 100 as hugeint)", 2)
    ) + ")"),
)
def revenue_waterfall(c):
    months = revenue.customer_months(c.fact_revenue_attribution)
    return revenue.revenue_waterfall(months, c.scratch)


_RETENTION = """
with active as (
  select distinct customer_key as k, year(revenue_month) * 12 + month(revenue_month) - 1 as n
  from fact_revenue_attribution),
firsts as (select k, min(n) as first from active group by k),
cohorts as (select first, count(*) as size from firsts group by first),
ages as (
  select first, size, unnest(range(0, (select max(n) from active) - first + 1)) as age from cohorts),
seen as (select first, n - first as age, count(*) as present from active join firsts using (k) group by all)
select strftime(make_date(cast(first // 12 as bigint), cast(first % 12 + 1 as bigint), 1), '%Y-%m-%d') as cohort_month,
  cast(age as bigint) as age, size as cohort_customers, coalesce(present, 0) as active_customers,
  cast(SHARE as double) as retention_pct
from ages left join seen using (first, age)
"""


@query(
    "cohort_retention",
    sql("select * from (" + _RETENTION.replace("SHARE", ratio("coalesce(present, 0) * 100", "size", 2)) + ")"),
)
def cohort_retention(c):
    return revenue.cohort_retention(c.fact_revenue_attribution, "revenue_month", c.scratch)


@query(
    "cohort_revenue",
    sql(
        "select strftime(cohort, '%Y-%m-%d') as cohort_month, cast(datediff('month', cohort, revenue_month)"
        " as bigint) as age, count(*) as paying_customers, cast(sum(r) as double) as revenue from"
        " (select customer_key, revenue_month, sum(attributed_revenue) as r from fact_revenue_attribution group by all)"
        " join (select customer_key, cast(date_trunc('month', min(order_created_at)) as date) as cohort"
        " from fact_order where customer_key is not null and order_created_at is not null group by all)"
        " using (customer_key) group by all"
    ),
)
def cohort_revenue(c):
    return revenue.cohort_revenue(c.fact_revenue_attribution, c.fact_order)


# -- figures of loads ------------------------------------------------------


def _figures_sql() -> str:
    parts = []
    for name, sums in ledger.SUMS.items():
        model = "view_course_revenue_monthly" if name == "course_months" else name
        event = ledger.EVENTS.get(name)
        latest = f"cast(max({event}) as timestamp)" if event else "cast(null as timestamp)"
        measures = {"rows": "cast(count(*) as double)"}
        measures |= {c: f"cast(sum(cast({c} as decimal(38,2))) as double)" for c in sums}
        parts += [
            f"select '{name}' as table_name, '{measure}' as measure, {value} as value,"
            f" strftime({latest}, '%Y-%m-%d %H:%M:%S') as latest from {model}"
            for measure, value in measures.items()
        ]
    return " union all ".join(parts)


@query("load_ledger", sql(_figures_sql()))
def load_ledger(c):
    return models._built(c).ledger.drop("load")


_MONTH_FIGURES = (
    "select strftime(consumption_month, '%Y-%m-%d') as load, 'fact_consumption' as table_name,"
    " 'rows' as measure, cast(count(*) as double) as value from fact_consumption group by 1"
    " union all select strftime(revenue_month, '%Y-%m-%d'), 'fact_revenue_attribution',"
    " 'attributed_revenue', cast(sum(attributed_revenue) as double) from fact_revenue_attribution group by 1"
)


@query(
    "volume_spikes",
    sql(
        f"select * from (with figures as ({_MONTH_FIGURES}), before as (select f.*, (select list(b.value) from"
        " (select value from figures e where e.table_name = f.table_name and e.load < f.load"
        " order by e.load desc limit 30) b) as earlier from figures f),"
        " centred as (select *, list_median(earlier) as median from before),"
        " spread as (select *, list_median(list_transform(earlier, lambda x: abs(x - median))) as deviation from centred)"
        " select load, table_name, measure, value, median, deviation, coalesce(len(earlier) >= 3"
        " and abs(value - median) > deviation * 5 * 1.4826::double and abs(value - median) > abs(median) * 0.25::double,"
        " false) as is_spike from spread)"
    ),
)
def volume_spikes(c):
    """Each month held against the months before, as a load against loads."""
    months = {
        "fact_consumption": ("consumption_month", "rows", F.count(F.lit(1))),
        "fact_revenue_attribution": (
            "revenue_month", "attributed_revenue", F.sum("attributed_revenue"),
        ),
    }
    found = [
        c.tables[name]
        .groupBy(F.date_format(month, "yyyy-MM-dd").alias("load"))
        .agg(value.cast("double").alias("value"))
        .select("load", F.lit(name).alias("table_name"), F.lit(measure).alias("measure"), "value")
        for name, (month, measure, value) in months.items()
    ]
    return ledger.volume_spikes(found[0].unionByName(found[1]))


@query(
    "source_freshness",
    sql(
        "select table_name, strftime(latest, '%Y-%m-%d %H:%M:%S') as latest, datediff('second', latest,"
        " timestamp '2001-09-01') // 3600 as age_hours, case when latest is null or"
        " datediff('second', latest, timestamp '2001-09-01') > 100 * 86400 then 'error'"
        " when datediff('second', latest, timestamp '2001-09-01') > 30 * 86400 then 'warn' else 'pass' end as level from ("
        " select 'fact_order' as table_name, max(order_created_at) as latest from fact_order union all"
        " select 'fact_consumption', cast(max(consumption_month) as timestamp) from fact_consumption union all"
        " select 'dim_customer', max(first_order_date) from dim_customer)"
    ),
)
def source_freshness(c):
    figures = models._built(c).ledger.where("measure = 'rows'")
    events = figures.where(F.col("table_name").isin(*ledger.EVENTS))
    return ledger.freshness(
        events, SECOND_LOAD, dt.timedelta(days=30), dt.timedelta(days=100)
    )


# -- calendar --------------------------------------------------------------

_DATES = """
with ends as (
  select min(d) as low, max(d) as high from (
    select cast(order_created_at as date) as d from fact_order union all select consumption_month from fact_consumption)),
days as (
  select cast(unnest(generate_series(cast(date_trunc('year', low) as timestamp),
    cast(make_date(cast(year(high) as bigint), 12, 31) as timestamp), interval 1 day)) as date) as day from ends),
moons as (
  select day, year(day) as y, (19 * (year(day) % 19) + year(day) // 100 - year(day) // 400
    - (8 * (year(day) // 100) + 13) // 25 + 15) % 30 as e from days),
paschal as (
  select day, y, cast(make_date(cast(y as bigint), 3, 21) + cast(e - case when e = 29 or (e = 28 and y % 19 > 10)
    then 1 else 0 end as int) as date) as moon from moons),
dated as (select day, y, date_diff('day', cast(moon + cast(7 - isodow(moon) % 7 as int) as date), day) as since from paschal)
select cast(strftime(day, '%Y%m%d') as bigint) as date_key, strftime(day, '%Y-%m-%d') as day, y as year,
  quarter(day) as quarter, month(day) as month, strftime(date_trunc('month', day), '%Y-%m-%d') as month_start,
  day = last_day(day) as is_month_end, weekofyear(day) as iso_week, isodow(day) as weekday, isodow(day) > 5 as is_weekend,
  y + case when month(day) >= 4 then 1 else 0 end as fiscal_year, ((month(day) + 8) % 12) // 3 + 1 as fiscal_quarter,
  (month(day) + 8) % 12 + 1 as fiscal_month,
  case since when 50 then 'Whit Monday' when 39 then 'Ascension' when 1 then 'Easter Monday' when 0 then 'Easter Sunday'
    when -2 then 'Good Friday' else case strftime(day, '%m-%d') when '12-26' then 'St Stephen' when '12-25' then 'Christmas'
    when '05-01' then 'Labour Day' when '01-01' then 'New Year' end end as holiday
from dated
"""


def _dates(c):
    """The calendar of the facts' days; its fiscal year begins in April."""
    days = c.fact_order.select(F.col("order_created_at").cast("date").alias("day")).unionByName(
        c.fact_consumption.select(F.col("consumption_month").alias("day"))
    )
    return calendar.dim_date(days, fiscal_start=4)


@query("dim_date", sql(f"select * from ({_DATES})"))
def dim_date(c):
    return _dates(c)


@query(
    "fact_days",
    sql(
        "select date_key, count(*) as orders, cast(sum(net_amount_usd) as double) as net_amount_usd"
        " from fact_order where date_key is not null group by date_key"
    ),
)
def fact_days(c):
    """Orders by calendar day: every day of the fact is found in the calendar."""
    orders = c.fact_order.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("net_amount_usd").alias("net_amount_usd")
    )
    return _dates(c).select("date_key").join(orders, "date_key")


# -- clustered facts -------------------------------------------------------


def _clustered(c):
    if not hasattr(c, "clustered"):
        fact = c.fact_consumption
        c.clustered = clustered.ClusteredFact.write(
            fact, c.scratch.folder("clustered"), clustered.buckets_for(fact.count())
        )
    return c.clustered


@query(
    "clustered_customer_months",
    sql(
        "select customer_key, strftime(consumption_month, '%Y-%m-%d') as consumption_month,"
        " cast(sum(total_minutes_consumed) as bigint) as minutes, count(*) as titles,"
        " count(*) filter (is_revenue_eligible) as paid_titles from fact_consumption group by all"
    ),
)
def clustered_customer_months(c):
    return clustered.customer_months(_clustered(c))


#: Courses whose months are looked up.
COURSES = (1, 2, 3, 5, 8, 13, 21, 34)


@query(
    "clustered_course_months",
    sql(
        "select course_key, strftime(consumption_month, '%Y-%m-%d') as consumption_month,"
        " cast(sum(total_minutes_consumed) as bigint) as minutes, count(*) as viewers"
        f" from fact_consumption where course_key in {COURSES} group by all"
    ),
)
def clustered_course_months(c):
    return clustered.course_months(_clustered(c), COURSES)


# -- revenue of packs ------------------------------------------------------
#
# The tables have no groups of customers; eight neighbours by id make one here.

TEAM = 8

_PACK_MODEL = f"""
  with members as (
    select customer_id // {TEAM} as group_id, customer_key from dim_customer where is_current),
  minutes as (
    select customer_key, consumption_month, sum(total_minutes_consumed) as w
    from fact_consumption group by all),
  spread as (
    select o.order_key, o.customer_key as buyer_key, m.customer_key as member_key,
      cast(date_trunc('month', o.order_created_at) as date) as revenue_month, o.net_amount_usd,
      cast(coalesce(w.w, 0) as bigint) as member_minutes,
      cast(abs(o.net_amount_usd) * 100 as bigint) as whole
    from fact_order o left join members b on b.customer_key = o.customer_key
    left join members m on m.group_id = b.group_id
    left join minutes w on w.customer_key = m.customer_key
      and w.consumption_month = cast(date_trunc('month', o.order_created_at) as date)
    where contains(upper(o.line_items), 'PACK') and o.subscription_type is null
      and o.net_amount_usd is not null),
  weighed as (
    select *, sum(member_minutes) over g as total, count(*) over g as n
    from spread window g as (partition by order_key)),
  dealt as (
    select *, case when total = 0 then 1 else member_minutes end as w,
      cast(case when total = 0 then n else total end as bigint) as t from weighed),
  placed as (
    select *, (whole * w) // t as part, row_number() over (
      partition by order_key order by (whole * w) % t desc, member_key) as place from dealt)
  select *, sign(net_amount_usd) * (part + case when place <= whole - sum(part) over (
    partition by order_key) then 1 else 0 end) as signed from placed
"""


@query(
    "pack_revenue",
    sql(
        "select order_key, buyer_key, member_key, strftime(revenue_month, '%Y-%m-%d') as revenue_month,"
        " member_minutes, cast(net_amount_usd as double) as net_amount_usd,"
        f" cast(cast(signed as decimal(18,0)) * 0.01 as double) as member_revenue from ({_PACK_MODEL})"
    ),
)
def pack_revenue(c):
    team = F.call_function("div", F.col("customer_id"), F.lit(TEAM)).alias("group_id")
    members = c.dim_customer.where("is_current").select(team, "customer_key")
    return packs.pack_revenue(
        packs.pack_orders(c.fact_order), members, c.fact_consumption, c.scratch
    )
