"""The models as DuckDB SQL, written independently of the Spark code.

``sql`` puts the needed models in front of a final select. Ratios stay in
whole numbers because decimal division in DuckDB gives a double.
"""

from __future__ import annotations

import re


def share(a: str, b: str) -> str:
    """a/b to four places for non-negative whole numbers."""
    return f"(cast((2*{a}*10000 + {b}) // (2*{b}) as decimal(12,0)) * 0.0001)"


def ratio(n: str, d: str, places: int) -> str:
    """n/d half away from zero for whole numbers; null if d is 0."""
    n, d = f"cast({n} as hugeint)", f"nullif(cast({d} as hugeint), 0)"
    whole = f"((2*abs({n})*{10**places} + abs({d})) // (2*abs({d})))"
    return f"(cast(sign({n})*sign({d})*{whole} as decimal(24,0)) * {10**-places:.{places}f})"


def cents(x: str) -> str:
    return f"cast(({x})*100 as hugeint)"


def mixed(x: str, key: str) -> str:
    return (
        f"case when mod({key},2)=0 then strftime({x},'%d/%m/%y %H:%M') "
        f"else strftime({x},'%Y-%m-%d %H:%M:%S') end"
    )


def parsed(x: str) -> str:
    return (
        f"case when {x} like '%/%' then strptime({x},'%d/%m/%y %H:%M') "
        f"when {x} like '%-%' then cast({x} as timestamp) end"
    )


def _raw_customers(condition: str) -> str:
    return f"""
      with g as (
        select c_custkey as k,
               min(o_orderdate) filter (where o_orderpriority <> '5-LOW') as p,
               min(o_orderdate) as a,
               sum(cast(o_totalprice as decimal(12,2))) as s
        from customer left join (select * from orders where {condition})
          on o_custkey = c_custkey
        group by c_custkey),
      t as (select k, {mixed('p', 'k')} as first_paid, {mixed('a', 'k')} as first_order,
                   cast(cast(s as decimal(20,2)) as varchar) as spent from g)
      select cast(k as varchar) as customer_id, first_paid, first_order, spent from t
      union all select '  ', first_paid, first_order, spent from t where mod(k,97)=0
      union all select cast(k as varchar), first_paid, first_order, '1.00' from t
      where mod(k,500)=0"""


def _stg_customers(raw: str) -> str:
    return f"""
      select cast(customer_id as bigint) as customer_id,
             {parsed('first_paid')} as first_paid_order_date,
             {parsed('first_order')} as first_order_date,
             cast(spent as decimal(18,2)) as total_spent
      from {raw} where customer_id is not null and trim(customer_id) <> ''
      qualify row_number() over (partition by cast(customer_id as bigint)
        order by total_spent desc nulls first, first_paid_order_date desc nulls first,
                 first_order_date desc nulls first) = 1"""


_CHANGED = """(f.total_spent is distinct from n.total_spent
          or f.first_paid_order_date is distinct from n.first_paid_order_date)"""

MODELS = {
    "raw_orders": f"""
      select cast(o_orderkey as varchar) as order_id,
             'ORD-' || cast(o_orderkey as varchar) || ' ' as order_number,
             {mixed('o_orderdate', 'o_orderkey')} as created_at,
             case when mod(o_orderkey,101)=0 then '  '
                  else cast(o_custkey as varchar) end as customer_id,
             case o_orderpriority
               when '1-URGENT' then 'Professional Yearly Subscription'
               when '2-HIGH' then ' professional monthly subscription '
               when '3-MEDIUM' then 'Yearly Subscription'
               when '4-NOT SPECIFIED' then 'Monthly Subscription'
               else 'Business Pack' end as line_items,
             n_name as country,
             cast(cast(case when mod(o_orderkey,211)=0 then -o_totalprice
                            else o_totalprice end as decimal(12,2)) as varchar) as net
      from orders join customer on o_custkey=c_custkey
      join nation on c_nationkey=n_nationkey""",
    "raw_customers_early": _raw_customers("o_orderdate < timestamp '1999-01-01'"),
    "raw_customers": _raw_customers("true"),
    "raw_courses": """
      select ' ' || p_name || ' #' || cast(p_partkey as varchar) || ' ' as course_name,
             case when mod(p_size,4)=0 then 'Free' else ' Paid' end as course_type,
             p_brand as instructor
      from part""",
    "raw_consumption": """
      select cast(o_custkey as varchar) as user_id,
             case when mod(l_orderkey+l_linenumber,503)=0 then ' '
                  else p_name || ' #' || cast(p_partkey as varchar) end as course_name,
             cast(cast(l_quantity*3 as int) as varchar) as minutes,
             cast(date_trunc('month',o_orderdate) as date) as month
      from lineitem join orders on l_orderkey=o_orderkey
      join part on l_partkey=p_partkey""",
    "stg_customers_early": _stg_customers("raw_customers_early"),
    "stg_customers": _stg_customers("raw_customers"),
    "stg_orders": f"""
      select cast(order_id as bigint) as order_id, trim(order_number) as order_number,
             {parsed('created_at')} as order_created_at,
             cast(nullif(trim(customer_id),'') as bigint) as customer_id,
             trim(line_items) as line_items, trim(country) as billing_address_country,
             cast(net as decimal(12,2)) as net_usd
      from raw_orders""",
    "stg_courses": """
      select trim(course_name) as course_name, upper(trim(course_type)) as course_type,
             trim(instructor) as course_instructor
      from raw_courses""",
    "stg_consumption": """
      select cast(user_id as bigint) as user_id, trim(course_name) as course_name,
             cast(minutes as integer) as minutes_consumed, month as consumption_month
      from raw_consumption where course_name is not null and trim(course_name) <> ''""",
    "snap_customer": f"""
      select f.*, timestamp '1999-01-01' as dbt_valid_from,
             case when {_CHANGED} and n.customer_id is not null
                  then timestamp '2001-09-01' end as dbt_valid_to
      from stg_customers_early f left join stg_customers n on f.customer_id=n.customer_id
      union all
      select n.*, timestamp '2001-09-01', null
      from stg_customers n left join stg_customers_early f on f.customer_id=n.customer_id
      where f.customer_id is null or {_CHANGED}""",
    "dim_course": """
      select row_number() over (order by course_name, course_type, course_instructor)
               as course_key,
             *, course_type is not distinct from 'PAID' as is_revenue_generating,
             cast(null as integer) as total_duration_minutes,
             cast(null as integer) as lesson_count,
             cast(null as integer) as enrollment_count
      from stg_courses""",
    "dim_customer": """
      select row_number() over (order by customer_id, dbt_valid_from) as customer_key,
             customer_id, first_paid_order_date, first_order_date, total_spent,
             cast(null as varchar) as customer_status,
             dbt_valid_from as effective_from_date, dbt_valid_to as effective_to_date,
             dbt_valid_to is null as is_current
      from snap_customer""",
    "dim_customer_scd1": """
      select row_number() over (order by customer_id) as customer_key, *,
             cast(null as varchar) as customer_status,
             first_order_date as effective_from_date,
             cast(null as timestamp) as effective_to_date, true as is_current
      from stg_customers""",
    "fact_order": """
      with o as (
        select *, upper(line_items) as t,
               row_number() over (partition by customer_id order by
                 order_created_at nulls last, order_id nulls last) as order_sequence,
               row_number() over (partition by customer_id order by
                 order_created_at desc nulls first, order_id desc nulls first) as back,
               cast(net_usd*100 as bigint) as c
        from stg_orders)
      select row_number() over (order by order_id) as order_key, order_id, order_number,
             customer_key,
             cast(strftime(order_created_at,'%Y%m%d') as bigint) as date_key,
             order_created_at, line_items, billing_address_country as billing_country,
             case when contains(t,'YEARLY') then 'YEARLY'
                  when contains(t,'MONTHLY') then 'MONTHLY' end as subscription_type,
             case when contains(t,'PROFESSIONAL') then 'PROFESSIONAL'
                  when contains(t,'SUBSCRIPTION') then 'STANDARD' end as subscription_tier,
             case when contains(t,'YEARLY') then 12
                  when contains(t,'MONTHLY') then 1 end as subscription_interval_months,
             net_usd as net_amount_usd,
             case when contains(t,'YEARLY') then
               cast(sign(c)*((2*abs(c)+12)//24) as decimal(18,0))*0.01
               else net_usd end as monthly_value,
             order_sequence = 1 as is_first_order, back = 1 as is_latest_order,
             order_sequence
      from o left join (select customer_key, customer_id as cid from dim_customer
                        where is_current) on cid = customer_id""",
    "consumption_by_month": """
      select customer_key, course_key, consumption_month, is_revenue_generating,
             cast(sum(minutes_consumed) as bigint) as minutes
      from stg_consumption s
      join dim_customer c on c.customer_id = s.user_id and c.is_current
      join dim_course d on d.course_name = s.course_name
      group by all""",
    "fact_consumption": f"""
      with m as (select *, cast(sum(minutes) over (
                   partition by customer_key, consumption_month) as bigint) as whole
                 from consumption_by_month)
      select row_number() over (order by customer_key, course_key, consumption_month)
               as consumption_key,
             customer_key, course_key,
             cast(strftime(consumption_month,'%Y%m%d') as bigint) as date_key,
             consumption_month, minutes as total_minutes_consumed,
             {ratio('minutes', '60', 2)} as total_hours_consumed,
             cast(null as bigint) as unique_sessions,
             cast(null as decimal(5,2)) as completion_percentage,
             {share('minutes', 'nullif(whole,0)')} as consumption_percentage_of_month,
             is_revenue_generating as is_revenue_eligible
      from m""",
    "latest_paid_orders": """
      select customer_key, cast(date_trunc('month',order_created_at) as date) as month,
             order_key, subscription_type, monthly_value
      from fact_order
      where subscription_type in ('MONTHLY','YEARLY') and customer_key is not null
        and monthly_value > 0
      qualify row_number() over (partition by customer_key,
        date_trunc('month',order_created_at)
        order by order_created_at desc nulls first, order_key desc) = 1""",
    "fact_revenue_attribution": f"""
      with p as (select *, cast(sum(total_minutes_consumed) over (
                   partition by customer_key, consumption_month) as bigint) as whole
                 from fact_consumption where is_revenue_eligible),
      s as (select p.customer_key, course_key, order_key, date_key, consumption_month,
                   subscription_type, monthly_value, total_minutes_consumed, whole,
                   {share('total_minutes_consumed', 'nullif(whole,0)')} as pct
            from p join latest_paid_orders o
              on o.customer_key=p.customer_key and o.month=p.consumption_month)
      select row_number() over (
               order by customer_key, course_key, order_key, consumption_month)
               as revenue_key,
             customer_key, course_key, order_key, date_key,
             consumption_month as revenue_month, subscription_type,
             monthly_value as subscription_monthly_value,
             total_minutes_consumed as course_minutes_consumed,
             whole as total_paid_minutes_consumed,
             cast(pct as decimal(9,4)) as attribution_percentage,
             round(cast(monthly_value as decimal(12,2))*cast(pct as decimal(9,4)), 2)
               as attributed_revenue,
             round(cast(monthly_value as decimal(12,2))*cast(pct as decimal(9,4))
               *cast(0.20 as decimal(3,2)), 2) as instructor_royalty,
             false as is_free_course
      from s""",
    "customer_mrr": """
      select revenue_month, customer_key, sum(subscription_monthly_value) as mrr,
             max(subscription_type) as plan,
             lag(sum(subscription_monthly_value)) over w as before,
             lag(revenue_month) over w as month_before
      from fact_revenue_attribution group by revenue_month, customer_key
      window w as (partition by customer_key order by revenue_month)""",
    "view_monthly_mrr_arr": f"""
      with m as (
        select revenue_month as month, sum(mrr) as mrr,
               sum(case when before is null then mrr else 0 end) as new_mrr,
               sum(case when mrr > before then mrr-before else 0 end) as expansion_mrr,
               sum(case when mrr < before then before-mrr else 0 end) as contraction_mrr,
               count(distinct customer_key) as total_customers,
               count(distinct case when before is null then customer_key end)
                 as new_customers,
               count(distinct case when before is not null then customer_key end)
                 as retained_customers
        from customer_mrr group by revenue_month),
      l as (select *, lag(mrr) over (order by month) as mrr_before,
                   lag(total_customers) over (order by month) as customers_before,
                   new_mrr + expansion_mrr - contraction_mrr as net_new_mrr from m)
      select month, mrr, mrr*12 as arr, new_mrr, 0.0 as churned_mrr, expansion_mrr,
             contraction_mrr, net_new_mrr,
             {ratio(cents('net_new_mrr') + '*100', cents('mrr_before'), 2)}
               as mrr_growth_rate_pct,
             total_customers, new_customers, retained_customers,
             {ratio('retained_customers*100', 'customers_before', 2)}
               as customer_retention_rate_pct,
             {ratio(cents('mrr'), 'total_customers*100', 2)} as arpu,
             {ratio(cents('new_mrr+expansion_mrr'), cents('contraction_mrr'), 2)}
               as quick_ratio
      from l""",
    "view_course_revenue_monthly": f"""
      with g as (
        select revenue_month as month, course_name, course_type, course_instructor,
               sum(attributed_revenue) as revenue,
               sum(course_minutes_consumed) as minutes,
               count(attributed_revenue) as n, count(course_minutes_consumed) as nm,
               count(distinct customer_key) as students,
               count(distinct customer_key) filter (where course_minutes_consumed >= 60)
                 as engaged,
               sum(instructor_royalty) as royalty
        from fact_revenue_attribution join dim_course using (course_key)
        where course_type = 'PAID' group by all)
      select month, course_name, course_type, course_instructor as instructor,
             revenue as total_revenue,
             {ratio(cents('revenue'), 'n*100', 2)} as avg_revenue_per_student,
             minutes as total_minutes_consumed,
             {ratio('minutes', '60', 2)} as total_hours_consumed,
             {ratio('minutes', 'nm', 2)} as avg_minutes_per_student,
             students as unique_students, engaged as students_1plus_hours,
             {ratio('engaged*100', 'students', 2)} as engagement_rate_pct,
             royalty as total_instructor_royalty,
             rank() over (partition by month order by revenue desc nulls first)
               as revenue_rank,
             rank() over (partition by month order by students desc) as popularity_rank
      from g""",
    "view_instructor_royalties_monthly": """
      select revenue_month as month, course_instructor as instructor,
             count(distinct course_name) as courses_count,
             sum(attributed_revenue) as total_course_revenue,
             sum(instructor_royalty) as royalty_amount,
             count(distinct customer_key) as unique_students
      from fact_revenue_attribution join dim_course using (course_key)
      where course_type = 'PAID' group by 1, 2""",
    "view_customer_subscription_status": """
      select customer_id, coalesce(subscription_type,'NONE') as current_plan,
             coalesce(monthly_value,0) as mrr, first_order_date as start_date,
             order_created_at as last_order_date, total_spent,
             case when order_created_at >= timestamp '2001-06-01' then 'ACTIVE'
                  when order_created_at >= timestamp '2001-06-01' - interval 90 day
                    then 'AT_RISK'
                  when order_created_at is not null then 'CHURNED'
                  else 'UNKNOWN' end as status
      from (select * from dim_customer where is_current) c
      left join (select * from fact_order where is_latest_order
                 and subscription_type is not null) o
        on o.customer_key = c.customer_key""",
    "view_consumption_trends": f"""
      with g as (
        select consumption_month as month, course_name, course_type, course_instructor,
               sum(total_minutes_consumed) as minutes,
               count(distinct customer_key) as users,
               sum(total_hours_consumed) as hours
        from fact_consumption join dim_course using (course_key) group by all)
      select month, course_name, course_type, course_instructor as instructor,
             minutes as total_minutes, users as unique_users,
             {ratio('minutes', 'users', 2)} as avg_minutes_per_user,
             hours as total_hours
      from g""",
    "attribution_sums": """
      select customer_key, revenue_month, sum(attribution_percentage) as pct_sum,
             sum(attributed_revenue) as revenue_sum,
             max(subscription_monthly_value) as monthly_value, count(*) as row_count
      from fact_revenue_attribution group by customer_key, revenue_month""",
    "faulty_attribution": """
      select revenue_key, customer_key, revenue_month, subscription_monthly_value,
             case when mod(revenue_key, 11) = 0 then course_key + free_shift else course_key end as course_key,
             case when mod(revenue_key, 5) = 0 then attribution_percentage + 0.5
                  else attribution_percentage end as attribution_percentage,
             case when mod(revenue_key, 7) = 0 then -attributed_revenue
                  else attributed_revenue end as attributed_revenue,
             case when mod(revenue_key, 3) = 0 then instructor_royalty + 1
                  else instructor_royalty end as instructor_royalty
      from (select f.*, (select min(course_key) from dim_course where course_type = 'FREE')
              - course_key as free_shift from fact_revenue_attribution f)""",
    "faulty_sums": """
      select customer_key, revenue_month, sum(attribution_percentage) as pct_sum,
             sum(attributed_revenue) as revenue_sum, count(*) as row_count
      from faulty_attribution group by customer_key, revenue_month""",
}


def sql(select: str) -> str:
    """``select`` with every model it mentions, directly or not, in front."""
    needed: list[str] = []

    def need(text: str) -> None:
        for name in MODELS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                need(MODELS[name])
                if name not in needed:
                    needed.append(name)

    need(select)
    parts = [f"{name} as ({MODELS[name].strip()})" for name in needed]
    return f"with {', '.join(parts)} {select}" if parts else select


# Casts that make both engines show the same type and text.


def k(x: str, name: str | None = None) -> str:
    return f"cast({x} as bigint) as {name or x}"


def d(x: str, name: str | None = None) -> str:
    return f"cast({x} as double) as {name or x}"


def day(x: str, name: str | None = None) -> str:
    return f"strftime({x}, '%Y-%m-%d') as {name or x}"


def ts(x: str, name: str | None = None) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S') as {name or x}"


def columns(text: str) -> str:
    """``a b:k c:d`` as a select list; the letter picks the cast."""
    casts = {"k": k, "d": d, "day": day, "ts": ts}
    out = []
    for word in text.split():
        name, _, kind = word.partition(":")
        out.append(casts[kind](name) if kind else name)
    return ", ".join(out)


# Select list of each model.
SHOW = {
    "stg_customers": "customer_id:k first_paid_order_date:ts first_order_date:ts"
    " total_spent:d",
    "stg_orders": "order_id:k order_number order_created_at:ts customer_id:k line_items"
    " billing_address_country net_usd:d",
    "stg_courses": "course_name course_type course_instructor",
    "stg_consumption": "user_id:k course_name minutes_consumed:k consumption_month:day",
    "snap_customer": "customer_id:k first_paid_order_date:ts first_order_date:ts"
    " total_spent:d dbt_valid_from:ts dbt_valid_to:ts",
    "dim_course": "course_key:k course_name course_type course_instructor"
    " is_revenue_generating total_duration_minutes:k lesson_count:k enrollment_count:k",
    "dim_customer": "customer_key:k customer_id:k first_paid_order_date:ts"
    " first_order_date:ts total_spent:d customer_status effective_from_date:ts"
    " effective_to_date:ts is_current",
    "dim_customer_scd1": "customer_key:k customer_id:k first_paid_order_date:ts"
    " first_order_date:ts total_spent:d customer_status effective_from_date:ts"
    " effective_to_date:ts is_current",
    "fact_order": "order_key:k order_id:k order_number customer_key:k date_key:k"
    " order_created_at:ts line_items billing_country subscription_type"
    " subscription_tier subscription_interval_months:k net_amount_usd:d monthly_value:d"
    " is_first_order is_latest_order order_sequence:k",
    "fact_consumption": "consumption_key:k customer_key:k course_key:k date_key:k"
    " consumption_month:day total_minutes_consumed:k total_hours_consumed:d"
    " unique_sessions:k completion_percentage:d consumption_percentage_of_month:d"
    " is_revenue_eligible",
    "fact_revenue_attribution": "revenue_key:k customer_key:k course_key:k order_key:k"
    " date_key:k revenue_month:day subscription_type subscription_monthly_value:d"
    " course_minutes_consumed:k total_paid_minutes_consumed:k attribution_percentage:d"
    " attributed_revenue:d instructor_royalty:d is_free_course",
    "view_monthly_mrr_arr": "month:day mrr:d arr:d new_mrr:d churned_mrr:d"
    " expansion_mrr:d contraction_mrr:d net_new_mrr:d mrr_growth_rate_pct:d"
    " total_customers:k new_customers:k retained_customers:k"
    " customer_retention_rate_pct:d arpu:d quick_ratio:d",
    "view_course_revenue_monthly": "month:day course_name course_type instructor"
    " total_revenue:d avg_revenue_per_student:d total_minutes_consumed:k"
    " total_hours_consumed:d avg_minutes_per_student:d unique_students:k"
    " students_1plus_hours:k engagement_rate_pct:d total_instructor_royalty:d"
    " revenue_rank:k popularity_rank:k",
    "view_instructor_royalties_monthly": "month:day instructor courses_count:k"
    " total_course_revenue:d royalty_amount:d unique_students:k",
    "view_customer_subscription_status": "customer_id:k current_plan mrr:d start_date:ts"
    " last_order_date:ts total_spent:d status",
    "view_consumption_trends": "month:day course_name course_type instructor"
    " total_minutes:k unique_users:k avg_minutes_per_user:d total_hours:d",
}


def show(model: str) -> str:
    return sql(f"select {columns(SHOW[model])} from {model}")


def pick(model: str, cols: str, rest: str = "") -> str:
    """Some columns of a model, with an optional tail of the query."""
    return sql(f"select {columns(cols)} from {model} {rest}")
