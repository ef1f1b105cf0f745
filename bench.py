"""Time the headline queries and print one JSON line.

``build_pipeline`` runs everything from the source files: raw, staging,
history, dimensions, facts, views and checks. Every other entry runs on stored
tables of the layer below, as it does in a warehouse. Results are written to a
sink that evaluates each row and column and keeps nothing.
"""

from __future__ import annotations

import json
import os
import time

from watchledger import build_session
from watchledger.plans import build, facts, quality, views
from watchledger.operators import number_rows
from watchledger.sources.commerce import SECOND_LOAD
from workload.context import Context


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, action):
        start = time.perf_counter()
        result = action()
        if result is not None:
            run(result)
        seconds[name] = round(time.perf_counter() - start, 3)

    run(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count())  # warm up
    c = Context(spark, folder)

    def whole_build():
        history = c.first_snapshot
        out = c.scratch.folder("bench-warehouse")
        built = build.build_warehouse(
            spark, c.raw_tables, out, SECOND_LOAD, c.settings, history=history
        )
        for name, df in built.views.items():
            if name.startswith("view_"):
                run(df)
        run(built.checks)
        return None

    timed("build_pipeline", whole_build)

    dim_customer, dim_course = c.dim_customer, c.dim_course
    orders, consumption = c.fact_order, c.fact_consumption
    attribution = c.fact_revenue_attribution
    settings, scratch = c.settings, c.scratch

    def attribution_again():
        return facts.fact_revenue_attribution(orders, consumption, settings, scratch)

    timed("fact_order", lambda: facts.fact_order(
        c.stg_orders, dim_customer, settings, scratch))
    timed("fact_consumption", lambda: facts.fact_consumption(
        c.stg_consumption, dim_customer, dim_course, settings, scratch))
    timed("fact_revenue_attribution", attribution_again)
    timed("view_monthly_mrr_arr", lambda: views.view_monthly_mrr_arr(attribution))
    def course_revenue():
        months = views.course_months(attribution, dim_course, settings, scratch)
        return views.view_course_revenue_monthly(scratch.stage(months, "months"))

    timed("view_course_revenue_monthly", course_revenue)
    timed("view_instructor_royalties_monthly",
          lambda: views.view_instructor_royalties_monthly(attribution, dim_course))
    timed("view_customer_subscription_status",
          lambda: views.view_customer_subscription_status(
              dim_customer, orders, settings))
    timed("view_consumption_trends",
          lambda: views.view_consumption_trends(consumption, dim_course))
    timed("surrogate_key_dense", lambda: number_rows(
        consumption.drop("consumption_key"),
        ["customer_key", "course_key", "consumption_month"], scratch, "n"))
    tables = {**c.model_tables(), "fact_revenue_attribution": attribution}
    timed("build_checks", lambda: quality.build_tests(tables))
    timed("revenue_checks", lambda: quality.revenue_checks(attribution))

    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
