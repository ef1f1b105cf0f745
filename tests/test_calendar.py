"""The calendar over more than thirty years."""

import datetime as dt

from dateutil.easter import easter
from pyspark.sql import functions as F

from watchledger.plans import calendar


def made(spark, first, last, **how):
    return calendar.dim_date(spark.createDataFrame([(first,), (last,)], "day date"), **how)


def test_days_weeks_and_easter(spark):
    rows = made(spark, dt.date(1990, 5, 3), dt.date(2030, 2, 1)).collect()
    days = [dt.date(1990, 1, 1) + dt.timedelta(i) for i in range((dt.date(2031, 1, 1) - dt.date(1990, 1, 1)).days)]
    assert sorted(r.day for r in rows) == days
    for r in rows:
        d = r.day
        assert r.date_key == int(d.strftime("%Y%m%d")) and (r.iso_week, r.weekday) == d.isocalendar()[1:]
        assert (r.year, r.month, r.quarter, r.is_weekend) == (d.year, d.month, (d.month + 2) // 3, d.isoweekday() > 5)
        assert r.is_month_end == ((d + dt.timedelta(1)).day == 1) and r.month_start == d.replace(day=1)
        assert (r.fiscal_year, r.fiscal_quarter, r.fiscal_month) == (d.year, (d.month + 2) // 3, d.month)
    found = {r.day: r.holiday for r in rows}
    for year in range(1990, 2031):
        sunday = easter(year)
        assert found[sunday] == "Easter Sunday"
        for after, name in calendar.EASTER_HOLIDAYS.items():
            assert found[sunday + dt.timedelta(after)] == name
        assert found[dt.date(year, 12, 25)] == "Christmas"
    assert sum(h == "Easter Sunday" for h in found.values()) == 41


def test_easter_over_centuries(spark):
    years = spark.range(1583, 2600).select("id", calendar.easter_sunday(F.col("id")).alias("e"))
    assert all(r.e == easter(r.id) for r in years.collect())


def test_fiscal_years_and_nothing(spark):
    rows = {r.day: r for r in made(spark, dt.date(2022, 1, 1), dt.date(2022, 1, 1), fiscal_start=4).collect()}
    march, april = rows[dt.date(2022, 3, 31)], rows[dt.date(2022, 4, 1)]
    assert (march.fiscal_year, march.fiscal_quarter, march.fiscal_month) == (2022, 4, 12)
    assert (april.fiscal_year, april.fiscal_quarter, april.fiscal_month) == (2023, 1, 1)
    assert calendar.dim_date(spark.createDataFrame([], "day date")).collect() == []


def test_days_that_the_calendar_lacks(spark):
    dates = made(spark, dt.date(2022, 1, 1), dt.date(2022, 1, 1))
    fact = spark.createDataFrame([(20220505,), (20230101,), (20230101,), (None,)], "date_key long")
    assert [tuple(r) for r in calendar.days_without_date(fact, dates).collect()] == [(20230101, 2)]
