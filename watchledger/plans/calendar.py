"""A day per row, with fiscal periods and holidays that move.

Facts carry ``date_key``, a day as the number YYYYMMDD, which is this table's key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchledger.functions import date_key

# Holidays by month and day, and by days after Easter Sunday.
FIXED_HOLIDAYS = {(1, 1): "New Year", (5, 1): "Labour Day", (12, 25): "Christmas", (12, 26): "St Stephen"}
EASTER_HOLIDAYS = {-2: "Good Friday", 0: "Easter Sunday", 1: "Easter Monday", 39: "Ascension", 50: "Whit Monday"}


def easter_sunday(year: Column) -> Column:
    """Easter of a year after 1582, from the full moon of the Gregorian calendar.

    The 14th day of the paschal moon is found from the year's place in the cycle of
    19 years and corrections by century; Easter is the Sunday after it.
    """

    def div(a: Column, b: int) -> Column:
        return F.call_function("div", a, F.lit(b))

    century = div(year, 100)
    golden = year % 19
    shift = century - div(century, 4) - div(century * 8 + 13, 25) + 15
    epact = (golden * 19 + shift) % 30
    # Two years of the cycle would fall on the same late moon.
    late = (epact == 29) | ((epact == 28) & (golden > 10))
    moon_day = (epact - late.cast("int")).cast("int")
    moon = F.date_add(F.make_date(year.cast("int"), F.lit(3), F.lit(21)), moon_day)
    return F.next_day(moon, "SUN")


def dim_date(days: DataFrame, fiscal_start: int = 1) -> DataFrame:
    """Every day of the years from the first to the last of column ``day``.

    ``days`` is reduced to its two ends; a fiscal year is named after the calendar
    year that it ends in and begins with month ``fiscal_start``.
    """
    ends = days.agg(
        F.trunc(F.min("day"), "year").alias("low"),
        F.last_day(F.add_months(F.trunc(F.max("day"), "year"), F.lit(11))).alias("high"),
    )
    each = ends.where("low is not null").select(
        F.explode(F.expr("sequence(low, high, interval 1 day)")).alias("day")
    )
    day = F.col("day")
    year, month = F.year(day), F.month(day)
    since = F.date_diff(day, easter_sunday(year))
    holiday = F.lit(None).cast("string")
    for (m, d), name in FIXED_HOLIDAYS.items():
        holiday = F.when((month == m) & (F.day(day) == d), name).otherwise(holiday)
    for after, name in EASTER_HOLIDAYS.items():
        holiday = F.when(since == after, name).otherwise(holiday)
    fiscal_month = (month + (12 - fiscal_start)) % 12 + 1
    fiscal_year = year + (month >= fiscal_start).cast("int") * (1 if fiscal_start > 1 else 0)
    weekday = F.weekday(day) + 1
    return each.select(
        date_key(day).alias("date_key"),
        "day",
        year.alias("year"),
        F.quarter(day).alias("quarter"),
        month.alias("month"),
        F.trunc(day, "month").alias("month_start"),
        (day == F.last_day(day)).alias("is_month_end"),
        F.weekofyear(day).alias("iso_week"),
        weekday.alias("weekday"),
        (weekday > 5).alias("is_weekend"),
        fiscal_year.alias("fiscal_year"),
        (F.floor((fiscal_month - 1) / 3) + 1).cast("int").alias("fiscal_quarter"),
        fiscal_month.alias("fiscal_month"),
        holiday.alias("holiday"),
    )


def days_without_date(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Date keys of a fact that the calendar lacks, with their rows."""
    counted = fact.where("date_key is not null").groupBy("date_key").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(dates.select("date_key"), "date_key", "left_anti")
