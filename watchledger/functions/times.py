"""Timestamps without a zone, so that month cuts never depend on the session."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


# Day-first text and its ISO form, by the digits of the year.
# Two-digit years from 70 on belong to the 1900s, the others to the 2000s. The
# time may be missing; what follows the minutes is ignored.
DAY_FIRST = r"^\s*(\d{1,2})/(\d{1,2})/(YEAR)(?!\d)\s*((?:\d{1,2}(?::\d{1,2})?)?).*$"
ISO_FORMS = (
    (r"[0-6]\d", "20$3-$2-$1 $4"),
    (r"[7-9]\d", "19$3-$2-$1 $4"),
    (r"\d{4}", "$3-$2-$1 $4"),
)


def parse_mixed_timestamp(text: Column) -> Column:
    """Day-first text with slashes, ISO text with dashes, otherwise null.

    Text that has the separator but is no date gives null as well. Rewriting
    to ISO keeps each value to one cast: taking it apart piece by piece
    evaluates the same pieces over and over inside the CASE.
    """
    iso = text
    for year, form in ISO_FORMS:
        iso = F.regexp_replace(iso, DAY_FIRST.replace("YEAR", year), form)
    return F.when(text.contains("/"), iso.try_cast("timestamp_ntz")).when(
        text.contains("-"), text.try_cast("timestamp_ntz")
    )


def date_key(when: Column) -> Column:
    """Date as the whole number ``YYYYMMDD``."""
    key = F.year(when) * 10_000 + F.month(when) * 100 + F.day(when)
    return key.cast("long")


def month_start(when: Column) -> Column:
    return F.trunc(when, "month")


def recency_status(last: Column, as_of: dt.date, at_risk_days: int) -> Column:
    """ACTIVE, AT_RISK, CHURNED or UNKNOWN by the date of the last order."""
    day = F.lit(as_of.isoformat()).cast("date")
    at = day.cast("timestamp_ntz")
    edge = F.date_sub(day, at_risk_days).cast("timestamp_ntz")
    return (
        F.when(last >= at, "ACTIVE")
        .when(last >= edge, "AT_RISK")
        .when(last.isNotNull(), "CHURNED")
        .otherwise("UNKNOWN")
    )
