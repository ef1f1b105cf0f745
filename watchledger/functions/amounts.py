"""Exact decimal arithmetic.

A decimal division that runs out of digits and is then rounded again can land
on the wrong side of a half. The ratios below therefore stay in integers until
the last step and round half away from zero once.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up_ratio(num: Column, den: Column, places: int) -> Column:
    """``num / den`` of two longs to ``places``; null if ``den`` is 0.

    Long arithmetic, so that wide results stay fast. A numerator too large to
    be doubled and scaled fails instead of wrapping around (ANSI mode).
    """
    n = num.cast("long")
    d = F.nullif(den.cast("long"), F.lit(0).cast("long"))
    doubled = F.abs(n) * (2 * 10**places) + F.abs(d)
    rounded = F.call_function("div", doubled, F.abs(d) * 2)
    signed = F.when((n < 0) != (d < 0), -rounded).otherwise(rounded)
    return _shift(signed, places, 18)


def half_up_ratio_wide(num: Column, den: Column, places: int) -> Column:
    """The same for whole numbers of up to 30 digits, for a few grand totals."""
    n = num.cast("decimal(30,0)")
    d = F.nullif(den.cast("decimal(30,0)"), F.lit(0).cast("decimal(30,0)"))
    scale = F.lit(Decimal(2 * 10**places))
    doubled, divisor = F.abs(n) * scale + F.abs(d), F.abs(d) * F.lit(Decimal(2))
    # Dividing what is left without the remainder is exact, and unlike ``div``
    # it fails on a quotient that does not fit instead of wrapping around.
    rounded = ((doubled - doubled % divisor) / divisor).cast("decimal(24,0)")
    signed = F.when((n < 0) != (d < 0), -rounded).otherwise(rounded)
    return _shift(signed, places, 24)


def cents(amount: Column) -> Column:
    return (amount * F.lit(Decimal(100))).cast("decimal(28,0)")


def mean_of_amounts(total: Column, count: Column) -> Column:
    """Mean of amounts with two decimals, half up to cents."""
    whole = half_up_ratio(cents(total), count, 0)
    return (whole * F.lit(Decimal("0.01"))).cast("decimal(20,2)")


def share_4dp(part: Column, whole: Column) -> Column:
    """Share of a whole to four places."""
    return half_up_ratio(part, whole, 4).cast("decimal(9,4)")


def amortize_monthly(yearly: Column, months: int = 12) -> Column:
    """A price for several months as a price for one, half up to cents."""
    return F.round(yearly / F.lit(Decimal(f"{months}.0")), 2)


def minutes_to_hours(minutes: Column) -> Column:
    return half_up_ratio(minutes, F.lit(60), 2)


def _shift(whole: Column, places: int, digits: int) -> Column:
    whole = whole.cast(f"decimal({digits},0)")
    if places == 0:
        return whole
    return whole * F.lit(Decimal(1).scaleb(-places))
