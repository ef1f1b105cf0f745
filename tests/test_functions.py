import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from watchledger import functions as L

DATES = [
    ("05/10/95 13:45", dt.datetime(1995, 10, 5, 13, 45)),
    ("05/10/22 13:45", dt.datetime(2022, 10, 5, 13, 45)),
    ("1/2/69 9:05", dt.datetime(2069, 2, 1, 9, 5)),
    ("01/02/70 00:00", dt.datetime(1970, 2, 1)),
    ("31/12/2021 23:59", dt.datetime(2021, 12, 31, 23, 59)),
    ("05/10/22", dt.datetime(2022, 10, 5)),
    (" 05/10/22  7:08 ", dt.datetime(2022, 10, 5, 7, 8)),
    ("05/10/22 13:45:59", dt.datetime(2022, 10, 5, 13, 45)),
    ("31/02/22 10:00", None),
    ("5/x/22 10:00", None),
    ("2022-10-05 13:45:00", dt.datetime(2022, 10, 5, 13, 45)),
    ("2022-10-05", dt.datetime(2022, 10, 5)),
    ("n-a", None),
    ("n/a", None),
    ("20221005", None),
    ("", None),
    (None, None),
]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_mixed_timestamps(spark):
    df = spark.createDataFrame([(t,) for t, _ in DATES], "t string")
    got = df.select(L.parse_mixed_timestamp(F.col("t")).alias("x"))
    assert got.schema["x"].dataType.simpleString() == "timestamp_ntz"
    assert [r.x for r in got.collect()] == [want for _, want in DATES]


def test_timestamps_do_not_follow_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    try:
        when = L.parse_mixed_timestamp(F.lit("2022-10-31 23:30:00"))
        assert one(spark, L.month_start(when)) == dt.date(2022, 10, 1)
        assert one(spark, L.date_key(when)) == 20221031
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "num, den, places, want",
    [
        (1, 8, 2, "0.13"),
        (-1, 8, 2, "-0.13"),
        (1, -8, 2, "-0.13"),
        (1, 3, 4, "0.3333"),
        (2, 3, 0, "1"),
        (5, 10, 0, "1"),
        (4, 10, 0, "0"),
    ],
)
def test_ratio_is_half_up(spark, num, den, places, want):
    assert one(spark, L.half_up_ratio(F.lit(num), F.lit(den), places)) == Decimal(want)
    wide = one(spark, L.half_up_ratio_wide(F.lit(num), F.lit(den), places))
    assert wide == Decimal(want)


def test_large_ratios_are_right_or_fail(spark):
    num = F.lit(str(10**20 + 5)).cast("decimal(30,0)")
    wide = one(spark, L.half_up_ratio_wide(num, F.lit(10), 0))
    assert wide == Decimal("10000000000000000001")
    for digits in (17, 20):
        num = F.lit(str(10**digits)).cast("decimal(30,0)")
        with pytest.raises(Exception, match="OVERFLOW|OUT_OF_RANGE|overflow"):
            one(spark, L.half_up_ratio(num, F.lit(3), 4))


def test_ratio_matches_exact_arithmetic(spark):
    from fractions import Fraction
    from math import floor

    pairs = [(n * 7919 % 100_003, n * 104_729 % 997 + 1) for n in range(3000)]
    df = spark.createDataFrame(pairs, "n long, d long")
    rows = df.select(
        "n",
        "d",
        L.half_up_ratio(F.col("n"), F.col("d"), 2).alias("two"),
        L.share_4dp(F.col("n"), F.col("d")).alias("four"),
    ).collect()
    for r in rows:
        exact = Fraction(r.n, r.d)
        assert Fraction(r.two) == Fraction(floor(exact * 100 + Fraction(1, 2)), 100)
        assert Fraction(r.four) == Fraction(floor(exact * 10**4 + Fraction(1, 2)), 10**4)


def test_zero_divisors_give_null(spark):
    zero = F.lit(0).cast("long")
    assert one(spark, L.half_up_ratio(F.lit(3), zero, 2)) is None
    assert one(spark, L.share_4dp(F.lit(3), zero)) is None
    assert one(spark, L.half_up_ratio_wide(F.lit(3), zero, 2)) is None


def test_amounts(spark):
    price = F.lit(Decimal("150.00")).cast("decimal(12,2)")
    assert one(spark, L.amortize_monthly(price)) == Decimal("12.50")
    refund = F.lit(Decimal("-0.18")).cast("decimal(12,2)")
    assert one(spark, L.amortize_monthly(refund)) == Decimal("-0.02")
    assert one(spark, L.minutes_to_hours(F.lit(100))) == Decimal("1.67")
    mean = L.mean_of_amounts(F.lit(Decimal("-0.05")), F.lit(2))
    assert one(spark, mean) == Decimal("-0.03")


def test_texts(spark):
    assert one(spark, L.blank_to_null(F.lit("  "))) is None
    assert one(spark, L.blank_to_null(F.lit(" 7 "))) == "7"
    assert one(spark, L.is_filled(F.lit("  "))) is False
    rules = (("YEARLY", "Y"), ("MONTHLY", "M"))
    assert one(spark, L.first_match(F.lit("monthly to yearly"), rules)) == "Y"
    assert one(spark, L.first_match(F.lit("a monthly plan"), rules)) == "M"
    assert one(spark, L.first_match(F.lit("pack"), rules)) is None
    assert one(spark, L.first_match(F.lit(None).cast("string"), rules)) is None


@pytest.mark.parametrize(
    "last, want",
    [
        ("2022-10-01 00:00:00", "ACTIVE"),
        ("2022-09-30 23:59:59", "AT_RISK"),
        ("2022-07-03 00:00:00", "AT_RISK"),
        ("2022-07-02 23:59:59", "CHURNED"),
        (None, "UNKNOWN"),
    ],
)
def test_recency(spark, last, want):
    at = F.lit(last).cast("timestamp_ntz")
    assert one(spark, L.recency_status(at, dt.date(2022, 10, 1), 90)) == want
