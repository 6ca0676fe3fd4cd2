"""Packed dates and birth numbers (F-1 ... F-6), edge rows of the fixtures."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions import dates


def _one(spark, expr, value, t="bigint"):
    return spark.createDataFrame([(value,)], f"x {t}").select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("packed,expected", [
    (930101, dt.date(1993, 1, 1)), (981231, dt.date(1998, 12, 31)), (991231, dt.date(1999, 12, 31)),
    (101, dt.date(2000, 1, 1)), (1017, dt.date(2000, 10, 17)), (41229, dt.date(2004, 12, 29)),
    (850101, dt.date(1985, 1, 1)),
])
def test_transaction_date(spark, packed, expected):
    assert _one(spark, dates.transaction_date, packed) == expected


@pytest.mark.parametrize("packed,expected", [
    (930101, dt.date(1993, 1, 1)), (1017, dt.date(2000, 10, 17)), (850101, dt.date(2085, 1, 1)),
])
def test_account_open_date(spark, packed, expected):
    assert _one(spark, dates.account_open_date, packed) == expected


def test_bad_date_rejects_or_fails(spark):
    bad = 991332  # month 13, day 32
    assert _one(spark, lambda c: dates.transaction_date(c, strict=False), bad) is None
    with pytest.raises(Exception):
        _one(spark, dates.transaction_date, bad)


@pytest.mark.parametrize("bn,gender,born", [
    (700101, "M", dt.date(1970, 1, 1)),
    (755502, "F", dt.date(1975, 5, 2)),
    (706213, "F", dt.date(1970, 12, 13)),   # 62 > 50: the rule makes it a woman
    (10203, "M", dt.date(1901, 2, 3)),      # padded
])
def test_birth_number(spark, bn, gender, born):
    assert _one(spark, dates.gender, bn) == gender
    assert _one(spark, dates.birth_date, bn) == born


def test_birth_number_month_zero_is_rejected(spark):
    assert _one(spark, lambda c: dates.birth_date(c, strict=False), 5001) is None


def test_age_is_calendar_year_difference(spark):
    # Born 1970-12-13: completed years on 1998-12-31 are 28, calendar difference 28;
    # born 1970-01-01 -> 28 as well; the rule ignores month and day.
    df = spark.createDataFrame([(dt.date(1970, 12, 31),), (dt.date(1970, 1, 1),)], "d date")
    ages = [r[0] for r in df.select(dates.age_at_end_of_dataset("d")).collect()]
    assert ages == [28, 28]


def test_to_yymmdd_loses_leading_zero(spark):
    df = spark.createDataFrame([(dt.date(2000, 1, 1),), (dt.date(1999, 12, 31),)], "d date")
    assert [r[0] for r in df.select(dates.to_yymmdd("d")).collect()] == [101, 991231]
