import datetime as dt

import pytest
from pyspark.sql import functions as F

from stellate.functions.dates import days_inclusive, is_weekend, month_text, years_crossed
from stellate.functions.numbers import band, money, round_up_half, units, zero_if
from stellate.functions.text import clean, clean_lower, clean_upper, gender_label
from stellate.plans.dimensions import AGE_BANDS, LAST_AGE_BAND


def values(spark, schema, inputs, column):
    # The inputs may hold None, so the result is read by position.
    numbered = [(i, *v) if isinstance(v, tuple) else (i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(numbered, "i int, " + schema)
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_clean_strips_all_white_space(spark):
    texts = ["\tx y", "x y\n", " x y　", "  x y  ", "x y", " \u0085x y\r\n", "", " ", None]
    got = values(spark, "t string", texts, clean("t"))
    assert got == ["x y"] * 6 + ["", "", None]


def test_clean_agrees_with_the_unicode_property(spark):
    every = [(chr(c) + "x",) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame(every, "t string")
    by_regex = F.regexp_replace("t", r"(?U)^\s+|\s+$", "")
    assert df.where(clean("t") != by_regex).count() == 0


def test_clean_case(spark):
    assert values(spark, "t string", [" aB\t", None], clean_upper("t")) == ["AB", None]
    assert values(spark, "t string", [" aB\t", None], clean_lower("t")) == ["ab", None]


def test_gender_is_upper_cased_but_not_trimmed(spark):
    got = values(spark, "g string", ["M", "m", "f", "F", "x", "", None, " m"], gender_label("g"))
    assert got == ["Male", "Male", "Female", "Female", "Unknown", "Unknown", "Unknown", "Unknown"]


def test_age_counts_calendar_years(spark):
    births = [dt.date(2008, 12, 31), dt.date(2008, 1, 1), None]
    assert values(spark, "d date", births, years_crossed("d", dt.date(2026, 1, 1))) == [18, 18, None]


def test_age_bands_and_unknown_age(spark):
    ages = [17, 18, 29, 30, 44, 45, 59, 60, None]
    got = values(spark, "a bigint", ages, band(F.col("a"), AGE_BANDS, LAST_AGE_BAND))
    assert got == ["Under 18", "18-29", "18-29", "30-44", "30-44", "45-59", "45-59", "60+", "60+"]


def test_duration_includes_both_days(spark):
    first = dt.date(2024, 2, 28)
    spans = [(first, first), (first, dt.date(2024, 3, 1)), (first, None)]
    assert values(spark, "s date, e date", spans, days_inclusive("s", "e")) == [1, 3, None]


def test_weekend_and_month(spark):
    days = [dt.date(2024, 3, 2), dt.date(2024, 3, 3), dt.date(2024, 3, 4)]
    assert values(spark, "d date", days, is_weekend("d")) == [True, True, False]
    assert values(spark, "d date", days, month_text("d")) == ["2024-03"] * 3


@pytest.mark.parametrize("n,d,expected", [(1, 8, 0.13), (5, 8, 0.63), (2, 3, 0.67), (1, 200, 0.01)])
def test_round_up_half(spark, n, d, expected):
    assert values(spark, "n bigint, d bigint", [(n, d)], round_up_half(F.col("n") / F.col("d"))) == [expected]


def test_money(spark):
    cents = [0, 1, 4005, 999999, -250, None]
    assert values(spark, "c bigint", cents, units(F.col("c"))) == [0.0, 0.01, 40.05, 9999.99, -2.5, None]
    assert values(spark, "c bigint", cents, money(F.col("c"))) == [0.0, 0.01, 40.05, 9999.99, -2.5, None]


def test_zero_if_keeps_the_value_for_an_unknown_condition(spark):
    pairs = [(True, 7), (False, 7), (None, 7)]
    assert values(spark, "c boolean, v bigint", pairs, zero_if(F.col("c"), F.col("v"))) == [0, 7, 7]
