"""Generated scan of a date range (SRC-5, SC-15)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F


def date_range(spark: SparkSession, start: dt.date, end: dt.date, name: str = "date_key") -> DataFrame:
    """One row per day; its size is fixed by the two dates, not by the data."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(0, 1, 1, 1).select(F.explode(days).alias(name))


def years_spanned(df: DataFrame, column: str, name: str = "date_key") -> DataFrame:
    """One row per day of the whole years from the column's first day to its last."""
    ends = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    start = F.trunc("first", "year")
    end = F.last_day(F.add_months(F.trunc("last", "year"), 11))
    return ends.select(F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias(name))
