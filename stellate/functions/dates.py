"""Date parts, differences and formats (SC-7..14, SC-22); all in UTC (see session.py)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# The day ages are taken at, and the calendar's default range.
AGE_AS_OF = dt.date(2026, 1, 1)
CALENDAR_START = dt.date(2023, 1, 1)
CALENDAR_END = dt.date(2026, 12, 31)

WEEKEND = (1, 7)  # Sunday is 1


def day(ts: Column | str) -> Column:
    return F.to_date(ts)


def month_text(value: Column | str) -> Column:
    return F.date_format(value, "yyyy-MM")


def years_crossed(start: Column | str, end: dt.date) -> Column:
    """Calendar-year boundaries between two dates (not completed years)."""
    return F.lit(end.year).cast("bigint") - F.year(start)


def days_inclusive(start: Column | str, end: Column | str) -> Column:
    return (F.datediff(end, start) + 1).cast("bigint")


def is_weekend(date: Column | str) -> Column:
    return F.dayofweek(date).isin(*WEEKEND)
