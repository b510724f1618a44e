"""Dimensions; business keys are the dimension keys (MOD-7..10)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from stellate.functions.dates import CALENDAR_END, CALENDAR_START, day, is_weekend, month_text
from stellate.functions.numbers import band
from stellate.operators.calendar import date_range, years_spanned

# Age bands by exclusive upper bound, and the band above them.
AGE_BANDS = ((18, "Under 18"), (30, "18-29"), (45, "30-44"), (60, "45-59"))
LAST_AGE_BAND = "60+"


def dim_date(spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END) -> DataFrame:
    """Every day of a fixed range."""
    return _calendar(date_range(spark, start, end))


def dim_date_of(df: DataFrame, column: str) -> DataFrame:
    """Every day of the years a timestamp column covers."""
    return _calendar(years_spanned(df.select(day(column).alias("day")), "day"))


def _calendar(days: DataFrame) -> DataFrame:
    return days.select(
        "date_key",
        F.year("date_key").cast("bigint").alias("year"),
        F.quarter("date_key").cast("bigint").alias("quarter"),
        F.month("date_key").cast("bigint").alias("month"),
        month_text("date_key").alias("year_month"),
        F.date_format("date_key", "MMMM").alias("month_name"),
        F.dayofmonth("date_key").cast("bigint").alias("day_of_month"),
        F.dayofweek("date_key").cast("bigint").alias("day_of_week"),
        F.date_format("date_key", "EEEE").alias("day_name"),
        is_weekend("date_key").alias("is_weekend"),
    )


def dim_player(players: DataFrame) -> DataFrame:
    """From staged players."""
    return players.select(
        F.col("player_id").alias("player_key"),
        "full_name",
        "email",
        "country",
        "gender",
        "date_of_birth",
        "age_2026",
        band(F.col("age_2026"), AGE_BANDS, LAST_AGE_BAND).alias("age_band"),
        day("created_at").alias("joined_date"),
    )


def dim_club(clubs: DataFrame) -> DataFrame:
    """From staged clubs."""
    return clubs.select(
        F.col("club_id").alias("club_key"),
        "club_name",
        "city",
        "country",
        day("created_at").alias("opened_date"),
    )


# What the tournament dimension reads of the staged clubs.
CLUB_COLUMNS = ("club_id", "club_name", "city", "country")


def dim_tournament(tournaments: DataFrame, clubs: DataFrame) -> DataFrame:
    """From staged tournaments and clubs; a tournament of an unknown club keeps NULL club columns.

    No broadcast is asked for: Spark broadcasts the clubs while they are under its
    threshold and shuffles both sides beyond it.
    """
    club = clubs.select(*CLUB_COLUMNS).withColumnsRenamed({"city": "club_city", "country": "club_country"})
    return tournaments.join(club, "club_id", "left").select(
        F.col("tournament_id").alias("tournament_key"),
        "tournament_name",
        "category",
        "surface",
        "currency",
        "entry_fee_aud",
        "max_teams",
        "start_date",
        "end_date",
        "duration_days",
        "status",
        F.col("club_id").alias("club_key"),
        "club_name",
        "club_city",
        "club_country",
    )
