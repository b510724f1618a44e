"""Staging: typed, cleaned, one row per source row or key (MOD-1..6)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from stellate.functions.dates import AGE_AS_OF, day, days_inclusive, years_crossed
from stellate.functions.numbers import units
from stellate.functions.text import clean, clean_lower, clean_upper, gender_label
from stellate.operators.dedupe import latest_per_key


def stg_clubs(clubs: DataFrame) -> DataFrame:
    return clubs.select(
        "club_id",
        clean("name").alias("club_name"),
        clean("city").alias("city"),
        clean_upper("country").alias("country"),
        "created_at",
    )


def stg_players(players: DataFrame, as_of: dt.date = AGE_AS_OF) -> DataFrame:
    return players.select(
        "player_id",
        clean("full_name").alias("full_name"),
        clean_lower("email").alias("email"),
        clean_upper("country").alias("country"),
        gender_label("gender").alias("gender"),
        "date_of_birth",
        years_crossed("date_of_birth", as_of).alias("age_2026"),
        "created_at",
    )


def stg_tournaments(tournaments: DataFrame) -> DataFrame:
    return tournaments.select(
        "tournament_id",
        "club_id",
        clean("name").alias("tournament_name"),
        "category",
        "surface",
        "entry_fee_cents",
        units(F.col("entry_fee_cents")).alias("entry_fee_aud"),
        "currency",
        "max_teams",
        "start_date",
        "end_date",
        days_inclusive("start_date", "end_date").alias("duration_days"),
        "status",
        "created_at",
    )


def stg_registrations(registrations: DataFrame) -> DataFrame:
    """Replays are settled here: the latest row of each registration stays."""
    return latest_per_key(registrations, ["registration_id"], newest="registered_at").select(
        "registration_id",
        "tournament_id",
        "player_id",
        "partner_player_id",
        "seed",
        "amount_paid_cents",
        units(F.col("amount_paid_cents")).alias("amount_paid_aud"),
        "payment_status",
        (F.col("payment_status") == "paid").alias("is_paid"),
        "registered_at",
    )


def stg_payments(payments: DataFrame) -> DataFrame:
    return payments.select(
        "payment_id",
        "registration_id",
        "provider",
        "amount_cents",
        units(F.col("amount_cents")).alias("amount_aud"),
        "currency",
        "status",
        (F.col("status") == "refunded").alias("is_refunded"),
        "created_at",
    )


def stg_matches(matches: DataFrame) -> DataFrame:
    return matches.select(
        "match_id",
        "tournament_id",
        "round",
        "court",
        "scheduled_at",
        day("scheduled_at").alias("match_date"),
        "team1_player1",
        "team1_player2",
        "team2_player1",
        "team2_player2",
        "winner_team",
        "score",
        "status",
    )
