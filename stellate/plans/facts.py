"""Facts at explicit grains (MOD-11, MOD-12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stellate.functions.dates import day
from stellate.functions.numbers import zero_if
from stellate.operators.unpivot import unpivot_slots

# Player slot -> team.
TEAM_SLOTS = {"team1_player1": 1, "team1_player2": 1, "team2_player1": 2, "team2_player2": 2}

# How each fact is written: partition column, cluster columns, grain (see sinks.tables).
LAYOUT = {
    "fct_registration": ("registered_date", ("tournament_key", "club_key"), ("registration_id",)),
    "fct_match_participation": ("match_date", ("tournament_key", "player_key"), ("match_id", "team")),
}

# What the registration fact reads of the tournament dimension.
TOURNAMENT_COLUMNS = ("tournament_key", "club_key", "category", "surface")


def fct_registration(registrations: DataFrame, tournaments: DataFrame) -> DataFrame:
    """One row per staged registration of a known tournament; a refund counts as no revenue.

    No broadcast is asked for: Spark sends the dimension to all tasks while its bytes are under
    the session's threshold; above, a shuffle join splits hot tournaments.
    """
    tournament = tournaments.select(*TOURNAMENT_COLUMNS)
    refunded = F.col("payment_status") == "refunded"
    return registrations.join(tournament, F.col("tournament_id") == F.col("tournament_key")).select(
        "registration_id",
        day("registered_at").alias("registered_date"),
        "tournament_key",
        "club_key",
        F.col("player_id").alias("player_key"),
        F.col("partner_player_id").alias("partner_player_key"),
        "category",
        "surface",
        "payment_status",
        "is_paid",
        "amount_paid_cents",
        "amount_paid_aud",
        zero_if(refunded, F.col("amount_paid_cents")).alias("net_revenue_cents"),
        zero_if(refunded, F.col("amount_paid_aud")).alias("net_revenue_aud"),
    )


def fct_match_participation(matches: DataFrame) -> DataFrame:
    """One row per player of a staged match that was played; empty slots drop out."""
    played = matches.where(F.col("status") == "played").select(
        "match_id", "match_date", "tournament_id", "round", "status", "winner_team", *TEAM_SLOTS
    )
    players = unpivot_slots(played, TEAM_SLOTS, value="player_key", group="team")
    won = F.col("team") == F.col("winner_team")
    return players.where(F.col("player_key").isNotNull()).select(
        "match_id",
        "match_date",
        F.col("tournament_id").alias("tournament_key"),
        "player_key",
        "round",
        "team",
        "status",
        won.alias("is_winner"),
        won.cast("bigint").alias("win_flag"),
    )
