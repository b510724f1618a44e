"""Declared schemas of the landing tables (SRC-1, SRC-3); nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _columns(**types: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[t]) for name, t in types.items()])


# The column names and types of the source tables.
SCHEMAS = {
    "clubs": _columns(
        club_id="bigint",
        name="string",
        city="string",
        country="string",
        created_at="timestamp",
    ),
    "players": _columns(
        player_id="bigint",
        full_name="string",
        email="string",
        country="string",
        gender="string",
        date_of_birth="date",
        created_at="timestamp",
    ),
    "tournaments": _columns(
        tournament_id="bigint",
        club_id="bigint",
        name="string",
        category="string",
        surface="string",
        entry_fee_cents="bigint",
        currency="string",
        max_teams="bigint",
        start_date="date",
        end_date="date",
        status="string",
        created_at="timestamp",
    ),
    "registrations": _columns(
        registration_id="bigint",
        tournament_id="bigint",
        player_id="bigint",
        partner_player_id="bigint",
        seed="bigint",
        amount_paid_cents="bigint",
        payment_status="string",
        registered_at="timestamp",
    ),
    "payments": _columns(
        payment_id="bigint",
        registration_id="bigint",
        provider="string",
        amount_cents="bigint",
        currency="string",
        status="string",
        created_at="timestamp",
    ),
    "matches": _columns(
        match_id="bigint",
        tournament_id="bigint",
        round="string",
        court="string",
        scheduled_at="timestamp",
        team1_player1="bigint",
        team1_player2="bigint",
        team2_player1="bigint",
        team2_player2="bigint",
        winner_team="bigint",
        score="string",
        status="string",
    ),
}

# The primary key of each source table.
PRIMARY_KEYS = {
    "clubs": "club_id",
    "players": "player_id",
    "tournaments": "tournament_id",
    "registrations": "registration_id",
    "payments": "payment_id",
    "matches": "match_id",
}
