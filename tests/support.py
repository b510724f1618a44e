"""Small clean source tables, and helpers to change single rows of them."""

from __future__ import annotations

import datetime as dt

from stellate.sources.schemas import SCHEMAS


def ts(text):
    return None if text is None else dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def day(text):
    return None if text is None else dt.date.fromisoformat(text)


CLUBS = [
    dict(club_id=1, name="  North Court ", city="Oslo\n", country="no", created_at=ts("2022-05-01T10:00:00")),
    dict(club_id=2, name="South Court", city="Rome", country="IT", created_at=ts("2022-06-01T23:59:59")),
]
PLAYERS = [
    dict(
        player_id=i,
        full_name=f" Player {i}",
        email=f" P{i}@Example.com",
        country="es" if i % 2 else "ES",
        gender="MfX"[i % 3],
        date_of_birth=day(f"{1960 + 7 * i}-06-15"),
        created_at=ts(f"2023-0{1 + i % 3}-10T08:00:00"),
    )
    for i in range(1, 7)
]
TOURNAMENTS = [
    dict(
        tournament_id=i,
        club_id=1 + i % 2,
        name=f"Cup {i} ",
        category="Open",
        surface="Indoor",
        entry_fee_cents=5000,
        currency="AUD",
        max_teams=4,
        start_date=day("2024-03-01"),
        end_date=day("2024-03-03"),
        status="completed",
        created_at=ts("2024-01-01T00:00:00"),
    )
    for i in (1, 2)
]
REGISTRATIONS = [
    dict(
        registration_id=i,
        tournament_id=1 + i % 2,
        player_id=1 + i % 6,
        partner_player_id=1 + (i + 1) % 6,
        seed=None,
        amount_paid_cents={"paid": 5000, "refunded": 5000}.get(status, 0),
        payment_status=status,
        registered_at=ts(f"2024-0{1 + i % 2}-15T12:00:00"),
    )
    for i, status in enumerate(["paid", "paid", "refunded", "waived", "pending", "paid"], start=1)
]
PAYMENTS = [
    dict(
        payment_id=10 + i,
        registration_id=i,
        provider="stripe" if i % 2 else "paypal",
        amount_cents=5000,
        currency="AUD",
        status="refunded" if i == 3 else "succeeded",
        created_at=ts("2024-01-15T12:00:00"),
    )
    for i in (1, 2, 3, 6)
]
MATCHES = [
    dict(
        match_id=i,
        tournament_id=1,
        round="QF",
        court="Court 1",
        scheduled_at=ts(f"2024-03-0{1 + i % 3}T09:00:00"),
        team1_player1=1,
        team1_player2=2,
        team2_player1=3,
        team2_player2=4,
        winner_team=1 if i != 4 else 2,
        score="6-3 6-4",
        status="played",
    )
    for i in range(1, 6)
]
CLEAN = {
    "clubs": CLUBS,
    "players": PLAYERS,
    "tournaments": TOURNAMENTS,
    "registrations": REGISTRATIONS,
    "payments": PAYMENTS,
    "matches": MATCHES,
}


def frame(spark, table, rows):
    schema = SCHEMAS[table]
    return spark.createDataFrame([tuple(r[c] for c in schema.names) for r in rows], schema)


def sources(spark, **changed):
    """The clean tables, with whole tables replaced."""
    return {table: frame(spark, table, changed.get(table, rows)) for table, rows in CLEAN.items()}


def rows(df):
    """Rows as dicts, in an order that does not depend on the plan."""
    return sorted((r.asDict() for r in df.collect()), key=lambda r: repr(list(r.values())))


def plan(df):
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The physical plan after adaptive changes; runs the query."""
    df.collect()
    return plan(df)
