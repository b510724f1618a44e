import datetime as dt

import pytest
from pyspark.errors import PySparkException

from stellate.plans import dimensions, facts, marts, reports, staging
from tests.support import CLUBS, MATCHES, PAYMENTS, PLAYERS, REGISTRATIONS, TOURNAMENTS, frame, rows, ts


def registration_fact(spark, registrations, tournaments=TOURNAMENTS, clubs=CLUBS):
    staged = staging.stg_registrations(frame(spark, "registrations", registrations))
    return facts.fct_registration(staged, tournament_dim(spark, tournaments, clubs))


def tournament_dim(spark, tournaments=TOURNAMENTS, clubs=CLUBS):
    return dimensions.dim_tournament(
        staging.stg_tournaments(frame(spark, "tournaments", tournaments)),
        staging.stg_clubs(frame(spark, "clubs", clubs)),
    )


def player_dim(spark, players=PLAYERS):
    return dimensions.dim_player(staging.stg_players(frame(spark, "players", players)))


def participation_fact(spark, matches):
    return facts.fct_match_participation(staging.stg_matches(frame(spark, "matches", matches)))


# Staging


def test_staged_clubs_and_players(spark):
    club = rows(staging.stg_clubs(frame(spark, "clubs", CLUBS[:1])))[0]
    assert (club["club_name"], club["city"], club["country"]) == ("North Court", "Oslo", "NO")
    player = rows(staging.stg_players(frame(spark, "players", PLAYERS[:1])))[0]
    assert player["full_name"] == "Player 1" and player["email"] == "p1@example.com"
    assert player["country"] == "ES" and player["gender"] == "Female" and player["age_2026"] == 2026 - 1967


def test_age_reference_day_is_a_parameter(spark):
    players = frame(spark, "players", PLAYERS[:1])
    assert rows(staging.stg_players(players, dt.date(2030, 1, 1)))[0]["age_2026"] == 2030 - 1967


def test_staged_tournaments(spark):
    got = rows(staging.stg_tournaments(frame(spark, "tournaments", TOURNAMENTS[:1])))[0]
    assert got["tournament_name"] == "Cup 1"
    assert got["entry_fee_aud"] == 50.0 and got["duration_days"] == 3


def test_staged_registrations_keep_the_latest_version(spark):
    first = REGISTRATIONS[0]
    versions = [
        first,
        {**first, "payment_status": "refunded", "registered_at": ts("2024-09-01T00:00:00")},
        {**first, "payment_status": "waived", "registered_at": None},
        {**REGISTRATIONS[1], "payment_status": None},
    ]
    got = rows(staging.stg_registrations(frame(spark, "registrations", versions)))
    assert [(r["registration_id"], r["payment_status"], r["is_paid"]) for r in got] == [
        (1, "refunded", False),
        (2, None, None),
    ]


def test_staged_payments_and_matches(spark):
    changed = [{**PAYMENTS[0], "status": s} for s in ("refunded", "failed", None)]
    got = staging.stg_payments(frame(spark, "payments", changed)).collect()
    assert [(r.is_refunded, r.amount_aud) for r in got] == [(True, 50.0), (False, 50.0), (None, 50.0)]
    late = {**MATCHES[0], "scheduled_at": ts("2024-03-01T23:59:59")}
    unset = {**MATCHES[0], "scheduled_at": None}
    got = staging.stg_matches(frame(spark, "matches", [late, unset])).collect()
    assert [r.match_date for r in got] == [dt.date(2024, 3, 1), None]


# Dimensions


def test_calendar(spark):
    got = dimensions.dim_date(spark, dt.date(2024, 2, 28), dt.date(2024, 3, 3)).collect()
    assert len(got) == 5
    assert got[-1].asDict() == dict(
        date_key=dt.date(2024, 3, 3),
        year=2024,
        quarter=1,
        month=3,
        year_month="2024-03",
        month_name="March",
        day_of_month=3,
        day_of_week=1,
        day_name="Sunday",
        is_weekend=True,
    )
    assert [r.is_weekend for r in got] == [False, False, False, True, True]
    assert dimensions.dim_date(spark).count() == 1461


def test_tournament_of_unknown_club_is_kept(spark):
    stray = {**TOURNAMENTS[0], "club_id": 99}
    got = rows(tournament_dim(spark, [stray]))[0]
    assert got["club_key"] == 99
    assert got["club_name"] is None and got["club_city"] is None and got["club_country"] is None


def test_player_and_club_dimensions(spark):
    unborn = {**PLAYERS[0], "date_of_birth": None}
    got = rows(player_dim(spark, [unborn]))[0]
    assert got["age_2026"] is None and got["age_band"] == "60+" and got["joined_date"] == dt.date(2023, 2, 10)
    club = rows(dimensions.dim_club(staging.stg_clubs(frame(spark, "clubs", CLUBS[1:]))))[0]
    assert club["club_key"] == 2 and club["opened_date"] == dt.date(2022, 6, 1)


# Facts


def test_registration_fact(spark):
    first = REGISTRATIONS[0]
    versions = [
        first,
        {**first, "registration_id": 2, "payment_status": "refunded"},
        {**first, "registration_id": 3, "payment_status": None},
        {**first, "registration_id": 4, "tournament_id": 99},
        {**first, "registration_id": 5, "tournament_id": None},
    ]
    got = rows(registration_fact(spark, versions))
    assert [
        (r["registration_id"], r["is_paid"], r["net_revenue_cents"], r["net_revenue_aud"]) for r in got
    ] == [(1, True, 5000, 50.0), (2, False, 0, 0.0), (3, None, 5000, 50.0)]


def test_participation_fact(spark):
    full = MATCHES[0]
    matches = [
        full,
        {**full, "match_id": 2, "team2_player2": None, "winner_team": 2},
        {**full, "match_id": 3, "status": "walkover"},
        {**full, "match_id": 4, "status": "scheduled"},
        {**full, "match_id": 5, "winner_team": None, "scheduled_at": None},
        {**full, "match_id": 6, "status": None},
    ]
    got = participation_fact(spark, matches).collect()
    by_match = {m: [r for r in got if r.match_id == m] for m in range(1, 7)}
    assert [len(by_match[m]) for m in range(1, 7)] == [4, 3, 0, 0, 4, 0]
    assert [(r.player_key, r.team, r.win_flag) for r in by_match[1]] == [(1, 1, 1), (2, 1, 1), (3, 2, 0), (4, 2, 0)]
    assert [(r.player_key, r.is_winner) for r in by_match[2]] == [(1, False), (2, False), (3, True)]
    assert {(r.is_winner, r.win_flag, r.match_date) for r in by_match[5]} == {(None, None, None)}
    assert len({(r.match_id, r.player_key) for r in got}) == len(got)


# Marts


def test_monthly_revenue(spark):
    namesake = [CLUBS[0], {**CLUBS[1], "name": "North Court"}]
    entries = [
        *REGISTRATIONS,
        {**REGISTRATIONS[0], "registration_id": 50, "registered_at": ts("2030-01-01T00:00:00")},
        {**REGISTRATIONS[0], "registration_id": 51, "registered_at": None},
    ]
    tournaments = tournament_dim(spark, clubs=namesake)
    fact = registration_fact(spark, entries, clubs=namesake)
    got = rows(marts.monthly_revenue(fact, dimensions.dim_date(spark), tournaments))
    assert [tuple(r.values()) for r in got] == [
        ("2024-01", "North Court", "Open", 3, 2, 100.0),
        ("2024-02", "North Court", "Open", 3, 1, 50.0),
    ]


def test_tournament_fill(spark):
    base = TOURNAMENTS[0]
    tournaments = [
        base,
        {**base, "tournament_id": 2, "max_teams": 1},
        {**base, "tournament_id": 3},
        {**base, "tournament_id": 4, "status": "cancelled"},
        {**base, "tournament_id": 5, "status": None},
    ]
    fact = registration_fact(spark, REGISTRATIONS, tournaments)
    got = rows(marts.tournament_fill(tournament_dim(spark, tournaments), fact))
    shown = [(r["tournament_key"], r["teams_entered"], r["fill_rate"], r["net_revenue_aud"]) for r in got]
    assert shown == [(1, 3, 0.75, 100.0), (2, 3, 3.0, 50.0), (3, 0, 0.0, None)]


def test_zero_capacity_fails(spark):
    full = [{**TOURNAMENTS[0], "max_teams": 0}]
    fill = marts.tournament_fill(tournament_dim(spark, full), registration_fact(spark, REGISTRATIONS, full))
    with pytest.raises(PySparkException, match="DIVIDE_BY_ZERO"):
        fill.collect()


def test_repeated_dimension_rows_count_like_a_plain_join(spark):
    twice = [TOURNAMENTS[0], TOURNAMENTS[0]]
    dim = tournament_dim(spark, twice)
    fact = registration_fact(spark, REGISTRATIONS, TOURNAMENTS)
    plain = dim.join(fact, "tournament_key", "left").count()
    assert rows(marts.tournament_fill(dim, fact))[0]["teams_entered"] == plain == 6


def test_leaderboard(spark):
    base = MATCHES[0]
    five = [{**base, "match_id": 100 + i, "team1_player1": 5, "winner_team": None} for i in range(5)]
    four = [{**m, "team1_player2": 6} for m in MATCHES[:4]]
    stray = [{**m, "match_id": 200 + i, "team1_player1": 77} for i, m in enumerate(MATCHES)]
    got = rows(marts.player_leaderboard(participation_fact(spark, [*five, *four, *stray]), player_dim(spark)))
    shown = {r["player_key"]: (r["matches_played"], r["wins"], r["win_rate"]) for r in got}
    assert shown[5] == (5, None, None)
    assert 6 not in shown and 77 not in shown and 1 not in shown
    assert shown[3] == (14, 2, 0.143)


def test_leaderboard_threshold_is_a_parameter(spark):
    fact = participation_fact(spark, MATCHES)
    assert marts.player_leaderboard(fact, player_dim(spark), min_matches=6).count() == 0
    assert marts.player_leaderboard(fact, player_dim(spark)).count() == 4


def test_acquisition_keeps_unknown_months(spark):
    players = [*PLAYERS, {**PLAYERS[0], "created_at": None}]
    got = rows(marts.player_acquisition(player_dim(spark, players)))
    assert {r["join_month"]: r["new_players"] for r in got} == {
        "2023-01": 2,
        "2023-02": 2,
        "2023-03": 2,
        None: 1,
    }


def test_refund_rate(spark):
    base = {**PAYMENTS[0], "provider": "stripe"}
    states = ["succeeded", "refunded", "failed", None]
    payments = [{**base, "status": s} for s in states] + [{**base, "provider": None}]
    got = rows(marts.refund_rate(staging.stg_payments(frame(spark, "payments", payments))))
    assert {r["provider"]: tuple(r.values())[1:] for r in got} == {
        "stripe": (4, 1, 0.25, 50.0),
        None: (1, 0, 0.0, 0.0),
    }


def test_headline(spark):
    got = rows(reports.headline(registration_fact(spark, REGISTRATIONS)))
    assert got == [dict(total_net_revenue_aud=150.0, paid_registrations=3, registrations=6)]


# Ordered and top-k reports


def leaderboard(spark):
    data = [
        (1, "a", "X", "60+", 5, 3, 0.6),
        (2, "b", "X", "60+", 9, 8, 0.9),
        (3, "c", "X", "60+", 7, None, None),
        (4, "d", "X", "60+", 10, 9, 0.9),
        (5, "e", "X", "60+", 10, 9, 0.9),
    ]
    names = "player_key long, full_name string, country string, age_band string"
    return spark.createDataFrame(data, names + ", matches_played long, wins long, win_rate double")


def test_top_players(spark):
    assert [r.full_name for r in reports.top_players(leaderboard(spark), 4).collect()] == ["d", "e", "b", "a"]
    assert [r.full_name for r in reports.best_win_rates(leaderboard(spark)).collect()] == list("bdeac")
    assert reports.best_win_rates(leaderboard(spark), 2).count() == 2


def test_ordered_reads(spark):
    fill = spark.createDataFrame([(1, 0.5), (2, 1.25), (3, 0.5)], "tournament_key long, fill_rate double")
    assert [r.tournament_key for r in reports.tournaments_by_fill(fill).collect()] == [2, 1, 3]
    refunds = spark.createDataFrame([("b",), ("a",), (None,)], "provider string")
    assert [r.provider for r in reports.refunds_by_provider(refunds).collect()] == [None, "a", "b"]
    revenue = spark.createDataFrame(
        [("2024-02", "x", "o"), ("2024-01", "y", "o"), ("2024-01", "x", "o")],
        "year_month string, club_name string, category string",
    )
    ordered = [tuple(r)[:2] for r in reports.revenue_by_month(revenue).collect()]
    assert ordered == [("2024-01", "x"), ("2024-01", "y"), ("2024-02", "x")]
    assert [tuple(r)[:2] for r in reports.revenue_by_month(revenue, 1).collect()] == ordered[:1]


def test_latest_months(spark):
    months = [f"20{y}-{m:02d}-01T00:00:00" for y in (23, 24) for m in (1, 5, 9, 12)]
    entries = [
        {**REGISTRATIONS[0], "registration_id": i, "registered_at": ts(m), "amount_paid_cents": 100 * i}
        for i, m in enumerate(months)
    ]
    got = reports.latest_months(frame(spark, "registrations", entries)).collect()
    assert [(r.year_month, r.net_revenue_aud) for r in got] == [
        ("2024-12", 7.0),
        ("2024-09", 6.0),
        ("2024-05", 5.0),
        ("2024-01", 4.0),
        ("2023-12", 3.0),
        ("2023-09", 2.0),
    ]


def test_top_players_by_rounded_rate(spark):
    got = reports.top_players_by_rounded_rate(frame(spark, "matches", MATCHES), n=3).collect()
    assert [tuple(r) for r in got] == [(1, 5, 4, 0.8), (2, 5, 4, 0.8), (3, 5, 1, 0.2)]
    assert reports.top_players_by_rounded_rate(frame(spark, "matches", MATCHES[:4])).count() == 0
