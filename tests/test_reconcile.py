import datetime as dt

import pytest
from pyspark.sql import functions as F

from stellate.plans import dimensions, facts, marts, reconcile, reports, staging
from tests.support import MATCHES, PAYMENTS, REGISTRATIONS, TOURNAMENTS, sources, ts


def models(spark, tables, calendar=(dt.date(2023, 1, 1), dt.date(2026, 12, 31))):
    dim = dimensions.dim_tournament(
        staging.stg_tournaments(tables["tournaments"]), staging.stg_clubs(tables["clubs"])
    )
    fact = facts.fct_registration(staging.stg_registrations(tables["registrations"]), dim)
    played = facts.fct_match_participation(staging.stg_matches(tables["matches"]))
    players = dimensions.dim_player(staging.stg_players(tables["players"]))
    views = {
        "v_monthly_revenue": marts.monthly_revenue(fact, dimensions.dim_date(spark, *calendar), dim),
        "v_tournament_fill": marts.tournament_fill(dim, fact),
        "v_player_leaderboard": marts.player_leaderboard(played, players),
        "v_refund_rate": marts.refund_rate(staging.stg_payments(tables["payments"])),
    }
    return views, reports.headline(fact)


def differing(spark, tables, **options):
    checked = reconcile.reconcile(tables, *models(spark, tables, **options)).collect()
    return {(r.area, r.metric, r.key): (r.expected, r.actual) for r in checked if not r.match}


def test_clean_sources_agree(spark):
    tables = sources(spark)
    checked = reconcile.reconcile(tables, *models(spark, tables)).collect()
    assert all(r.match for r in checked)
    assert {r.area: sum(x.area == r.area for x in checked) for r in checked} == {
        "totals": 3,
        "months": 2,
        "fill": 1,
        "players": 8,
        "refunds": 4,
    }


def test_orphan_registration_differs_in_the_totals_and_its_month(spark):
    stray = {**REGISTRATIONS[0], "registration_id": 90, "tournament_id": 99}
    found = differing(spark, sources(spark, registrations=[*REGISTRATIONS, stray]))
    assert found == {
        ("totals", "registrations", "all"): (7.0, 6.0),
        ("totals", "paid_registrations", "all"): (4.0, 3.0),
        ("totals", "total_net_revenue_aud", "all"): (200.0, 150.0),
        ("months", "net_revenue_aud", "2024-02"): (100.0, 50.0),
    }


def test_day_off_the_calendar_differs_in_its_month_only(spark):
    late = {**REGISTRATIONS[3], "registration_id": 90, "registered_at": ts("2031-05-05T00:00:00")}
    found = differing(spark, sources(spark, registrations=[*REGISTRATIONS, late]))
    assert found == {("months", "net_revenue_aud", "2031-05"): (0.0, None)}


def test_tournament_of_unknown_status_differs_in_the_fill(spark):
    unknown = {**TOURNAMENTS[0], "tournament_id": 9, "status": None}
    found = differing(spark, sources(spark, tournaments=[*TOURNAMENTS, unknown]))
    assert found == {("fill", "average_fill_rate", "all"): (0.5, 0.75)}


def test_unknown_player_differs_on_one_side(spark):
    strangers = [{**m, "team1_player1": 99} for m in MATCHES]
    found = differing(spark, sources(spark, matches=strangers))
    assert found == {
        ("players", "matches_played", "99"): (5.0, None),
        ("players", "wins", "99"): (4.0, None),
    }


def test_all_winners_unknown_counts_as_no_wins(spark):
    assert differing(spark, sources(spark, matches=[{**m, "winner_team": None} for m in MATCHES])) == {}


def test_unknown_provider_and_state_agree(spark):
    odd = [{**PAYMENTS[0], "payment_id": 90, "provider": None, "status": None}]
    assert differing(spark, sources(spark, payments=[*PAYMENTS, *odd])) == {}


def test_compare_pairs_null_keys_and_shows_repeats(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("only", 3), ("twice", 4)], "k string, n long")
    right = spark.createDataFrame([("a", 1), (None, 2), ("twice", 4), ("twice", 4)], "k string, n long")
    got = reconcile.compare(left, right, F.col("k"), {"n": (F.col("n"), F.col("n"))}).collect()
    assert {r.key: (r.expected, r.actual, r.match) for r in got} == {
        "a": (1.0, 1.0, True),
        None: (2.0, 2.0, True),
        "only": (3.0, None, False),
        "twice": (4.0, 8.0, False),
    }


@pytest.mark.parametrize("actual,match", [(0.7504, True), (0.7506, False), (None, False)])
def test_compare_tolerance(spark, actual, match):
    left = spark.createDataFrame([(0.75,)], "v double")
    right = spark.createDataFrame([(actual,)], "v double")
    got = reconcile.compare(left, right, F.lit("all"), {"v": (F.col("v"), F.col("v"))}, 0.0005).collect()
    assert [r.match for r in got] == [match]
