import pytest

from stellate.plans import quality, staging
from tests.support import CLEAN, CLUBS, MATCHES, PAYMENTS, PLAYERS, REGISTRATIONS, TOURNAMENTS, frame, sources


def failing(checks):
    return {(r.table_name, r.column_name, r.rule): r.offending for r in checks.collect() if not r.passed}


def test_clean_sources_pass_all_sixteen_rules(spark):
    checks = quality.gate(quality.run_checks(sources(spark)))
    assert len(checks) == 16 and all(r.passed for r in checks)


REG = REGISTRATIONS[0]

OFFENCES = [
    ("clubs", [*CLUBS, CLUBS[0]], ("clubs", "club_id", "unique"), 1),
    ("players", [*PLAYERS, PLAYERS[0], PLAYERS[0]], ("players", "player_id", "unique"), 2),
    ("tournaments", [*TOURNAMENTS, TOURNAMENTS[0]], ("tournaments", "tournament_id", "unique"), 1),
    ("registrations", [*REGISTRATIONS, REG], ("registrations", "registration_id", "unique"), 1),
    ("payments", [*PAYMENTS, PAYMENTS[0]], ("payments", "payment_id", "unique"), 1),
    ("matches", [*MATCHES, MATCHES[0]], ("matches", "match_id", "unique"), 1),
    (
        "tournaments",
        [*TOURNAMENTS, {**TOURNAMENTS[0], "tournament_id": 9, "club_id": 99}],
        ("tournaments", "club_id", "references clubs"),
        1,
    ),
    (
        "registrations",
        [*REGISTRATIONS, {**REG, "registration_id": 90, "tournament_id": None}],
        ("registrations", "tournament_id", "references tournaments"),
        1,
    ),
    (
        "registrations",
        [*REGISTRATIONS, {**REG, "registration_id": 90, "player_id": 99}],
        ("registrations", "player_id", "references players"),
        1,
    ),
    (
        "registrations",
        [*REGISTRATIONS, {**REG, "registration_id": 90, "partner_player_id": 99}],
        ("registrations", "partner_player_id", "references players"),
        1,
    ),
    (
        "payments",
        [*PAYMENTS, *({**PAYMENTS[0], "payment_id": i, "registration_id": 99} for i in (90, 91))],
        ("payments", "registration_id", "references registrations"),
        2,
    ),
    (
        "matches",
        [*MATCHES, {**MATCHES[0], "match_id": 90, "tournament_id": 99}],
        ("matches", "tournament_id", "references tournaments"),
        1,
    ),
    (
        "registrations",
        [*REGISTRATIONS, *({**REG, "registration_id": i, "payment_status": s} for i, s in ((90, "free"), (91, None)))],
        ("registrations", "payment_status", "in domain"),
        2,
    ),
    (
        "matches",
        [*MATCHES, {**MATCHES[0], "match_id": 90, "winner_team": 3}],
        ("matches", "winner_team", "in domain"),
        1,
    ),
    (
        "registrations",
        [*REGISTRATIONS, {**REG, "registration_id": 90, "payment_status": "waived", "amount_paid_cents": -1}],
        ("registrations", "amount_paid_cents", "not negative"),
        1,
    ),
    (
        "registrations",
        [*REGISTRATIONS, *({**REG, "registration_id": 90 + i, "amount_paid_cents": a} for i, a in ((0, 0), (1, None)))],
        ("registrations", "amount_paid_cents", "positive when paid"),
        2,
    ),
]


def _name(value):
    return ".".join(value) if isinstance(value, tuple) else ""


@pytest.mark.parametrize("table,changed,rule,count", OFFENCES, ids=_name)
def test_one_offence_fails_one_rule(spark, table, changed, rule, count):
    assert failing(quality.run_checks(sources(spark, **{table: changed}))) == {rule: count}


def test_values_that_pass(spark):
    changed = sources(
        spark,
        registrations=[
            *REGISTRATIONS,
            {**REG, "registration_id": 90, "partner_player_id": None},
            {**REG, "registration_id": 91, "payment_status": "waived", "amount_paid_cents": None},
        ],
        matches=[*MATCHES, {**MATCHES[0], "match_id": 90, "winner_team": None}],
    )
    assert failing(quality.run_checks(changed)) == {}


def test_a_null_key_is_a_value(spark):
    lost = {**CLUBS[0], "club_id": None}
    stray = {**TOURNAMENTS[0], "tournament_id": 9, "club_id": None}
    assert failing(quality.run_checks(sources(spark, clubs=[*CLUBS, lost], tournaments=[*TOURNAMENTS, stray]))) == {}
    twice = sources(spark, clubs=[*CLUBS, lost, lost])
    assert failing(quality.run_checks(twice)) == {("clubs", "club_id", "unique"): 1}
    assert failing(quality.run_checks(sources(spark, tournaments=[*TOURNAMENTS, stray]))) == {
        ("tournaments", "club_id", "references clubs"): 1
    }


def test_gate_stops_on_errors_and_lets_warnings_pass(spark):
    replayed = sources(spark, registrations=[*REGISTRATIONS, REG])
    report = quality.gate(quality.run_checks(replayed))
    assert [r.rule for r in report if not r.passed] == ["unique"]
    with pytest.raises(quality.QualityError, match="clubs.club_id unique: 1 offending"):
        quality.gate(quality.run_checks(sources(spark, clubs=[*CLUBS, CLUBS[0]])))


def test_staged_registrations_may_not_repeat(spark):
    raw = frame(spark, "registrations", [*REGISTRATIONS, REG])
    assert failing(quality.check_staged(staging.stg_registrations(raw))) == {}
    with pytest.raises(quality.QualityError):
        quality.gate(quality.check_staged(raw))


def test_empty_tables_are_reported(spark):
    empty = sources(spark, **{table: [] for table in CLEAN})
    checks = quality.run_checks(empty).collect()
    assert len(checks) == 16 and all(r.passed and r.offending == 0 for r in checks)
