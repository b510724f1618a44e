"""The queries again as DuckDB SQL over the given tables.

Written apart from the Spark code, in the plainest form: one join or GROUP BY per
question, without the counting ahead of joins. Ratios are rounded with whole numbers, half
away from zero: ``(2000 * n + d) // (2 * d) / 1000``.
"""

from __future__ import annotations

# The given tables as the six source tables.
SOURCES = """
clubs AS (
  SELECT s_suppkey AS club_id, '  ' || s_name || ' ' AS name,
         CASE WHEN s_suppkey % 4 = 0 THEN n_name || ' ' ELSE n_name END AS city,
         lower(n_name) AS country, TIMESTAMP '1995-01-01 00:00:00' AS created_at
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
players AS (
  SELECT c_custkey AS player_id,
         CASE WHEN c_custkey % 33 = 0 THEN '  ' || c_name || '  ' ELSE c_name END AS full_name,
         CASE WHEN c_custkey % 7 = 0 THEN ' Player' || c_custkey || '@Example.com '
              ELSE 'player' || c_custkey || '@example.com' END AS email,
         CASE WHEN c_custkey % 20 = 0 THEN lower(n_name) ELSE n_name END AS country,
         CASE WHEN c_custkey % 25 = 0 THEN NULL WHEN c_custkey % 10 = 3 THEN 'x'
              WHEN c_custkey % 2 = 0 THEN 'm' ELSE 'F' END AS gender,
         CASE WHEN c_custkey % 97 = 5 THEN NULL
              ELSE DATE '1950-01-01' + CAST((c_custkey * 7919) % 23000 AS INT) END AS date_of_birth,
         CAST(DATE '1995-01-01' + CAST((c_custkey * 31) % 2000 AS INT) AS TIMESTAMP) AS created_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
tournaments AS (
  SELECT p_partkey AS tournament_id,
         CASE WHEN p_partkey % 50 = 49 THEN -1 ELSE CAST(floor(p_partkey / 20) AS BIGINT) END AS club_id,
         ' ' || p_name AS name, p_type AS category,
         CASE WHEN p_size <= 25 THEN 'Indoor' ELSE 'Outdoor' END AS surface,
         4000 + 2000 * (p_partkey % 5) AS entry_fee_cents, 'AUD' AS currency,
         CAST(CASE p_partkey % 3 WHEN 0 THEN 8 WHEN 1 THEN 16 ELSE 32 END AS BIGINT) AS max_teams,
         DATE '1995-01-01' + CAST((p_partkey * 13) % 2500 AS INT) AS start_date,
         DATE '1995-01-01' + CAST((p_partkey * 13) % 2500 + 1 + p_size % 3 AS INT) AS end_date,
         CASE WHEN p_partkey % 13 = 0 THEN 'cancelled' WHEN p_partkey % 29 = 7 THEN NULL
              WHEN p_partkey % 5 = 0 THEN 'scheduled' ELSE 'completed' END AS status,
         TIMESTAMP '1995-01-01 00:00:00' AS created_at
  FROM part
),
registrations AS (
  SELECT l_orderkey * 8 + l_linenumber AS registration_id,
         CASE WHEN l_partkey % 41 = 11 THEN l_partkey + 1000000 ELSE l_partkey END AS tournament_id,
         o_custkey AS player_id,
         CASE WHEN l_orderkey % 9 = 0 THEN NULL
              ELSE (o_custkey + 1 + l_linenumber) % (SELECT count(*) FROM customer) END AS partner_player_id,
         CAST(CASE WHEN l_linenumber <= 4 THEN l_linenumber END AS BIGINT) AS seed,
         CASE WHEN l_returnflag IN ('A', 'R')
              THEN CASE WHEN l_orderkey % 211 = 0 THEN 0 ELSE 4000 + 2000 * (l_partkey % 5) END
              ELSE 0 END AS amount_paid_cents,
         CASE WHEN l_orderkey % 307 = 0 THEN 'unknown' WHEN l_returnflag = 'A' THEN 'paid'
              WHEN l_returnflag = 'R' THEN 'refunded' WHEN l_linestatus = 'F' THEN 'pending'
              ELSE 'waived' END AS payment_status,
         CAST(l_shipdate AS TIMESTAMP) AS registered_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
payments AS (
  SELECT o_orderkey AS payment_id, o_orderkey * 8 + 1 AS registration_id, o_orderpriority AS provider,
         CAST(round(o_totalprice * 100) AS BIGINT) AS amount_cents, 'AUD' AS currency,
         CASE o_orderstatus WHEN 'F' THEN 'succeeded' WHEN 'P' THEN 'refunded' ELSE 'failed' END AS status,
         CAST(o_orderdate AS TIMESTAMP) AS created_at
  FROM orders
),
matches AS (
  SELECT event_id AS match_id, event_id % (SELECT count(*) FROM part) AS tournament_id,
         'R' || (event_id % 5) AS round, 'Court ' || (1 + event_id % 6) AS court,
         CASE WHEN event_id % 101 = 3 THEN NULL ELSE CAST(ts AS TIMESTAMP) END AS scheduled_at,
         user_id AS team1_player1,
         CASE WHEN event_id % 4 = 0 THEN NULL ELSE user_id + 1 END AS team1_player2,
         CAST(floor(event_id * 3 / 20) AS BIGINT) AS team2_player1,
         CASE WHEN event_id % 6 = 0 THEN NULL
              ELSE (event_id * 7) % (SELECT count(*) FROM customer) END AS team2_player2,
         CASE WHEN event_id % 19 = 0 THEN NULL
              ELSE 1 + (event_id + user_id) % 2 END AS winner_team,
         '6-3 6-4' AS score,
         CASE event_type WHEN 'error' THEN 'walkover' WHEN 'view' THEN 'scheduled' ELSE 'played' END AS status
  FROM events
)"""

MODELS = """
stg_clubs AS (
  SELECT club_id, trim(name) AS club_name, trim(city) AS city, upper(trim(country)) AS country, created_at
  FROM clubs
),
stg_players AS (
  SELECT player_id, trim(full_name) AS full_name, lower(trim(email)) AS email,
         upper(trim(country)) AS country,
         CASE WHEN gender IN ('M', 'm') THEN 'Male' WHEN gender IN ('F', 'f') THEN 'Female'
              ELSE 'Unknown' END AS gender,
         date_of_birth, date_diff('year', date_of_birth, DATE '2026-01-01') AS age_2026, created_at
  FROM players
),
stg_tournaments AS (
  SELECT tournament_id, club_id, trim(name) AS tournament_name, category, surface, entry_fee_cents,
         entry_fee_cents / CAST(100 AS DOUBLE) AS entry_fee_aud, currency, max_teams, start_date, end_date,
         date_diff('day', start_date, end_date) + 1 AS duration_days, status, created_at
  FROM tournaments
),
stg_registrations AS (
  SELECT registration_id, tournament_id, player_id, partner_player_id, seed, amount_paid_cents,
         amount_paid_cents / CAST(100 AS DOUBLE) AS amount_paid_aud, payment_status,
         payment_status = 'paid' AS is_paid, registered_at
  FROM registrations
  QUALIFY row_number() OVER (
    PARTITION BY registration_id
    ORDER BY registered_at DESC NULLS LAST, tournament_id ASC NULLS LAST, player_id ASC NULLS LAST,
             partner_player_id ASC NULLS LAST, seed ASC NULLS LAST, amount_paid_cents ASC NULLS LAST,
             payment_status ASC NULLS LAST) = 1
),
stg_payments AS (
  SELECT payment_id, registration_id, provider, amount_cents,
         amount_cents / CAST(100 AS DOUBLE) AS amount_aud, currency, status,
         status = 'refunded' AS is_refunded, created_at
  FROM payments
),
stg_matches AS (
  SELECT match_id, tournament_id, round, court, scheduled_at, CAST(scheduled_at AS DATE) AS match_date,
         team1_player1, team1_player2, team2_player1, team2_player2, winner_team, score, status
  FROM matches
),
dim_date AS (
  SELECT day AS date_key, year(day) AS year, quarter(day) AS quarter, month(day) AS month,
         strftime(day, '%Y-%m') AS year_month, monthname(day) AS month_name, day(day) AS day_of_month,
         dayofweek(day) + 1 AS day_of_week, dayname(day) AS day_name, dayofweek(day) IN (0, 6) AS is_weekend
  FROM (
    SELECT CAST(unnest(generate_series(
             make_date(year(min(registered_at)), 1, 1), make_date(year(max(registered_at)), 12, 31),
             INTERVAL 1 DAY)) AS DATE) AS day
    FROM registrations
  )
),
dim_player AS (
  SELECT player_id AS player_key, full_name, email, country, gender, date_of_birth, age_2026,
         CASE WHEN age_2026 IS NULL OR age_2026 >= 60 THEN '60+' WHEN age_2026 >= 45 THEN '45-59'
              WHEN age_2026 >= 30 THEN '30-44' WHEN age_2026 >= 18 THEN '18-29'
              ELSE 'Under 18' END AS age_band,
         CAST(created_at AS DATE) AS joined_date
  FROM stg_players
),
dim_club AS (
  SELECT club_id AS club_key, club_name, city, country, CAST(created_at AS DATE) AS opened_date FROM stg_clubs
),
dim_tournament AS (
  SELECT tournament_id AS tournament_key, tournament_name, category, surface, currency, entry_fee_aud,
         max_teams, start_date, end_date, duration_days, status, t.club_id AS club_key, club_name,
         city AS club_city, country AS club_country
  FROM stg_tournaments t LEFT JOIN stg_clubs c ON t.club_id = c.club_id
),
fct_registration AS (
  SELECT registration_id, CAST(registered_at AS DATE) AS registered_date, tournament_key, club_key,
         player_id AS player_key, partner_player_id AS partner_player_key, category, surface,
         payment_status, is_paid, amount_paid_cents, amount_paid_aud,
         CASE WHEN payment_status IS DISTINCT FROM 'refunded' THEN amount_paid_cents ELSE 0 END
           AS net_revenue_cents,
         CASE WHEN payment_status IS DISTINCT FROM 'refunded' THEN amount_paid_aud ELSE 0 END
           AS net_revenue_aud
  FROM stg_registrations JOIN dim_tournament ON tournament_id = tournament_key
),
slots AS (
  SELECT match_id, unnest([team1_player1, team1_player2, team2_player1, team2_player2]) AS player_id,
         unnest([1, 1, 2, 2]) AS team
  FROM matches
),
fct_match_participation AS (
  SELECT m.match_id, match_date, tournament_id AS tournament_key, s.player_id AS player_key, round,
         CAST(team AS BIGINT) AS team, status, team = winner_team AS is_winner,
         CAST(team = winner_team AS BIGINT) AS win_flag
  FROM stg_matches m JOIN slots s ON s.match_id = m.match_id
  WHERE status = 'played' AND s.player_id IS NOT NULL
),
monthly_revenue AS (
  SELECT year_month, club_name, f.category, count(*) AS registrations,
         CAST(count_if(is_paid) AS BIGINT) AS paid_registrations,
         CAST(sum(net_revenue_cents) AS BIGINT) / CAST(100 AS DOUBLE) AS net_revenue_aud
  FROM fct_registration f
  JOIN dim_date ON registered_date = date_key
  JOIN dim_tournament t ON f.tournament_key = t.tournament_key
  GROUP BY ALL
),
monthly_revenue_clipped AS (
  SELECT * FROM monthly_revenue WHERE year_month BETWEEN '1996-01' AND '2000-12'
),
tournament_fill AS (
  SELECT t.tournament_key, tournament_name, club_name, t.category, max_teams,
         count(registration_id) AS teams_entered,
         ((2000 * count(registration_id) + max_teams) // (2 * max_teams)) / CAST(1000 AS DOUBLE) AS fill_rate,
         CAST(sum(net_revenue_cents) AS BIGINT) / CAST(100 AS DOUBLE) AS net_revenue_aud
  FROM dim_tournament t LEFT JOIN fct_registration f ON f.tournament_key = t.tournament_key
  WHERE status <> 'cancelled'
  GROUP BY t.tournament_key, tournament_name, club_name, t.category, max_teams
),
player_leaderboard AS (
  SELECT p.player_key, full_name, country, age_band, count(*) AS matches_played,
         CAST(sum(win_flag) AS BIGINT) AS wins,
         ((2000 * CAST(sum(win_flag) AS BIGINT) + count(*)) // (2 * count(*))) / CAST(1000 AS DOUBLE) AS win_rate
  FROM fct_match_participation f JOIN dim_player p ON f.player_key = p.player_key
  GROUP BY p.player_key, full_name, country, age_band
  HAVING count(*) >= 5
),
player_acquisition AS (
  SELECT strftime(joined_date, '%Y-%m') AS join_month, count(*) AS new_players FROM dim_player GROUP BY 1
),
refund_rate AS (
  SELECT provider, count(*) AS payments, CAST(count_if(is_refunded) AS BIGINT) AS refunds,
         ((2000 * CAST(count_if(is_refunded) AS BIGINT) + count(*)) // (2 * count(*))) / CAST(1000 AS DOUBLE)
           AS refund_rate,
         coalesce(CAST(sum(amount_cents) FILTER (WHERE is_refunded) AS BIGINT), 0) / CAST(100 AS DOUBLE)
           AS refunded_aud
  FROM stg_payments
  GROUP BY provider
),
headline AS (
  SELECT CAST(sum(net_revenue_cents) AS BIGINT) / CAST(100 AS DOUBLE) AS total_net_revenue_aud,
         CAST(count_if(is_paid) AS BIGINT) AS paid_registrations, count(*) AS registrations
  FROM fct_registration
)"""

# Metrics straight from the source rows.
FROM_SOURCE = """
net_by_month AS (
  SELECT strftime(registered_at, '%Y-%m') AS year_month,
         CAST(sum(amount_paid_cents) FILTER (WHERE payment_status <> 'refunded') AS BIGINT)
           / CAST(100 AS DOUBLE) AS net_revenue_aud
  FROM registrations
  GROUP BY 1
),
player_records AS (
  SELECT s.player_id, count(*) AS matches_played,
         CAST(count_if(team = winner_team) AS BIGINT) AS wins
  FROM matches m JOIN slots s ON s.match_id = m.match_id
  WHERE status = 'played' AND s.player_id IS NOT NULL
  GROUP BY s.player_id
)"""


def _unique(table: str, key: str) -> str:
    return f"SELECT '{table}' AS table_name, '{key}' AS column_name, 'unique' AS rule, " + (
        f"(SELECT count(*) FROM {table}) - (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {table})) AS offending"
    )


def _reference(table: str, column: str, parent: str, key: str, nullable: bool = False) -> str:
    missing = f"NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} IS NOT DISTINCT FROM c.{column})"
    if nullable:
        missing += f" AND c.{column} IS NOT NULL"
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, 'references {parent}' AS rule, "
        f"(SELECT count(*) FROM {table} c WHERE {missing}) AS offending"
    )


def _row_rule(table: str, column: str, rule: str, offends: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{rule}' AS rule, "
        f"(SELECT count(*) FROM {table} WHERE {offends}) AS offending"
    )


_PK = [
    _unique("clubs", "club_id"),
    _unique("players", "player_id"),
    _unique("tournaments", "tournament_id"),
    _unique("registrations", "registration_id"),
    _unique("payments", "payment_id"),
    _unique("matches", "match_id"),
]
_FK = [
    _reference("tournaments", "club_id", "clubs", "club_id"),
    _reference("registrations", "tournament_id", "tournaments", "tournament_id"),
    _reference("registrations", "player_id", "players", "player_id"),
    _reference("registrations", "partner_player_id", "players", "player_id", nullable=True),
    _reference("payments", "registration_id", "registrations", "registration_id"),
    _reference("matches", "tournament_id", "tournaments", "tournament_id"),
]
_ROWS = [
    _row_rule(
        "registrations",
        "payment_status",
        "in domain",
        "payment_status IS NULL OR payment_status NOT IN ('paid', 'pending', 'refunded', 'waived')",
    ),
    _row_rule("matches", "winner_team", "in domain", "winner_team NOT IN (1, 2)"),
    _row_rule("registrations", "amount_paid_cents", "not negative", "amount_paid_cents < 0"),
    _row_rule(
        "registrations",
        "amount_paid_cents",
        "positive when paid",
        "payment_status = 'paid' AND (amount_paid_cents IS NULL OR amount_paid_cents <= 0)",
    ),
]
_STAGED = [_unique("stg_registrations", "registration_id")]


def _report(rules: list[str], warn: bool = True) -> str:
    warning = "column_name = 'registration_id' AND rule = 'unique'" if warn else "false"
    return (
        "SELECT replace(table_name, 'stg_', '') AS table_name, column_name, rule, "
        f"CASE WHEN {warning} THEN 'warning' ELSE 'error' END AS severity, "
        "offending, offending = 0 AS passed FROM (" + " UNION ALL ".join(rules) + ")"
    )


def _compare(expected: str, actual: str, tolerance: float = 0.0) -> str:
    """Both sides give (metric, key, value)."""
    near = f" OR coalesce(abs(e.value - a.value) <= {tolerance}, false)" if tolerance else ""
    return (
        "SELECT coalesce(e.metric, a.metric) AS metric, coalesce(e.key, a.key) AS key, "
        "CAST(e.value AS DOUBLE) AS expected, CAST(a.value AS DOUBLE) AS actual, "
        f"e.value IS NOT DISTINCT FROM a.value{near} AS match "
        f"FROM ({expected}) e FULL OUTER JOIN ({actual}) a "
        "ON e.metric = a.metric AND e.key IS NOT DISTINCT FROM a.key"
    )


def _measures(source: str, key: str, **values: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{metric}' AS metric, CAST({key} AS VARCHAR) AS key, CAST({value} AS DOUBLE) AS value FROM {source}"
        for metric, value in values.items()
    )


_NET = "CAST(sum(CASE WHEN payment_status = 'refunded' THEN 0 ELSE amount_paid_cents END) AS BIGINT)"

RECONCILE = {
    "reconcile_totals": _compare(
        _measures(
            f"(SELECT count(*) AS n, count_if(payment_status = 'paid') AS paid, {_NET} AS cents FROM registrations)",
            "'all'",
            registrations="n",
            paid_registrations="paid",
            total_net_revenue_aud="cents / CAST(100 AS DOUBLE)",
        ),
        _measures(
            "headline",
            "'all'",
            registrations="registrations",
            paid_registrations="paid_registrations",
            total_net_revenue_aud="total_net_revenue_aud",
        ),
    ),
    "reconcile_months": _compare(
        _measures("net_by_month", "year_month", net_revenue_aud="net_revenue_aud"),
        _measures(
            "(SELECT year_month, round(sum(net_revenue_aud), 2) AS net FROM monthly_revenue GROUP BY year_month)",
            "year_month",
            net_revenue_aud="net",
        ),
    ),
    "reconcile_fill": _compare(
        _measures(
            "(SELECT avg(coalesce(n, 0) / max_teams) AS rate FROM tournaments t LEFT JOIN "
            "(SELECT tournament_id AS id, count(*) AS n FROM registrations GROUP BY 1) ON id = t.tournament_id "
            "WHERE status IS DISTINCT FROM 'cancelled')",
            "'all'",
            average_fill_rate="round(rate, 6)",
        ),
        _measures(
            "(SELECT avg(teams_entered / max_teams) AS rate FROM tournament_fill)",
            "'all'",
            average_fill_rate="round(rate, 6)",
        ),
        tolerance=0.0005,
    ),
    "reconcile_players": _compare(
        _measures(
            "(SELECT * FROM player_records WHERE matches_played >= 5)",
            "player_id",
            matches_played="matches_played",
            wins="wins",
        ),
        _measures(
            "player_leaderboard", "player_key", matches_played="matches_played", wins="coalesce(wins, 0)"
        ),
    ),
    "reconcile_refunds": _compare(
        _measures(
            "(SELECT provider, count(*) AS n, count_if(status = 'refunded') AS r FROM payments GROUP BY provider)",
            "provider",
            payments="n",
            refunds="r",
        ),
        _measures("refund_rate", "provider", payments="payments", refunds="refunds"),
    ),
}

REPORTS = {
    "top_players": (
        "SELECT full_name, wins, matches_played, win_rate FROM player_leaderboard "
        "ORDER BY win_rate DESC NULLS LAST, matches_played DESC, player_key LIMIT 5"
    ),
    "best_win_rates": (
        "SELECT * FROM player_leaderboard ORDER BY win_rate DESC NULLS LAST, player_key LIMIT 20"
    ),
    "revenue_by_month": "SELECT * FROM monthly_revenue ORDER BY year_month",
    "revenue_first_rows": (
        "SELECT * FROM monthly_revenue ORDER BY year_month NULLS FIRST, club_name NULLS FIRST, "
        "category NULLS FIRST LIMIT 20"
    ),
    "tournaments_by_fill": "SELECT * FROM tournament_fill ORDER BY fill_rate DESC",
    "refunds_by_provider": "SELECT * FROM refund_rate ORDER BY provider",
    "latest_months": "SELECT * FROM net_by_month ORDER BY year_month DESC NULLS LAST LIMIT 6",
    "top_players_by_rounded_rate": (
        "SELECT player_id, matches_played, wins, floor(wins / matches_played * 100 + 0.5) / 100 AS rate "
        "FROM player_records WHERE matches_played >= 5 ORDER BY rate DESC, player_id LIMIT 5"
    ),
}

QUALITY = {
    "dq_pk": _report(_PK),
    "dq_fk": _report(_FK),
    "dq_rules": _report(_ROWS),
    "dq_report": _report(_PK + _FK + _ROWS),
    "dq_staged": _report(_STAGED, warn=False),
    "dq_orphan_registrations": (
        "SELECT * FROM registrations r WHERE NOT EXISTS "
        "(SELECT 1 FROM tournaments t WHERE t.tournament_id IS NOT DISTINCT FROM r.tournament_id)"
    ),
    "dq_orphan_payments": (
        "SELECT * FROM payments p WHERE NOT EXISTS "
        "(SELECT 1 FROM registrations r WHERE r.registration_id IS NOT DISTINCT FROM p.registration_id)"
    ),
}

SOURCE_TABLES = ("clubs", "players", "tournaments", "registrations", "payments", "matches")
MODEL_TABLES = (
    "stg_clubs",
    "stg_players",
    "stg_tournaments",
    "stg_registrations",
    "stg_payments",
    "stg_matches",
    "dim_date",
    "dim_player",
    "dim_club",
    "dim_tournament",
    "fct_registration",
    "fct_match_participation",
    "monthly_revenue",
    "monthly_revenue_clipped",
    "tournament_fill",
    "player_leaderboard",
    "player_acquisition",
    "refund_rate",
    "headline",
)

MARTS = ("monthly_revenue", "tournament_fill", "player_leaderboard", "player_acquisition", "refund_rate")

SINKS = {f"deployed_{name}": f"SELECT * FROM {name}" for name in MARTS} | {
    "sink_fct_registration": "SELECT * FROM fct_registration",
    "sink_fct_match_participation": "SELECT * FROM fct_match_participation",
    "sink_interleaved_fct_registration": "SELECT * FROM fct_registration",
    "sink_interleaved_fct_match_participation": "SELECT * FROM fct_match_participation",
    "landing_unknown_fields": (
        "SELECT 'export_row' AS field, count(*) AS row_count FROM payments UNION ALL "
        "SELECT 'refund_note' AS field, count(*) AS row_count FROM payments WHERE status = 'refunded'"
    ),
}

_GATE = " UNION ALL ".join(f"SELECT '{table}' AS table_name, count(*) AS published_rows FROM {table}" for table in SOURCE_TABLES)
_HALF = "(SELECT * FROM registrations WHERE registration_id % 2 = 0)"
_HEADLINE = (
    "SELECT '{read}' AS read, count(*) AS registrations, CAST(count_if(is_paid) AS BIGINT) AS paid_registrations, "
    "CAST(sum(net_revenue_cents) AS BIGINT) / CAST(100 AS DOUBLE) AS total_net_revenue_aud FROM fct_registration{where}"
)
# The strict build lands half of the registrations, so references to and rules on them are counted anew.
_HALVED = [rule.replace("FROM registrations", f"FROM {_HALF}") for rule in _FK + _ROWS]

BUILDS = {
    "verify": " UNION ALL ".join(
        f"SELECT '{name.removeprefix('reconcile_')}' AS area, * FROM ({text})" for name, text in RECONCILE.items()
    ),
    "layer_descriptions": (
        "SELECT * FROM (VALUES ('raw', 'Landing: one typed copy per source table', 6), "
        "('stg', 'Staging: cleaned and deduplicated', 6), ('core', 'Core: dimensions and facts of the star schema', 6), "
        "('mart', 'Marts: views that answer business questions', 5)) AS t(layer, description, relations)"
    ),
    "strict_gate": (
        f"SELECT r.table_name, column_name, rule, offending, 1 AS releases, published_rows FROM ({_report(_PK + _HALVED)}) r "
        f"JOIN ({_GATE}) c ON c.table_name = r.table_name WHERE severity = 'error' AND NOT passed"
    ),
    "release_reads": " UNION ALL ".join(
        _HEADLINE.format(read=read, where=where)
        for read, where in (("pinned", ""), ("after_failure", ""), ("current", " WHERE registration_id % 2 = 0"))
    ),
}


def oracle_sql() -> dict[str, str]:
    selects = (
        {name: f"SELECT * FROM {name}" for name in MODEL_TABLES}
        | REPORTS
        | QUALITY
        | RECONCILE
        | {f"landing_{table}": f"SELECT * FROM {table}" for table in SOURCE_TABLES}
        | SINKS
        | BUILDS
    )
    prefix = "WITH " + ",".join((SOURCES, MODELS, FROM_SOURCE))
    return {name: f"{prefix}\n{select}" for name, select in selects.items()}
