"""Marts (MOD-13..17), each one Spark SQL text used two ways.

A mart function binds the text to DataFrames; ``publish`` stores it as a view over the
catalog tables, so that every read sees the latest build.

Facts are counted per key before they meet a dimension: the counts combine before the
shuffle, so no tournament, player or month is hot in the join, and the second sum keeps
the result exact even if a dimension repeats a key. Money is summed as integer cents.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from stellate.sinks.releases import Release

# Fixed value: fewest matches a player on the leaderboard has played.
MIN_MATCHES = 5

MONTHLY_REVENUE = """
WITH monthly AS (
  SELECT c.year_month, r.tournament_key, r.category,
         count(*) AS entries, count_if(r.is_paid) AS paid, sum(r.net_revenue_cents) AS cents
  FROM {fct_registration} r JOIN {dim_date} c ON c.date_key = r.registered_date
  GROUP BY c.year_month, r.tournament_key, r.category
)
SELECT m.year_month, t.club_name, m.category,
       sum(m.entries) AS registrations,
       sum(m.paid) AS paid_registrations,
       round(sum(m.cents) / 100D, 2) AS net_revenue_aud
FROM monthly m JOIN {dim_tournament} t USING (tournament_key)
GROUP BY m.year_month, t.club_name, m.category
"""

TOURNAMENT_FILL = """
WITH entries AS (
  SELECT tournament_key, count(registration_id) AS teams, sum(net_revenue_cents) AS cents
  FROM {fct_registration}
  GROUP BY tournament_key
),
filled AS (
  SELECT t.tournament_key, t.tournament_name, t.club_name, t.category, t.max_teams,
         coalesce(sum(e.teams), 0L) AS teams_entered, sum(e.cents) AS cents
  FROM {dim_tournament} t LEFT JOIN entries e USING (tournament_key)
  WHERE t.status <> 'cancelled'
  GROUP BY t.tournament_key, t.tournament_name, t.club_name, t.category, t.max_teams
)
SELECT tournament_key, tournament_name, club_name, category, max_teams, teams_entered,
       round(teams_entered / max_teams, 3) AS fill_rate,
       round(cents / 100D, 2) AS net_revenue_aud
FROM filled
"""

PLAYER_LEADERBOARD = """
WITH record AS (
  SELECT player_key, count(*) AS played, sum(win_flag) AS won
  FROM {fct_match_participation}
  GROUP BY player_key
),
ranked AS (
  SELECT p.player_key, p.full_name, p.country, p.age_band,
         sum(r.played) AS matches_played, sum(r.won) AS wins
  FROM record r JOIN {dim_player} p USING (player_key)
  GROUP BY p.player_key, p.full_name, p.country, p.age_band
)
SELECT player_key, full_name, country, age_band, matches_played, wins,
       round(try_divide(wins, matches_played), 3) AS win_rate
FROM ranked
WHERE matches_played >= {min_matches}
"""

PLAYER_ACQUISITION = """
SELECT date_format(joined_date, 'yyyy-MM') AS join_month, count(*) AS new_players
FROM {dim_player}
GROUP BY 1
"""

REFUND_RATE = """
WITH totals AS (
  SELECT provider, count(*) AS payments, count_if(is_refunded) AS refunds,
         sum(CASE WHEN is_refunded THEN amount_cents ELSE 0 END) AS cents
  FROM {stg_payments}
  GROUP BY provider
)
SELECT provider, payments, refunds,
       round(try_divide(refunds, payments), 3) AS refund_rate,
       round(cents / 100D, 2) AS refunded_aud
FROM totals
"""

# View name -> text.
VIEWS = {
    "v_monthly_revenue": MONTHLY_REVENUE,
    "v_tournament_fill": TOURNAMENT_FILL,
    "v_player_leaderboard": PLAYER_LEADERBOARD,
    "v_player_acquisition": PLAYER_ACQUISITION,
    "v_refund_rate": REFUND_RATE,
}


def monthly_revenue(fct_registration: DataFrame, dim_date: DataFrame, dim_tournament: DataFrame) -> DataFrame:
    """Entries and net revenue by month, club name and category; days off the calendar drop out."""
    return fct_registration.sparkSession.sql(
        MONTHLY_REVENUE, fct_registration=fct_registration, dim_date=dim_date, dim_tournament=dim_tournament
    )


def tournament_fill(dim_tournament: DataFrame, fct_registration: DataFrame) -> DataFrame:
    """Teams entered against capacity, for every tournament known not to be cancelled.

    Without entries the count is 0 and the revenue NULL. A capacity of 0 fails the query.
    """
    return fct_registration.sparkSession.sql(
        TOURNAMENT_FILL, dim_tournament=dim_tournament, fct_registration=fct_registration
    )


def player_leaderboard(
    fct_match_participation: DataFrame, dim_player: DataFrame, min_matches: int = MIN_MATCHES
) -> DataFrame:
    """Win rate of every known player with enough matches."""
    return fct_match_participation.sparkSession.sql(
        PLAYER_LEADERBOARD,
        fct_match_participation=fct_match_participation,
        dim_player=dim_player,
        min_matches=min_matches,
    )


def player_acquisition(dim_player: DataFrame) -> DataFrame:
    """New players by month of joining; an unknown date forms its own row."""
    return dim_player.sparkSession.sql(PLAYER_ACQUISITION, dim_player=dim_player)


def refund_rate(stg_payments: DataFrame) -> DataFrame:
    """Share of refunded payments by provider, among payments of any status."""
    return stg_payments.sparkSession.sql(REFUND_RATE, stg_payments=stg_payments)


# The tables the views read, and their layers.
READS = {
    "fct_registration": "core",
    "fct_match_participation": "core",
    "dim_date": "core",
    "dim_player": "core",
    "dim_tournament": "core",
    "stg_payments": "stg",
}


def of_release(release: Release, min_matches: int = MIN_MATCHES) -> dict[str, DataFrame]:
    """The five marts over the tables of one release."""
    tables = {table: release.table(layer, table) for table, layer in READS.items()}
    spark = release.spark
    return {view: spark.sql(text, **_named(text, tables), min_matches=min_matches) for view, text in VIEWS.items()}


def view_texts(release: Release, min_matches: int = MIN_MATCHES) -> list[tuple[str, str]]:
    """The five views as SQL over the files of one release, for the catalog (SNK-5)."""
    scans = {table: f"({release.version(layer, table).as_sql(release.spark)})" for table, layer in READS.items()}
    return [(view, text.format(**scans, min_matches=min_matches)) for view, text in VIEWS.items()]


def _named(text: str, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {table: df for table, df in tables.items() if f"{{{table}}}" in text}
