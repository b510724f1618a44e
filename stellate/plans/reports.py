"""Ordered and top-k reads of the marts, and the headline totals (MOD-18, SRT-1..5, AGG-11).

A limit is part of the report; each order ends in a unique key, so a report is determined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stellate.functions.numbers import money, round_up_half
from stellate.plans.marts import MIN_MATCHES
from stellate.plans.reconcile import net_by_month, player_records


def headline(fct_registration: DataFrame) -> DataFrame:
    """Total net revenue, paid registrations and registrations, as one row."""
    return fct_registration.agg(
        money(F.sum("net_revenue_cents")).alias("total_net_revenue_aud"),
        F.count_if("is_paid").alias("paid_registrations"),
        F.count(F.lit(1)).alias("registrations"),
    )


def top_players(leaderboard: DataFrame, n: int = 5) -> DataFrame:
    """Best win rates, more matches first among equals."""
    return (
        leaderboard.orderBy(F.desc_nulls_last("win_rate"), F.desc("matches_played"), "player_key")
        .limit(n)
        .select("full_name", "wins", "matches_played", "win_rate")
    )


def best_win_rates(leaderboard: DataFrame, n: int = 20) -> DataFrame:
    """Leaderboard rows with the best win rates."""
    return leaderboard.orderBy(F.desc_nulls_last("win_rate"), "player_key").limit(n)


def revenue_by_month(revenue: DataFrame, n: int | None = None) -> DataFrame:
    """Monthly revenue in order, whole or its first ``n`` rows."""
    ordered = revenue.orderBy(
        F.asc_nulls_first("year_month"), F.asc_nulls_first("club_name"), F.asc_nulls_first("category")
    )
    return ordered if n is None else ordered.limit(n)


def tournaments_by_fill(fill: DataFrame) -> DataFrame:
    """All tournaments, fullest first."""
    return fill.orderBy(F.desc_nulls_last("fill_rate"), "tournament_key")


def refunds_by_provider(refunds: DataFrame) -> DataFrame:
    return refunds.orderBy(F.asc_nulls_first("provider"))


def latest_months(registrations: DataFrame, n: int = 6) -> DataFrame:
    """Net revenue of the latest months, straight from the source rows."""
    return (
        net_by_month(registrations)
        .orderBy(F.desc_nulls_last("year_month"))
        .limit(n)
        .select("year_month", money(F.col("net_cents")).alias("net_revenue_aud"))
    )


def top_players_by_rounded_rate(matches: DataFrame, n: int = 5, min_matches: int = MIN_MATCHES) -> DataFrame:
    """Best win rates at two places, lower player id first among equals, straight from the source rows."""
    rate = round_up_half(F.col("wins") / F.col("matches_played"))
    return (
        player_records(matches)
        .where(F.col("matches_played") >= min_matches)
        .withColumn("rate", rate)
        .orderBy(F.desc("rate"), "player_id")
        .limit(n)
    )
