"""Headline metrics recomputed from the source rows and compared with the models (REC-1..6).

The recomputation shares no plan with staging, facts or marts, or it would prove nothing:
it neither settles replays nor drops unknown keys, so on clean sources both sides agree
and on dirty ones the difference shows what the models removed.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from stellate.functions.dates import month_text
from stellate.functions.numbers import money
from stellate.plans.marts import MIN_MATCHES

PLAYER_SLOTS = ["team1_player1", "team1_player2", "team2_player1", "team2_player2"]

# Rounded ratios may stand this far from the exact ones.
FILL_TOLERANCE = 0.0005


def _net_cents() -> Column:
    refunded = F.col("payment_status").eqNullSafe("refunded")
    return F.sum(F.when(refunded, 0).otherwise(F.col("amount_paid_cents")))


def totals(registrations: DataFrame) -> DataFrame:
    return registrations.agg(
        F.count(F.lit(1)).alias("registrations"),
        F.count_if(F.col("payment_status") == "paid").alias("paid_registrations"),
        _net_cents().alias("net_cents"),
    )


def net_by_month(registrations: DataFrame) -> DataFrame:
    return registrations.groupBy(month_text("registered_at").alias("year_month")).agg(
        _net_cents().alias("net_cents")
    )


def mean_fill(tournaments: DataFrame, registrations: DataFrame) -> DataFrame:
    """Mean of the unrounded fill ratios of all tournaments not cancelled, an unknown status included."""
    entries = registrations.groupBy("tournament_id").agg(F.count(F.lit(1)).alias("entries"))
    held = tournaments.where(~F.col("status").eqNullSafe("cancelled"))
    ratio = F.coalesce("entries", F.lit(0)) / F.col("max_teams")
    return held.join(entries, "tournament_id", "left").agg(F.avg(ratio).alias("average_fill_rate"))


def player_records(matches: DataFrame) -> DataFrame:
    """Matches played and won per player; a match without a winner counts as not won."""
    played = matches.where(F.col("status") == "played").select("winner_team", *PLAYER_SLOTS)
    slots = played.unpivot(["winner_team"], PLAYER_SLOTS, "slot", "player_id")
    team = F.when(F.col("slot").startswith("team1"), 1).otherwise(2)
    return (
        slots.where(F.col("player_id").isNotNull())
        .groupBy("player_id")
        .agg(
            F.count(F.lit(1)).alias("matches_played"),
            F.count_if(F.col("winner_team") == team).alias("wins"),
        )
    )


def refunds(payments: DataFrame) -> DataFrame:
    return payments.groupBy("provider").agg(
        F.count(F.lit(1)).alias("payments"),
        F.count_if(F.col("status") == "refunded").alias("refunds"),
    )


class Comparison(NamedTuple):
    """Two sides and what is compared of them: a metric's expression on either side, by a key that holds on both."""

    expected: DataFrame
    actual: DataFrame
    key: Column
    measures: Mapping[str, tuple[Column, Column]]
    tolerance: float = 0.0

    def values(self, area: str) -> DataFrame:
        """Both sides stacked: (area, metric, key, expected, actual, tolerance), one of the two values null."""
        nothing = F.lit(None).cast("double")

        def side(df: DataFrame, own: int) -> DataFrame:
            rows = (
                F.struct(
                    F.lit(metric).alias("metric"),
                    self.key.cast("string").alias("key"),
                    *((both[own].cast("double") if which == own else nothing).alias(name) for which, name in enumerate(("expected", "actual"))),
                )
                for metric, both in self.measures.items()
            )
            return df.select(F.lit(area).alias("area"), F.inline(F.array(*rows)), F.lit(self.tolerance).alias("tolerance"))

        return side(self.expected, 0).unionByName(side(self.actual, 1))


def compare_all(comparisons: Mapping[str, Comparison]) -> DataFrame:
    """All comparisons as (area, metric, key, expected, actual, match).

    The sides of all areas are stacked and grouped, which pairs them like null-safe full outer joins
    but with one shuffle for all, and shows a key that one side repeats as a difference.
    """
    stacked = reduce(DataFrame.unionByName, (c.values(area) for area, c in comparisons.items()))
    paired = stacked.groupBy("area", "metric", "key").agg(
        F.sum("expected").alias("expected"), F.sum("actual").alias("actual"), F.max("tolerance").alias("tolerance")
    )
    near = F.abs(F.col("expected") - F.col("actual")) <= F.col("tolerance")
    same = F.col("expected").eqNullSafe(F.col("actual")) | F.coalesce(near, F.lit(False))
    return paired.withColumn("match", same).drop("tolerance")


def compare(
    expected: DataFrame,
    actual: DataFrame,
    key: Column,
    measures: Mapping[str, tuple[Column, Column]],
    tolerance: float = 0.0,
) -> DataFrame:
    """One comparison as (metric, key, expected, actual, match)."""
    return compare_all({"": Comparison(expected, actual, key, measures, tolerance)}).drop("area")


def _totals(registrations: DataFrame, headline: DataFrame) -> Comparison:
    return Comparison(
        totals(registrations),
        headline,
        F.lit("all"),
        {
            "registrations": (F.col("registrations"), F.col("registrations")),
            "paid_registrations": (F.col("paid_registrations"), F.col("paid_registrations")),
            "total_net_revenue_aud": (money(F.col("net_cents")), F.col("total_net_revenue_aud")),
        },
    )


def _months(registrations: DataFrame, monthly_revenue: DataFrame) -> Comparison:
    rolled_up = monthly_revenue.groupBy("year_month").agg(F.round(F.sum("net_revenue_aud"), 2).alias("net"))
    net = (money(F.col("net_cents")), F.col("net"))
    return Comparison(net_by_month(registrations), rolled_up, F.col("year_month"), {"net_revenue_aud": net})


def _fill(tournaments: DataFrame, registrations: DataFrame, tournament_fill: DataFrame) -> Comparison:
    ratio = F.col("teams_entered") / F.col("max_teams")
    actual = tournament_fill.agg(F.avg(ratio).alias("average_fill_rate"))
    rate = F.round("average_fill_rate", 6)
    return Comparison(
        mean_fill(tournaments, registrations), actual, F.lit("all"), {"average_fill_rate": (rate, rate)}, FILL_TOLERANCE
    )


def _players(matches: DataFrame, leaderboard: DataFrame, min_matches: int) -> Comparison:
    expected = (
        player_records(matches)
        .where(F.col("matches_played") >= min_matches)
        .withColumnRenamed("player_id", "player_key")
    )
    measures = {
        "matches_played": (F.col("matches_played"), F.col("matches_played")),
        "wins": (F.col("wins"), F.coalesce("wins", F.lit(0))),
    }
    return Comparison(expected, leaderboard, F.col("player_key"), measures)


def _refunds(payments: DataFrame, refund_rate: DataFrame) -> Comparison:
    same = {m: (F.col(m), F.col(m)) for m in ("payments", "refunds")}
    return Comparison(refunds(payments), refund_rate, F.col("provider"), same)


def reconcile_totals(registrations: DataFrame, headline: DataFrame) -> DataFrame:
    return compare(*_totals(registrations, headline))


def reconcile_months(registrations: DataFrame, monthly_revenue: DataFrame) -> DataFrame:
    return compare(*_months(registrations, monthly_revenue))


def reconcile_fill(tournaments: DataFrame, registrations: DataFrame, tournament_fill: DataFrame) -> DataFrame:
    return compare(*_fill(tournaments, registrations, tournament_fill))


def reconcile_players(matches: DataFrame, leaderboard: DataFrame, min_matches: int = MIN_MATCHES) -> DataFrame:
    """Played and won per player; the leaderboard's unknown wins count as none."""
    return compare(*_players(matches, leaderboard, min_matches))


def reconcile_refunds(payments: DataFrame, refund_rate: DataFrame) -> DataFrame:
    return compare(*_refunds(payments, refund_rate))


def reconcile(
    sources: Mapping[str, DataFrame],
    marts: Mapping[str, DataFrame],
    headline: DataFrame,
    min_matches: int = MIN_MATCHES,
) -> DataFrame:
    """Every comparison in one stacked pass, with an area column in front."""
    registrations = sources["registrations"]
    return compare_all(
        {
            "totals": _totals(registrations, headline),
            "months": _months(registrations, marts["v_monthly_revenue"]),
            "fill": _fill(sources["tournaments"], registrations, marts["v_tournament_fill"]),
            "players": _players(sources["matches"], marts["v_player_leaderboard"], min_matches),
            "refunds": _refunds(sources["payments"], marts["v_refund_rate"]),
        }
    )
