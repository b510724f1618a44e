"""Data-quality rules over the source tables, and the gate (DQ-1..9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F

from stellate.operators.census import Reference, RowRule, census
from stellate.sources.schemas import PRIMARY_KEYS


def outside(column: str, allowed: Sequence, nullable: bool = False) -> Column:
    """The value is none of the allowed ones; NULL counts as one of them only if ``nullable``."""
    return ~F.coalesce(F.col(column).isin(*allowed), F.lit(nullable))


# The references and the value domains that are checked.
REFERENCES = (
    Reference("tournaments", "club_id", "clubs"),
    Reference("registrations", "tournament_id", "tournaments"),
    Reference("registrations", "player_id", "players"),
    Reference("registrations", "partner_player_id", "players", nullable=True),
    Reference("payments", "registration_id", "registrations"),
    Reference("matches", "tournament_id", "tournaments"),
)
PAYMENT_STATUSES = ("paid", "pending", "refunded", "waived")
WINNERS = (1, 2)

ROW_RULES = (
    RowRule(
        "registrations", "payment_status", "in domain", lambda: outside("payment_status", PAYMENT_STATUSES)
    ),
    RowRule("matches", "winner_team", "in domain", lambda: outside("winner_team", WINNERS, nullable=True)),
    RowRule("registrations", "amount_paid_cents", "not negative", lambda: F.col("amount_paid_cents") < 0),
    RowRule(
        "registrations",
        "amount_paid_cents",
        "positive when paid",
        lambda: (F.col("payment_status") == "paid") & (F.coalesce("amount_paid_cents", F.lit(0)) <= 0),
    ),
)

# Replays repeat a registration on purpose and staging settles them, so on source rows
# this rule only warns; the gate on it is check_staged.
WARNINGS = (("registrations", "registration_id", "unique"),)


class QualityError(Exception):
    """A gate rule failed; ``failed`` holds the report's rows of such rules."""

    def __init__(self, message: str, failed: Sequence[Row] = ()):
        super().__init__(message)
        self.failed = list(failed)


def report(offences: DataFrame, warnings: Sequence[tuple[str, str, str]] = WARNINGS) -> DataFrame:
    """Offence counts with a verdict: (table_name, column_name, rule, severity, offending, passed)."""
    rule = F.concat_ws("|", "table_name", "column_name", "rule")
    warns = rule.isin(*("|".join(w) for w in warnings)) if warnings else F.lit(False)
    return offences.select(
        "table_name",
        "column_name",
        "rule",
        F.when(warns, "warning").otherwise("error").alias("severity"),
        "offending",
        (F.col("offending") == 0).alias("passed"),
    )


def run_checks(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, str] = PRIMARY_KEYS,
    references: Sequence[Reference] = REFERENCES,
    row_rules: Sequence[RowRule] = ROW_RULES,
) -> DataFrame:
    """The given rules, by default all, over the six source tables, one row per rule."""
    return report(census(tables, keys, references, row_rules))


def check_staged(stg_registrations: DataFrame) -> DataFrame:
    """After staging no registration may repeat."""
    key = {"registrations": PRIMARY_KEYS["registrations"]}
    return report(census({"registrations": stg_registrations}, key), warnings=())


def gate(checks: DataFrame) -> list[Row]:
    """Run a report, which has one row per rule; raise if a rule that is no warning failed."""
    rows = checks.collect()
    failed = [r for r in rows if not r.passed and r.severity == "error"]
    if failed:
        lines = (f"{r.table_name}.{r.column_name} {r.rule}: {r.offending} offending" for r in failed)
        raise QualityError("; ".join(lines), failed)
    return rows
