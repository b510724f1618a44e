"""The full build: land, check, stage, model, then publish all layers at once as a release."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Row

from stellate.functions.dates import AGE_AS_OF, CALENDAR_END, CALENDAR_START
from stellate.operators.sides import broadcast_by_rows
from stellate.plans import dimensions, facts, marts, quality, reconcile, reports, staging
from stellate.sinks.releases import Draft, Release
from stellate.sinks.tables import Warehouse
from stellate.sources.schemas import SCHEMAS

Tables = Mapping[str, DataFrame]
Days = tuple[dt.date, dt.date]


def land(draft: Draft, sources: Tables) -> dict[str, DataFrame]:
    """Write the landing tables; rows that do not fit their schema fail here."""
    return {table: draft.replace("raw", table, sources[table]) for table in SCHEMAS}


def stage(draft: Draft, raw: Tables, as_of: dt.date = AGE_AS_OF) -> dict[str, DataFrame]:
    models = {
        "stg_clubs": staging.stg_clubs(raw["clubs"]),
        "stg_players": staging.stg_players(raw["players"], as_of),
        "stg_tournaments": staging.stg_tournaments(raw["tournaments"]),
        "stg_registrations": staging.stg_registrations(raw["registrations"]),
        "stg_payments": staging.stg_payments(raw["payments"]),
        "stg_matches": staging.stg_matches(raw["matches"]),
    }
    return {name: draft.replace("stg", name, df) for name, df in models.items()}


def model(
    draft: Draft,
    staged: Tables,
    calendar: Days = (CALENDAR_START, CALENDAR_END),
    interleave: bool = False,
) -> dict[str, DataFrame]:
    """Dimensions first: the registration fact reads the written tournament dimension.

    Clubs and tournaments are joined as written tables, whose files say little of their rows, so their rows
    are measured before one of them may be broadcast.
    With ``interleave`` the facts' files are narrow in each cluster key, not in the first only.
    """
    core = {
        "dim_date": dimensions.dim_date(draft.spark, *calendar),
        "dim_player": dimensions.dim_player(staged["stg_players"]),
        "dim_club": dimensions.dim_club(staged["stg_clubs"]),
        "dim_tournament": dimensions.dim_tournament(staged["stg_tournaments"], broadcast_by_rows(staged["stg_clubs"], dimensions.CLUB_COLUMNS)),
    }
    core = {name: draft.replace("core", name, df) for name, df in core.items()}
    tournaments = broadcast_by_rows(core["dim_tournament"], facts.TOURNAMENT_COLUMNS)
    fact_models = {
        "fct_registration": facts.fct_registration(staged["stg_registrations"], tournaments),
        "fct_match_participation": facts.fct_match_participation(staged["stg_matches"]),
    }
    for name, df in fact_models.items():
        partition_by, cluster_by, grain = facts.LAYOUT[name]
        core[name] = draft.replace("core", name, df, partition_by, cluster_by, grain, interleave)
    return core


class ReconcileError(Exception):
    """The marts of a build differ from its landing rows."""


def build(
    warehouse: Warehouse,
    sources: Tables,
    calendar: Days | Callable[[Tables], Days] = (CALENDAR_START, CALENDAR_END),
    as_of: dt.date = AGE_AS_OF,
    min_matches: int = marts.MIN_MATCHES,
    strict: bool = True,
    reconciled: bool = False,
    interleave: bool = False,
) -> list[Row]:
    """Write, audit, publish: build all layers unseen, check them, make them the current release; returns the quality report.

    Each layer is read back from its written tables, so a lost executor costs a step's
    tasks and never the steps before it. A failed rule stops the build before staging,
    or after it for repeated registrations; ``strict=False`` only reports. With ``reconciled`` a mart that
    differs from the landing rows stops it too. A build that stops publishes nothing: landing tables,
    models and views stay as they were, all of one release, and its files are deleted.
    A calendar that follows the data is given as a function of the landing tables, which are read for it as
    they were written.
    """
    check = quality.gate if strict else DataFrame.collect
    warehouse.create_layers()
    draft = warehouse.begin()
    try:
        raw = land(draft, sources)
        report = check(quality.run_checks(raw))
        staged = stage(draft, raw, as_of)
        report += check(quality.check_staged(staged["stg_registrations"]))
        model(draft, staged, calendar(raw) if callable(calendar) else calendar, interleave)
        if reconciled:
            differing = verify_release(draft.release(), min_matches).where("NOT match").limit(20).collect()
            if differing:
                raise ReconcileError("; ".join(f"{r.area} {r.metric} {r.key}: {r.expected} against {r.actual}" for r in differing))
    except Exception:
        draft.discard()
        raise
    warehouse.publish(draft, marts.view_texts(draft.release(), min_matches))
    return report


def verify_release(release: Release, min_matches: int = marts.MIN_MATCHES) -> DataFrame:
    """Marts against the landing rows they came from, both sides read from one release (REC-6)."""
    views = marts.of_release(release, min_matches)
    headline = reports.headline(release.table("core", "fct_registration"))
    return reconcile.reconcile(release.tables("raw"), views, headline, min_matches)


def verify(warehouse: Warehouse, min_matches: int = marts.MIN_MATCHES) -> DataFrame:
    """``verify_release`` of the current release, which it keeps reading if another is published meanwhile."""
    return verify_release(warehouse.release(), min_matches)
