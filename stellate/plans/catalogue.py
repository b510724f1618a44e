"""Every model, check and report as a query over a folder of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from stellate.operators.keys import orphans
from stellate.plans import dimensions, facts, marts, pipeline, quality, reconcile, reports, staging
from stellate.session import prepare, scratch_dir
from stellate.sinks.releases import Release
from stellate.sinks.tables import Warehouse, clustered
from stellate.sources.binding import CLIPPED_CALENDAR, Bound
from stellate.sources.landing import read_landing, unknown_fields, write_lines
from stellate.sources.schemas import SCHEMAS


class Models:
    """All layers over one folder as lazy DataFrames; nothing is stored between queries."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark)
        self.source = Bound(spark, folder)

    # Staging

    @cached_property
    def stg_clubs(self) -> DataFrame:
        return staging.stg_clubs(self.source["clubs"])

    @cached_property
    def stg_players(self) -> DataFrame:
        return staging.stg_players(self.source["players"])

    @cached_property
    def stg_tournaments(self) -> DataFrame:
        return staging.stg_tournaments(self.source["tournaments"])

    @cached_property
    def stg_registrations(self) -> DataFrame:
        return staging.stg_registrations(self.source["registrations"])

    @cached_property
    def stg_payments(self) -> DataFrame:
        return staging.stg_payments(self.source["payments"])

    @cached_property
    def stg_matches(self) -> DataFrame:
        return staging.stg_matches(self.source["matches"])

    # Dimensions and facts

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date_of(self.source["registrations"], "registered_at")

    @cached_property
    def dim_player(self) -> DataFrame:
        return dimensions.dim_player(self.stg_players)

    @cached_property
    def dim_club(self) -> DataFrame:
        return dimensions.dim_club(self.stg_clubs)

    @cached_property
    def dim_tournament(self) -> DataFrame:
        return dimensions.dim_tournament(self.stg_tournaments, self.stg_clubs)

    @cached_property
    def fct_registration(self) -> DataFrame:
        return facts.fct_registration(self.stg_registrations, self.dim_tournament)

    @cached_property
    def fct_match_participation(self) -> DataFrame:
        return facts.fct_match_participation(self.stg_matches)

    # Marts

    @cached_property
    def monthly_revenue(self) -> DataFrame:
        return marts.monthly_revenue(self.fct_registration, self.dim_date, self.dim_tournament)

    @cached_property
    def monthly_revenue_clipped(self) -> DataFrame:
        clipped = dimensions.dim_date(self.spark, *CLIPPED_CALENDAR)
        return marts.monthly_revenue(self.fct_registration, clipped, self.dim_tournament)

    @cached_property
    def tournament_fill(self) -> DataFrame:
        return marts.tournament_fill(self.dim_tournament, self.fct_registration)

    @cached_property
    def player_leaderboard(self) -> DataFrame:
        return marts.player_leaderboard(self.fct_match_participation, self.dim_player)

    @cached_property
    def player_acquisition(self) -> DataFrame:
        return marts.player_acquisition(self.dim_player)

    @cached_property
    def refund_rate(self) -> DataFrame:
        return marts.refund_rate(self.stg_payments)

    @cached_property
    def headline(self) -> DataFrame:
        return reports.headline(self.fct_registration)

    # Ordered and top-k reports

    @property
    def top_players(self) -> DataFrame:
        return reports.top_players(self.player_leaderboard)

    @property
    def best_win_rates(self) -> DataFrame:
        return reports.best_win_rates(self.player_leaderboard)

    @property
    def revenue_by_month(self) -> DataFrame:
        return reports.revenue_by_month(self.monthly_revenue)

    @property
    def revenue_first_rows(self) -> DataFrame:
        return reports.revenue_by_month(self.monthly_revenue, 20)

    @property
    def tournaments_by_fill(self) -> DataFrame:
        return reports.tournaments_by_fill(self.tournament_fill)

    @property
    def refunds_by_provider(self) -> DataFrame:
        return reports.refunds_by_provider(self.refund_rate)

    @property
    def latest_months(self) -> DataFrame:
        return reports.latest_months(self.source["registrations"])

    @property
    def top_players_by_rounded_rate(self) -> DataFrame:
        return reports.top_players_by_rounded_rate(self.source["matches"])

    # Quality

    @property
    def dq_pk(self) -> DataFrame:
        return quality.run_checks(self.source, references=(), row_rules=())

    @property
    def dq_fk(self) -> DataFrame:
        return quality.run_checks(self.source, row_rules=()).where(F.col("rule") != "unique")

    @property
    def dq_rules(self) -> DataFrame:
        return quality.run_checks(self.source, keys={}, references=())

    @property
    def dq_report(self) -> DataFrame:
        return quality.run_checks(self.source)

    @property
    def dq_staged(self) -> DataFrame:
        return quality.check_staged(self.stg_registrations)

    @property
    def dq_orphan_registrations(self) -> DataFrame:
        return orphans(self.source["registrations"], "tournament_id", self.source["tournaments"], "tournament_id")

    @property
    def dq_orphan_payments(self) -> DataFrame:
        return orphans(self.source["payments"], "registration_id", self.source["registrations"], "registration_id")

    # Reconciliation

    @property
    def reconcile_totals(self) -> DataFrame:
        return reconcile.reconcile_totals(self.source["registrations"], self.headline)

    @property
    def reconcile_months(self) -> DataFrame:
        return reconcile.reconcile_months(self.source["registrations"], self.monthly_revenue)

    @property
    def reconcile_fill(self) -> DataFrame:
        return reconcile.reconcile_fill(
            self.source["tournaments"], self.source["registrations"], self.tournament_fill
        )

    @property
    def reconcile_players(self) -> DataFrame:
        return reconcile.reconcile_players(self.source["matches"], self.player_leaderboard)

    @property
    def reconcile_refunds(self) -> DataFrame:
        return reconcile.reconcile_refunds(self.source["payments"], self.refund_rate)

    # Sinks and landing; these write below the shared scratch folder

    def landing(self, table: str) -> DataFrame:
        """A source table written as JSON lines and read back under its declared schema."""
        path = scratch_dir(self.spark, f"landing/{table}.ndjson")
        write_lines(self.source[table], path)
        return read_landing(self.spark, path, SCHEMAS[table], reject_unknown=True)

    @property
    def landing_unknown_fields(self) -> DataFrame:
        """Payments exported with two fields the schema does not have, one of them often absent."""
        path = scratch_dir(self.spark, "landing/payments_extra.ndjson")
        extra = self.source["payments"].select(
            "*",
            F.col("payment_id").alias("export_row"),
            F.when(F.col("status") == "refunded", F.col("provider")).alias("refund_note"),
        )
        write_lines(extra, path)
        return unknown_fields(self.spark, path, SCHEMAS["payments"])

    def sink_roundtrip(self, fact: str, interleave: bool = False) -> DataFrame:
        """A fact written partitioned and clustered, and read back."""
        path = scratch_dir(self.spark, f"sink/{fact}")
        partition_by, cluster_by, grain = facts.LAYOUT[fact]
        df = getattr(self, fact)
        laid_out = clustered(df, partition_by, cluster_by, grain, interleave)
        laid_out.write.mode("overwrite").partitionBy(partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # Builds; each is written below the scratch folder and published as a release of its own

    def warehouse(self, catalog: bool = False) -> Warehouse:
        root = scratch_dir(self.spark, "warehouse")
        return Warehouse(self.spark, prefix=f"stellate_{uuid.uuid4().hex}_", root=root, catalog=catalog)

    def deploy(self, warehouse: Warehouse, strict: bool = False, **changed: DataFrame) -> None:
        """The whole build of the sources, some of them changed; known offences are only reported, unless strict."""
        sources = {table: self.source[table] for table in SCHEMAS} | changed
        pipeline.build(warehouse, sources, calendar=_days_covered, strict=strict)

    def deployed(self, view: str) -> DataFrame:
        """A view of the catalog; its scan names files, so it outlives the databases, which are dropped."""
        warehouse = self.warehouse(catalog=True)
        try:
            self.deploy(warehouse)
            return warehouse.table("mart", view)
        finally:
            warehouse.drop_layers()

    @property
    def verify(self) -> DataFrame:
        """All areas of the reconciliation over the written tables of one release."""
        warehouse = self.warehouse()
        self.deploy(warehouse)
        return pipeline.verify(warehouse)

    @property
    def layer_descriptions(self) -> DataFrame:
        """What the catalog says of a deployed build's layers: (layer, description, relations)."""
        warehouse = self.warehouse(catalog=True)
        try:
            self.deploy(warehouse)
            return self.spark.createDataFrame(warehouse.describe_layers(), "layer string, description string, relations bigint")
        finally:
            warehouse.drop_layers()

    @property
    def strict_gate(self) -> DataFrame:
        """The rules that stop a strict landing of new rows, and what its table holds after that: (table_name,
        column_name, rule, offending, releases, published_rows). The landing would halve the registrations."""
        warehouse = self.warehouse()
        self.deploy(warehouse)
        try:
            self.deploy(warehouse, strict=True, registrations=_halved(warehouse.release()))
            failed = []
        except quality.QualityError as error:
            failed = [(r.table_name, r.column_name, r.rule, r.offending) for r in error.failed]
        rules = self.spark.createDataFrame(failed, "table_name string, column_name string, rule string, offending bigint")
        raw = warehouse.release().tables("raw")
        counts = [df.agg(F.lit(table).alias("table_name"), F.count("*").alias("published_rows")) for table, df in raw.items()]
        releases = F.lit(len(warehouse.store.numbers())).cast("bigint").alias("releases")
        return rules.join(reduce(DataFrame.unionByName, counts), "table_name").select(
            "table_name", "column_name", "rule", "offending", releases, "published_rows"
        )

    @property
    def release_reads(self) -> DataFrame:
        """Headlines of a release that stays pinned while a strict build fails and another halves the registrations."""
        warehouse = self.warehouse()
        self.deploy(warehouse)
        pinned = warehouse.release()
        halved = _halved(pinned)
        try:
            self.deploy(warehouse, strict=True, registrations=halved)
        except quality.QualityError:
            pass  # the given tables offend; the next read shows that nothing changed
        after_failure = warehouse.release()
        self.deploy(warehouse, registrations=halved)
        reads = {"pinned": pinned, "after_failure": after_failure, "current": warehouse.release()}
        rows = (reports.headline(r.table("core", "fct_registration")).select(F.lit(name).alias("read"), "*") for name, r in reads.items())
        return reduce(DataFrame.unionByName, rows)


def _days_covered(raw: pipeline.Tables) -> pipeline.Days:
    """The days of the registrations; a fixed range if none is known."""
    day = F.to_date("registered_at")
    first, last = raw["registrations"].agg(F.min(day), F.max(day)).first()
    return (first, last) if first else CLIPPED_CALENDAR


def _halved(release: Release) -> DataFrame:
    """Half of the registrations, from a release's landing table: its rows are the source's, which need not be joined again."""
    return release.table("raw", "registrations").where("registration_id % 2 = 0")


# Names of Models attributes that are queries as they stand.
PLAIN = (
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
    "top_players",
    "best_win_rates",
    "revenue_by_month",
    "revenue_first_rows",
    "tournaments_by_fill",
    "refunds_by_provider",
    "latest_months",
    "top_players_by_rounded_rate",
    "dq_pk",
    "dq_fk",
    "dq_rules",
    "dq_report",
    "dq_staged",
    "dq_orphan_registrations",
    "dq_orphan_payments",
    "reconcile_totals",
    "reconcile_months",
    "reconcile_fill",
    "reconcile_players",
    "reconcile_refunds",
    "landing_unknown_fields",
    "verify",
    "layer_descriptions",
    "strict_gate",
    "release_reads",
)

Query = Callable[[SparkSession, str], DataFrame]


def _plain(name: str) -> Query:
    return lambda spark, folder: getattr(Models(spark, folder), name)


def _landing(table: str) -> Query:
    return lambda spark, folder: Models(spark, folder).landing(table)


def _sink(fact: str, interleave: bool) -> Query:
    return lambda spark, folder: Models(spark, folder).sink_roundtrip(fact, interleave)


def _deployed(view: str) -> Query:
    return lambda spark, folder: Models(spark, folder).deployed(view)


def queries() -> dict[str, Query]:
    return (
        {name: _plain(name) for name in PLAIN}
        | {f"landing_{table}": _landing(table) for table in SCHEMAS}
        | {f"sink_{fact}": _sink(fact, False) for fact in facts.LAYOUT}
        | {f"sink_interleaved_{fact}": _sink(fact, True) for fact in facts.LAYOUT}
        | {f"deployed_{view.removeprefix('v_')}": _deployed(view) for view in marts.VIEWS}
    )
