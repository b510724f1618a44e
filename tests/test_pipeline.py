import datetime as dt
import glob
import re

import pytest

from stellate.operators.keys import orphans
from stellate.plans import dimensions, facts, marts, pipeline, quality, staging
from stellate.plans.catalogue import Models
from stellate.session import scratch_dir
from stellate.sinks.releases import Draft
from stellate.sinks.tables import LAYERS, Warehouse, clustered
from tests.support import CLUBS, MATCHES, REGISTRATIONS, plan, rows, sources, ts


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    warehouse = Warehouse(spark, prefix="t_", root=str(tmp_path_factory.mktemp("wh")))
    pipeline.build(warehouse, sources(spark))
    return warehouse


def test_layers_and_tables(spark, built):
    assert {d.name for d in spark.catalog.listDatabases()} >= {f"t_{layer}" for layer in LAYERS}
    described = {r.info_name: r.info_value for r in spark.sql("DESCRIBE DATABASE t_raw").collect()}
    assert described["Comment"] == LAYERS["raw"]
    tables = {layer: {t.name for t in spark.catalog.listTables(f"t_{layer}")} for layer in LAYERS}
    assert len(tables["raw"]) == 6 and len(tables["stg"]) == 6 and len(tables["core"]) == 6
    assert tables["mart"] == set(marts.VIEWS)
    assert all(t.tableType == "VIEW" for t in spark.catalog.listTables("t_mart"))


def test_stored_tables_equal_the_lazy_models(spark, built):
    tables = sources(spark)
    dim = dimensions.dim_tournament(
        staging.stg_tournaments(tables["tournaments"]), staging.stg_clubs(tables["clubs"])
    )
    fact = facts.fct_registration(staging.stg_registrations(tables["registrations"]), dim)
    played = facts.fct_match_participation(staging.stg_matches(tables["matches"]))
    for name, lazy in {
        "dim_tournament": dim,
        "dim_player": dimensions.dim_player(staging.stg_players(tables["players"])),
        "dim_club": dimensions.dim_club(staging.stg_clubs(tables["clubs"])),
        "dim_date": dimensions.dim_date(spark),
        "fct_registration": fact,
        "fct_match_participation": played,
    }.items():
        assert rows(built.table("core", name).select(lazy.columns)) == rows(lazy)
    views = {
        "v_monthly_revenue": marts.monthly_revenue(fact, dimensions.dim_date(spark), dim),
        "v_tournament_fill": marts.tournament_fill(dim, fact),
        "v_player_leaderboard": marts.player_leaderboard(
            played, dimensions.dim_player(staging.stg_players(tables["players"]))
        ),
        "v_player_acquisition": marts.player_acquisition(
            dimensions.dim_player(staging.stg_players(tables["players"]))
        ),
        "v_refund_rate": marts.refund_rate(staging.stg_payments(tables["payments"])),
    }
    assert set(views) == set(marts.VIEWS)
    for name, lazy in views.items():
        stored = built.table("mart", name)
        assert stored.columns == lazy.columns and rows(stored) == rows(lazy)


def test_marts_reconcile_with_their_sources(built):
    assert all(r.match for r in pipeline.verify(built).collect())


def test_rebuild_replaces_everything_and_views_follow(spark, tmp_path):
    warehouse = Warehouse(spark, prefix="again_", root=str(tmp_path))
    pipeline.build(warehouse, sources(spark))
    pipeline.build(warehouse, sources(spark))
    assert warehouse.table("raw", "registrations").count() == len(REGISTRATIONS)
    late = {**REGISTRATIONS[0], "registration_id": 90, "registered_at": ts("2025-07-01T00:00:00")}
    before = rows(warehouse.table("mart", "v_monthly_revenue"))
    pipeline.build(warehouse, sources(spark, registrations=[*REGISTRATIONS, late]))
    after = rows(warehouse.table("mart", "v_monthly_revenue"))
    assert [r for r in after if r not in before] == [
        dict(
            year_month="2025-07",
            club_name="North Court",
            category="Open",
            registrations=1,
            paid_registrations=1,
            net_revenue_aud=50.0,
        )
    ]


def test_catalog_managed_tables(spark):
    warehouse = Warehouse(spark, prefix="managed_")
    for _ in range(2):
        pipeline.build(warehouse, sources(spark))
    assert warehouse.table("core", "fct_registration").count() == len(REGISTRATIONS)


def test_failed_rule_stops_the_build_before_staging(spark, tmp_path):
    warehouse = Warehouse(spark, prefix="bad_", root=str(tmp_path))
    dirty = sources(spark, clubs=[*CLUBS, CLUBS[0]])
    with pytest.raises(quality.QualityError):
        pipeline.build(warehouse, dirty)
    assert spark.catalog.listTables("bad_stg") == []
    report = pipeline.build(warehouse, dirty, strict=False)
    assert [r.column_name for r in report if not r.passed] == ["club_id"]


def test_replayed_registrations_are_settled_by_the_build(spark, tmp_path):
    warehouse = Warehouse(spark, prefix="replay_", root=str(tmp_path))
    pipeline.build(warehouse, sources(spark, registrations=REGISTRATIONS * 3))
    assert warehouse.table("core", "fct_registration").count() == len(REGISTRATIONS)


def test_unknown_dates_form_a_partition(spark, tmp_path):
    warehouse = Warehouse(spark, prefix="nodate_", root=str(tmp_path))
    unset = {**MATCHES[0], "match_id": 90, "scheduled_at": None}
    pipeline.build(warehouse, sources(spark, matches=[*MATCHES, unset]))
    fact = warehouse.table("core", "fct_match_participation")
    assert fact.where("match_date IS NULL").count() == 4
    assert glob.glob(f"{tmp_path}/nodate_releases/tables/core/fct_match_participation/*/match_date=__HIVE_DEFAULT_PARTITION__")


def test_fact_filters_prune_partitions_and_row_groups(built):
    fact = built.table("core", "fct_registration").where("registered_date = date '2024-02-15' AND tournament_key = 2")
    text = plan(fact)
    assert re.search(r"PartitionFilters: \[[^\]]*registered_date", text)
    assert "EqualTo(tournament_key,2)" in text


def test_month_filter_on_the_view_reaches_the_fact_partitions(built):
    month = built.table("mart", "v_monthly_revenue").where("year_month = '2024-02'")
    assert "dynamicpruning" in plan(month).lower()


def test_clustered_write_spreads_a_hot_day_and_sorts_once(spark, tmp_path):
    hot = spark.range(40_000).selectExpr(
        "if(id % 3 = 0, date '2024-01-01', date_add(date '2024-01-02', int(id % 20))) AS d",
        "if(id % 3 = 0, 7, id % 50) AS k",
        "id",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid = clustered(hot, "d", ["k"], ["id"])
        laid.write.partitionBy("d").parquet(str(tmp_path / "f"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot_files = glob.glob(f"{tmp_path}/f/d=2024-01-01/*.parquet")
    all_files = glob.glob(f"{tmp_path}/f/*/*.parquet")
    assert len(hot_files) > 1 and len(all_files) <= 21 + 2 * 4
    back = spark.read.parquet(str(tmp_path / "f"))
    assert back.count() == 40_000 and back.exceptAll(hot.select(back.columns)).count() == 0


def test_facts_refer_to_their_dimensions(built):
    registrations = built.table("core", "fct_registration")
    played = built.table("core", "fct_match_participation")
    dates = built.table("core", "dim_date").selectExpr("unix_date(date_key) AS date_key")
    links = [
        (registrations, "player_key", "dim_player", "player_key"),
        (registrations, "tournament_key", "dim_tournament", "tournament_key"),
        (registrations, "club_key", "dim_club", "club_key"),
        (played, "player_key", "dim_player", "player_key"),
        (played, "tournament_key", "dim_tournament", "tournament_key"),
    ]
    for fact, column, dim, key in links:
        assert orphans(fact, column, built.table("core", dim), key).count() == 0
    for fact, column in ((registrations, "registered_date"), (played, "match_date")):
        days = fact.selectExpr(f"unix_date({column}) AS day")
        assert orphans(days, "day", dates, "date_key").count() == 0


def test_fact_grains(built):
    registrations = built.table("core", "fct_registration")
    assert registrations.select("registration_id").distinct().count() == registrations.count()
    played = built.table("core", "fct_match_participation")
    assert played.select("match_id", "player_key").distinct().count() == played.count() == 4 * len(MATCHES)


def test_clustered_write_is_not_sorted_again(spark):
    spark.sql("CREATE TABLE sorted_once (k BIGINT, id BIGINT, d DATE) USING parquet PARTITIONED BY (d)")
    rows_ = spark.range(100).selectExpr("id % 7 AS k", "id", "date_add(date '2024-01-01', int(id % 5)) AS d")
    clustered(rows_, "d", ["k"], ["id"]).createOrReplaceTempView("laid_out")
    text = spark.sql("EXPLAIN INSERT INTO sorted_once SELECT * FROM laid_out").first()[0]
    assert text.count("Sort [") == 1 and "rangepartitioning(d" in text


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/")


def test_tables_are_written_small_and_the_calendar_is_read_from_them(spark, tmp_path):
    warehouse = Warehouse(spark, prefix="days_", root=str(tmp_path))
    read = []

    def first_days(raw):
        read.extend(raw["registrations"].inputFiles())
        return dt.date(2024, 1, 1), dt.date(2024, 2, 29)

    pipeline.build(warehouse, sources(spark), calendar=first_days)
    assert warehouse.table("core", "dim_date").count() == 60
    assert read and all("/tables/raw/registrations/" in f for f in read)
    written = glob.glob(f"{tmp_path}/days_releases/tables/*/*/**/*.parquet", recursive=True)
    assert written and all(f.endswith(".zstd.parquet") for f in written)


@pytest.mark.parametrize("name", ["strict_gate", "release_reads"])
def test_later_landings_take_the_rows_landed_first(spark, name, monkeypatch):
    landed = []

    def small(self, warehouse, strict=False, **changed):
        if not changed:
            pipeline.build(warehouse, sources(spark))
            return
        landed.append(changed["registrations"])
        if strict:
            raise quality.QualityError("stopped")

    monkeypatch.setattr(Models, "deploy", small)
    getattr(Models(spark, "/root/testdata/sf0.001"), name)
    assert landed
    for df in landed:
        assert "Join" not in plan(df) and all("/tables/raw/registrations/" in f for f in df.inputFiles())
        assert sorted(r.registration_id for r in df.collect()) == [2, 4, 6]


@pytest.fixture
def planned(monkeypatch):
    """The plans of a build's tables as they are written: table -> one text a build."""
    texts, replace = {}, Draft.replace

    def seen(self, layer, table, df, *layout):
        texts.setdefault(table, []).append(plan(df))
        return replace(self, layer, table, df, *layout)

    monkeypatch.setattr(Draft, "replace", seen)
    return texts


def alike(spark, many):
    """Clubs and tournaments that take little of a file and much of a broadcast."""
    clubs = spark.range(many).selectExpr(
        "id AS club_id", "'North Court' AS name", "'Oslo' AS city", "'NO' AS country",
        "timestamp '2022-05-01 10:00:00' AS created_at",
    )
    tournaments = spark.range(many).selectExpr(
        "id AS tournament_id", "id AS club_id", "'Cup' AS name", "'Open' AS category", "'Indoor' AS surface",
        "5000L AS entry_fee_cents", "'AUD' AS currency", "4L AS max_teams", "date '2024-03-01' AS start_date",
        "date '2024-03-03' AS end_date", "'completed' AS status", "timestamp '2024-01-01 00:00:00' AS created_at",
    )
    return dict(clubs=clubs, tournaments=tournaments)


def test_sides_are_broadcast_by_their_rows_not_by_their_files(spark, tmp_path, planned):
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "100KB")
    try:
        for name, changed, join in (("few", {}, "BroadcastHashJoin"), ("many", alike(spark, 5_000), "SortMergeJoin")):
            warehouse = Warehouse(spark, prefix=name, root=str(tmp_path), catalog=False)
            pipeline.build(warehouse, sources(spark) | changed)
            assert join in planned["dim_tournament"][-1] and join in planned["fct_registration"][-1]
            dim = warehouse.table("core", "dim_tournament")
            assert dim.where("club_name = 'North Court' OR club_name = 'South Court'").count() == (5_000 if changed else 2)
            assert warehouse.table("core", "fct_registration").count() == len(REGISTRATIONS)
    finally:
        spark.conf.unset(key)
    written = glob.glob(f"{tmp_path}/manyreleases/tables/core/dim_tournament/*/*.parquet")
    assert sum(len(open(f, "rb").read()) for f in written) < 100_000


def test_no_build_of_release_reads_broadcasts_many_tournaments(spark, planned):
    models, key = Models(spark, "/root/testdata/sf0.001"), "spark.sql.autoBroadcastJoinThreshold"
    models.source = sources(spark) | alike(spark, 5_000)
    spark.conf.set(key, "100KB")
    try:
        reads = models.release_reads.collect()
    finally:
        spark.conf.unset(key)
    assert len(planned["registrations"]) == 3  # the second build stops before its models
    assert len(planned["fct_registration"]) == len(planned["dim_tournament"]) == 2
    assert all("BroadcastHashJoin" not in text for table in ("fct_registration", "dim_tournament") for text in planned[table])
    assert {r.read: r.registrations for r in reads} == {"pinned": 6, "after_failure": 6, "current": 3}
