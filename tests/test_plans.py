"""The plans that matter at scale: pruned scans, few shuffles, no hot task, nothing in Python."""

import os

import pytest

import __spark_entry__ as entry
from stellate.plans import dimensions, facts, marts, staging
from stellate.plans.catalogue import PLAIN, Models
from tests.support import final_plan, plan

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n in PLAIN if not n.startswith(("landing", "deployed"))])
def test_no_cross_join_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "SinglePartition, REPARTITION"):
        assert operator not in text


def test_scans_read_only_what_a_query_needs(spark):
    text = plan(Models(spark, FOLDER).refund_rate)
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double,o_orderpriority:string>" in text
    text = plan(Models(spark, FOLDER).player_leaderboard)
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in text


def written(spark, tmp_path, name, df):
    df.write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


def test_filters_reach_the_scan_of_the_matches(spark, tmp_path):
    matches = written(spark, tmp_path, "m", Models(spark, FOLDER).source["matches"])
    text = plan(facts.fct_match_participation(staging.stg_matches(matches)))
    assert "EqualTo(status,played)" in text and text.count("FileScan") == 1 and "Exchange" not in text


def test_filter_on_one_tournament_reaches_both_sides_of_the_fill(spark, tmp_path):
    models = Models(spark, FOLDER)
    fact = written(spark, tmp_path, "f", models.fct_registration)
    dim = written(spark, tmp_path, "t", models.dim_tournament)
    text = plan(marts.tournament_fill(dim, fact).where("tournament_key = 7"))
    assert text.count("EqualTo(tournament_key,7)") == 2


def test_marts_over_tables_combine_before_they_shuffle(spark, tmp_path):
    models = Models(spark, FOLDER)
    fact = written(spark, tmp_path, "f", models.fct_registration)
    dim = written(spark, tmp_path, "t", models.dim_tournament)
    text = plan(marts.monthly_revenue(fact, models.dim_date, dim))
    # The fact meets the calendar without a shuffle and is counted before the first one.
    scan = text.index("registered_date", text.index("FileScan"))
    first = text.rindex("Exchange hashpartitioning", 0, scan)
    assert "partial_count" in text[first:scan]
    assert "BroadcastHashJoin [registered_date" in text[first:scan]


def test_leaderboard_shuffles_once_when_players_are_many(spark, tmp_path):
    models = Models(spark, FOLDER)
    played = written(spark, tmp_path, "p", models.fct_match_participation)
    players = written(spark, tmp_path, "d", models.dim_player)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(marts.player_leaderboard(played, players))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange per side; the second grouping reuses the join's partitioning.
    assert text.count("Exchange") == 2 and "SortMergeJoin" in text


def test_a_hot_tournament_is_split_in_the_fact_join(spark, tmp_path, monkeypatch):
    registrations = spark.range(60_000).selectExpr(
        "id AS registration_id",
        "if(id % 3 = 0, 7, id % 400) AS tournament_id",
        "id AS player_id",
        "id AS partner_player_id",
        "id AS seed",
        "id AS amount_paid_cents",
        "'paid' AS payment_status",
        "timestamp '2024-01-01 00:00:00' AS registered_at",
    )
    clubs = spark.createDataFrame([(0, "c", "x", "y")], "club_id long, club_name string, city string, country string")
    tournaments = spark.range(400).selectExpr(
        "id AS tournament_id", "0L AS club_id", "'t' AS tournament_name", "'o' AS category", "'i' AS surface",
        "'AUD' AS currency", "1D AS entry_fee_aud", "8L AS max_teams", "date '2024-01-01' AS start_date",
        "date '2024-01-01' AS end_date", "1L AS duration_days", "'completed' AS status",
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        dim = dimensions.dim_tournament(tournaments, clubs)
        fact = facts.fct_registration(staging.stg_registrations(registrations), dim)
        mart = marts.monthly_revenue(fact, dimensions.dim_date(spark), dim)
        assert "skew=true" in final_plan(mart)
        assert sum(r.registrations for r in mart.collect()) == 60_000
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_merged_partitions_stay_small_unless_the_cluster_names_a_size(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.unset(key)
    Models(spark, FOLDER)
    assert spark.conf.get(key) == "8m"
    spark.conf.set(key, "20KB")
    try:
        Models(spark, FOLDER)
        assert spark.conf.get(key) == "20KB"
    finally:
        spark.conf.unset(key)


def test_few_named_partitions_do_not_widen_the_tasks_of_the_monthly_revenue(spark):
    named, initial = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = {key: spark.conf.get(key) for key in (named, initial)}
    try:
        spark.conf.set(named, "4")
        spark.conf.unset(initial)
        for query in ("revenue_by_month", "revenue_first_rows", "reconcile_months"):
            text = plan(getattr(Models(spark, FOLDER), query))
            assert "hashpartitioning(registration_id" in text and ", 4), ENSURE_REQUIREMENTS" not in text
        spark.conf.set(named, "600")  # more than the fewest: no start of our own stays behind
        Models(spark, FOLDER)
        assert spark.conf.get(initial, None) is None
        spark.conf.set(initial, "7")
        Models(spark, FOLDER)
        assert spark.conf.get(initial) == "7"
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_scanned_splits_stay_small_unless_the_cluster_names_a_size(spark):
    key = "spark.sql.files.maxPartitionBytes"
    spark.conf.unset(key)
    Models(spark, FOLDER)
    assert spark.conf.get(key) == "8m"
    spark.conf.set(key, "64m")
    try:
        Models(spark, FOLDER)
        assert spark.conf.get(key) == "64m"
    finally:
        spark.conf.unset(key)


@pytest.fixture(scope="module")
def long_lineitems(spark, tmp_path_factory):
    """A folder whose lineitems are one file of some 45 MB in row groups of 1 MB."""
    folder = tmp_path_factory.mktemp("long")
    for table in ("customer", "part", "supplier", "nation"):
        os.symlink(f"{FOLDER}/{table}.parquet", folder / f"{table}.parquet")
    lines = spark.range(0, 1_200_000, 1, 1).selectExpr(
        "id div 4 AS l_orderkey",
        "id % 200 AS l_partkey",
        "int(id % 4 + 1) AS l_linenumber",
        "substr('ARN', int(id % 3 + 1), 1) AS l_returnflag",
        "'F' AS l_linestatus",
        "timestamp_ntz '1997-05-01 00:00:00' AS l_shipdate",
        "uuid() AS l_comment",
    )
    lines.write.option("parquet.block.size", 1 << 20).parquet(str(folder / "lineitem.parquet"))
    orders = spark.range(300_000).selectExpr("id AS o_orderkey", "id % 150 AS o_custkey")
    orders.write.parquet(str(folder / "orders.parquet"))
    return str(folder)


@pytest.mark.parametrize("query", ["revenue_first_rows", "reconcile_months"])
def test_no_task_scans_and_sorts_a_whole_file(spark, long_lineitems, query):
    least = "spark.sql.files.minPartitionNum"  # or Spark would split by the cores of this machine
    size = "spark.sql.files.maxPartitionBytes"
    spark.conf.unset(size)
    spark.conf.set(least, "1")
    try:
        spark.sparkContext.setJobGroup(f"scans of {query}", query)
        assert getattr(Models(spark, long_lineitems), query).collect()
        tracker = spark.sparkContext.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(f"scans of {query}")]
        stages = [tracker.getStageInfo(s) for job in jobs for s in job.stageIds]
        # The shuffles of this session start with 4 partitions, so a wider stage is one that scans.
        assert max(stage.numTasks for stage in stages if stage) >= 5
    finally:
        spark.conf.unset(least)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
