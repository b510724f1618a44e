"""Releases: what readers see while builds fail, succeed and race, and what is dropped."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from stellate.plans import marts, pipeline, quality
from stellate.sinks.releases import NoRelease, PublishConflict, Store
from stellate.sinks.tables import LAYERS, Warehouse
from tests.support import CLUBS, PAYMENTS, REGISTRATIONS, rows, sources

LATE = {**REGISTRATIONS[0], "registration_id": 90}


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def put(store, n, table="t"):
    draft = store.begin()
    draft.replace("raw", table, store.spark.range(n))
    return draft.publish()


def test_pinned_rows_outlive_a_replace(store):
    first = put(store, 3)
    read = first.table("raw", "t")
    second = put(store, 5)
    assert (read.count(), first.table("raw", "t").count(), second.table("raw", "t").count()) == (3, 3, 5)
    assert store.release().number == 2 and store.release(1).table("raw", "t").count() == 3


def test_unpublished_and_failed_builds_are_not_seen(store):
    put(store, 3)
    draft = store.begin()
    draft.replace("raw", "t", store.spark.range(9))
    assert store.release().table("raw", "t").count() == 3 and draft.table("raw", "t").count() == 9
    bad = store.begin()
    with pytest.raises(Exception, match="broken"):
        bad.replace("raw", "t", store.spark.range(4).select(F.raise_error(F.lit("broken")).cast("int").alias("id")))
    assert store.release().table("raw", "t").count() == 3


def test_tables_that_a_build_leaves_out_are_kept(store):
    put(store, 3, "a")
    release = put(store, 4, "b")
    assert {name: df.count() for name, df in release.tables("raw").items()} == {"a": 3, "b": 4}
    alone = store.begin(keep=False)
    alone.replace("raw", "c", store.spark.range(1))
    assert set(alone.publish().tables("raw")) == {"c"}


def test_of_two_builds_on_one_release_one_is_published(store):
    put(store, 3)
    one, other = store.begin(), store.begin()
    one.replace("raw", "t", store.spark.range(4))
    other.replace("raw", "t", store.spark.range(5))
    one.publish()
    with pytest.raises(PublishConflict):
        other.publish()
    assert store.release().table("raw", "t").count() == 4


def test_a_claimed_number_is_never_published_twice(store):
    put(store, 3)
    draft = store.begin()
    draft.replace("raw", "t", store.spark.range(4))
    store.files.create(f"{store.root}/releases/{2:012d}.claim", "a build that is just publishing")
    with pytest.raises(PublishConflict):
        draft.publish()


def test_nothing_published(store):
    with pytest.raises(NoRelease):
        store.release()
    put(store, 1)
    with pytest.raises(NoRelease):
        store.release(7)
    with pytest.raises(NoRelease):
        store.release().table("raw", "other")


def test_old_versions_are_dropped_by_age(store):
    for n in (1, 2, 3):
        release = put(store, n)
    draft = store.begin()
    draft.replace("raw", "t", store.spark.range(9))
    assert store.expire(dt.timedelta(hours=1)) == [] and store.numbers() == [1, 2, 3]
    dropped = store.expire(dt.timedelta(0), keep=2)
    assert store.numbers() == [2, 3] and len(dropped) == 2  # the first release's files and the unfinished build's
    assert store.release(2).table("raw", "t").count() == 2 and release.table("raw", "t").count() == 3
    put(store, 4, "u")
    store.expire(dt.timedelta(0))
    # the last release still names files of an earlier one
    assert {name: df.count() for name, df in store.release().tables("raw").items()} == {"t": 3, "u": 4}


def test_schema_types_and_empty_tables_survive(spark, store):
    df = spark.sql("SELECT 1L AS id, date '2024-01-01' AS d, CAST(NULL AS STRING) AS s, 2.5D AS x")
    draft = store.begin()
    draft.replace("core", "p", df, "d", ["id"])
    draft.replace("core", "e", df.limit(0), "d", ["id"])
    release = draft.publish()
    for name, n in (("p", 1), ("e", 0)):
        read = release.table("core", name)
        assert read.dtypes == [("id", "bigint"), ("s", "string"), ("x", "double"), ("d", "date")] and read.count() == n
        view = spark.sql(release.version("core", name).as_sql(spark))
        assert view.dtypes == read.dtypes and rows(view) == rows(read)


def test_one_verify_reads_one_release_through_a_rebuild(spark, tmp_path):
    warehouse = Warehouse(spark, prefix="pin_", root=str(tmp_path), catalog=False)
    pipeline.build(warehouse, sources(spark))
    pinned = warehouse.release()
    views = marts.of_release(pinned)
    verified = pipeline.verify(warehouse)
    before = rows(views["v_refund_rate"])
    # a rebuild between the two reads
    pipeline.build(warehouse, sources(spark, registrations=[*REGISTRATIONS, LATE], payments=PAYMENTS[:2]))
    assert rows(views["v_refund_rate"]) == before != rows(marts.of_release(warehouse.release())["v_refund_rate"])
    result = verified.collect()
    assert all(r.match for r in result) and {r.area for r in result} == {"totals", "months", "fill", "players", "refunds"}
    total = next(r for r in result if r.metric == "registrations")
    assert total.expected == total.actual == len(REGISTRATIONS)


def test_failed_gate_leaves_every_layer_as_it_was(spark, tmp_path):
    warehouse = Warehouse(spark, prefix="gate_", root=str(tmp_path))
    pipeline.build(warehouse, sources(spark))
    before = {(layer, name): rows(df) for layer in ("raw", "stg", "core") for name, df in warehouse.release().tables(layer).items()}
    files = glob.glob(f"{tmp_path}/**/*.parquet", recursive=True)
    dirty = sources(spark, clubs=[*CLUBS, CLUBS[0]], registrations=[*REGISTRATIONS, LATE])
    with pytest.raises(quality.QualityError) as error:
        pipeline.build(warehouse, dirty)
    assert [(r.table_name, r.column_name) for r in error.value.failed] == [("clubs", "club_id")]
    assert warehouse.release().number == 1
    for (layer, name), was in before.items():
        assert rows(warehouse.table(layer, name)) == was
    assert glob.glob(f"{tmp_path}/**/*.parquet", recursive=True) == files


def test_marts_that_do_not_reconcile_are_not_published(spark, tmp_path):
    warehouse = Warehouse(spark, prefix="rec_", root=str(tmp_path), catalog=False)
    pipeline.build(warehouse, sources(spark), reconciled=True)
    with pytest.raises(pipeline.ReconcileError, match="registrations all"):
        pipeline.build(warehouse, sources(spark, registrations=REGISTRATIONS * 2), reconciled=True)
    assert warehouse.release().number == 1


def test_views_name_one_release_and_layers_are_described(spark, tmp_path):
    warehouse = Warehouse(spark, prefix="set_", root=str(tmp_path))
    pipeline.build(warehouse, sources(spark))
    read = warehouse.table("mart", "v_refund_rate")
    was = rows(read)
    pipeline.build(warehouse, sources(spark, payments=PAYMENTS[:2]))
    build = warehouse.release().build
    for view in marts.VIEWS:
        text = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED set_mart.{view}").collect()}["View Text"]
        assert text.count("parquet.`") == text.count(build) > 0
    assert rows(read) == was != rows(warehouse.table("mart", "v_refund_rate"))
    assert [(layer, text) for layer, text, _ in warehouse.describe_layers()] == list(LAYERS.items())
    warehouse.drop_layers()
    assert warehouse.describe_layers() == [] and rows(read) == was
