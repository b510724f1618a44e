"""Every query against its SQL, over whole tables, on the given data and on a skewed copy."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import oracle
from stellate.plans import catalogue

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events")
QUERIES = catalogue.queries()
ORACLE = oracle.oracle_sql()

# One key holds a third of the rows: a replayed registration, a tournament, a player, a provider.
SKEW = {
    "lineitem": "SELECT * REPLACE (CASE WHEN r % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey, "
    "CASE WHEN r % 3 = 0 THEN 1 ELSE l_linenumber END AS l_linenumber, "
    "CASE WHEN r % 3 = 1 THEN 7 ELSE l_partkey END AS l_partkey)",
    "events": "SELECT * REPLACE (CASE WHEN r % 3 = 0 THEN 11 ELSE user_id END AS user_id)",
    "orders": "SELECT * REPLACE (CASE WHEN r % 3 = 0 THEN '9-HOT' ELSE o_orderpriority END AS o_orderpriority, "
    "CASE WHEN r % 3 = 1 THEN 3 ELSE o_custkey END AS o_custkey)",
}
# These write; their models are compared on the skewed copy by their own queries.
BUILT = ("sink", "landing", "deployed", "layer", "strict", "release")


def connect(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = connect(FOLDER)
    for table in TABLES:
        select = SKEW.get(table, "SELECT *")
        numbered = f"{select} FROM (SELECT *, row_number() OVER () AS r FROM {table})"
        con.execute(f"COPY (SELECT * EXCLUDE (r) FROM ({numbered})) TO '{folder}/{table}.parquet'")
    return str(folder)


def assert_same(spark, folder, name):
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    relation = connect(folder).sql(ORACLE[name])
    assert sorted(relation.columns) == columns
    order = [relation.columns.index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in order) for row in relation.fetchall()), key=repr)
    actual = sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)
    assert actual == expected
    assert actual


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, name):
    assert_same(spark, FOLDER, name)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(BUILT)])
def test_query_equals_sql_on_skewed_data_without_broadcasts(spark, skewed, name, monkeypatch):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        assert_same(spark, skewed, name)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "year_month",
        "club_name",
        "category",
        "registrations",
        "paid_registrations",
        "net_revenue_aud",
    ]
    assert df.count() == 2698
