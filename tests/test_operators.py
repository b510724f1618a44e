import datetime as dt
import itertools
import random

from pyspark.sql import Window, functions as F

from stellate.operators.calendar import date_range, years_spanned
from stellate.operators.census import Reference, RowRule, census
from stellate.operators.dedupe import latest_per_key
from stellate.operators.keys import orphans
from stellate.operators.sides import broadcast_by_rows, row_bytes
from stellate.operators.unpivot import unpivot_slots
from tests.support import plan, rows


def _time(seconds):
    return None if seconds is None else dt.datetime(1970, 1, 1) + dt.timedelta(seconds=seconds)


VERSIONS = "k bigint, t timestamp, a bigint, b string"


def test_latest_per_key(spark):
    data = [
        (1, 5, 0, "a"),
        (1, 9, 0, "b"),
        (1, None, 0, "c"),
        (2, None, 0, "d"),
        (3, -9, 0, "e"),
        (3, -8, 0, "f"),
        (None, 3, 0, "g"),
        (None, 4, 0, "h"),
    ]
    df = spark.createDataFrame([(k, _time(t), a, b) for k, t, a, b in data], VERSIONS)
    latest = latest_per_key(df, ["k"], "t")
    assert latest.schema == df.schema
    assert {(r.k, r.t, r.b) for r in latest.collect()} == {
        (1, _time(9), "b"),
        (2, None, "d"),
        (3, _time(-8), "f"),
        (None, _time(4), "h"),
    }


def test_latest_per_key_settles_ties_by_the_other_columns(spark):
    data = [(1, _time(5), None, "z"), (1, _time(5), 2, "y"), (1, _time(5), 2, "x"), (1, _time(4), 0, "a")]
    for order in itertools.permutations(data):
        df = spark.createDataFrame(order, VERSIONS).repartition(3)
        assert [tuple(r) for r in latest_per_key(df, ["k"], "t").collect()] == [(1, _time(5), 2, "x")]


def test_latest_per_key_against_brute_force(spark):
    draw = random.Random(3)
    for _ in range(4):
        data = [
            (
                7 if draw.random() < 1 / 3 else draw.choice([None, 1, 2, 3]),
                draw.choice([None, 10, 20, 30]),
                draw.choice([None, 1, 2]),
                draw.choice([None, "a", "b"]),
            )
            for _ in range(200)
        ]
        best = {}
        for row in data:
            rank = (row[1] is None, -(row[1] or 0), row[2] is None, row[2] or 0, row[3] is None, row[3] or "")
            best[row[0]] = min(best.get(row[0], (rank, row)), (rank, row), key=lambda pair: pair[0])
        timed = [(k, _time(t), a, b) for k, t, a, b in data]
        df = spark.createDataFrame(timed, VERSIONS).repartition(5)
        got = {tuple(r) for r in latest_per_key(df, ["k"], "t").collect()}
        assert got == {(k, _time(t), a, b) for _, (k, t, a, b) in best.values()}


def test_latest_per_key_keeps_one_row_per_task_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 0, id) AS k", "timestamp_seconds(id) AS t")
    text = plan(latest_per_key(df, ["k"], "t"))
    assert text.count("Exchange") == 1 and text.index("Exchange") < text.index("partial_min")


def test_latest_per_key_equals_the_window(spark):
    draw = random.Random(8)
    data = [
        (draw.choice([None, 1, 1, 1, 2, 3]), _time(draw.choice([None, -5, 0, 7])), draw.choice([None, "x", "y"]))
        for _ in range(300)
    ]
    df = spark.createDataFrame(data, "k bigint, t timestamp, v string")
    order = Window.partitionBy("k").orderBy(F.desc_nulls_last("t"), F.asc_nulls_last("v"))
    window = df.withColumn("n", F.row_number().over(order)).where("n = 1").drop("n")
    assert rows(latest_per_key(df, ["k"], "t")) == rows(window)


def test_unpivot_scans_once_and_keeps_empty_slots(spark, tmp_path):
    data = spark.createDataFrame([(1, 10, None), (2, 20, 30)], "m bigint, a bigint, b bigint")
    data.write.parquet(str(tmp_path / "m"))
    df = spark.read.parquet(str(tmp_path / "m"))
    got = unpivot_slots(df, {"a": 1, "b": 2}, "player", "team")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(
        map(repr, [(1, 10, 1), (1, None, 2), (2, 20, 1), (2, 30, 2)])
    )
    assert plan(got).count("FileScan") == 1
    assert dict(got.dtypes)["team"] == "bigint"


def test_date_range_is_inclusive_and_knows_leap_years(spark):
    got = [r.date_key for r in date_range(spark, dt.date(2024, 2, 28), dt.date(2024, 3, 2)).collect()]
    assert got == [dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1), dt.date(2024, 3, 2)]
    assert date_range(spark, dt.date(2023, 1, 1), dt.date(2026, 12, 31)).count() == 1461


def test_years_spanned(spark):
    days = [(dt.date(2023, 11, 5),), (dt.date(2024, 1, 1),), (None,)]
    got = [r.date_key for r in years_spanned(spark.createDataFrame(days, "d date"), "d").collect()]
    assert got[0] == dt.date(2023, 1, 1) and got[-1] == dt.date(2024, 12, 31) and len(got) == 365 + 366
    assert years_spanned(spark.createDataFrame([], "d date"), "d").count() == 0


def test_orphans(spark):
    child = spark.createDataFrame([(1, 7), (2, 8), (3, None)], "id bigint, fk bigint")
    parent = spark.createDataFrame([(7,), (7,), (9,)], "pk bigint")
    with_null = parent.unionAll(spark.createDataFrame([(None,)], "pk bigint"))

    def found(p, nullable=False):
        return [r["id"] for r in rows(orphans(child, "fk", p, "pk", nullable))]

    assert found(parent) == [2, 3]
    assert found(parent, nullable=True) == [2]
    assert found(with_null) == [2]


def _brute(parents, children, others):
    """Census of three tables by sets and loops."""
    known = set(parents)
    return {
        ("p", "pk", "unique"): len(parents) - len(known),
        ("c", "fk", "references p"): sum(fk not in known for _, fk, _ in children),
        ("c", "opt", "references p"): sum(o is not None and o not in known for _, _, o in children),
        ("c", "id", "unique"): len(children) - len({i for i, _, _ in children}),
        ("o", "ref", "references c"): sum(r not in {i for i, _, _ in children} for r in others),
        ("c", "fk", "even"): sum(fk is not None and fk % 2 == 1 for _, fk, _ in children),
    }


def test_census_against_brute_force(spark):
    draw = random.Random(5)
    for case in range(6):
        pool = [None, *range(12)]
        hot = draw.choice(pool)  # a third of all values
        value = lambda: hot if draw.random() < 1 / 3 else draw.choice(pool)
        parents = [value() for _ in range(0 if case == 0 else 20)]
        children = [(value(), value(), value()) for _ in range(60)]
        others = [value() for _ in range(0 if case == 1 else 30)]
        tables = {
            "p": spark.createDataFrame([(v,) for v in parents], "pk bigint"),
            "c": spark.createDataFrame(children, "id bigint, fk bigint, opt bigint"),
            "o": spark.createDataFrame([(v,) for v in others], "ref bigint"),
        }
        got = census(
            tables,
            {"p": "pk", "c": "id"},
            [Reference("c", "fk", "p"), Reference("c", "opt", "p", nullable=True), Reference("o", "ref", "c")],
            [RowRule("c", "fk", "even", lambda: F.col("fk") % 2 == 1)],
        )
        found = {(r.table_name, r.column_name, r.rule): r.offending for r in got.collect()}
        assert found == _brute(parents, children, others)


def test_census_scans_each_table_once_with_one_keyed_shuffle(spark, tmp_path):
    for name, cols in {"p": "id AS pk", "c": "id AS id, id AS fk"}.items():
        spark.range(50).selectExpr(*cols.split(", ")).write.parquet(str(tmp_path / name))
    tables = {n: spark.read.parquet(str(tmp_path / n)) for n in "pc"}
    rule = RowRule("c", "fk", "not negative", lambda: F.col("fk") < 0)
    text = plan(census(tables, {"p": "pk", "c": "id"}, [Reference("c", "fk", "p")], [rule]))
    assert text.count("FileScan") == 2
    assert text.count("Exchange hashpartitioning(owner") + text.count("Exchange hashpartitioning(value") <= 2
    assert "Join" not in text and "Window" not in text


def test_row_bytes_are_words_and_texts(spark):
    df = spark.createDataFrame([(1, "ab", None), (None, None, "\u00e9"), (3, "", "x")], "k bigint, a string, b string")
    assert row_bytes(df) == 3 * 32 + 2 + 2 + 1
    assert row_bytes(df.select("k")) == 3 * 16 and row_bytes(df.where("false")) == 0


def test_a_side_is_merged_only_over_the_threshold(spark, tmp_path):
    spark.range(1_000).selectExpr("id AS k", "'x' AS a", "repeat('y', 900) AS b").write.parquet(str(tmp_path / "s"))
    side, key = spark.read.parquet(str(tmp_path / "s")), "spark.sql.autoBroadcastJoinThreshold"
    rows_ = spark.range(10).withColumnRenamed("id", "k")

    def joined(*columns):
        return rows_.join(broadcast_by_rows(side, columns).select(*columns), "k")

    spark.conf.set(key, "50KB")
    try:
        assert "BroadcastHashJoin" in plan(joined("k", "a"))  # 25,000 bytes; b is not read
        assert "SortMergeJoin" in plan(joined("k", "a", "b")) and joined("k", "a", "b").count() == 10
        spark.conf.set(key, "-1")
        assert plan(broadcast_by_rows(side, ["k", "b"])) == plan(side)
    finally:
        spark.conf.unset(key)
