"""What filters on either cluster key skip, read from Parquet footers."""

import glob

import pyarrow.parquet as pq
import pytest

from stellate.sinks.layout import clustered, z_order


def groups(folder):
    """(column -> (least, greatest)) of each row group below a folder."""
    for path in glob.glob(f"{folder}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(path).metadata
        for k in range(meta.num_row_groups):
            columns = (meta.row_group(k).column(c) for c in range(meta.num_columns))
            yield {c.path_in_schema: (c.statistics.min, c.statistics.max) for c in columns}


def skipped(folder, column, values):
    """Share of the row groups that an equality filter need not read, over some values."""
    all_groups = list(groups(folder))
    misses = [not least <= v <= most for v in values for least, most in (g[column] for g in all_groups)]
    return len(all_groups), sum(misses) / len(misses)


@pytest.fixture(scope="module")
def fact(spark):
    # two keys that have nothing to do with each other, a hot value, nulls, one day
    return spark.range(60_000).selectExpr(
        "date '2024-01-01' AS d",
        "if(id % 3 = 0, 500, abs(hash(id, 1)) % 1000) AS k1",
        "if(id % 50 = 0, NULL, abs(hash(id, 2)) % 1000) AS k2",
        "id",
    )


def write(df, folder, interleave):
    laid_out = clustered(df, "d", ["k1", "k2"], ["id"], interleave)
    laid_out.write.option("parquet.block.size", 16_384).option("parquet.page.size.row.check.min", 100).partitionBy("d").parquet(folder)


def test_either_key_skips_row_groups(spark, fact, tmp_path):
    write(fact, str(tmp_path / "sorted"), False)
    write(fact, str(tmp_path / "z"), True)
    values = range(5, 1000, 37)
    n, first = skipped(tmp_path / "z", "k1", values)
    _, second = skipped(tmp_path / "z", "k2", values)
    _, sorted_first = skipped(tmp_path / "sorted", "k1", values)
    _, sorted_second = skipped(tmp_path / "sorted", "k2", values)
    assert n >= 16
    assert first > 0.5 and second > 0.5
    assert sorted_first > first and sorted_second < second / 2  # what a plain sort gives for either
    back = spark.read.parquet(str(tmp_path / "z"))
    assert back.select(fact.columns).exceptAll(fact).count() == 0 and back.count() == 60_000


def test_ranges_hold_equally_many_rows_and_bits_alternate(spark):
    df = spark.range(1600).selectExpr("id AS a", "1599 - id AS b", "CAST(NULL AS INT) AS n", "date_add(date '2024-01-01', int(id)) AS day")
    counts = df.groupBy(z_order(df, ["a"], 3).alias("z")).count().collect()
    assert sorted(r.z for r in counts) == list(range(8)) and all(abs(r["count"] - 200) <= 1 for r in counts)
    both = {r.z for r in df.select(z_order(df, ["a", "b"], 1).alias("z")).distinct().collect()}
    assert both == {0b10, 0b01} or both == {0b10, 0b01, 0b11}
    assert df.select(z_order(df, ["n", "day"], 2).alias("z")).distinct().count() == 4
    assert df.limit(0).select(z_order(df.limit(0), ["a"]).alias("z")).collect() == []


def test_interleaved_rows_are_sorted_once(spark, fact):
    spark.sql("CREATE TABLE z_once (k1 INT, k2 INT, id BIGINT, d DATE) USING parquet PARTITIONED BY (d)")
    clustered(fact, "d", ["k1", "k2"], ["id"], True).select("k1", "k2", "id", "d").createOrReplaceTempView("z_laid_out")
    text = spark.sql("EXPLAIN INSERT INTO z_once SELECT * FROM z_laid_out").first()[0]
    assert text.count("Sort [") == 1
