"""Line dedup: hashed lines, range-partitioned and sorted, give each document a bitmap of its lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stellate.llm.shared import ascii_lower, partitions, row_key, stored

BLANKS = " \t\n\x0b\x0c\r"
MIN_DOCS = 10
BITS = 63  # of a signed long, so that no shift is negative


def lines_of(text: Column) -> Column:
    """All lines; null and empty texts are one empty line."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def bit_of(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), position % BITS)


def hashed_lines(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """id, row, position and a 128-bit hash of each line's key; lines without a key are left out."""
    given = docs.select(F.col(id_column).alias("id"), row_key(F.col(text)).alias("row"), lines_of(F.col(text)).alias("lines"))
    split = given.select("id", "row", F.posexplode("lines").alias("position", "line"))
    keyed = split.select("id", "row", "position", ascii_lower(F.btrim("line", F.lit(BLANKS))).alias("key"))
    # the second hash begins with another seed, so the two are independent
    hashes = (F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), F.col("key")).alias("h2"))
    return keyed.where(F.col("key") != "").select(*hashes, "id", "row", "position")


def bitmaps(docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, keep_first: bool = False) -> DataFrame:
    """For each document that loses lines: id, row (a hash of its text) and `dropped`.

    `dropped` is a bitmap with runs of kept lines left out: words of BITS lines as (word, bits),
    by word, only where a bit is set. A line goes if its key is in at least `min_docs`
    documents; with `keep_first` the first occurrence by id, text hash and position stays.
    Rows with the same id and text are one document; null ids are ids like any other.

    The lines are range-partitioned by hash with documents dealt over as many parts of a hash as there
    are partitions, and sorted by document and position: each part streams its own first
    occurrences and counts documents once. A line in a third of all rows thus lies in many
    parts; one small row for each part is added up, and the join with the frequent keys is one
    whose hot keys adaptive execution splits.
    """
    n = partitions(docs.sparkSession)
    lines = stored(hashed_lines(docs, id_column, text), "lines")
    part = F.pmod(F.hash("id", "row"), F.lit(n)).alias("part")
    ranged = lines.select("*", part).repartitionByRange(n, "h1", "h2", "part")
    stream = Window.partitionBy("h1", "h2", "part").orderBy("id", "row", "position")
    place = F.struct("id", "row", "position")
    same_doc = F.lag(F.struct("id", "row")).over(stream).eqNullSafe(F.struct("id", "row"))
    begins = ranged.withColumn("begins", (~same_doc).cast("bigint"))
    parts = begins.groupBy("h1", "h2", "part").agg(F.sum("begins").alias("docs"), F.min(place).alias("first"))
    totals = parts.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.min("first").alias("first"))
    frequent = totals.where(F.col("docs") >= min_docs).select("h1", "h2", *(["first"] if keep_first else []))
    # the null-safe join has a shuffle of its own; on the aggregate's, hot keys could not be split
    frequent = frequent.withColumnsRenamed({"h1": "f1", "h2": "f2"})
    gone = lines.join(frequent, F.col("h1").eqNullSafe(F.col("f1")) & F.col("h2").eqNullSafe(F.col("f2"))).drop("f1", "f2")
    if keep_first:
        gone = gone.where(~place.eqNullSafe(F.col("first")))
    word = F.floor(F.col("position") / BITS).cast("int").alias("word")
    bit = bit_of(F.col("position"))
    words = gone.groupBy("id", "row", word).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy("id", "row").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("dropped"))


def kept_lines(lines: Column, dropped: str) -> tuple[Column, Column]:
    """A bitmap column with its zero words, to be named `__dense`, and the lines whose bit is not set."""

    def before(k: Column) -> Column:
        return F.coalesce(F.get(dropped, k - 1)["word"], F.lit(-1))

    # a line then finds its word by index
    dense = F.flatten(F.transform(dropped, lambda w, k: F.array_append(F.array_repeat(F.lit(0).cast("bigint"), w["word"] - before(k) - 1), w["bits"])))
    def keeps(_: Column, i: Column) -> Column:
        word = F.coalesce(F.get("__dense", F.floor(i / BITS).cast("int")), F.lit(0))
        return word.bitwiseAND(bit_of(i)) == 0

    return dense, F.filter(lines, keeps)


def with_kept(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """All columns and `kept_text`, `n_lines`, `n_dropped`; every row stays.

    A null text is one empty line and gives an empty kept text. Input columns of the new names
    are replaced. Documents meet their bitmaps in one join; only rows with a bitmap are split.
    """
    found = bitmaps(docs, id_column, text, **options).withColumnsRenamed({"id": "__id", "row": "__row"})
    names = [c for c in docs.columns if c not in ("kept_text", "n_lines", "n_dropped")]
    packed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("__doc"),
        F.col(id_column).alias("__doc_id"),
        row_key(F.col(text)).alias("__doc_row"),
        F.col(text).cast("string").alias("__text"),
    )
    on = F.col("__doc_id").eqNullSafe(F.col("__id")) & (F.col("__doc_row") == F.col("__row"))
    joined = packed.join(found, on, "left")
    dense, kept = kept_lines(lines_of(F.col("__text")), "dropped")
    lines = joined.withColumn("__dense", F.when(F.col("dropped").isNotNull(), dense))
    lines = lines.withColumn("__kept", F.when(F.col("dropped").isNotNull(), kept))
    text_kept = F.coalesce(F.array_join("__kept", "\n"), F.col("__text"), F.lit(""))
    # a line more than line ends
    n_lines = F.octet_length(F.coalesce("__text", F.lit(""))) - F.octet_length(F.replace(F.coalesce("__text", F.lit("")), F.lit("\n"), F.lit(""))) + 1
    return lines.select(
        "__doc.*",
        text_kept.alias("kept_text"),
        n_lines.cast("bigint").alias("n_lines"),
        F.coalesce(n_lines - F.size("__kept"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )


def drop_lines(docs: DataFrame, **options) -> DataFrame:
    """The documents with their own columns, `text` without the dropped lines and `n_chars` anew."""
    kept = with_kept(docs, **options)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("bigint")}
    return kept.select(*(new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return with_kept(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT r, doc_id, i, l[i] AS line, translate(regexp_replace(regexp_replace(l[i], '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT r, doc_id, string_split(text, chr(10)) AS l FROM docs), unnest(range(1, len(l) + 1)) AS u(i)),
frequent AS (SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE f.key IS NOT NULL) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN frequent f USING (key) GROUP BY r
"""
