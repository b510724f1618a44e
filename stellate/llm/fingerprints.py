"""Document fingerprints: consistent weighted samples of word counts, with DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stellate.llm.shared import UPPER, partitions, stored

#: Samples of a fingerprint; the likeness of two is off by 0.5 / sqrt(SAMPLES) at most (one deviation).
SAMPLES = 24
#: Bits of a sample in the fingerprint, and hex digits that show them.
BITS, DIGITS = 31, 8
MASK = 2**BITS - 1
#: Samples drawn side by side: more would make one generated method too long for the JVM to compile.
BLOCK = 2
SPACE_CHARS = "\t\n\x0b\x0c\r"
KEY = ["k1", "k2"]


def _words(text: Column) -> Column:
    """Words with A-Z lower-cased; empty ones are to be left out."""
    return F.split(F.translate(text, UPPER + SPACE_CHARS, UPPER.lower() + " " * len(SPACE_CHARS)), " ")


def _gamma(h: Column) -> Column:
    """A draw of Gamma(2, 1) from 64 random bits: minus the log of two uniform numbers' product."""
    high, low = F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF))
    return F.lit(64 * 0.6931471805599453) - F.ln((high + 0.5) * (low + 0.5))


def samples(terms: DataFrame, keys: list[str], weights: dict[str, str], n: int = SAMPLES) -> DataFrame:
    """`keys` and, for each weight column, an array of `n` samples under the name it maps to.

    `terms` has a row for each group and term: a 64-bit `term` and the weights, of which null or 0
    leaves the term out. Each sample k draws r and c from Gamma(2, 1) and b from [0, 1) by hashing the
    term, so that all groups draw alike; t = floor(ln(weight) / r + b), and the term with the
    least c * exp(-r * (t - b + 1)) is the group's sample, shown by the term's hash xor t. Two groups
    have the same sample with a probability equal to their generalised Jaccard similarity
    (sum of least weights over sum of greatest). Logarithms are compared, in steps of 2**-16;
    a tie goes to the lesser hash. A group without terms gives no row, one without weights nulls.
    """
    blocks = terms.select("*", F.explode(F.array(*(F.lit(k) for k in range(0, n, BLOCK)))).alias("block"))
    drawn = {}
    for k in range(BLOCK):
        a, b, c = (F.xxhash64(F.col("term"), F.col("block"), F.lit(k + j * BLOCK)) for j in range(3))
        drawn |= {f"r{k}": _gamma(a), f"c{k}": F.ln(_gamma(b)), f"b{k}": F.shiftrightunsigned(c, 11) * 2.0**-53, f"h{k}": c}
    logs = {f"ln_{w}": F.when(F.col(w) > 0, F.ln(F.col(w))) for w in weights}
    rows = blocks.select(*keys, "block", *(v.alias(name) for name, v in (drawn | logs).items()))

    def least(k: int, w: str) -> Column:
        t = F.floor(F.col(f"ln_{w}") / F.col(f"r{k}") + F.col(f"b{k}"))
        rank = ((F.col(f"c{k}") - F.col(f"r{k}") * (t - F.col(f"b{k}") + 1)) * 65536.0).cast("bigint")
        return F.min(F.shiftleft(rank, BITS).bitwiseOR(F.col(f"h{k}").bitwiseXOR(t).bitwiseAND(F.lit(MASK)))).alias(f"{w}_{k}")

    found = rows.groupBy(*keys, "block").agg(*(least(k, w) for w in weights for k in range(BLOCK)))
    parts = {w: F.array(*(F.col(f"{w}_{k}").bitwiseAND(F.lit(MASK)).cast("int") for k in range(BLOCK))) for w in weights}
    # blocks of one group lie together, so nothing is shuffled here
    lists = (F.array_sort(F.collect_list(F.struct("block", part.alias("part")))).alias(w) for w, part in parts.items())
    gathered = found.groupBy(*keys).agg(*lists)
    arrays = (F.flatten(F.transform(w, lambda x: x["part"])).alias(out) for w, out in weights.items())
    return gathered.select(*keys, *arrays)


def likeness(a: Column, b: Column, n: int = SAMPLES) -> Column:
    """Share of equal samples, 0 to 1; no samples (null) are like no samples only."""
    equal = reduce(lambda x, y: x + y, ((F.get(a, F.lit(k)) == F.get(b, F.lit(k))).cast("int") for k in range(n)))
    return F.when(a.isNotNull() & b.isNotNull(), equal / F.lit(float(n))).otherwise((a.isNull() & b.isNull()).cast("double"))


def shown(array: str, n: int = SAMPLES) -> Column:
    """The samples as fixed-width hex digits; empty where a text has no words."""
    digits = (F.lower(F.lpad(F.hex(F.get(array, F.lit(k))), DIGITS, "0")) for k in range(n))
    return F.coalesce(F.concat(*digits), F.lit(""))


def _ordered(docs: DataFrame) -> DataFrame:
    """Different rows (id, text) as `k1`, `k2`, with n_chars, copies and `at`, their place by descending id.

    Places rise with the order, by one within a partition of the sort; only narrow rows are sorted.
    Rows with one id are in order of their hashed text, null ids come last.
    """
    different = docs.groupBy(*KEY).agg(F.min("id").alias("id"), F.max("n_chars").alias("n_chars"), F.count("*").alias("copies"))
    order = [F.desc_nulls_last("id"), *KEY]
    dealt = different.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    return stored(dealt.withColumn("at", F.monotonically_increasing_id()), "order")


def _links(ordered: DataFrame) -> DataFrame:
    """For each row its next one: k1, k2 (of the next), p1, p2, p_id, p_chars (its own), and how often: `times`.

    The last row of a partition is followed by the first of the next partition that has rows, the very last by
    the very first; that table has a row for each partition of the sort, which bounds its broadcast. All copies of a row but the last
    are followed by the row itself (`own`).
    """
    part = F.shiftrightunsigned("at", 33).alias("part")
    edges = ordered.groupBy(part).agg(F.min("at").alias("first"), F.max("at").alias("last"))
    after = F.lead("first").over(Window.orderBy("part"))
    edges = edges.select("last", F.coalesce(after, F.min("first").over(Window.partitionBy())).alias("following"))
    step = ordered.join(F.broadcast(edges), F.col("at") == F.col("last"), "left")
    previous = step.select(F.coalesce("following", F.col("at") + 1).alias("next"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("id").alias("p_id"), F.col("n_chars").alias("p_chars"))
    last = previous.join(ordered.select("at", *KEY), F.col("next") == F.col("at"))
    last = last.select(*KEY, "p1", "p2", "p_id", "p_chars", F.lit(1).cast("bigint").alias("times"), F.lit(False).alias("own"))
    inner = ordered.where("copies > 1").select(
        *KEY, F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("id").alias("p_id"), F.col("n_chars").alias("p_chars"), (F.col("copies") - 1).alias("times"), F.lit(True).alias("own")
    )
    return last.union(inner)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: its id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Terms are words, weighted by their count. The edited text has its last third of code points (rounded down) replaced by
    the first as many of the next row, by descending id; after the last row comes the first. A null text
    is empty; a text without words has an empty fingerprint, which is like an empty one only. Null ids come last, rows with one id in the
    order of a hash; rows equal in id and text follow each other, so each but the last is its own
    next one. An empty table gives no rows.

    Whole texts are shuffled once, by a 128-bit key of (id, text), and the heads that other texts
    take once more; words are counted and sampled where their text lies, without another shuffle.
    Copies are combined before the shuffle, so none is hot.
    """
    given = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), given.alias("text"))
    null_id = F.col("id").isNull()
    keyed = rows.select("*", F.xxhash64("id", "text").alias("k1"), F.xxhash64(F.lit(7), null_id, "id", "text").alias("k2"))
    ordered = _ordered(keyed.select("id", *KEY, F.length("text").cast("bigint").alias("n_chars")))
    links = _links(ordered)
    # read twice with the same columns, so that texts are shuffled once
    whole = keyed.groupBy(*KEY).agg(F.first("text").alias("text"))
    third = F.floor(F.col("p_chars") / 3).cast("int")
    heads = whole.join(links, KEY).select(
        F.col("k1").alias("n1"), F.col("k2").alias("n2"), "p1", "p2", F.col("p_id").alias("id"), "times", "own", F.left("text", third).alias("head")
    )
    n_chars = F.length("text")
    edited = F.concat(F.left("text", n_chars - F.floor(n_chars / 3).cast("int")), "head")
    both = whole.join(heads, (F.col("k1") == F.col("p1")) & (F.col("k2") == F.col("p2"))).withColumn("edited", edited)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    sides = F.array(*(F.struct(F.col(t).alias("t"), a.alias("a"), b.alias("b")) for t, a, b in (("text", one, none), ("edited", none, one))))
    split = both.select(*KEY, "own", F.inline(sides)).select(*KEY, "own", "a", "b", F.explode(_words(F.col("t"))).alias("word"))
    terms = split.where("word <> ''").select(*KEY, "own", "a", "b", F.xxhash64("word").alias("term"))
    counts = terms.groupBy(*KEY, "own", "term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    prints = samples(counts, [*KEY, "own"], {"a": "print", "b": "edited_print"})
    facts = both.select(*KEY, "own", "id", "n1", "n2", "times", n_chars.cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    # samples of no words are null, so arrays are made null as a whole
    has = {c: F.when(F.get(c, F.lit(0)).isNotNull(), F.col(c)) for c in ("print", "edited_print")}
    found = stored(facts.join(prints, [*KEY, "own"], "left").withColumns(has), "prints")
    following = found.where(~F.col("own")).select(F.col("k1").alias("n1"), F.col("k2").alias("n2"), F.col("print").alias("next_print"))
    joined = found.join(following, ["n1", "n2"])
    return joined.select(
        F.col("id").alias(id_column), "n_chars", "edited_sha256",
        shown("print").alias("fingerprint"), shown("edited_print").alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
        F.explode(F.sequence(one, "times")).alias("copy"),
    ).drop("copy")


def op13_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
