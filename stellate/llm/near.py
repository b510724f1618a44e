"""MinHash near-dedup: banded candidates, pruned batch by batch by a posterior, verified exactly."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.graph import components
from stellate.llm.shared import mix64, partitions, row_key, shingle_sets, stored, text_slices, texts

WIDTH = 5
BANDS, ROWS = 24, 5
#: Further bands, of the next values, for classes that share one band only and that in a large bucket.
SECOND = 12
#: Values of a signature: the bands take the first ones, the comparison all.
HASHES = 640
#: Signature values are compared in batches; a pair goes once it is too improbable that its
#: similarity reaches the threshold. A pair just at the threshold goes at one of all the batches
#: with a probability of MISS at most.
BATCH = 40
MISS = 1e-3
#: Members of a bucket compared in one place; larger buckets are split, see below.
BUCKET = 1024
#: Neighbours of each member that the first round verifies besides a spanning forest.
NEAREST = 3
#: Bytes of ids sent to all tasks at most, so that texts need not be shuffled to find a few; more meet in a shuffle join.
BROADCAST_BYTES = 8 << 20
_FACTORS = mix64(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
_OFFSETS = mix64(np.arange(1001, HASHES + 1001, dtype=np.uint64))


def signature(sets: list[np.ndarray]) -> np.ndarray:
    """One byte of each set's minima under HASHES random orders; sets are not empty."""
    flat = np.concatenate(sets)
    first = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), HASHES), np.uint8)
    for k in range(HASHES):
        least = np.minimum.reduceat((flat * _FACTORS[k] + _OFFSETS[k]) >> np.uint64(24), first)
        out[:, k] = least & np.uint64(0xFF)
    return out


def band_keys(signatures: np.ndarray, first: int = 0, count: int = BANDS) -> np.ndarray:
    """A 64-bit key of each band from the first; the band's number is part of it."""
    rows = signatures[:, first * ROWS : (first + count) * ROWS].reshape(-1, count, ROWS).astype(np.uint64)
    key = np.tile(mix64(np.arange(first + 1, first + count + 1, dtype=np.uint64)), (len(signatures), 1))
    for r in range(ROWS):
        key = mix64(key ^ (rows[:, :, r] + np.uint64(r + 1) * np.uint64(0x1000003)))
    return key.view(np.int64)


def missed(bounds: tuple[int, ...], similarity: float) -> float:
    """The exact probability that a pair of this similarity goes at any of the batches."""
    p = similarity + (1 - similarity) / 256
    k = np.arange(BATCH + 1)
    batch = np.array([comb(BATCH, m) for m in k.tolist()], float) * p**k * (1 - p) ** (BATCH - k)
    stays, gone = np.ones(1), 0.0  # by number of matches so far
    for least in bounds:
        stays = np.convolve(stays, batch)
        gone += stays[:least].sum()
        stays[:least] = 0
    return float(gone)


@cache
def least_matches(percent: int) -> tuple[int, ...]:
    """By number of batches compared: the fewest matches at which a pair stays.

    Posterior of the similarity s under a uniform prior after m matches of n: proportional to
    p^m (1 - p)^(n - m), where p = s + (1 - s) / 256 as bytes may match by chance; on a grid.
    Its bound is the largest at which all batches together miss MISS of the pairs at the threshold.
    """
    s = (np.arange(4000) + 0.5) / 4000
    p = s + (1 - s) / 256
    posteriors = []
    for n in range(BATCH, HASHES + 1, BATCH):
        logs = np.log(p)[None, :] * np.arange(n + 1)[:, None] + np.log1p(-p)[None, :] * (n - np.arange(n + 1))[:, None]
        weight = np.exp(logs - logs.max(axis=1, keepdims=True))
        posteriors.append(weight[:, s >= percent / 100].sum(axis=1) / weight.sum(axis=1))
    low, high = -60.0, 0.0  # logarithms of bounds that do and may not miss few enough
    for _ in range(40):
        middle = (low + high) / 2
        bounds = tuple(int(np.argmax(above >= np.exp(middle))) for above in posteriors)
        low, high = (middle, high) if missed(bounds, percent / 100) <= MISS else (low, middle)
    return tuple(int(np.argmax(above >= np.exp(low))) for above in posteriors)


def survivors(signatures: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs i < j of rows that no batch prunes, and their matches."""
    bounds = least_matches(percent)
    matches = np.zeros((len(signatures), len(signatures)), np.int16)
    for k in range(BATCH):
        matches += signatures[:, None, k] == signatures[None, :, k]
    i, j = np.nonzero(np.triu(matches >= bounds[0], 1))
    count = matches[i, j].astype(np.int64)
    for batch, least in enumerate(bounds[1:], start=1):
        part = slice(batch * BATCH, (batch + 1) * BATCH)
        count += (signatures[i, part] == signatures[j, part]).sum(axis=1)
        alive = count >= least
        i, j, count = i[alive], j[alive], count[alive]
    return i, j, count


def spanning(i: np.ndarray, j: np.ndarray, matches: np.ndarray, n: int) -> list[int]:
    """Indices of a spanning forest of the pairs and of each row's NEAREST, the most similar first."""
    parent, degree = list(range(n)), [0] * n

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    chosen = []
    for k in np.lexsort((j, i, -matches)).tolist():
        x, y = int(i[k]), int(j[k])
        a, b = root(x), root(y)
        if a != b or min(degree[x], degree[y]) < NEAREST:
            parent[b] = a
            degree[x] += 1
            degree[y] += 1
            chosen.append(k)
    return chosen


def signed(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """id, a hash of the text, number of shingles, a 128-bit fingerprint of the set and the signature (null if empty)."""
    given = docs.select(F.col(id_column).alias("id"), row_key(F.col(text)).alias("row"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            sets = shingle_sets(texts(batch), WIDTH)
            full = [k for k, s in enumerate(sets) if len(s)]
            marks: list[bytes | None] = [None] * len(sets)
            if full:
                for k, row in zip(full, signature([sets[k] for k in full])):
                    marks[k] = row.tobytes()
            f1 = np.array([mix64(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            f2 = np.array([np.bitwise_xor.reduce(mix64(~s)) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
            columns = [batch.column("id"), batch.column("row"), pa.array([len(s) for s in sets], pa.int64()), pa.array(f1), pa.array(f2), pa.array(marks, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "row", "n", "f1", "f2", "marks"])

    id_type = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(run, f"id {id_type}, row bigint, n bigint, f1 bigint, f2 bigint, marks binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), HASHES)


def _banded(classes: DataFrame, first: int, count: int) -> DataFrame:
    """(node, band, key) of these bands."""
    node = classes.schema["node"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = band_keys(_matrix(batch.column("marks")), first, count) if batch.num_rows else np.zeros((0, count), np.int64)
            at = np.repeat(np.arange(batch.num_rows), count)
            for a in range(0, len(at), 200_000):
                part = slice(a, a + 200_000)
                band = pa.array((np.arange(len(at)) % count + first).astype(np.int32)[part])
                columns = [batch.column("node").take(pa.array(at[part])), band, pa.array(keys.reshape(-1)[part])]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "band", "key"])

    return classes.select("node", "marks").mapInArrow(run, f"node {node}, band int, key bigint")


def _sized(rows: DataFrame) -> DataFrame:
    """Rows of keys that several have, with the key's `size`. The null-safe join has a shuffle of its own, whose
    hot keys adaptive execution splits; one that reused the aggregate's could not be."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").withColumnRenamed("key", "sized")
    return rows.join(sizes, F.col("key").eqNullSafe(F.col("sized"))).drop("sized")


def _buckets(classes: DataFrame) -> DataFrame:
    """(node, band, key, size) of all bands that several classes share."""
    return stored(_sized(stored(_banded(classes, 0, BANDS), "bands")), "buckets")


def _in_place(places: DataFrame, classes: DataFrame) -> DataFrame:
    return places.distinct().join(classes.select("node", "marks"), "node")


def _linear(classes: DataFrame, buckets: DataFrame) -> DataFrame:
    """(key, node, marks): places of the first round, at most one for each class and band.

    A bucket over BUCKET is dealt into blocks, each with one leader of the whole bucket, so that a group of near
    copies becomes one component however large it is, with rows in proportion to its size.
    """
    small = buckets.where(F.col("size") <= BUCKET).select("node", "key")
    blocks = F.ceil(F.col("size") / BUCKET).cast("int")
    large = buckets.where(F.col("size") > BUCKET)
    dealt = large.select("node", F.xxhash64("key", F.pmod(F.hash("node"), blocks)).alias("key"))
    leaders = large.groupBy("key").agg(F.min("node").alias("node"), F.max("size").alias("size"))
    leaders = leaders.select("node", "key", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
    leaders = leaders.select("node", F.xxhash64("key", "block").alias("key"))
    return stored(_in_place(small.union(dealt).union(leaders), classes), "members")


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows of keys whose classes are of several components."""
    of = rows.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    of = of.where("least <> most").select(F.col("key").alias("mixed"))
    return rows.join(of, F.col("key").eqNullSafe(F.col("mixed")), "left_semi")


def _members(classes: DataFrame, buckets: DataFrame, known: DataFrame) -> DataFrame:
    """(key, node, marks, component, split, again): a class in each place where it meets classes of other
    components (of `known`: node, component); split has a bit for each of its bands that is not a place
    of its own; `again` tells places for pairs that share one band only.

    Buckets of one component are settled and dropped, so a group of near copies costs nothing here.
    A band's bucket over BUCKET is split by each further bucket
    over BUCKET, as pairs that share a smaller one meet there, and for pairs that share no other
    band by SECOND bands of other values. What is still over BUCKET is cut into blocks, a large component into its own ones,
    and each two blocks meet in a place of their own unless they are of one component, so that loses no pair and no place grows.

    A pair at the threshold shares no band with a probability of 6.9e-5 at 0.80 (7e-7 at 0.85). In
    large buckets it can also share just one (8.1e-4; 1.4e-5) and none of the SECOND (8.3e-3;
    8e-4), which adds 7e-6 (1e-8) at most.
    """
    component = F.coalesce("component", "node").alias("component")
    by_band = buckets.join(known, "node", "left").select("node", component, "band", "key", "size")
    by_band = stored(_mixed(by_band), "unsettled")
    over = by_band.where(F.col("size") > BUCKET).select("node", "component", "key")
    large = classes.join(over.select("node").distinct(), "node", "left_semi")
    second = stored(_banded(large, BANDS, SECOND), "second").select("node", F.col("key").alias("other"), F.lit(True).alias("again"))
    others = over.select("node", F.col("key").alias("other"), F.lit(False).alias("again")).union(second)
    twice = over.join(others, "node").where("again OR key < other")
    twice = twice.select("node", "component", F.xxhash64("key", "other").alias("key"), "again")
    finer = _sized(_mixed(twice))
    places = by_band.where(F.col("size") <= BUCKET).select("node", "key", F.lit(False).alias("again"))
    places = places.union(finer.where(F.col("size") <= BUCKET).select("node", "key", "again"))
    places = places.union(_met(finer.where(F.col("size") > BUCKET)))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("band"))
    split = buckets.where(F.col("size") > BUCKET).groupBy("node").agg(F.bit_or(bit).alias("split"))
    placed = _in_place(places, classes).join(split, "node", "left").join(known, "node", "left")
    return stored(placed.select("key", "node", "marks", component, F.coalesce("split", F.lit(0)).cast("bigint").alias("split"), "again"), "members")


def _met(rows: DataFrame) -> DataFrame:
    """(node, key, again): each two blocks of a large key, but those of one component, in a place of their own.

    A component over BUCKET has blocks for itself, by node; the others share blocks, a component in
    one. So a key that one component fills but for a few classes has places in proportion to its size.
    """
    per = rows.groupBy("key", "component").agg(F.count("*").alias("n"))
    own = F.when(F.col("n") > BUCKET, F.col("component"))
    shared = per.groupBy("key").agg(F.sum(F.when(F.col("n") <= BUCKET, F.col("n"))).alias("rest"))
    per = per.join(shared, "key").select(
        F.col("key").alias("p_key"), F.col("component").alias("p_component"), own.alias("own"),
        F.ceil(F.coalesce(F.when(own.isNotNull(), F.col("n")), F.col("rest")) / BUCKET).cast("int").alias("blocks"),
    )
    same = F.col("key").eqNullSafe(F.col("p_key")) & F.col("component").eqNullSafe(F.col("p_component"))
    number = F.pmod(F.when(F.col("own").isNull(), F.hash("component")).otherwise(F.hash("node")), F.col("blocks"))
    dealt = rows.join(per, same).select("node", "key", "again", "own", number.alias("number"))
    of = dealt.select(F.col("key").alias("b_key"), F.col("own").alias("b_own"), F.col("number").alias("b_number")).distinct()
    meet = F.col("key").eqNullSafe(F.col("b_key")) & (F.col("own").isNull() | ~F.col("own").eqNullSafe(F.col("b_own")))
    here, there = F.xxhash64(F.lit(1), "own", "number"), F.xxhash64(F.lit(1), "b_own", "b_number")
    return dealt.join(of, meet).select("node", F.xxhash64("key", F.least(here, there), F.greatest(here, there)).alias("key"), "again")


def _first_meeting(group: pa.Table, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether this place is the first that a pair shares; in places that are no band, whether they are for it."""
    keys = band_keys(_matrix(group.column("marks").combine_chunks()))
    again = group.column("again")[0].as_py()
    here = np.flatnonzero((keys == group.column("key")[0].as_py()).all(axis=0))
    if not len(here) and not again:
        return np.ones(len(i), bool)
    split = np.asarray(group.column("split").combine_chunks())
    places = (split[:, None] >> np.arange(BANDS)[None, :]) & 1 == 0
    out = np.empty(len(i), bool)
    for a in range(0, len(i), 100_000):
        part = slice(a, a + 100_000)
        alike = keys[i[part]] == keys[j[part]]
        out[part] = alike.sum(axis=1) == 1 if again else (alike & places[i[part]]).argmax(axis=1) == here[0]
    return out


def _pairs(members: DataFrame, percent: int, tree: bool) -> DataFrame:
    """Candidates (a, b): of each place a spanning forest of its survivors, or, once classes
    have a `component`, all survivors of different ones."""
    node = members.schema["node"].dataType.simpleString()

    def emitted(group: pa.Table) -> pa.RecordBatch:
        i, j, matches = survivors(_matrix(group.column("marks").combine_chunks()), percent)
        if tree:
            chosen = spanning(i, j, matches, group.num_rows)
        else:
            _, part = np.unique(np.array(group.column("component").to_pylist(), object).astype(str), return_inverse=True)
            chosen = np.flatnonzero(part[i] != part[j])
            chosen = chosen[_first_meeting(group, i[chosen], j[chosen])]
        nodes = group.column("node").combine_chunks()
        columns = [nodes.take(pa.array(i[chosen], pa.int64())), nodes.take(pa.array(j[chosen], pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the place that the last batch ended in
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*held, batch])
            keys = np.asarray(table.column("key").combine_chunks())
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1), len(keys)]
            for a, b in zip(cuts[:-2], cuts[1:-1]):
                yield emitted(table.slice(a, b - a))
            held = table.slice(cuts[-2]).to_batches()
        if held:
            yield emitted(pa.Table.from_batches(held))

    placed = members.repartition(partitions(members.sparkSession), "key").sortWithinPartitions("key", "node")
    found = placed.mapInArrow(run, f"a {node}, b {node}")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _verified(pairs: DataFrame, docs: DataFrame, percent: int, id_column: str, text: str) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    pairs = stored(pairs, "pairs")
    involved = stored(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "involved")
    held = involved.agg(F.sum(F.octet_length(F.col("id").cast("string")) + 16)).first()[0] or 0
    given = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    needed = given.join(F.broadcast(involved) if held <= BROADCAST_BYTES else involved, "id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            sets = [s.view(np.int64) for s in shingle_sets(texts(batch), WIDTH)]
            offsets = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            shingles = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), shingles], names=["id", "shingles"])

    id_type = given.schema["id"].dataType.simpleString()
    sets = stored(needed.mapInArrow(run, f"id {id_type}, shingles array<bigint>"), "sets")
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb")).cast("bigint")
    joined = pairs.join(left, "a").join(right, "b")
    return joined.where(100 * both >= percent * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def grouped(docs: DataFrame, percent: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: id, n_shingles, component_id and kept (the id is the component's).

    Documents are linked where their sets of different 5-word shingles have a Jaccard similarity
    of percent / 100 or more; fewer words are one shingle. Null, empty and blank texts are linked
    with nothing. Equal sets are one class from the start. Rows that share an id are one document:
    each has the component of its own set, and a link of one links the id. Rows with a null id
    take their class's component, which no null id can name; alone they have none and are kept.

    A first round verifies a spanning forest of the pruned candidates in each place, which joins most
    of a large group with few pairs; a second one verifies all that still lie between components, in
    the buckets that hold several.
    """
    return _judged(docs, percent, id_column, text).drop("__row")


def _judged(docs: DataFrame, percent: int, id_column: str, text: str) -> DataFrame:
    """grouped(), with `__row`, a hash of the text."""
    signs = stored(signed(docs, id_column, text), "signs")
    equal = signs.where("n > 0").groupBy("f1", "f2").agg(F.min("id").alias("node"), F.first("marks").alias("marks"))
    classes = stored(equal, "classes")
    named_classes = classes.where("node IS NOT NULL")
    buckets = _buckets(named_classes)
    first = stored(_verified(_pairs(_linear(named_classes, buckets), percent, tree=True), docs, percent, id_column, text), "verified")
    joined = stored(components(first), "components")
    second = _verified(_pairs(_members(named_classes, buckets, joined), percent, tree=False), docs, percent, id_column, text)
    # the first round's components stand for its links, so that only the second's paths are walked
    settled = joined.select(F.col("node").alias("a"), F.col("component").alias("b"))
    whole = stored(components(settled.union(second)), "components")
    named = classes.select("f1", "f2", "node").join(whole, "node", "left")
    named = named.select("f1", "f2", F.coalesce("component", "node").alias("component"))
    rows = signs.select("id", "row", "n", "f1", "f2").join(named.withColumn("in", F.lit(1)), ["f1", "f2"], "left")
    component = F.when((F.col("n") > 0) & F.col("in").isNotNull(), F.col("component")).otherwise(F.col("id"))
    result = rows.select(F.col("id").alias(id_column), F.col("row").alias("__row"), F.col("n").alias("n_shingles"), component.alias("component_id"))
    return result.withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id")))


def drop_copies(docs: DataFrame, percent: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, with its own columns; rows with a null id stay where no group has
    them. Rows that share an id, or have none, go each by its own text."""
    gone = _judged(docs, percent, id_column, text).where(~F.col("kept")).select(F.col(id_column).alias("__gone"), "__row").distinct()
    same = F.col(id_column).eqNullSafe(F.col("__gone")) & (row_key(F.col(text)) == F.col("__row"))
    return docs.join(stored(gone, "gone"), same, "left_anti")


def op6_near_dedup(spark, sf_dir: str) -> DataFrame:
    return grouped(spark.read.parquet(f"{sf_dir}/documents.parquet"), 85)
