"""Suffix-array dedup: bytes covered by 200-byte strings that occur twice, by merging shard BWTs.

Most of a corpus repeats nothing, and most repeats are copies of whole stretches. Both are settled by hashes, without loss:

1. Every 200-byte window is owned by its least 48-byte substring (by hash, then from the left). Equal
   windows are owned by equal substrings, so a run of windows whose owner is unique repeats nothing.
2. Runs with equal bytes repeat as a whole.
3. What is left are runs with equal owners and different bytes: the edges of copies. They are cut
   into strings whose windows share a core. Equal strings repeat as a whole; different ones with
   equal cores meet in one place, where shards of them are sorted and their Burrows-Wheeler
   transforms merged by interleave refinement up to depth 200.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.shared import _BASE, _BASE_INVERSE, _BYTE_VALUES, _powers, mix64, partitions, row_key, stored, text_slices, texts

LENGTH = 200
OWNER = 48
#: Windows of a string of step 3 begin within so many bytes.
OFFSETS = 40
PIECE = 4 << 20
#: Bytes whose arrays stay in a processor's cache; short texts are read in halves of it.
BLOCK = 512 << 10
PLACE_BITS = 23
SHARD_BYTES, PLACE_BYTES = 64 << 10, 256 << 10
#: Symbols by which one round of the merge refines the order; LENGTH is a multiple.
STEP = 8
#: Strings with one core compared in one place; windows of more are counted by 128-bit hash.
SAME_CORE = 4096


_KNOWN_POWERS = _powers(_BASE, BLOCK + 1), _powers(_BASE_INVERSE, BLOCK + 1)


def _prefix(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) + 1
    power, inverse = (x[:n] for x in _KNOWN_POWERS) if n <= BLOCK + 1 else (_powers(_BASE, n), _powers(_BASE_INVERSE, n))
    prefix = np.zeros(n, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * power[:-1], out=prefix[1:])
    return prefix, inverse


def _hash(prefix: np.ndarray, inverse: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64((prefix[b] - prefix[a]) * inverse[a] + (b - a).astype(np.uint64))


def owned_runs(pieces: list[bytes]) -> tuple[np.ndarray, ...]:
    """(piece, first window, windows, owner's place, owner's hash, hash of all bytes) of each run."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    data = np.frombuffer(b"".join(pieces), np.uint8)
    width = LENGTH - OWNER + 1
    n = len(data) - OWNER + 1
    if n < width:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),) * 2
    prefix, inverse = _prefix(data)
    grams = mix64((prefix[OWNER:] - prefix[:n]) * inverse[:n] + np.uint64(OWNER))
    place = np.uint64((1 << PLACE_BITS) - 1)
    value = (grams & ~place) | np.arange(n, dtype=np.uint64)
    padded = np.concatenate((value, np.full(-n % width, np.iinfo(np.uint64).max, np.uint64))).reshape(-1, width)
    before = np.minimum.accumulate(padded, axis=1).ravel()
    after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(after[: n - width + 1], before[width - 1 : n])
    owner = (least & place).astype(np.int64)
    ends = np.cumsum(lengths)
    piece = np.repeat(np.arange(len(pieces)), lengths)
    valid = np.flatnonzero(np.arange(LENGTH, len(owner) + LENGTH) <= np.repeat(ends, lengths)[: len(owner)])
    new = np.ones(len(valid), bool)
    new[1:] = (np.diff(owner[valid]) != 0) | (np.diff(valid) != 1)
    first = valid[new]
    windows = np.diff(np.append(np.flatnonzero(new), len(valid)))
    base = (ends - lengths)[piece[first]]
    own = owner[first]
    return piece[first], first - base, windows, own - base, mix64(grams[own]), _hash(prefix, inverse, first, first + windows + LENGTH - 1)


def runs(given: DataFrame) -> DataFrame:
    """(h, c, id, row, start, windows, owner) of all runs of all texts; long texts in overlapping pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            raw = texts(batch)
            group = np.cumsum([len(x) for x in raw]) // (BLOCK // 2)
            short = np.array([k for k, x in enumerate(raw) if len(x) <= PIECE], np.int64)
            jobs = [([raw[k] for k in own], own, 0) for own in np.split(short, np.flatnonzero(np.diff(group[short])) + 1) if len(own)]
            jobs += [([raw[k][a : a + PIECE + LENGTH - 1]], np.array([k]), a) for k, x in enumerate(raw) if len(x) > PIECE for a in range(0, len(x), PIECE)]
            for pieces, at, offset in jobs:
                piece, start, windows, owner, h, c = owned_runs(pieces)
                rows = pa.array(at[piece])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), batch.column("id").take(rows), batch.column("row").take(rows)]
                    + [pa.array(start + offset), pa.array(windows.astype(np.int32)), pa.array(owner + offset)],
                    names=["h", "c", "id", "row", "start", "windows", "owner"],
                )

    id_type = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(run, f"h bigint, c bigint, id {id_type}, row bigint, start bigint, windows int, owner bigint")


def suffix_order(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The suffixes of a shard's strings by their first LENGTH symbols at least; each string ends with a 0."""
    left = ends - np.arange(len(data))
    width = 7
    key = np.zeros(len(data), np.int64)
    for j in range(width):  # seven symbols of nine bits
        symbol = np.zeros(len(data), np.int64)
        symbol[: len(data) - j] = data[j:]
        key = (key << 9) | np.where(j < left, symbol, 0)
    rank = np.unique(key, return_inverse=True)[1].reshape(-1)
    while width < LENGTH:
        after = np.arange(len(data)) + width
        second = np.where(width < left, rank[np.minimum(after, len(data) - 1)] + 1, 0)
        key = rank * (int(second.max(initial=0)) + 1) + second
        rank = np.unique(key, return_inverse=True)[1].reshape(-1)
        width *= 2
    return np.argsort(rank, kind="stable")


def _stable_order(rank: np.ndarray) -> np.ndarray:
    """Stable argsort of ranks in 32 bits, 16 bits at a time, which numpy sorts by radix."""
    order = np.argsort((rank & 0xFFFF).astype(np.uint16), kind="stable")
    high = (rank >> 16).astype(np.uint16)
    return order[np.argsort(high[order], kind="stable")] if high.any() else order


def repeated_windows(strings: list[bytes]) -> list[np.ndarray]:
    """For each string the places whose next LENGTH bytes occur at another place of any string.

    The strings are split into shards, each sorted by itself. From the shards' transforms alone,
    the interleave of their suffixes is refined: the order by t + STEP symbols is a stable sort, by
    the STEP symbols before, of the order by t symbols. Blocks of suffixes with equal first t
    symbols are carried along. A suffix can share t + STEP symbols with another only if the one
    STEP after it shares t, so a block of one is settled, with a common prefix below t, and leaves; so do
    suffixes that would pass the end of their string. What is left at LENGTH are the repeated intervals.
    """
    grams, last, places = [], [], []
    base = 0
    sizes = np.cumsum([len(s) + 1 for s in strings])
    for shard in range(int(sizes[-1]) // SHARD_BYTES + 1):
        own = np.flatnonzero(sizes // SHARD_BYTES == shard)
        if not len(own):
            continue
        # bytes count from 1; 0 ends a string
        data = np.concatenate([np.append(np.frombuffer(strings[k], np.uint8).astype(np.uint16) + 1, np.uint16(0)) for k in own])
        length = np.array([len(strings[k]) + 1 for k in own])
        ends = np.repeat(np.cumsum(length), length)
        starts = ends - np.repeat(length, length)
        order = suffix_order(data, ends)
        inverse = np.empty(len(order), np.int64)
        inverse[order] = np.arange(len(order))
        before = np.zeros(len(data), np.uint64)  # the STEP bytes before each place
        for j in range(STEP if len(data) > STEP else 0):
            before[STEP:] = (before[STEP:] << np.uint64(8)) | ((data[j : len(data) - STEP + j] - 1) & 0xFF).astype(np.uint64)
        inside = order - STEP >= starts[order]
        grams.append((before[order], inside))
        last.append((inverse[np.where(inside, order - STEP, 0)] + base).astype(np.int32))
        places.append(order + base)
        base += len(data)
    gram, inside = np.concatenate([g for g, _ in grams]), np.concatenate([i for _, i in grams])
    step, place = np.concatenate(last), np.concatenate(places)
    rank = np.zeros(base, np.uint32)  # 0: no STEP symbols before
    rank[inside] = np.unique(gram[inside], return_inverse=True)[1].reshape(-1) + 1
    merged = np.arange(base, dtype=np.int32)  # shard after shard: the order by no symbol at all
    block = np.zeros(base, np.int32)
    for _ in range(LENGTH // STEP):
        merged, block = merged[inside[merged]], block[inside[merged]]
        order = _stable_order(rank[merged])
        merged, block = merged[order], block[order]
        before = rank[merged]
        edge = np.ones(len(merged) + 1, bool)
        edge[1:-1] = (before[1:] != before[:-1]) | (block[1:] != block[:-1])
        shared = ~(edge[:-1] & edge[1:])
        merged = step[merged[shared]]
        block = np.cumsum(edge[:-1], dtype=np.int32)[shared]
    found = np.zeros(base, bool)
    found[place[merged]] = True
    out = []
    for end, s in zip(sizes, strings):
        at = end - len(s) - 1
        out.append(np.flatnonzero(found[at : at + max(0, len(s) - LENGTH + 1)]))
    return out


def _spans(places: np.ndarray) -> list[tuple[int, int]]:
    """(first, windows) of runs of consecutive places."""
    if not len(places):
        return []
    cuts = np.flatnonzero(np.diff(places) != 1) + 1
    return [(int(p[0]), len(p)) for p in np.split(places, cuts)]


def _strings(needed: DataFrame) -> DataFrame:
    """(core, s, id, row, start, windows): pieces of runs whose windows all hold the core; s is a
    128-bit hash of a piece's bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            cores, strings, rows, starts, windows = [], [], [], [], []
            for k, (text, todo) in enumerate(zip(texts(batch), batch.column("todo").to_pylist())):
                for r in todo:
                    low, high = r["owner"] - r["start"] - r["windows"] + 1, r["owner"] - r["start"]
                    for part in range(low // OFFSETS, high // OFFSETS + 1):
                        least, most = max(low, part * OFFSETS), min(high, part * OFFSETS + OFFSETS - 1)
                        core = text[r["owner"] - part * OFFSETS : r["owner"] - part * OFFSETS - OFFSETS + 1 + LENGTH]
                        cores.append(hashlib.blake2b(core, digest_size=16, key=b"%d" % part).digest())
                        strings.append(hashlib.blake2b(text[r["owner"] - most : r["owner"] - least + LENGTH], digest_size=16).digest())
                        rows.append(k)
                        starts.append(r["owner"] - most)
                        windows.append(most - least + 1)
            at = pa.array(rows, pa.int64())
            columns = [pa.array(cores, pa.binary()), pa.array(strings, pa.binary()), batch.column("id").take(at), batch.column("row").take(at)]
            columns += [pa.array(starts, pa.int64()), pa.array(windows, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["core", "s", "id", "row", "start", "windows"])

    id_type = needed.schema["id"].dataType.simpleString()
    return needed.mapInArrow(run, f"core binary, s binary, id {id_type}, row bigint, start bigint, windows bigint")


def _bytes_of(needed: DataFrame) -> DataFrame:
    """(core, n, string, id, row, start) of the pieces listed in `todo`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            listed = [(k, text, r) for k, (text, todo) in enumerate(zip(texts(batch), batch.column("todo").to_pylist())) for r in todo]
            at = pa.array([k for k, _, _ in listed], pa.int64())
            columns = [pa.array([r["core"] for *_, r in listed], pa.binary()), pa.array([r["n"] for *_, r in listed], pa.int64())]
            columns += [pa.array([t[r["start"] : r["start"] + r["windows"] + LENGTH - 1] for _, t, r in listed], pa.binary())]
            columns += [batch.column("id").take(at), batch.column("row").take(at), pa.array([r["start"] for *_, r in listed], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["core", "n", "string", "id", "row", "start"])

    id_type = needed.schema["id"].dataType.simpleString()
    return needed.mapInArrow(run, f"core binary, n bigint, string binary, id {id_type}, row bigint, start bigint")


def _with_texts(given: DataFrame, pieces: DataFrame, *columns: str) -> DataFrame:
    """Each text with its list `todo` of pieces. Both sides are shuffled at every size: the pieces grow with the texts."""
    todo = pieces.groupBy("id", "row").agg(F.collect_list(F.struct(*columns)).alias("todo"))
    todo = todo.withColumnsRenamed({"id": "__id", "row": "__row"}).hint("merge")
    on = F.col("id").eqNullSafe(F.col("__id")) & (F.col("row") == F.col("__row"))
    return given.join(todo, on).select("id", "row", "text", "todo")


def _having(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is listed. The null-safe join does not reuse the shuffle that grouped the
    keys, so adaptive execution can split a hot one."""
    listed = keys.select(F.col(key).alias("__key"))
    return rows.join(listed, F.col(key).eqNullSafe(F.col("__key")), "left_semi")


def _merged(strings: DataFrame) -> DataFrame:
    """(id, row, start, windows) of repeats among strings that share a core."""
    id_type = strings.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, row bigint, start bigint, windows bigint"

    def solved(table: pa.Table) -> pa.RecordBatch:
        found = repeated_windows(table.column("string").to_pylist())
        rows, first, windows = [], [], []
        for k, (start, places) in enumerate(zip(table.column("start").to_pylist(), found)):
            for a, n in _spans(places):
                rows.append(k)
                first.append(start + a)
                windows.append(n)
        own = table.select(["id", "row"]).combine_chunks().take(pa.array(rows, pa.int64())).to_batches()
        columns = own[0].columns if own else [pa.array([], table.schema.field(c).type) for c in ("id", "row")]
        return pa.RecordBatch.from_arrays([*columns, pa.array(first, pa.int64()), pa.array(windows, pa.int64())], names=["id", "row", "start", "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            cores = batch.column("core").to_pylist()
            lengths = np.cumsum([len(s) for s in batch.column("string").to_pylist()])
            at = 0
            for k in range(1, len(cores)):  # a place ends where a core does
                if cores[k] != cores[k - 1] and size + lengths[k - 1] >= PLACE_BYTES:
                    yield solved(pa.Table.from_batches([*held, batch.slice(at, k - at)]))
                    held, at, size = [], k, -int(lengths[k - 1])
            if len(cores):
                held.append(batch.slice(at))
                size += int(lengths[-1])
        if held:
            yield solved(pa.Table.from_batches(held))

    placed = strings.select("core", "string", "id", "row", "start").repartition(partitions(strings.sparkSession), "core")
    return placed.sortWithinPartitions("core", "string", "id", "row", "start").mapInArrow(run, schema)


def _counted(strings: DataFrame) -> DataFrame:
    """The same for cores that very many strings share: each window counted by its hash."""
    id_type = strings.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, rows, starts = [], [], []
            for k, (s, start) in enumerate(zip(batch.column("string").to_pylist(), batch.column("start").to_pylist())):
                for a in range(len(s) - LENGTH + 1):
                    hashes.append(hashlib.blake2b(s[a : a + LENGTH], digest_size=16).digest())
                    rows.append(k)
                    starts.append(start + a)
            at = pa.array(rows, pa.int64())
            columns = [pa.array(hashes, pa.binary()), batch.column("id").take(at), batch.column("row").take(at), pa.array(starts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["w", "id", "row", "start"])

    windows = stored(strings.mapInArrow(run, f"w binary, id {id_type}, row bigint, start bigint"), "windows")
    twice = windows.groupBy("w").agg(F.count("*").alias("n")).where("n > 1").select("w")
    return windows.join(twice, "w", "left_semi").select("id", "row", "start", F.lit(1).cast("bigint").alias("windows"))


def repeated_spans(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, row, spans): for documents with repeats, unmerged byte spans (start, end) to remove.

    `row` is a hash of the text. Rows with the same id and text are occurrences of their own,
    so all of their bytes repeat. Texts under LENGTH bytes have no window.
    """
    given = docs.select(F.col(id_column).alias("id"), row_key(F.col(text)).alias("row"), F.col(text).alias("text"))
    every = runs(given)  # computed twice: cheaper than to keep it
    owners = every.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    shared = stored(_having(every, owners, "h"), "shared")
    first = F.min(F.struct("id", "row", "start", "windows", "owner")).alias("first")
    kinds = stored(shared.groupBy("h", "c").agg(F.count("*").alias("n"), first), "kinds")
    whole = shared.join(kinds.where("n > 1").select("h", "c"), ["h", "c"], "left_semi")
    whole = whole.select("id", "row", "start", F.col("windows").cast("bigint").alias("windows"))
    several = kinds.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1").select("h")
    edges = _having(kinds, several, "h").select("first.*")
    strings = stored(_strings(_with_texts(given, edges, "start", "windows", "owner")), "strings")
    alike = strings.groupBy("core", "s").agg(F.count("*").alias("n"), F.min(F.struct("id", "row", "start", "windows")).alias("first"))
    alike = stored(alike, "alike")
    equal = strings.join(alike.where("n > 1").select("core", "s"), ["core", "s"], "left_semi").select("id", "row", "start", "windows")
    cores = alike.groupBy("core").agg(F.count("*").alias("n")).where("n > 1")
    differing = alike.select("core", "first.*").join(cores, "core")
    meeting = stored(_bytes_of(_with_texts(given, differing, "core", "n", "start", "windows")), "meeting")
    parts = whole.union(equal).union(_merged(meeting.where(F.col("n") <= SAME_CORE))).union(_counted(meeting.where(F.col("n") > SAME_CORE)))
    span = F.struct("start", (F.col("start") + F.col("windows") + (LENGTH - 1)).alias("end"))
    return parts.groupBy("id", "row").agg(F.collect_set(span).alias("spans"))


def union_of(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def removed(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: id, n_bytes, spans (maximal removed byte runs) and kept (the remaining bytes).

    A null or empty text has no bytes and no spans. Every row gives a row.
    """
    spans = repeated_spans(docs, id_column, text).withColumnsRenamed({"id": "__id", "row": "__row"})
    given = docs.select(F.col(id_column).alias("id"), row_key(F.col(text)).alias("row"), F.col(text).alias("text"))
    joined = given.join(spans, F.col("id").eqNullSafe(F.col("__id")) & (F.col("row") == F.col("__row")), "left")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            raw = texts(batch)
            gone = [union_of([(s["start"], s["end"]) for s in x or []]) for x in batch.column("spans").to_pylist()]
            kept = [b"".join(t[a:b] for a, b in zip([0, *(e for _, e in g)], [*(s for s, _ in g), len(t)])) for t, g in zip(raw, gone)]
            lists = pa.array([[{"start": a, "end": b} for a, b in g] for g in gone], kind)
            columns = [batch.column("id"), pa.array(map(len, raw), pa.int64()), lists, pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_bytes", "spans", "kept"])

    id_type = given.schema["id"].dataType.simpleString()
    out = joined.select("id", "text", "spans").mapInArrow(run, f"id {id_type}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
    return out.withColumnRenamed("id", id_column)


def op10_repeats(spark, sf_dir: str) -> DataFrame:
    rows = removed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
