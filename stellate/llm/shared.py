"""Helpers of the operators: shared tables, whole-text batches, words as numpy arrays."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Words are runs of anything but ASCII white space; the same class in Java, RE2 and Python.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes of text that a Python task holds as numpy arrays at once; one longer text counts alone.
CHUNK_BYTES = 2 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the cluster's shared folder and read back.

    Cuts the lineage: a lost executor costs the reading of files, not the steps before. Each
    call takes a fresh folder. Where the session names no folder, one of our own is set on a
    local master only, whose tasks share one machine; elsewhere that is an error.
    """
    spark = df.sparkSession
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"name a folder that all executors share in {CHECKPOINT_DIR}")
        root = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set(CHECKPOINT_DIR, root)
    path = f"{root.rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else, unlike lower()."""
    return F.translate(text, UPPER, UPPER.lower())


def row_key(text: Column) -> Column:
    """Tells rows apart that share an id but not their text."""
    return F.xxhash64(text)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows again in slices of about CHUNK_BYTES of text; texts are never cut."""
    for batch in batches:
        lengths = np.asarray(pc.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
        group = np.cumsum(lengths) // CHUNK_BYTES
        cuts = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if b > a:
                yield batch.slice(a, b - a)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 texts; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def word_lists(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a list for about every CHUNK_BYTES, so a long text is not held as words at once."""
    at = 0
    while len(raw) - at > CHUNK_BYTES:
        cut = _SPACE_BYTE.search(raw, at + CHUNK_BYTES)
        if cut is None:
            break
        yield raw[at : cut.start()].split()
        at = cut.end()
    yield raw[at:].split()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer on uint64: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_SPACE_BYTE = re.compile(rb"[\x20\x09-\x0D]")
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUES = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each lower-cased word, and where each text's words begin (len + 1)."""
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    data = _LOWER[np.frombuffer(b"".join(raw), np.uint8)]
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    inside = ~_IS_SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    first = bounds[:-1][lengths > 0]
    starts[first] = inside[first]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] if len(data) else True
    last = bounds[1:][lengths > 0] - 1
    ends[last] = inside[last]
    at, to = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    # position i adds value * base**i; dividing by base**start makes equal words equal
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE_VALUES[data] * _powers(_BASE, len(data)))))
    hashes = (total[to] - total[at]) * _powers(_BASE_INVERSE, len(data) + 1)[at]
    return mix64(hashes + (to - at).astype(np.uint64)), np.searchsorted(at, bounds)


def long_word_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """word_hashes(), a long text in pieces, so that only 8 bytes a word stay of it."""
    if sum(map(len, raw)) <= 2 * CHUNK_BYTES:
        return word_hashes(raw)
    parts = []
    bounds = [0]
    for text in raw:
        n = 0
        for words in word_lists(text):
            parts.append(word_hashes([b" ".join(words)])[0])
            n += len(parts[-1])
        bounds.append(bounds[-1] + n)
    return np.concatenate(parts or [np.zeros(0, np.uint64)]), np.array(bounds)


def shingle_sets(raw: list[bytes], width: int) -> list[np.ndarray]:
    """Each text's sorted different shingle hashes: `width` words, or all words of a shorter text."""
    hashes, bounds = long_word_hashes(raw)
    salts = mix64(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    whole = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for j in range(width):
        whole += hashes[j : j + len(whole)] * salts[j]
    whole = mix64(whole)
    out = []
    for a, b in zip(bounds, bounds[1:]):
        if b - a >= width:
            out.append(np.unique(whole[a : b - width + 1]))
        else:  # the number of words tells it from a full shingle
            own = (hashes[a:b] * salts[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix64(np.array([own] if b > a else [], np.uint64)))
    return out
