"""Token counts: byte-pair merges over ragged numpy arrays, all sequences a step at a time.

A word of some thousand bytes has about as many steps as bytes, so the pairs of such a word wait in a heap instead.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.shared import CHUNK_BYTES, text_slices, texts, word_lists

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Chunks whose counts a task remembers; beyond that it starts anew, which only costs time.
REMEMBERED = 500_000
REMEMBERED_BYTES = 32 << 20
#: Bytes of a word beyond which its pairs wait in a heap; the counts are the same.
LONG_WORD = 4096


def byte_characters() -> list[str]:
    """The visible stand-in of each byte in byte-level vocabularies: itself, or the next from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


class MergeTable:
    """The vocabulary as arrays: symbols of bytes, and sorted pairs with rank and merged symbol."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocabulary, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.specials = [t["content"] for t in spec["added_tokens"]]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        characters = byte_characters()
        self.inner = np.array([vocabulary[c] for c in characters], np.int64)
        self.last = np.array([vocabulary[c + suffix] for c in characters], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.base = max(vocabulary.values()) + 1
        keys = np.array([vocabulary[a] * self.base + vocabulary[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(order, len(merges))  # the last stands for no merge
        self.merged = np.append(np.array([vocabulary[a + b] for a, b in merges], np.int64)[order], -1)

    def normalized(self, text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()

    def pre_tokens(self, chunk: str) -> tuple[list[bytes], int]:
        """UTF-8 pre-tokens of a chunk without ASCII white space, and its number of special tokens."""
        if chunk.isascii() and chunk.isalpha():
            return [chunk.lower().encode()], 0
        parts = self.split.split(chunk) if self.split and "<" in chunk else [chunk]
        plain = [w.encode() for p in parts[::2] for w in self.words.findall(self.normalized(p))]
        return plain, len(parts) // 2

    def count(self, words: list[bytes]) -> np.ndarray:
        """Symbols left of each word once no pair can merge.

        In each round every word merges its pair of lowest rank at all its places, from the left;
        words without a pair leave. Rounds are as many as the most merges of one word.
        """
        long = [k for k, w in enumerate(words) if len(w) > LONG_WORD]
        if long:
            left = self.count([b"" if len(w) > LONG_WORD else w for w in words])
            left[long] = [self.count_long(words[k]) for k in long]
            return left
        left = np.fromiter(map(len, words), np.int64, len(words))
        if not left.sum():
            return left
        data = np.frombuffer(b"".join(words), np.uint8)
        owner = np.repeat(np.arange(len(words)), left)
        symbols = self.inner[data]
        ends = np.cumsum(left)[left > 0] - 1
        symbols[ends] = self.last[data[ends]]
        while len(symbols) > 1:
            key = symbols[:-1] * self.base + symbols[1:]
            at = np.searchsorted(self.keys, key)
            hit = (self.keys[at] == key) & (owner[:-1] == owner[1:])
            rank = np.where(hit, self.ranks[at], len(self.keys))
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            lowest = np.minimum.reduceat(np.append(rank, len(self.keys)), first)
            going = lowest < len(self.keys)
            if not going.any():
                break
            size = np.diff(np.append(first, len(owner)))
            chosen = (rank == np.repeat(lowest, size)[:-1]) & hit
            # in a run of overlapping choices (a a a) take every other one from the left
            place = np.flatnonzero(chosen)
            new_run = np.diff(place, prepend=-2) != 1
            in_run = np.arange(len(place)) - np.maximum.accumulate(np.where(new_run, np.arange(len(place)), 0))
            place = place[in_run % 2 == 0]
            symbols[place] = self.merged[at[place]]
            stays = np.ones(len(symbols), bool)
            stays[place + 1] = False
            left -= np.bincount(owner[place], minlength=len(words))
            stays &= np.repeat(going, size)  # words without a pair are done
            symbols, owner = symbols[stays], owner[stays]
        return left

    @cached_property
    def pairs(self) -> dict[int, tuple[int, int]]:
        return dict(zip(self.keys[:-1].tolist(), zip(self.ranks[:-1].tolist(), self.merged[:-1].tolist())))

    def count_long(self, word: bytes) -> int:
        """The same for one word: the pair of lowest rank first, then from the left; n log n steps."""
        data = np.frombuffer(word, np.uint8)
        given = self.inner[data]
        given[-1] = self.last[data[-1]]
        key = given[:-1] * self.base + given[1:]
        at = np.searchsorted(self.keys, key)
        places = np.flatnonzero(self.keys[at] == key)
        heap = ((self.ranks[at[places]] << 32) | places).tolist()
        heapq.heapify(heap)
        n = left = len(given)
        symbols, after, before = array("q", given.tolist()), array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        while heap:
            rank, i = divmod(heapq.heappop(heap), 1 << 32)
            j = after[i]
            if symbols[i] < 0 or j == n:
                continue
            found = self.pairs.get(symbols[i] * self.base + symbols[j])
            if found is None or found[0] != rank:  # one of the two has merged meanwhile
                continue
            symbols[i], symbols[j] = found[1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            left -= 1
            for a in (before[i], i):
                if a >= 0 and after[a] < n:
                    found = self.pairs.get(symbols[a] * self.base + symbols[after[a]])
                    if found:
                        heapq.heappush(heap, found[0] << 32 | a)
        return left


class Counts:
    """Counts tokens of texts; each different chunk between ASCII white space is merged once."""

    def __init__(self, file: str):
        self.table = MergeTable(file)
        self.known: dict[bytes, int] = {}
        self.held = 0

    def __call__(self, raw: list[bytes]) -> list[int]:
        """Tokens of each text; the chunks of all short texts are merged together."""
        short = [x.split() for x in raw if len(x) <= CHUNK_BYTES]
        self.of_chunks([c for chunks in short for c in chunks])
        return [sum(map(self.of_chunks, word_lists(x))) for x in raw]

    def of_chunks(self, chunks: list[bytes]) -> int:
        new = {c for c in chunks if c not in self.known}
        size = sum(map(len, new))
        if len(self.known) + len(new) > REMEMBERED or self.held + size > REMEMBERED_BYTES:
            self.known.clear()
            new = set(chunks)
            self.held, size = 0, sum(map(len, new))
        self.held += size
        if new:
            self.learn(list(new))
        return sum(map(self.known.__getitem__, chunks))

    def learn(self, new: list[bytes]) -> None:
        parts = [self.table.pre_tokens(c.decode()) for c in new]
        words: Counter[bytes] = Counter(w for ws, _ in parts for w in ws)
        per_word = dict(zip(words, self.table.count(list(words)).tolist()))
        self.known.update((c, n + sum(map(per_word.__getitem__, ws))) for c, (ws, n) in zip(new, parts))


def token_counts(docs: DataFrame, file: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row its id, n_bytes and n_tokens (long).

    Null and empty texts have 0 of both. Equal ids give a row each. Special strings in a text
    count as one token; begin and end tokens are not added. No shuffle; a task holds one slice
    of texts and at most REMEMBERED chunks or REMEMBERED_BYTES (a slice with more holds its own).
    """
    given = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counts(file)
        for batch in text_slices(batches):
            raw = texts(batch)
            columns = [batch.column("id"), pa.array(map(len, raw), pa.int64()), pa.array(count(raw), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_bytes", "n_tokens"])

    id_type = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(run, f"id {id_type}, n_bytes bigint, n_tokens bigint").withColumnRenamed("id", id_column)


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path(VOCABULARY))
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
