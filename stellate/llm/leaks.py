"""Benchmark decontamination: edit distance as Hamming distance after a random walk, then exact checks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.shared import CHUNK_BYTES, mix64, row_key, stored, text_slices

#: A passage matches an item if it takes at most (100 - PERCENT) % of the item's words as edits.
PERCENT = 80
#: Items of fewer words are allowed no edits, and are sought as they are.
MIN_WORDS = 5
#: Sampled symbols of a key, and keys. A part-sized window at the widest allowed distance
#: shares a key with its part with a probability over 0.9; windows beside it add their chances.
SAMPLED, KEYS = 3, 20
#: Longer items are sought by parts of at most so many words, as the walks of long windows drift apart.
PART_WORDS = 30
#: Item words that a pass holds; more items take more passes.
PASS_WORDS = 1_000_000
#: Letters and marks of scripts without spaces between words: Thai, Lao, Burmese, Khmer, Tai, kana, bopomofo, Han.
_SPACELESS = (
    "\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ecd\u0edc-\u0edf\u1000-\u103f\u1050-\u108f\u1780-\u17d3\u1950-\u19cf\u1a20-\u1a7c"
    "\u3005-\u3007\u3041-\u309a\u309d-\u309f\u30a1-\u30fa\u30fc-\u30ff\u3105-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
    "\ua9e0-\ua9ef\ua9fa-\ua9fe\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
)
_WORD = re.compile(rf"[{_SPACELESS}]|[^\W{_SPACELESS}]+")
_BREAK = re.compile(rf"[\s{_SPACELESS}]")


def lowered(text: str) -> str:
    """Lower case of the same length, so that places stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def allowed(words: int, percent: int = PERCENT) -> int:
    return words * (100 - percent) // 100


def part_bounds(words: int) -> list[int]:
    """Where an item's nearly equal parts begin, and its end.

    Edits beyond every part's own allowance would be more than the item's: some part of each
    match is a match of that part.
    """
    parts = max(1, -(-words // PART_WORDS))
    return [words * k // parts for k in range(parts + 1)]


def sampled_steps(size: int) -> np.ndarray:
    """Step by key: whether the key keeps what the walk writes there.

    A walk passes n words in 2n steps on average. Samples come from the first 1.25n, which
    costs less and has fewer edits behind it.
    """
    rng = np.random.Generator(np.random.PCG64(size))
    keeps = np.zeros((size + size // 4 + 1, KEYS), bool)
    for key in range(KEYS):
        keeps[rng.choice(len(keeps), SAMPLED, replace=False), key] = True
    return keeps


def embed(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, ends: np.ndarray, n_symbols: int) -> np.ndarray:
    """A row of KEYS keys for each window symbols[start : start + size], cut at its end.

    A key is what a random walk has written at the sampled steps. At each step the walk writes
    its symbol, and a coin shared by all windows (of key, step and symbol) says whether it moves
    on; beyond the window it writes padding. Walks meet again after an edit, so a small edit
    distance gives a small Hamming distance. The size is part of the key.
    """
    out = np.empty((len(starts), KEYS), np.uint64)
    different, which_size = np.unique(sizes, return_inverse=True)
    most = int(different.max(initial=0)) * 5 // 4 + 1
    keeps = np.zeros((most, len(different), KEYS), bool)
    for k, n in enumerate(different.tolist()):
        keeps[: n + n // 4 + 1, k] = sampled_steps(n)
    padded = np.append(symbols, 0)
    which = mix64(np.arange(1, KEYS + 1, dtype=np.uint64))[None, :]
    for a in range(0, len(starts), 4096):
        part = slice(a, a + 4096)
        stop = np.minimum(starts[part] + sizes[part], ends[part])[:, None]
        own_size = which_size[part]
        at = np.repeat(starts[part][:, None], KEYS, axis=1)
        key = np.repeat(mix64(sizes[part].astype(np.uint64))[:, None], KEYS, axis=1)
        for step in range(int(sizes[part].max()) * 5 // 4 + 1):
            now = np.where(at < stop, padded[np.minimum(at, stop)], n_symbols)
            here = np.nonzero(keeps[step][own_size])
            key[here] = mix64(key[here] + now[here].astype(np.uint64) + np.uint64(1))
            coin = mix64(which + ((now << 24) + step).astype(np.uint64)) & np.uint64(1)
            at += coin.astype(bool) & (at < stop)
        out[part] = key
    return out


@dataclass
class Index:
    """The items' parts by their number of words, each with its keys."""

    ids: list
    words: list[np.ndarray]
    vocabulary: dict[str, int]  # from 1; 0 is any other word
    percent: int

    def __post_init__(self) -> None:
        n = len(self.vocabulary) + 1
        self.whole: dict[int, dict[tuple[int, ...], list[int]]] = {}  # the items under MIN_WORDS, by size
        for k, w in enumerate(self.words):
            if len(w) < MIN_WORDS:
                self.whole.setdefault(len(w), {}).setdefault(tuple(w.tolist()), []).append(k)
        bounds = [part_bounds(len(w)) if len(w) >= MIN_WORDS else [0] for w in self.words]
        parts = [w[a:b] for w, cuts in zip(self.words, bounds) for a, b in zip(cuts, cuts[1:])]
        self.part_item = np.repeat(np.arange(len(bounds)), np.array([len(cuts) - 1 for cuts in bounds], np.int64))
        self.part_at = np.array([a for cuts in bounds for a in cuts[:-1]], np.int64)
        sizes = np.array([len(w) for w in parts], np.int64)
        flat = np.concatenate([*parts, np.zeros(0, np.int64)])
        starts = np.cumsum(sizes) - sizes
        keys = embed(flat, starts, sizes, starts + sizes, n)
        self.order = np.argsort(keys, axis=0, kind="stable")
        self.keys = np.take_along_axis(keys, self.order, axis=0)
        self.pairs = {}  # neighbouring words of the parts of each size
        for size in np.unique(sizes).tolist():
            own = [parts[k] for k in np.flatnonzero(sizes == size)]
            self.pairs[size] = np.unique(np.concatenate([w[:-1] * n + w[1:] for w in own]))
        self.all_pairs = np.unique(np.concatenate([*self.pairs.values(), np.zeros(0, np.int64)]))

    def encode(self, text: str) -> np.ndarray:
        """Word numbers; a long text is cut between words, so its words are not all held as strings."""
        parts, at = [], 0
        while at < len(text):
            cut = _BREAK.search(text, at + CHUNK_BYTES) if len(text) - at > CHUNK_BYTES else None
            end = cut.start() if cut else len(text)
            found = _WORD.findall(lowered(text[at:end]))
            parts.append(np.fromiter((self.vocabulary.get(w, 0) for w in found), np.int64, len(found)))
            at = end
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def find(self, texts: list[np.ndarray]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, first word, word after, distance) of all matches."""
        lengths = np.array([len(t) for t in texts], np.int64)
        flat = np.concatenate(texts) if texts else np.zeros(0, np.int64)
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        owner = np.repeat(np.arange(len(texts)), lengths)
        pair = flat[:-1] * (len(self.vocabulary) + 1) + flat[1:]
        inside = (flat[:-1] > 0) & (flat[1:] > 0) & (owner[:-1] == owner[1:])
        at = np.flatnonzero(inside)
        at = at[np.isin(pair[at], self.all_pairs)]
        windows = [np.zeros((2, 0), np.int64)]
        for size, pairs in self.pairs.items():
            edits = allowed(size, self.percent)
            # An edit breaks at most two of a part's size - 1 pairs of neighbours. So a match has
            # this many pairs of parts of its size within size + edits words, and the first of
            # them begins at most 2 * edits words after the match.
            least = max(size - 1 - 2 * edits, 1)
            own = at[np.isin(pair[at], pairs)]
            if len(own) >= least:
                first = own[np.flatnonzero(own[least - 1 :] - own[: len(own) - least + 1] < size + edits)]
                starts = first[:, None] - np.arange(2 * edits + 1)[None, :]
                starts = np.unique(starts[starts >= bounds[owner[first]][:, None]])
                windows.append(np.stack([starts, np.full(len(starts), size)]))
        starts, sizes = np.concatenate(windows, axis=1)
        keys = embed(flat, starts, sizes, bounds[owner[starts] + 1], len(self.vocabulary) + 1)
        near: dict[tuple[int, int], set[int]] = {}
        for key in range(KEYS):
            low = np.searchsorted(self.keys[:, key], keys[:, key], "left")
            high = np.searchsorted(self.keys[:, key], keys[:, key], "right")
            for w in np.flatnonzero(high > low):
                for k in self.order[low[w] : high[w], key]:
                    text = int(owner[starts[w]])  # a place is where the item would begin, so it may lie before the text
                    near.setdefault((text, int(self.part_item[k])), set()).add(int(starts[w] - bounds[text] - self.part_at[k]))
        for size, items in self.whole.items():
            begins = np.array([w[0] for w in items], np.int64)
            for w in np.flatnonzero(np.isin(flat[: max(0, len(flat) - size + 1)], begins)).tolist():
                text = int(owner[w])
                if w + size <= bounds[text + 1]:
                    for k in items.get(tuple(flat[w : w + size].tolist()), ()):
                        near.setdefault((text, k), set()).add(w - int(bounds[text]))
        out = []
        for (text, item), places in sorted(near.items()):
            out += [(text, item, *m) for m in self._verified(flat[bounds[text] : bounds[text + 1]], item, np.array(sorted(places)))]
        return out

    def _verified(self, text: np.ndarray, item: int, places: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """The best matches in each run of close places, about an item long, that are within the allowed edits."""
        words = self.words[item]
        edits = allowed(len(words), self.percent)
        # the edits before a part move it, besides those within it
        margin = edits + (2 * allowed(PART_WORDS, self.percent) if len(words) > PART_WORDS else 0)
        runs: list[list[int]] = []
        for p in places.tolist():
            if runs and p - runs[-1][-1] <= max(edits, 1) and p - runs[-1][0] <= len(words):
                runs[-1].append(p)
            else:
                runs.append([p])
        last = -1
        for run in runs:
            exact = [p for p in run if p >= 0 and np.array_equal(text[p : p + len(words)], words)]
            if exact:
                found = [(p, p + len(words), 0) for p in exact]
            else:
                found = self._within(text, words, max(0, run[0] - margin), min(len(text), run[-1] + len(words) + margin))
            for match in found:
                if match[0] >= last:  # runs may reach into each other
                    last = match[1]
                    yield match


    def _within(self, text: np.ndarray, words: np.ndarray, low: int, high: int) -> list[tuple[int, int, int]]:
        """The best match in text[low:high], and those beside it, in order."""
        edits = allowed(len(words), self.percent)
        if high - low < len(words) - edits or least_distance(words, text[low:high]) > edits:
            return []
        first, end, distance = best_match(words, text[low:high])
        if first == end:
            return [(low + first, low + end, distance)]
        return [*self._within(text, words, low, low + first), (low + first, low + end, distance), *self._within(text, words, low + end, high)]


def least_distance(item: np.ndarray, region: np.ndarray) -> int:
    """best_match()'s distance, sooner for long items."""
    place = np.arange(len(region) + 1)
    cost = np.zeros(len(region) + 1, np.int64)
    for word in item:
        cost[1:] = np.minimum(cost[:-1] + (region != word), cost[1:] + 1)
        cost[0] += 1
        cost = np.minimum.accumulate(cost - place) + place
    return int(cost.min())


def best_match(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """(first, end, distance) of the part of the region with the least edit distance to the item.

    A row of the table at a time. Of equal costs a word against a word comes first, then one that the
    region lacks, then one that the item lacks; of equal ends the first.
    """
    place = np.arange(len(region) + 1)
    cost, origin = np.zeros(len(region) + 1, np.int64), place
    for word in item:
        lacking, beside = cost + 1, np.append(len(item) + 1, cost[:-1] + (region != word))
        lacks = lacking < beside
        lacks[0] = True
        cost = np.where(lacks, lacking, beside)
        origin = np.where(lacks, origin, np.append(0, origin[:-1]))
        # words that the item lacks: a place is reached from the last one whose cost is not beaten from the left
        ahead = np.minimum.accumulate(cost - place)
        source = np.maximum.accumulate(np.where(cost - place == ahead, place, 0))
        cost, origin = ahead + place, origin[source]
    end = int(cost.argmin())
    return int(origin[end]), end, int(cost[end])


def build_index(rows: list[tuple], percent: int = PERCENT) -> Index:
    vocabulary: dict[str, int] = {}
    ids, words = [], []
    for item_id, text in rows:
        found = _WORD.findall(lowered(text or ""))
        if found:
            ids.append(item_id)
            words.append(np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in found], np.int64))
    return Index(ids, words, vocabulary, percent)


def matches(docs: DataFrame, items: DataFrame, percent: int = PERCENT, id_column: str = "doc_id", item_column: str = "item_id") -> DataFrame:
    """(id, item, start, end, distance, item_words): passages that match an item, in code points.

    Words are runs of letters, digits and underscores in lower case, and single characters of
    scripts without spaces; distances are in words. Null and empty texts match nothing. Items of
    fewer than MIN_WORDS words match only without edits. Repeated
    rows give repeated matches. Documents are scanned in place, without a shuffle. Items are
    taken in passes of about PASS_WORDS words, each written before the next, so what a task
    and the driver hold does not grow with them.
    """
    listed = items.select(F.col(item_column).alias("item"), F.col("text").alias("text"))
    n_words = F.regexp_count("text", F.lit(f"(?U){_WORD.pattern}"))
    total = listed.agg(F.coalesce(F.sum(F.greatest(n_words, F.lit(0))), F.lit(0))).first()[0]
    passes = max(1, -(-total // PASS_WORDS))
    given = docs.select(F.col(id_column).alias("id"), F.col("text").alias("text"))
    id_type, item_type = given.schema["id"].dataType.simpleString(), listed.schema["item"].dataType.simpleString()
    schema = f"id {id_type}, item {item_type}, start bigint, end bigint, distance bigint, item_words bigint"
    item_kind = listed.select("item").limit(0).toArrow().schema.field("item").type
    out = None
    for k in range(passes):
        block = listed.where(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == k).orderBy("item", "text")
        index = build_index([(r["item"], r["text"]) for r in block.collect()], percent)

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches):
                bodies = [x or "" for x in batch.column("text").to_pylist()]
                found = index.find([index.encode(x) for x in bodies])
                spans = {t: [m.span() for m in _WORD.finditer(lowered(bodies[t]))] for t in {f[0] for f in found}}
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array([t for t, *_ in found], pa.int64())),
                        pa.array([index.ids[i] for _, i, *_ in found], item_kind),
                        pa.array([spans[t][a][0] for t, _, a, _, _ in found], pa.int64()),
                        pa.array([spans[t][b - 1][1] if b > a else spans[t][a][0] for t, _, a, b, _ in found], pa.int64()),
                        pa.array([d for *_, d in found], pa.int64()),
                        pa.array([len(index.words[i]) for _, i, *_ in found], pa.int64()),
                    ],
                    names=["id", "item", "start", "end", "distance", "item_words"],
                )

        part = stored(given.mapInArrow(run, schema), "matches")
        out = part if out is None else out.union(part)
    return out.withColumnsRenamed({"id": id_column, "item": item_column})


def drop_leaks(docs: DataFrame, items: DataFrame, percent: int = PERCENT, id_column: str = "doc_id") -> DataFrame:
    """The documents without any matching passage, with their own columns. Rows that share an id,
    or have none, are judged each by its own text."""
    judged = docs.select(F.struct(F.col(id_column).alias("id"), row_key(F.col("text")).alias("row")).alias("__judged"), "text")
    leaked = matches(judged, items, percent, "__judged").select("__judged.*").distinct().withColumnsRenamed({"id": "__id", "row": "__row"})
    same = F.col(id_column).eqNullSafe(F.col("__id")) & (row_key(F.col("text")) == F.col("__row"))
    return docs.join(leaked, same, "left_anti")


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
