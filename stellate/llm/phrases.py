"""Phrase collocations: count streams in prefix and suffix order, each walked in lockstep with its own parts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stellate.llm.shared import mix64, partitions, stored, word_hashes

#: Words of the longest phrase, and occurrences of a candidate.
LONGEST, MIN_COUNT = 4, 30
TOP = 2000
#: Text that a task counts at once, in bytes.
BATCH_BYTES = 2 << 20
#: Bits of the filter of frequent pairs that each task holds: 8 MB, however large the corpus.
FILTER_BITS = 1 << 26
#: Bits by which pairs are told apart when they are first counted: fewer to shuffle, or fewer that pass in vain.
HASH_BITS = 40

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# 0 inside a word, 1 between words, 2 between pieces
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_BORDER = re.compile(rb"[.,;:!?\x0A-\x0D\x20\x09]")
_AHEAD = re.compile(rb"(?:[\x20\x09]+[^.,;:!?\x0A-\x0D\x20\x09]+){0,%d}" % (LONGEST - 1))


def segments(raw: bytes) -> Iterator[tuple[bytes, int]]:
    """A text in parts of about BATCH_BYTES, cut between words: each with the words behind it that its
    last phrases reach into, and its own length without them."""
    at = 0
    while len(raw) - at > BATCH_BYTES and (border := _BORDER.search(raw, at + BATCH_BYTES)):
        yield raw[at : _AHEAD.match(raw, border.start()).end()], border.start() - at
        at = border.start()
    yield raw[at:], len(raw) - at


class Words:
    """The words of some segments: ids into a vocabulary, languages, and which begin in a segment's own part."""

    def __init__(self, parts: list[tuple[str, bytes, int]]):
        langs, texts, own = zip(*parts)
        data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
        kind = _CLASS[data]
        inside = kind == 0
        edge = np.diff(inside.astype(np.int8), prepend=0)
        at, to = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        offsets = np.concatenate(([0], np.cumsum(to - at)))
        words = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[inside]))
        coded = words.dictionary_encode()
        self.vocabulary = coded.dictionary
        self.ids = np.asarray(coded.indices).astype(np.int64)
        begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        segment = np.searchsorted(begins, at, "right") - 1
        self.own = at - begins[segment] < np.array(own)[segment]
        self.langs, lang = np.unique(np.array(langs, dtype=object), return_inverse=True)
        self.lang = lang[segment]
        piece = np.cumsum(kind == 2, dtype=np.int64)[at]
        # whether the next word is of the same piece
        self.joined = np.append(piece[:-1] == piece[1:], False)[: len(at)]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Different pairs as numbers, and for each pair of neighbours, by `joined`, which one it is."""
        first = np.flatnonzero(self.joined)
        size = max(1, len(self.vocabulary))
        return np.unique((self.lang[first] * size + self.ids[first]) * size + self.ids[first + 1], return_inverse=True)

    def parts(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language, first and second word of pairs."""
        size = max(1, len(self.vocabulary))
        return pairs // size // size, pairs // size % size, pairs % size

    def hashes(self, pairs: np.ndarray) -> np.ndarray:
        """HASH_BITS of each pair of words in its language."""
        # a vocabulary word holds no white space, so each is one word here
        word = word_hashes([b" ".join(self.vocabulary.cast(pa.large_binary()).to_pylist())])[0]
        lang = np.array([word_hashes([f"l{x.encode().hex()}".encode()])[0][0] for x in self.langs], np.uint64)
        own, first, second = self.parts(pairs)
        with np.errstate(over="ignore"):
            mixed = mix64(word[first] * np.uint64(3) + mix64(word[second] + lang[own]))
        return mixed >> np.uint64(64 - HASH_BITS)


def batched(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    parts, held = [], 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary())):
            for data, own in segments(text.as_py() or b""):
                if data:
                    parts.append((lang, data, own))
                    held += len(data)
                if held >= BATCH_BYTES:
                    yield Words(parts)
                    parts, held = [], 0
    if parts:
        yield Words(parts)


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for words in batched(batches):
        pairs, which = words.pairs()
        n = np.bincount(which, weights=words.own[words.joined], minlength=len(pairs)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(words.hashes(pairs).astype(np.int64)), pa.array(n)], ["h", "n"])


def _phrase_counts(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, f): all words, longer phrases if the filter has all their pairs, and with a null phrase each language's words."""
    for words in batched(batches):
        size, own = max(1, len(words.vocabulary)), words.own
        pairs, which = words.pairs()
        h = words.hashes(pairs)
        there = (bits[(h >> np.uint64(6)) & np.uint64(len(bits) - 1)] >> (h & np.uint64(63)) & np.uint64(1)).astype(bool)
        pair = np.full(len(words.ids), -1)
        pair[words.joined] = np.where(there[which], which, -1)
        linked = np.append(pair >= 0, [False] * LONGEST)
        lang, first, second = words.parts(pairs)
        n = len(words.ids)

        def rows(codes: np.ndarray, split) -> pa.RecordBatch:
            different, counts = np.unique(codes, return_counts=True)
            of, *ids = split(different)
            taken = [words.vocabulary.take(pa.array(x)) for x in ids]
            phrase = pc.binary_join_element_wise(*taken, pa.scalar(" ", pa.large_string()))
            langs = pa.array(words.langs[of], pa.string())
            return pa.RecordBatch.from_arrays([langs, phrase.cast(pa.string()), pa.array(counts)], ["lang", "phrase", "f"])

        yield rows((words.lang * size + words.ids)[own], lambda c: (c // size, c % size))
        yield rows(pair[own & (pair >= 0)], lambda c: (lang[c], first[c], second[c]))
        at = np.flatnonzero(own & linked[:n] & linked[1 : n + 1])
        yield rows(pair[at] * size + words.ids[at + 2], lambda c: (lang[c // size], first[c // size], second[c // size], c % size))
        at = np.flatnonzero(own & linked[:n] & linked[1 : n + 1] & linked[2 : n + 2])
        many = max(1, len(pairs))
        yield rows(
            pair[at] * many + pair[at + 2],
            lambda c: (lang[c // many], first[c // many], second[c // many], first[c % many], second[c % many]),
        )
        total = np.bincount(words.lang[own], minlength=len(words.langs))
        langs = pa.array(words.langs, pa.string())
        yield pa.RecordBatch.from_arrays([langs, pa.nulls(len(total), pa.string()), pa.array(total)], ["lang", "phrase", "f"])


def counted(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, phrase, f) of phrases of up to LONGEST words found `min_count` times; a null phrase has all words of its language.

    Two scans. The first counts pairs of words by a hash, to learn which may be frequent: their bits,
    FILTER_BITS at most, are the one thing that passes through the driver. The second counts all words, and
    longer phrases where the filter has all their pairs; no frequent phrase has another pair. The filter
    only saves work: where it fills up, more is counted and dropped, so results are exact at any size.
    """
    spark = docs.sparkSession
    given = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    hashes = given.mapInArrow(_pair_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    words = FILTER_BITS // 64
    place = F.pmod(F.shiftright("h", 6), F.lit(words)).alias("place")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("h").bitwiseAND(F.lit(63)).cast("int"))
    found = hashes.groupBy(place).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(words, np.int64)
    bits[found.column("place").to_numpy()] = found.column("bits").to_numpy()
    shared = spark.sparkContext.broadcast(bits.view(np.uint64))
    counts = given.mapInArrow(lambda b: _phrase_counts(b, shared.value), "lang string, phrase string, f long")
    totals = counts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return totals.where((F.col("f") >= min_count) | F.col("phrase").isNull())


_STREAM = "lang string, path array<string>, f long, other array<long>, ext long, sums array<long>, edge boolean"


def _lockstep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with the counts of their proper beginnings (`sums`, null where they lie in an earlier
    partition) and in `ext` the greatest count of a row that is one word longer; for each such beginning an `edge` row."""
    stack: list[list] = []  # the beginnings of the row at hand: path, f, other, ext
    now = None
    out: list[dict] = []

    def pop(depth: int) -> None:
        while len(stack) > depth:
            path, f, other, ext = stack.pop()
            out.append({"lang": now, "path": path, "f": f, "other": other, "ext": ext, "sums": [x[1] for x in stack], "edge": f is None})

    for batch in batches:
        for lang, path, f, other, ext in zip(*(batch.column(c).to_pylist() for c in ("lang", "path", "f", "other", "ext"))):
            same = 0
            if lang == now:
                while same < len(stack) and same < len(path) and stack[same][0][-1] == path[same]:
                    same += 1
            pop(same)
            now = lang
            while len(stack) < len(path) - 1:
                stack.append([path[: len(stack) + 1], None, None, 0])
            if stack:
                stack[-1][3] = max(stack[-1][3], f)
            stack.append([path, f, other, ext])
        yield pa.RecordBatch.from_pylist(out, _stream_schema())
        out = []
    pop(0)
    yield pa.RecordBatch.from_pylist(out, _stream_schema())


def _stream_schema() -> pa.Schema:
    many = pa.list_(pa.int64())
    return pa.schema([("lang", pa.string()), ("path", pa.list_(pa.string())), ("f", pa.int64()), ("other", many), ("ext", pa.int64()), ("sums", many), ("edge", pa.bool_())])


def lockstep(rows: DataFrame) -> DataFrame:
    """Rows (lang, path, f, other, ext) with the counts of all proper beginnings of their path as `sums`, and `ext` raised to
    the greatest count of a path one word longer.

    The rows are range-partitioned by language and path and sorted, so that each follows its beginnings, and a walk
    that holds one path reads all counts off without hashing. A common first word may fill many
    partitions. A partition lacks the counts of at most LONGEST - 1 paths, the beginnings of its first row, whose own rows
    lie ahead; these few, bounded by the number of partitions, are joined by broadcasts.
    """
    n = partitions(rows.sparkSession)
    dealt = rows.repartitionByRange(n, "lang", "path").sortWithinPartitions("lang", "path")
    walked = stored(dealt.mapInArrow(_lockstep, _STREAM), "phrases")
    edges = walked.where("edge").groupBy("lang", "path").agg(F.max("ext").alias("late"))
    own = walked.where("NOT edge")
    known = own.join(F.broadcast(edges), ["lang", "path"]).select("lang", "path", F.col("f").alias("known"), "late")
    full = own
    for k in range(1, LONGEST):
        begun = known.where(F.size("path") == k).select(F.col("lang").alias("e_lang"), F.col("path").alias("e_path"), F.col("known").alias(f"f{k}"))
        begins = F.when((F.size("path") > k) & F.get("sums", F.lit(k - 1)).isNull(), F.slice("path", 1, k))
        full = full.join(F.broadcast(begun), (F.col("lang") == F.col("e_lang")) & (begins == F.col("e_path")), "left").drop("e_lang", "e_path")
    late = known.select(F.col("lang").alias("e_lang"), F.col("path").alias("e_path"), "late")
    full = full.join(F.broadcast(late), (F.col("lang") == F.col("e_lang")) & (F.col("path") == F.col("e_path")), "left")
    filled = F.array(*(F.col(f"f{k}") for k in range(1, LONGEST)))
    sums = F.transform("sums", lambda s, i: F.coalesce(s, F.get(filled, i)))
    return full.select("lang", "path", "f", "other", F.greatest("ext", F.coalesce("late", F.lit(0))).alias("ext"), sums.alias("sums"))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """Each language's first `top` phrases of 2 to LONGEST words: lang, rank, phrase, a, l, r, n, score.

    Null texts are empty, a null lang is `und`; rows count as often as they are repeated; an empty
    table, or one without frequent phrases, gives no rows. Other columns are left out. a is the phrase's count, l and r those
    of its two parts at the cut with the lowest floor(2000000 * a / (l + r)), the first of such; n has all words of the language. A phrase that makes up
    80 % of a shorter one's occurrences drops it; it is enough to look one word further, as that
    phrase occurs no less often. Ranks go by score, a and phrase. Products are decimals of 38 digits.
    """
    counts = stored(counted(docs, min_count), "counts")
    none = F.array().cast("array<long>")
    rows = counts.where("phrase IS NOT NULL").select("lang", F.split("phrase", " ").alias("path"), "f", none.alias("other"), F.lit(0).cast("bigint").alias("ext"))
    by_prefix = lockstep(rows)
    by_suffix = lockstep(by_prefix.select("lang", F.reverse("path").alias("path"), "f", F.col("sums").alias("other"), "ext"))
    cuts = F.transform(
        F.sequence(F.lit(1), F.size("path") - 1),
        lambda k: F.struct(k.alias("k"), F.get("other", k - 1).alias("l"), F.get("sums", F.size("path") - k - 1).alias("r")),
    )
    long = by_suffix.where((F.size("path") > 1) & (F.col("ext").cast("decimal(20,0)") * 5 < F.col("f").cast("decimal(20,0)") * 4))
    scored = long.select("lang", F.array_join(F.reverse("path"), " ").alias("phrase"), F.col("f").alias("a"), cuts.alias("cuts"))
    score = "transform(cuts, c -> struct((cast(a AS decimal(20,0)) * 2000000) div (cast(c.l AS decimal(20,0)) + cast(c.r AS decimal(20,0))) AS score, c.k, c.l, c.r))"
    best = scored.select("lang", "phrase", "a", F.array_min(F.expr(score)).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # a language's phrases are first ranked in buckets, so no task ranks them all
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(partitions(docs.sparkSession)))
    best = best.withColumn("bucket", bucket)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    words = counts.where("phrase IS NULL").select("lang", F.col("f").alias("n"))
    return best.join(words, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (
  SELECT lang, n, array_to_string(w[i:i + n - 1], ' ') AS phrase, w[i:i + n - 1] AS words
  FROM split, unnest([1, 2, 3, 4]) AS s(n), unnest(range(1, len(w) - n + 2)) AS u(i)),
counts AS (SELECT lang, n, phrase, any_value(words) AS words, count(*) AS f FROM grams GROUP BY lang, n, phrase HAVING count(*) >= 30),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
cuts AS (
  SELECT c.lang, c.n AS width, c.phrase, c.f AS a, k, p.f AS l, s.f AS r, (2000000::HUGEINT * c.f) // (p.f + s.f) AS score
  FROM counts c, unnest(range(1, c.n)) AS u(k)
  JOIN counts p ON p.lang = c.lang AND p.phrase = array_to_string(c.words[1:k], ' ')
  JOIN counts s ON s.lang = c.lang AND s.phrase = array_to_string(c.words[k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, inner_phrase AS phrase, max(f) AS f FROM (
    SELECT lang, f, array_to_string(words[i:j], ' ') AS inner_phrase
    FROM counts, unnest(range(1, n + 1)) AS u(i), unnest(range(i, n + 1)) AS v(j) WHERE j - i + 1 < n)
  GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN longer x ON x.lang = b.lang AND x.phrase = b.phrase WHERE x.f IS NULL OR 100::HUGEINT * x.f < 80::HUGEINT * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score::BIGINT AS score FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""
