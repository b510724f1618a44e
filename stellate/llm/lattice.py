"""LM scoring: the probability of a text as a sum over all segmentations into vocabulary pieces."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.shared import mix64, row_key, stored, text_slices, texts, word_lists

VOCABULARY = "piece_bpe_32k.model"
#: Most words of the largest counts that tasks get as a table: a fixed bound, whatever the corpus.
#: All other words meet their counts in a join, which therefore has no frequent key.
HEAD_WORDS = 1 << 17
#: Steps of the counts' histogram for each doubling.
STEPS = 16
#: Different words a task counts before it hands them on.
HELD_WORDS = 300_000
#: Taken from each word's count in favour of spelling.
DISCOUNT = 0.75
ROUNDS = 1
_BOUNDARY = "▁"
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Pieces:
    """Vocabulary pieces and their log probabilities; a piece is found by hashes of its prefixes.

    The first 256 pieces are the single bytes, so every word has a segmentation.
    """

    prefixes: np.ndarray  # sorted hashes of all prefixes of pieces
    piece: np.ndarray  # the piece that is this prefix, or -1
    logp: np.ndarray  # of each piece
    stop: float  # log probability that a word ends

    def arcs(self, words: list[bytes]) -> tuple[np.ndarray, ...]:
        """Arcs (step, from node, to node, piece) by step and from node, and each word's first node.

        A word of n bytes has n + 1 nodes; the step is the offset of an arc's first byte.
        """
        marked = [_BOUNDARY.encode() + w for w in words]
        size = np.fromiter(map(len, marked), np.int64, len(marked))
        data = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
        begin = np.cumsum(size) - size
        word = np.repeat(np.arange(len(words)), size)
        offset = np.arange(len(data)) - begin[word]
        left = size[word] - offset
        at, h = np.arange(len(data)), np.zeros(len(data), np.uint64)
        found = []
        for n in range(int(size.max(initial=0))):
            h = mix64(h * _STEP + data[at + n] + np.uint64(1))
            k = np.minimum(np.searchsorted(self.prefixes, h), len(self.prefixes) - 1)
            on = self.prefixes[k] == h
            at, h, k = at[on], h[on], k[on]
            whole = self.piece[k] >= 0
            found.append((at[whole], np.full(whole.sum(), n + 1), self.piece[k[whole]]))
            more = left[at] > n + 1
            at, h = at[more], h[more]
            if not len(at):
                break
        start, n, piece = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 3
        order = np.lexsort((n, start, offset[start]))
        start, n, piece = start[order], n[order], piece[order]
        nodes = start + word[start]
        return offset[start], nodes, nodes + n, piece, np.append(begin, len(data)) + np.arange(len(words) + 1)

    def forward(self, words: list[bytes]) -> tuple[np.ndarray, tuple, np.ndarray, np.ndarray]:
        """Natural log of each word's marginal probability, by a forward recursion over byte offsets."""
        step, source, target, piece, node = arcs = self.arcs(words)
        alpha = np.full(node[-1], -np.inf)
        alpha[node[:-1]] = 0.0
        cuts = np.searchsorted(step, np.arange(step.max(initial=-1) + 2))
        for a, b in zip(cuts, cuts[1:]):  # within a step, no two arcs of a word end at one node
            alpha[target[a:b]] = np.logaddexp(alpha[target[a:b]], alpha[source[a:b]] + self.logp[piece[a:b]])
        return alpha[node[1:] - 1] + self.stop, arcs, alpha, cuts

    def expected(self, words: list[bytes]) -> np.ndarray:
        """How often each piece occurs in the words, in expectation over their segmentations."""
        total, (step, source, target, piece, node), alpha, cuts = self.forward(words)
        beta = np.full(len(alpha), -np.inf)
        beta[node[1:] - 1] = 0.0
        for a, b in zip(cuts[-2::-1], cuts[:0:-1]):
            if b > a:
                first = np.flatnonzero(np.diff(source[a:b], prepend=-1))
                beta[source[a:b][first]] = np.logaddexp.reduceat(beta[target[a:b]] + self.logp[piece[a:b]], first)
        owner = np.searchsorted(node, source, side="right") - 1
        weight = np.exp(alpha[source] + self.logp[piece] + beta[target] + self.stop - total[owner])
        return np.bincount(piece, weight, len(self.logp))

    def learned(self, occurrences: np.ndarray, n_words: float) -> Pieces:
        """The pieces with probabilities from expected occurrences; none gets zero."""
        mass = occurrences + 0.01
        all_mass = mass.sum() + max(n_words, 1.0)
        return replace(self, logp=np.log(mass / all_mass), stop=math.log(max(n_words, 1.0) / all_mass))


def load_pieces(file: str) -> Pieces:
    """Pieces of a vocabulary file. The file's scores fall with the merge rank r; as
    probabilities they are taken to fall like 1 / (r + 3), as word frequencies do."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=file)
    scores: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
            scores[model.id_to_piece(i).encode()] = model.get_score(i)
    table = {bytes([b]): b for b in range(256)}
    for piece in sorted(scores, key=lambda p: (-scores[p], p)):
        table.setdefault(piece, len(table))
    least = min(scores.values(), default=0.0) - 1
    logp = -np.log(np.array([max(-scores.get(p, least), 0.0) + 3 for p in table]))
    logp -= np.logaddexp.reduce(np.append(logp, logp.max()))
    known: dict[int, int] = {}
    for p, k in table.items():
        h = np.zeros(1, np.uint64)
        for n, byte in enumerate(p):
            h = mix64(h * _STEP + np.uint64(byte + 1))
            known[int(h[0])] = k if n + 1 == len(p) else known.get(int(h[0]), -1)
    prefixes = np.array(sorted(known), np.uint64)
    return Pieces(prefixes, np.array([known[int(h)] for h in prefixes], np.int64), logp, float(logp.max()))


@dataclass
class WordModel:
    """A word is copied from the training words or spelled from pieces; both routes add up."""

    pieces: Pieces
    tokens: int  # of the training texts, ends included
    types: int  # different ones, the end included
    ends: int

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.types + 1)))

    def score(self, words: list[bytes], count: np.ndarray) -> np.ndarray:
        """log10 of each word's probability; spelled mass is what discounting the counts frees."""
        spelled = self.pieces.forward(words)[0] if words else np.zeros(0)
        spelled = spelled + math.log(max(DISCOUNT * (self.types - 1), 0.5) / max(self.tokens, 1))
        with np.errstate(divide="ignore"):
            copied = np.log(np.maximum(count - DISCOUNT, 0) / max(self.tokens, 1))
        return np.logaddexp(spelled, copied) / math.log(10)

    def end(self) -> tuple[float, float]:
        """base, score of the end token; an unseen end has the mass of half a token."""
        return float(self.base(np.array([self.ends]))[0]), math.log10(max(self.ends, 0.5) / max(self.tokens, 1))


def _batches(batch: pa.RecordBatch, column: str, n: int = 20_000) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for a in range(0, batch.num_rows, n):
        part = batch.slice(a, n)
        yield part, part.column(column).cast(pa.binary()).to_pylist()


def word_counts(docs: DataFrame, train: str, text: str) -> DataFrame:
    """All words with their count in training rows (0 for words only of other rows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            words = pa.array(list(held), pa.binary()).cast(pa.string())
            columns = [words, pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in text_slices(batches):
            for raw, counted in zip(texts(batch), batch.column("train").to_pylist()):
                for words in word_lists(raw.lower()):
                    if counted:
                        held.update(words)
                    else:
                        held.update(dict.fromkeys((w for w in set(words) if w not in held), 0))
            if len(held) > HELD_WORDS:
                yield out()
        yield out()

    given = docs.select(F.col(train).alias("train"), F.col(text).alias("text"))
    return given.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("count"))


def fit(counts: DataFrame, ends: int, pieces: Pieces, rounds: int = ROUNDS) -> WordModel:
    """Learn piece probabilities from the different training words, each counted once.

    Expectations are added up by piece (a row for each vocabulary entry, whatever the corpus).
    """
    tokens, types = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count(F.when(F.col("count") > 0, 1))).first()
    for _ in range(rounds):
        seen = counts.where(F.col("count") > 0).select("word")

        def run(batches: Iterator[pa.RecordBatch], current: Pieces = pieces) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(current.logp))
            for batch in batches:
                for _, words in _batches(batch, "word"):
                    total += current.expected(words)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["piece", "mass"])

        rows = seen.mapInArrow(run, "piece bigint, mass double").groupBy("piece").agg(F.sum("mass").alias("mass")).collect()
        occurrences = np.zeros(len(pieces.logp))
        for row in rows:
            occurrences[row["piece"]] = row["mass"]
        pieces = pieces.learned(occurrences, types)
    return WordModel(pieces, tokens + ends, types + (ends > 0), ends)


def frequent(counts: DataFrame, most: int = HEAD_WORDS) -> DataFrame:
    """The words above a count: the least one, of a histogram of a few hundred rows, that at most `most` words reach.

    No sort of all words. What stays below is shared by so many words that none of them is hot.
    """
    step = F.floor(F.log2("count") * STEPS).cast("int")
    held, least = 0, None
    for row in counts.where("count > 0").groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        held += row["count"]
        if held > most:
            break
        least = row["step"]
    return counts.where((F.col("count") > 0) & (step >= least) if least is not None else F.lit(False))


def scores(docs: DataFrame, file: str, train: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: id, train, n_tokens, n_known, train_tokens, base_score and score (log10).

    Learns from rows whose `train` is true (null is false). A null or empty text is one end
    token. Every row gives a row, repeated ones too. Without training rows all words are
    unknown and scores are spelled ones.

    Two scans and no shuffle of texts: words are counted in tasks and added up; then the most
    frequent words are looked up in a table of fixed size and only the rest, one row for each
    document and different word, joins the counts.
    """
    given = docs.select(
        F.col(id_column).alias("id"), row_key(F.col(text)).alias("row"),
        F.coalesce(F.col(train), F.lit(False)).alias("train"), F.col(text).alias("text"),
    )
    ends = given.where("train").count()
    counts = stored(word_counts(given, "train", "text"), "counts")
    model = fit(counts, ends, load_pieces(file))
    head = frequent(counts).toArrow()
    head_words, head_counts = head.column("word").cast(pa.binary()).to_pylist(), np.asarray(head.column("count"), np.int64)
    # entry 0 stands for all words that are not in the table
    head_base = np.append(0.0, model.base(head_counts))
    head_score = np.append(0.0, model.score(head_words, head_counts))
    head_known = np.append(0, head_counts > 0).astype(np.int64)
    end_base, end_score = model.end()

    def head_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: k for k, w in enumerate(head_words, start=1)}
        for batch in text_slices(batches):
            rows: list[int] = []
            rest: list[bytes] = []
            times: list[int] = []
            sums = []
            for at, raw in enumerate(texts(batch)):
                n, known, base, score = 1, int(ends > 0), end_base, end_score
                rare: Counter[bytes] = Counter()
                for words in word_lists(raw.lower()):
                    k = np.fromiter((place.get(w, 0) for w in words), np.int64, len(words))
                    n += len(words)
                    known += int(head_known[k].sum())
                    base += float(head_base[k].sum())
                    score += float(head_score[k].sum())
                    rare.update(words[i] for i in np.flatnonzero(k == 0))
                sums.append((n, known, base, score))
                # a key that no word has, as it has a space, and that spreads the documents
                rows += [at] * (1 + len(rare))
                rest += [b"%d " % hash((at, n)), *rare]
                times += [0, *rare.values()]
            rows_at = pa.array(rows, pa.int64())
            is_head = np.array(times, np.int64) == 0
            own = {name: batch.column(name).take(rows_at) for name in ("id", "row", "train")}
            totals = {
                name: pa.array([x if h else None for x, h in zip(np.array([s[k] for s in sums])[rows].tolist(), is_head)], kind)
                for k, (name, kind) in enumerate((("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())))
            }
            columns = own | {"word": pa.array(rest, pa.binary()).cast(pa.string()), "times": pa.array(times, pa.int64())} | totals
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    id_type = given.schema["id"].dataType.simpleString()
    parts = given.mapInArrow(
        head_part, f"id {id_type}, row bigint, train boolean, word string, times bigint, n_tokens bigint, n_known bigint, base_score double, score double"
    )

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words in _batches(batch, "word"):
                count = np.asarray(part.column("count"), np.int64)
                columns = [part.column("word"), part.column("count"), pa.array(model.base(count)), pa.array(model.score(words, count))]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "count", "word_base", "word_score"])

    by_word = counts.mapInArrow(scored, "word string, count bigint, word_base double, word_score double")
    joined = parts.join(by_word, "word", "left")
    times = F.col("times")
    summed = joined.groupBy("id", "row", "train").agg(
        F.count("n_tokens").alias("copies"),
        F.sum("n_tokens").alias("n_tokens"),
        (F.sum("n_known") + F.sum(F.when(F.col("count") > 0, times).otherwise(0))).alias("n_known"),
        (F.sum("base_score") + F.sum(F.coalesce(times * F.col("word_base"), F.lit(0.0)))).alias("base_score"),
        (F.sum("score") + F.sum(F.coalesce(times * F.col("word_score"), F.lit(0.0)))).alias("score"),
    )
    # rows that repeat id and text were added up: give each its share
    each = summed.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    share = {c: (F.col(c) / F.col("copies")).cast("bigint") for c in ("n_tokens", "n_known")}
    share |= {c: F.col(c) / F.col("copies") for c in ("base_score", "score")}
    return each.select(
        F.col("id").alias(id_column), "train", share["n_tokens"].alias("n_tokens"), share["n_known"].alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"), share["base_score"].alias("base_score"), share["score"].alias("score"),
    )


def held_out(id_column: str = "doc_id"):
    """Whether the id as text has a CRC-32 with remainder 1 by 5; a null id is an empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 5 == 1


def op2_lm_scoring(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", (~held_out()).alias("train"))
    scored = scores(docs, public_tokenizers.path(VOCABULARY), "train")
    columns = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), *columns)
