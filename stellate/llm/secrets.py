"""Secret scans: strong findings, and weak parts that are reported where they complete each other."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.shared import text_slices

#: Kinds in the order that breaks ties: the strong ones, then the weak parts.
KINDS = ("assign", "access", "hex", "identifier", "key", "endpoint")
N_STRONG = 3
#: A part completes another one at most so many code points away, with no blank line between.
REACH = 200

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ASSIGN_HINT = re.compile(r"password|passwd|secret|token|api_?key", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_IDENTIFIER = re.compile(
    r"""\b(?:user(?:_?name)?|login|account|client_?id|access_?key(?:_?id)?|key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]{3,})""",
    re.ASCII | re.IGNORECASE,
)
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+-")
_SCHEME_START = re.compile(r"\b[A-Za-z]", re.ASCII)
_ADDRESS = re.compile(r"""[^\s"'<>]+""", re.ASCII)
_HOST = re.compile(
    r"""\b(?:host|endpoint|server|database|url)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+\.[A-Za-z0-9.:/-]+""",
    re.ASCII | re.IGNORECASE,
)
_BLANK = re.compile(r"\n[\x20\x09\x0B-\x0D]*\n")
#: What makes a weak part of each kind count: a part of one of these kinds within reach.
COMPLETED_BY = {
    "identifier": ("assign", "hex", "key"),
    "key": ("access", "identifier", "endpoint"),
    "endpoint": ("assign", "hex", "key"),
}


def endpoints(text: str) -> list[tuple[int, int]]:
    """Spans of `scheme://address` and `host = name`, leftmost and without overlap.

    Each `://` looks back for where its scheme begins, so a long run of letters and hyphens is
    walked once and not anew from each of its words.
    """
    out: list[tuple[int, int]] = []
    at, colon = 0, text.find("://")
    host = _HOST.search(text)
    while colon >= 0 or host:
        url = None
        while colon >= 0 and url is None:
            begin = colon
            while begin > at and text[begin - 1] in _SCHEME:
                begin -= 1
            start, address = _SCHEME_START.search(text, begin, colon), _ADDRESS.match(text, colon + 3)
            if start and address:
                url = start.start(), address.end()
            else:
                colon = text.find("://", colon + 1)
        span = url if url and not (host and host.start() < url[0]) else host and host.span()
        if span is None:
            break
        out.append(span)
        at = span[1]
        if 0 <= colon < at:
            colon = text.find("://", at)
        if host and host.start() < at:
            host = _HOST.search(text, at)
    return out


def _entropy(token: str) -> float:
    return -sum(n / len(token) * math.log2(n / len(token)) for n in Counter(token).values())


def _looks_random(token: str) -> bool:
    return (
        any(c.isdigit() for c in token)
        and any(c.isupper() for c in token)
        and any(c.islower() for c in token)
        and _entropy(token) >= 3.5
    )


def candidates(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of each kind in code points, ends exclusive; weak ones do not overlap strong ones."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    if _ASSIGN_HINT.search(text):
        found["assign"] = [m.span() for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found["access"] = [m.span() for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    runs = [m.span() for m in _RUN.finditer(text)]  # every hex finding lies in one
    found["hex"] = [m.span() for a, b in runs for m in _HEX.finditer(text, a, b)]
    keys = [(a, b) for a, b in runs if _looks_random(text[a:b])]
    if found["assign"] or found["hex"] or keys:  # no weak part counts without a secret
        found["key"] = keys
        found["identifier"] = [m.span() for m in _IDENTIFIER.finditer(text)]
        if "://" in text or "." in text:
            found["endpoint"] = endpoints(text)
        strong = np.array(sorted(s for kind in KINDS[:N_STRONG] for s in found[kind])).reshape(-1, 2)
        for kind in KINDS[N_STRONG:]:
            found[kind] = _clear_of(found[kind], strong)
    return found


def _clear_of(spans: list[tuple[int, int]], taken: np.ndarray) -> list[tuple[int, int]]:
    if not spans or not len(taken):
        return spans
    own = np.array(spans)
    reached = np.maximum.accumulate(taken[:, 1])  # strong spans of two kinds may overlap
    before = np.searchsorted(taken[:, 0], own[:, 1], side="left")
    clear = (before == 0) | (reached[np.maximum(before - 1, 0)] <= own[:, 0])
    return [s for s, ok in zip(spans, clear) if ok]


def linked(text: str, found: dict[str, list[tuple[int, int]]], reach: int = REACH) -> list[tuple[int, int, str]]:
    """Strong findings and the weak ones that a complementary part within reach completes.

    The interval join is two binary searches for each weak part over the sorted starts of its
    complements and the running maximum of their ends, so many parts in a text stay cheap.
    """
    out = [(a, KINDS.index(kind), b) for kind in KINDS[:N_STRONG] for a, b in found[kind]]
    if any(found[kind] for kind in KINDS[N_STRONG:]):
        breaks = np.array([m.start() for m in _BLANK.finditer(text)], np.int64)
        for kind, others in COMPLETED_BY.items():
            partners = np.array(sorted(s for other in others for s in found[other]), np.int64).reshape(-1, 2)
            if not found[kind] or not len(partners):
                continue
            own = np.array(found[kind], np.int64)
            scope = np.searchsorted(breaks, own[:, 0])
            edges = np.concatenate(([0], breaks, [len(text) + 1]))
            low = np.maximum(own[:, 0] - reach, edges[scope])
            high = np.minimum(own[:, 1] + reach, edges[scope + 1])
            ends = np.maximum.accumulate(partners[:, 1])
            last = np.searchsorted(partners[:, 0], high, side="left")
            near = (last > 0) & (ends[np.maximum(last - 1, 0)] > low)
            out += [(a, KINDS.index(kind), b) for (a, b), ok in zip(found[kind], near) if ok]
    return [(a, b, KINDS[k]) for a, k, b in sorted(out)]


def scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """For each row its id and `findings`: array of (kind, start, end) by start, then kind.

    A null or empty text has none. Equal ids give a row each. Texts are scanned whole, in
    slices, without a shuffle; other columns are not read.
    """
    given = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            rows = []
            for body in batch.column("text").to_pylist():
                spans = linked(body, candidates(body), reach) if body else []
                rows.append([{"kind": k, "start": a, "end": b} for a, b, k in spans])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, kind)], names=["id", "findings"])

    id_type = given.schema["id"].dataType.simpleString()
    found = given.mapInArrow(run, f"id {id_type}, findings array<struct<kind:string,start:bigint,end:bigint>>")
    return found.withColumnRenamed("id", id_column)


def op5_secrets(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def of(*kinds: str):
        return F.filter("findings", lambda s: s["kind"].isin(*kinds))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    counts = (F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in KINDS[:N_STRONG])
    base = F.sha2(listed(of(*KINDS[:N_STRONG])).cast("binary"), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), listed(F.col("findings")).alias("spans"))
