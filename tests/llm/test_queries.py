"""Registered queries against their SQL, and those without SQL against plain code over whole small tables."""

import hashlib
import random
import re
import time
from collections import Counter
from fractions import Fraction

import duckdb
import pytest

import corpus_pipeline
from stellate.llm import lines, queries, secrets
from tests.support import final_plan

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    relation = con.sql(queries.oracle_sql()[name])
    df = queries.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in at) for r in relation.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == want


def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "source").collect()]


def plain_targets(of):
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(of, key=lambda s: (s is None, s or "")))}
    share, target = Fraction(3, 2) * sum(of.values()), {}
    while len(target) < len(of):
        open_ = [s for s in of if s not in target]
        left = share - sum(target.values())
        unit = left / sum(weight[s] for s in open_)
        parts = {s: weight[s] * unit for s in open_}
        above = [s for s in open_ if parts[s] > 2 * of[s]]
        target |= {s: Fraction(2 * of[s]) for s in above} if above else parts
    return target


def test_mix_meets_plain_targets(spark):
    rows = documents(spark)
    size = {i: len((t or "").encode().split()) for i, t, _ in rows}
    of = Counter()
    for i, _, source in rows:
        of[source] += size[i]
    target = plain_targets(of)
    found = queries.queries()["op1_mix"](spark, FOLDER).collect()
    source = {i: s for i, _, s in rows}
    assert len(found) == len(rows)
    assert all((r["size"], r["source_size"]) == (size[r["doc_id"]], of[source[r["doc_id"]]]) and r["taken"] <= 2 * r["size"] for r in found)
    assert all(abs(r["target"] - float(target[source[r["doc_id"]]])) < 1e-6 for r in found)
    for s in of:
        taken = sum(r["taken"] for r in found if source[r["doc_id"]] == s)
        assert abs(taken - target[s]) <= max(size[i] for i in size if source[i] == s)


def test_secrets_equal_plain_patterns(spark):
    def spans(text):
        assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
        out = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.A | re.I) if len(m[2]) >= 8]
        out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32])

    texts = {i: t or "" for i, t, _ in documents(spark)}
    found = queries.queries()["op5_secret_scans"](spark, FOLDER).collect()
    assert len(found) == len(texts)
    for r in found:
        base = spans(texts[r["doc_id"]])
        shown = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in base)
        assert [r[c] for c in ("n_assign", "n_access", "n_hex")] == [sum(k == n for _, k, _ in base) for n in range(3)]
        assert r["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest()
        whole = r["spans"].split(",") if r["spans"] else []
        assert [s for s in whole if s.split(":")[0] in ("assign", "access", "hex")] == (shown.split(",") if shown else [])


def test_endpoints_equal_one_pattern():
    plain = re.compile(
        r"""\b[A-Za-z][A-Za-z0-9+-]*://[^\s"'<>]+|\b(?:host|endpoint|server|database|url)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+\.[A-Za-z0-9.:/-]+""",
        re.ASCII | re.IGNORECASE,
    )
    r = random.Random(2)
    parts = ["http", "://", "-", "+", "_", "9", "a", ".", "b.c", "host", "url=", "url: ", " ", "\n", "'", "é", "://x", "server = a.b", "/"]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(16)))
        assert secrets.endpoints(text) == [m.span() for m in plain.finditer(text)], text


def test_long_unbroken_texts_are_scanned_in_time():
    text = "password=abcdefgh12 :// " + "a-" * 2_500_000
    start = time.perf_counter()
    assert [k for _, _, k in secrets.linked(text, secrets.candidates(text))] == ["assign"]
    assert time.perf_counter() - start < 20


def test_common_lines_are_split(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'a common line\\nown ' || id AS text").repartition(8)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.files.maxPartitionBytes": "64KB",
        "spark.sql.files.openCostInBytes": "1KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        assert "skew=true" in final_plan(lines.bitmaps(docs))
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_pipeline_stages_keep_the_columns_and_work_on_empty_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), FOLDER)
        assert empty.count() == 0
        assert set(docs.columns) <= set(empty.columns), name
    whole = corpus_pipeline.run(spark, FOLDER)
    rows = whole.collect()
    texts = {i: t for i, t, _ in documents(spark)}
    assert 0 < len(rows) == len({r["doc_id"] for r in rows}) < len(texts)
    # each kept text is its document's without some lines
    for r in rows:
        given = iter(texts[r["doc_id"]].split("\n"))
        assert all(line in given for line in r["text"].split("\n"))
        assert r["taken"] == r["repeats"] * len(r["text"].encode().split()) > 0
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), r["text"]).split() for r in rows]
    shingles = [frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in words]
    assert not any(5 * len(a & b) >= 4 * len(a | b) for k, a in enumerate(shingles) for b in shingles[:k] if a)
