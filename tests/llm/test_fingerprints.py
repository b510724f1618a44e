"""Fingerprints against plain edits, plain sampling and the exact generalised Jaccard similarity."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stellate.llm import fingerprints as fp


def corpus():
    r = random.Random(5)
    words = ["".join(r.choice("aeiourst") for _ in range(r.randint(1, 6))) for _ in range(300)]
    texts = [None, "", " \t\n", "One", "one two", "é" * 7, "x" * 30_000, "A a\x0bA\ra b"]
    texts += [" ".join(r.choice(words) for _ in range(r.randint(3, 120))) for _ in range(40)]
    rows = list(enumerate(texts)) + [(60, texts[9]), (61, texts[9].upper())]
    # repeated rows, one id with two texts, null ids
    return rows + [(12, texts[12])] * 2 + [(12, "another text of this id"), (None, "null id one"), (None, "null id one"), (None, None)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 3) for r in rows], "doc_id long, text string, fingerprint string, n_chars int")


def following(rows, keys):
    """Rows in the contract's order, ties by the operator's own keys, and the next of each."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), keys[r]))
    return [(a, b) for a, b in zip(order, order[1:] + order[:1])]


def edit(text, head):
    n = len(text) // 3
    return text[: len(text) - n] + head[:n]


def weights(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return Counter(re.findall(r"[^\x20\x09-\x0D]+", text))


def test_edits_and_likeness(spark):
    rows = corpus()
    keyed = frame(spark, rows).select("doc_id", "text", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("k1")).collect()
    keys = {(r["doc_id"], r["text"]): r["k1"] for r in keyed}
    want = []
    for (i, text), (_, after) in following(rows, keys):
        text, after = text or "", after or ""
        want.append((i, len(text), hashlib.sha256(edit(text, after).encode()).hexdigest()))
    got = fp.fingerprints(frame(spark, rows).repartition(5)).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=repr) == sorted(want, key=repr)
    print_of = {r["edited_sha256"]: r["edited_fingerprint"] for r in got}
    assert len(print_of) == len({(r["edited_sha256"], r["edited_fingerprint"]) for r in got})

    def share(a, b):
        pairs = [(a[k : k + fp.DIGITS], b[k : k + fp.DIGITS]) for k in range(0, len(a), fp.DIGITS)]
        return float(a == b) if not a or not b else sum(x == y for x, y in pairs) / fp.SAMPLES

    assert all(r["near_edited"] == share(r["fingerprint"], r["edited_fingerprint"]) for r in got)
    ids = Counter(i for i, _ in rows)
    by_id = {r["doc_id"]: r for r in got if ids[r["doc_id"]] == 1}
    for (i, _), (j, _) in following(rows, keys):
        if i in by_id and j in by_id:
            assert by_id[i]["near_next"] == share(by_id[i]["fingerprint"], by_id[j]["fingerprint"])
    # equal texts, and texts with equal words, have equal fingerprints; texts without words are alike
    assert by_id[9]["fingerprint"] == by_id[60]["fingerprint"] == by_id[61]["fingerprint"]
    assert {by_id[k]["fingerprint"] for k in range(3)} == {""}
    assert by_id[2]["near_next"] == by_id[1]["near_next"] == 1.0 and by_id[3]["near_next"] == 0.0


def test_collision_rate_is_the_generalised_jaccard_similarity(spark):
    r = random.Random(1)
    weight = {k: ({w: r.randint(1, 9) for w in range(40) if r.random() < 0.6}, {w: r.randint(1, 9) for w in range(40) if r.random() < 0.6}) for k in range(60)}
    rows = [(k, w, a.get(w, 0), b.get(w)) for k, (a, b) in weight.items() for w in range(40)]
    n = 400
    terms = spark.createDataFrame(rows, "g int, w long, a int, b int").select("g", F.xxhash64("g", "w").alias("term"), "a", "b")
    found = fp.samples(terms, ["g"], {"a": "x", "b": "y"}, n).collect()
    assert len(found) == 60
    errors = []
    for row in found:
        a, b = weight[row["g"]]
        exact = sum(min(a.get(w, 0), b.get(w, 0)) for w in range(40)) / sum(max(a.get(w, 0), b.get(w, 0)) for w in range(40))
        errors.append(sum(x == y for x, y in zip(row["x"], row["y"], strict=True)) / n - exact)
        assert len(row["x"]) == n and abs(errors[-1]) < 4.5 * (exact * (1 - exact) / n) ** 0.5 + 1e-9
    assert abs(sum(errors) / len(errors)) < 4 * 0.5 / (n * 60) ** 0.5


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = {r["doc_id"]: r for r in fp.op13_fingerprints(spark, folder).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    errors = []
    for (i, text), (j, after) in zip(order, order[1:] + order[:1]):
        new = edit(text, after)
        assert found[i]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        for other, near in ((new, "near_edited"), (after, "near_next")):
            a, b = weights(text), weights(other)
            errors.append(found[i][near] - sum((a & b).values()) / max(1, sum((a | b).values())))
    assert abs(sum(errors)) / len(errors) < 0.02


@pytest.mark.parametrize("rows", [[], [(1, "only one row of words")], [(1, "same"), (1, "same")], [(None, None)]])
def test_small_tables(spark, rows):
    got = fp.fingerprints(frame(spark, rows)).collect()
    assert [(r["doc_id"], r["near_next"]) for r in got] == [(i, 1.0) for i, _ in rows]


def test_no_python_worker(spark):
    df = fp.fingerprints(frame(spark, corpus()[:5]))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" not in df._jdf.queryExecution().executedPlan().toString()
