"""Phrases against plain counting of all of them."""

import random
import re
from collections import Counter, defaultdict

import pytest

from stellate.llm import phrases


def expected(rows, min_count, top):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    f[lang, tuple(words[i : i + n])] += 1
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= min_count}
    inside = defaultdict(int)
    for (lang, p), a in candidates.items():
        for i in range(len(p)):
            for j in range(i + 1, len(p) + 1):
                if j - i < len(p):
                    inside[lang, p[i:j]] = max(inside[lang, p[i:j]], a)
    found = defaultdict(list)
    for (lang, p), a in candidates.items():
        if 100 * inside[lang, p] >= 80 * a:
            continue
        score, _, left, right = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        found[lang].append((-score, -a, " ".join(p).encode(), left, right))
    out = []
    for lang, rows_ in found.items():
        for rank, (score, a, p, left, right) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def corpus():
    r = random.Random(11)
    words = ["of", "The", "the", "é", "a\x01b", "a", "x-y", "zz\x00", "New", "york", "city", "q"]
    fixed = ["new york city hall", "of the", "A b\tc  d"]
    rows = []
    for k in range(150):
        text = ""
        for _ in range(r.randrange(30)):
            text += (r.choice(fixed) if r.random() < 0.3 else r.choice(words)) + r.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\x0b"])
        rows.append((r.choice(["en", "en", "de", None]), text))
    # one first word with many phrases, a long text, nulls, empty texts and repeated rows
    rows += [("en", " ".join(f"the w{k % 97}" for k in range(3000))), ("und", "a b a b a b a b"), ("en", None), (None, ""), ("fr", " \n.. ,"), rows[0], rows[0]]
    return rows


def check(spark, rows, min_count, top=phrases.TOP, deal=1):
    docs = spark.createDataFrame([(*row, 1, "clash") for row in rows], "lang string, text string, n int, phrase string").repartition(deal)
    got = sorted(tuple(r) for r in phrases.collocations(docs, min_count, top).collect())
    assert got == expected(rows, min_count, top)
    return got


@pytest.mark.parametrize("size", [40, phrases.BATCH_BYTES])
def test_phrases_equal_plain_counts(spark, monkeypatch, size):
    monkeypatch.setattr(phrases, "BATCH_BYTES", size)
    assert check(spark, corpus(), 5, deal=3)


def test_ranks_and_ties(spark):
    assert len(check(spark, corpus(), 2, top=7)) == 7 * 3


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "FILTER_BITS", 64)
    assert check(spark, corpus(), 5)


def test_many_partitions_share_one_beginning(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        rows = [("en", f"the big w{k} end. the big. big w{k}") for k in range(300)] * 3
        assert check(spark, rows, 3, top=5000)
    finally:
        spark.conf.unset("spark.sql.shuffle.partitions")


def test_long_texts_are_cut_between_words():
    text = b"a b c d e, f g h  i\tj k" * 50
    for size in (1, 7, 30):
        parts = []
        phrases_size, phrases.BATCH_BYTES = phrases.BATCH_BYTES, size
        try:
            parts = list(phrases.segments(text))
        finally:
            phrases.BATCH_BYTES = phrases_size
        assert b"".join(data[:own] for data, own in parts) == text
    words = phrases.Words([("en", text, len(text))])
    assert len(words.ids) == sum(len(p.split()) for p in re.split(b",", text))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(docs).collect() == []
