"""Quality rules as a ledger of failure bits: each rule is evaluated once, policies come after."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.shared import SPACES

WINDOW = 8
SYMBOLS = "#*$%&|<>"

#: Name to failure test over the measurements; the place in this table is the rule's bit, so
#: new rules go to the end and a written ledger keeps its meaning. Integer tests only: a double
#: may differ between engines by a rounding.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "repeated_lines": "10 * n_dup_lines > 6 * n_lines",
    "shouting": "10 * n_bangs > 3 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
}
#: A policy rejects a document that fails one of its rules. Policies are versions: change by adding.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": tuple(RULES),
}
DEFAULT_POLICY = "v1"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_bangs")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns and one struct `measures`; nothing is shuffled.

    A null text counts as empty: no words, no lines with words. Windows of 8 words are told
    apart by 64-bit hashes within one text. Only texts that repeat a window pay for the sort
    that finds which words the repeats cover.
    """
    words = F.filter(F.split("__text", SPACES), lambda w: w != "")
    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    stages = [
        {"__text": F.coalesce(F.col("__given").cast("string"), F.lit(""))},
        {"__1": F.transform(words, lambda w: F.xxhash64(w)), "__lines": lines},
        {"__2": _joined("__1", 1)},
        {"__4": _joined("__2", 2)},
        # few texts repeat four words, and only those need their windows of eight
        {"__8": F.when(_repeats("__4"), _joined("__4", 4))},
        {"__sorted": F.when(_repeats("__8"), F.array_sort(F.transform("__8", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))},
        {"__at": F.array_sort(F.transform(F.filter("__sorted", _has_twin), lambda s: s["i"]))},
    ]
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row")
    df = reduce(lambda d, new: d.withColumns(new), stages, docs.select(row, F.col(text).alias("__given")))
    covered = F.aggregate(F.transform("__at", _fresh_words), F.lit(0).cast("bigint"), lambda a, b: a + b)
    measures = F.struct(
        F.size("__1").cast("bigint").alias("n_words"),
        F.length(_without(" \t\n\x0b\x0c\r")).cast("bigint").alias("word_chars"),
        _count_of(SYMBOLS).alias("n_symbols"),
        F.size("__lines").cast("bigint").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
        _count_of("!").alias("n_bangs"),
    )
    return df.select("__row.*", measures.alias("measures"))


def _without(characters: str) -> Column:
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), characters, F.col("__text"))


def _count_of(characters: str) -> Column:
    """How many of some ASCII characters the text has."""
    return (F.octet_length("__text") - F.octet_length(_without(characters))).cast("bigint")


def _joined(windows: str, width: int) -> Column:
    """Hashes of windows twice as wide, from those that begin `width` words apart."""
    firsts = F.slice(windows, F.lit(1), F.greatest(F.size(windows) - width, F.lit(0)))
    return F.transform(firsts, lambda h, i: F.xxhash64(h, F.get(windows, i + width)))


def _repeats(windows: str) -> Column:
    return F.size(F.array_distinct(windows)) < F.size(windows)


def _has_twin(s: Column, k: Column) -> Column:
    """A neighbour in the sorted (hash, place) pairs has the same hash."""
    after, before = F.get("__sorted", k + 1)["h"], F.get("__sorted", k - 1)["h"]
    return F.coalesce(after == s["h"], F.lit(False)) | F.coalesce(before == s["h"], F.lit(False))


def _fresh_words(place: Column, k: Column) -> Column:
    """Words of a repeated window that the next repeated window does not hold."""
    return F.least(F.lit(WINDOW), F.coalesce(F.get("__at", k + 1) - place, F.lit(WINDOW))).cast("bigint")


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns, `measures` and `failures`: bit k is set if rule k of RULES fails.

    Clashing input columns named `measures` or `failures` are replaced. Never null.
    """
    kept = docs.drop("measures", "failures")
    df = measured(kept, text)
    bits = [F.when(_over_measures(test), F.lit(1 << bit)).otherwise(F.lit(0)) for bit, test in enumerate(RULES.values())]
    return df.withColumn("failures", reduce(lambda a, b: a.bitwiseOR(b), bits).cast("bigint"))


def _over_measures(test: str) -> Column:
    return F.expr(" ".join(f"measures.{t}" if t in MEASURES else t for t in test.split()))


def mask(policy: str) -> int:
    return sum(1 << bit for bit, rule in enumerate(RULES) if rule in POLICIES[policy])


def passes(policy: str = DEFAULT_POLICY, failures: str = "failures") -> Column:
    """Whether a row of a ledger passes a policy; no text is read again."""
    return F.col(failures).bitwiseAND(F.lit(mask(policy))) == 0


def ablations(rows: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """For each rule of a policy: documents that fail it, and those that only it rejects.

    Counts by failure pattern first (at most 2^rules rows), so one small shuffle. An empty
    ledger gives a row of zeros per rule.
    """
    patterns = rows.groupBy(F.col("failures").bitwiseAND(F.lit(mask(policy))).alias("failed")).count()
    bits = [(bit, rule) for bit, rule in enumerate(RULES) if rule in POLICIES[policy]]
    sums = [
        c
        for bit, rule in bits
        for c in (
            F.coalesce(F.sum(F.when(F.col("failed").bitwiseAND(F.lit(1 << bit)) != 0, F.col("count"))), F.lit(0)).alias(f"f_{rule}"),
            F.coalesce(F.sum(F.when(F.col("failed") == 1 << bit, F.col("count"))), F.lit(0)).alias(f"o_{rule}"),
        )
    ]
    entries = [F.struct(F.lit(rule).alias("rule"), F.col(f"f_{rule}").alias("n_failed"), F.col(f"o_{rule}").alias("n_only")) for _, rule in bits]
    return patterns.agg(*sums).select(F.inline(F.array(*entries)))


def filter_quality(docs: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """The documents that pass a policy, with their own columns."""
    judged = ledger(docs.select(F.struct("*").alias("row"), F.col("text").alias("text")))
    # The test reads a row number, which no filter passes: pushed below the measurements, it would
    # repeat them in itself many times over.
    numbered = judged.withColumn("__number", F.monotonically_increasing_id())
    return numbered.where(passes(policy) & (F.col("__number") >= 0)).select("row.*")


def op8_quality(spark, sf_dir: str) -> DataFrame:
    rows = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    m = "measures."
    return rows.select(
        "doc_id",
        *(F.col(m + c).alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        (~passes("base")).alias("base_failed"),
        (passes("base") & passes()).alias("kept"),
        F.col("failures"),
    )


OP8_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
words AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM texts),
windows AS (
  SELECT r, i, list_slice(w, i, i + 7) AS v FROM words, unnest(range(1, len(w) - 6)) AS u(i) WHERE len(w) >= 8),
twins AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, v) > 1),
repeats AS (
  SELECT r, sum(least(8, coalesce(next - i, 8))) AS n FROM (
    SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next FROM twins) GROUP BY r),
measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    length(text) - length(replace(text, '!', '')) AS n_bangs, len(l) AS n_lines
  FROM words LEFT JOIN repeats USING (r)),
failed AS (
  SELECT *, CAST(
      CASE WHEN n_words < 20 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
    + CASE WHEN 10 * n_dup_lines > 6 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN 10 * n_bangs > 3 * n_words THEN 16 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END
    + CASE WHEN word_chars > 20 * n_words THEN 64 ELSE 0 END AS BIGINT) AS failures
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failures & 3 <> 0 AS base_failed, failures = 0 AS kept, failures
FROM failed
"""
