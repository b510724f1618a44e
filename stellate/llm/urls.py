"""URL filters: one bit-parallel automaton runs all rules and globs over each canonical URL."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.shared import ascii_lower

#: (verdict, host, path): a rule fits its host and all subdomains where the path starts with the rule's.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Words of a host, between dots and dashes, that block what no rule decides: a list of our own, to be replaced.
WORDS = ("adult", "bets", "betting", "casino", "escort", "gambling", "pills", "poker", "porn", "spam", "viagra", "xxx")

_SEGMENT, _ANY = "*", "**"
_TOKEN = re.compile(rb"(\*+)|\[([^]]+)\]|(.)", re.DOTALL)


def host_word_globs(words: Sequence[str]) -> tuple[str, ...]:
    """Globs over host + path that fit where a whole word of the host is one of these."""
    return tuple(f"{before}{word}{after}" for word in words for before in ("", "*[-.@]") for after in ("", "[-.:/]**"))


#: `*` stays within a path segment or the host, `**` does not, `[...]` is any one of these bytes; all else is literal.
GLOBS = host_word_globs(WORDS)


def parse_glob(pattern: str) -> list[bytes | str]:
    """Literals, as the bytes that fit, and the two wildcards; three or more stars are `**`."""
    out: list[bytes | str] = []
    for stars, listed, literal in _TOKEN.findall(pattern.encode()):
        out.append((_SEGMENT if len(stars) == 1 else _ANY) if stars else listed or literal)
    return out


def rule_globs(host: str, path: str) -> list[list[bytes | str]]:
    literal = [bytes([b]) for b in (host + path).encode()]
    return [[*literal, _ANY], [_SEGMENT, b".", *literal, _ANY]]


@dataclass
class Automaton:
    """Shift-And masks over 64-bit words; a pattern has a bit for each count of literals consumed.

    A step on byte c is (states << 1) & step[c] | states & stay[c]; the shift carries over words.
    """

    start: np.ndarray  # words
    step: np.ndarray  # 256 x words
    stay: np.ndarray  # 256 x words
    final: np.ndarray  # pattern: bit

    def run(self, data: list[bytes]) -> np.ndarray:
        """For each string and pattern, whether the whole string fits. Memory: strings x (words + patterns)."""
        lengths = np.fromiter(map(len, data), np.int64, len(data))
        order = np.argsort(-lengths, kind="stable")
        flat = np.frombuffer(b"".join(data), np.uint8)
        begin = (np.cumsum(lengths) - lengths)[order]
        states = np.repeat(self.start[None, :], len(data), axis=0)
        ends = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), side="left")
        for at, n in enumerate(ends):  # the n strings longer than `at`
            c, now = flat[begin[:n] + at], states[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            states[:n] = (moved & self.step[c]) | (now & self.stay[c])
        word, bit = self.final // 64, (self.final % 64).astype(np.uint64)
        out = np.empty((len(data), len(self.final)), dtype=bool)
        out[order] = (states[:, word] >> bit) & np.uint64(1) == 1
        return out


def compile_globs(patterns: Sequence[list[bytes | str]]) -> Automaton:
    n_bits = sum(1 + sum(isinstance(t, bytes) for t in p) for p in patterns)
    words = max(1, -(-n_bits // 64))
    start = np.zeros(words, np.uint64)
    step, stay = np.zeros((256, words), np.uint64), np.zeros((256, words), np.uint64)
    final, bit = [], 0
    for pattern in patterns:
        start[bit // 64] |= np.uint64(1 << bit % 64)
        for token in pattern:
            if isinstance(token, bytes):
                bit += 1
                step[list(token), bit // 64] |= np.uint64(1 << bit % 64)
            else:
                crossed = stay[:, bit // 64].copy()
                stay[:, bit // 64] |= np.uint64(1 << bit % 64)
                if token == _SEGMENT:
                    stay[ord("/"), bit // 64] = crossed[ord("/")]
        final.append(bit)
        bit += 1
    return Automaton(start, step, stay, np.array(final, np.int64))


def host_path(url: Column) -> tuple[Column, Column]:
    """Host after the first `://`, A-Z lower-cased, and path; both empty for null or without `://`."""
    given = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(given, "://")
    rest = F.when(at > 0, F.substring(given, at + 3, F.length(given))).otherwise("")
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def judged(pages: DataFrame, rules=RULES, globs: Sequence[str] = GLOBS, url: str = "url") -> DataFrame:
    """All columns and host, path, rule, verdict, globs (those that fit, in order).

    The longest fitting rule (host and path together, then the earlier one) decides; else any
    fitting glob blocks; else allow. Input columns of these names are replaced. A null url has
    an empty host and path, which the globs judge like any other. No shuffle; the masks grow
    with the rules, not with the data.
    """
    by_length = sorted(range(len(rules)), key=lambda k: -len(rules[k][1] + rules[k][2]))
    patterns = [g for _, host, path in rules for g in rule_globs(host, path)] + [parse_glob(g) for g in globs]
    automaton = compile_globs(patterns)
    names = [host + path for _, host, path in rules]
    verdicts = [verdict for verdict, _, _ in rules]
    listed = list(globs)

    @F.pandas_udf("rule string, verdict string, globs array<string>")
    def judge(canonical: pd.Series) -> pd.DataFrame:
        raw = [x.encode() for x in canonical]
        fits = np.concatenate([automaton.run(raw[a : a + 4096]) for a in range(0, len(raw), 4096)] or [np.zeros((0, len(patterns)), bool)])
        by_rule = fits[:, : 2 * len(names)].reshape(len(raw), len(names), 2).any(axis=2)
        by_glob = fits[:, 2 * len(names) :]
        rule = np.full(len(raw), -1)
        for k in reversed(by_length):
            rule[by_rule[:, k]] = k
        hits = [[listed[k] for k in np.flatnonzero(row)] for row in by_glob]
        return pd.DataFrame(
            {
                "rule": [names[k] if k >= 0 else None for k in rule],
                "verdict": [verdicts[k] if k >= 0 else "block" if h else "allow" for k, h in zip(rule, hits)],
                "globs": hits,
            }
        )

    row = F.struct(*(F.col(f"`{c}`") for c in pages.columns if c not in ("host", "path", "rule", "verdict", "globs")))
    host, path = host_path(F.col(url))
    split = pages.select(row.alias("__row"), host.alias("host"), path.alias("path"))
    found = split.withColumn("__found", judge(F.concat("host", "path")))
    return found.select("__row.*", "host", "path", "__found.*")


def op4_url_filters(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judged(pages).select("page_id", "host", "path", "rule", "verdict")


OP4_SQL = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(verdict, rule_host, rule_path) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (
  SELECT p.page_id, p.host, p.path, r.rule_host || r.rule_path AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST) AS nth
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path))
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN regexp_matches(host,
    '(^|[-.@])(adult|bets|betting|casino|escort|gambling|pills|poker|porn|spam|viagra|xxx)([-.:]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM fits WHERE nth = 1
"""
