"""Quality rules as a short-circuit cascade.

Each rule rejects a text on one measure.  On a bounded sample the cascade
measures every rule's cost (seconds per text) and selectivity (share rejected)
and runs the rules in falling order of rejections per second; a text rejected by
one rule is not given to the later ones.  The verdict is the conjunction of all
rules, so the order changes the work and never the result.

Words are runs of anything but the six ASCII white-space characters.  The base
measures are returned for every row, as the contract of the table asks.

Defined cases: a null or empty text has no words and fails the base rule;
repeated rows each get their row.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textmap import bounded_share, map_texts

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
WINDOW = 5
_NOT_SYMBOL = bytes(b for b in range(256) if b not in SYMBOLS)
#: Bytes that do not start a code point, and white space.
_NOT_WORD_CHAR = SPACES + bytes(range(0x80, 0xC0))


class Doc:
    """One text with the measures that rules share, each computed once and
    only when a rule asks for it."""

    def __init__(self, text: str | None):
        self.data = (text or "").encode("utf-8", "surrogatepass")
        self.words = self.data.split()
        self._memo: dict[str, float] = {}

    def get(self, name: str) -> int:
        if name not in self._memo:
            self._memo[name] = MEASURES[name](self)
        return self._memo[name]


def _word_chars(d: Doc) -> int:
    return len(d.data.translate(None, _NOT_WORD_CHAR))


def _symbols(d: Doc) -> int:
    return len(d.data.translate(None, _NOT_SYMBOL))


def _lines(d: Doc) -> list:
    return [x for x in d.data.split(b"\n") if x.strip()]


def _dup_lines(d: Doc) -> int:
    lines = _lines(d)
    return len(lines) - len(set(lines))


def _repeat_words(d: Doc) -> int:
    """Words inside 5-word windows that occur twice or more, exactly."""
    n = len(d.words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in d.words), np.int64, len(d.words))
    if len(ids) == len(w):
        return 0
    # exact names of windows: pairs, then fours, then fives, each renamed to
    # dense numbers, so products stay far below 2^63
    pair = w[:-1] * len(ids) + w[1:]
    _, pair = np.unique(pair, return_inverse=True)
    size = int(pair.max()) + 1
    if size == len(pair):
        return 0
    four = pair[:-2] * size + pair[2:]
    _, four = np.unique(four, return_inverse=True)
    size = int(four.max()) + 1
    if size == len(four):
        return 0
    _, five, times = np.unique(four[:n] * len(ids) + w[WINDOW - 1:], return_inverse=True,
                               return_counts=True)
    hit = np.flatnonzero(times[five] > 1)
    step = np.zeros(len(w) + 1, np.int64)
    np.add.at(step, hit, 1)
    np.add.at(step, hit + WINDOW, -1)
    return int((step[:-1].cumsum() > 0).sum())


MEASURES: dict[str, Callable[[Doc], int]] = {
    "n_words": lambda d: len(d.words),
    "word_chars": _word_chars,
    "n_symbols": _symbols,
    "n_lines": lambda d: len(_lines(d)),
    "n_dup_lines": _dup_lines,
    "n_repeat_words": _repeat_words,
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``reject`` is true for texts that the rule throws out; ``sql`` says the
    same over the measure columns."""
    name: str
    reject: Callable[[Doc], bool]
    sql: str


RULES: tuple[Rule, ...] = (
    Rule("too_few_words", lambda d: d.get("n_words") < 10, "n_words < 10"),
    Rule("repeated_windows", lambda d: 100 * d.get("n_repeat_words") > 20 * d.get("n_words"),
         "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", lambda d: 100 * d.get("n_symbols") > 10 * d.get("n_words"),
         "100 * n_symbols > 10 * n_words"),
    Rule("duplicate_lines", lambda d: 100 * d.get("n_dup_lines") > 30 * max(1, d.get("n_lines")),
         "100 * n_dup_lines > 30 * greatest(1, n_lines)"),
    Rule("short_words", lambda d: d.get("word_chars") < 2 * d.get("n_words"),
         "word_chars < 2 * n_words"),
    Rule("long_words", lambda d: d.get("word_chars") > 20 * d.get("n_words"),
         "word_chars > 20 * n_words"),
)
BASE_RULES = ("too_few_words", "repeated_windows")


@dataclass(frozen=True)
class Estimate:
    name: str
    cost: float        # seconds per text
    selectivity: float  # share of the sample that the rule rejects

    @property
    def rank(self) -> float:
        return self.selectivity / max(self.cost, 1e-9)


def estimate(docs: DataFrame, rules: tuple[Rule, ...] = RULES, bound: int = 2000,
             text: str = "text") -> list[Estimate]:
    """Cost and selectivity of each rule on a sample of about ``bound`` rows,
    measured on the executors; one row per task comes back."""
    sample = bounded_share(docs.select("doc_id", F.col(text).cast("string").alias("text")), bound)

    def make():
        def measure(texts: list) -> tuple:
            cost, hits = np.zeros((len(texts), len(rules))), np.zeros((len(texts), len(rules)))
            for i, t in enumerate(texts):
                for k, rule in enumerate(rules):
                    d = Doc(t)  # no shared measures: each rule pays its own
                    at = time.perf_counter()
                    hits[i, k] = rule.reject(d)
                    cost[i, k] = time.perf_counter() - at
            return list(cost), list(hits)

        return measure

    numbers = T.ArrayType(T.DoubleType())
    seen = map_texts(sample, make, [T.StructField("cost", numbers), T.StructField("hits", numbers)])
    sums = seen.agg(F.count("*").alias("n"),
                    *(F.sum(F.col(c)[k]).alias(f"{c}{k}") for c in ("cost", "hits")
                      for k in range(len(rules)))).first()
    n = max(1, sums["n"])
    return [Estimate(r.name, (sums[f"cost{k}"] or 0.0) / n, (sums[f"hits{k}"] or 0.0) / n)
            for k, r in enumerate(rules)]


def cascade_order(estimates: list[Estimate], rules: tuple[Rule, ...] = RULES) -> list[Rule]:
    """Rules by rejection per cost, best first; ties by name."""
    by = {r.name: r for r in rules}
    return [by[e.name] for e in sorted(estimates, key=lambda e: (-e.rank, e.name))]


def apply_rules(docs: DataFrame, order: list[Rule], measures: tuple[str, ...] = BASE,
                text: str = "text") -> DataFrame:
    """``row``, the asked ``measures`` (all rows), ``base_failed``, ``kept`` and
    ``n_rules`` (rules run before the verdict) per input row."""
    base = [r for r in RULES if r.name in BASE_RULES]

    def make():
        def run(texts: list) -> tuple:
            out = np.zeros((len(texts), len(measures)), np.int64)
            failed, kept, ran = (np.zeros(len(texts), t) for t in (bool, bool, np.int64))
            for i, t in enumerate(texts):
                d = Doc(t)
                verdict = True
                for rule in order:
                    ran[i] += 1
                    if rule.reject(d):
                        verdict = False
                        break
                kept[i] = verdict
                if measures:
                    out[i] = [d.get(m) for m in measures]
                    failed[i] = any(r.reject(d) for r in base)
            return (*out.T.copy(), failed, kept, ran)

        return run

    longs = [T.StructField(m, T.LongType()) for m in measures]
    return map_texts(docs, make, [*longs, T.StructField("base_failed", T.BooleanType()),
                                  T.StructField("kept", T.BooleanType()),
                                  T.StructField("n_rules", T.LongType())], text=text)


#: The same measures and verdict for DuckDB, over whole texts.
SQL = r"""
with w as (
  select doc_id, text, string_split(coalesce(text, ''), chr(10)) as all_lines,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
m as (
  select doc_id, words, len(words) as n_words,
         length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as word_chars,
         length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) as n_symbols,
         list_filter(all_lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from w),
win as (
  select doc_id, i, list_slice(words, i, i + 4) as ws
  from m, lateral (select unnest(generate_series(1, n_words - 4)) as i) where n_words >= 5),
rep as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, ws) as c from win)
  where c > 1),
hit as (
  select doc_id, count(distinct i + k) as n from rep, (select unnest([0, 1, 2, 3, 4]) as k)
  group by doc_id),
b as (
  select m.doc_id, n_words, word_chars, n_symbols, len(lines) as n_lines,
         len(lines) - len(list_distinct(lines)) as n_dup_lines,
         coalesce(hit.n, 0) as n_repeat_words from m left join hit using (doc_id)),
f as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from b)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
       cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
       cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
       not (""" + " or ".join(r.sql for r in RULES) + """) as kept
from f
"""
