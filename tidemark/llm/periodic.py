"""Periodic run detection by maximal-pair enumeration.

A run is a stretch of consecutive words that repeats with a smallest period q
(words q apart are equal), has at least ``max(min_length, 2 q)`` words and can't be
extended to either side with that period.

Method: the suffixes of a text are sorted, and the intervals of suffixes with a
common prefix of l words (LCP-interval tree) are visited bottom-up.  An interval
holds the list of its occurrences in text order, each in the class of the word to
its left, merged from the lists of its children (the smaller ones into the
largest).  Two neighbours i < j of that list with different left-word classes and
different words after the prefix are a maximal pair.  Their distance q = j - i and l
decide: with q <= l and q + l >= ``min_length``, the l + q words from i on are a run
of period q, with no extension; and every run shows up exactly once in this way,
for between its first word and the word one period later its prefix can't occur
(else its period would be smaller).

A run needs l >= ``min_length`` / 2, so only suffixes whose first ``min_length`` / 2
words occur twice in the text are sorted: numpy finds them by one sort of hashes
per chunk of texts, sorts them by prefix doubling, and the tree is walked over
them alone.  Hashes only choose candidates; the comparisons are of words.

The work is linear in the text but for the sorting, whole texts are used, and no
text is compared with another.

Defined cases: a null, empty or blank text has no words and no runs, and its
collapsed text is empty; texts shorter than ``min_length`` words have no runs;
repeated rows are each treated alike; an empty table gives no rows; extra columns
are carried in ``row``.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textmap import map_texts, mix64

MIN_LENGTH = 12
#: Words of the texts that are searched together, about.
CHUNK_WORDS = 200_000
#: Distinct words a task remembers before it starts over.
WORD_LIMIT = 500_000

Run = tuple[int, int, int]  # start, length, period


def repeated_seeds(w: np.ndarray, doc: np.ndarray, seed: int) -> np.ndarray:
    """Places at which ``seed`` words start that occur again in the same text
    (and, rarely, places whose hash is that of others)."""
    end = len(w) - seed + 1
    at = np.flatnonzero(w[seed - 1:seed - 1 + end] >= 0)
    at = at[doc[at] == doc[at + seed - 1]]
    h = doc[at].astype(np.uint64)
    for k in range(seed):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[at + k].astype(np.uint64)
    h = mix64(h)
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return at[twice]


def sorted_suffixes(w: np.ndarray, doc: np.ndarray, places: np.ndarray, seed: int
                    ) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``places`` (and of those ``seed`` words further on) in the order
    of text and words, and the number of the group of each with equal first
    ``seed`` words.  Texts end in at least ``seed`` negative numbers."""
    some = np.union1d(places, places + seed)
    keys = [doc[some]]
    for k in range(0, seed, 2):
        hi = (w[some + k] + 1) << 32
        keys.append(hi + (w[some + k + 1] + 1 if k + 1 < seed else 0))
    order = np.lexsort(keys[::-1])
    sa = some[order]
    first = np.ones(len(sa), bool)
    first[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)

    def starts(new: np.ndarray) -> np.ndarray:
        return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))

    rank = np.full(len(w), -1, np.int64)
    group = starts(first)
    rank[sa] = group
    open_ = np.flatnonzero(~(first & np.append(first[1:], True)))
    k = seed
    while len(open_):
        pos = sa[open_]
        low, high = rank[pos + k], rank[pos]
        o = np.lexsort((low, high))
        pos, low, high = pos[o], low[o], high[o]
        sa[open_] = pos
        new = np.ones(len(pos), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        rank[pos] = open_[starts(new)]
        open_ = open_[~(new & np.append(new[1:], True))]
        k *= 2
    return sa, group


def common_prefixes(words: list, sa: list, group: list, seed: int) -> list:
    """Common prefix of each suffix with the one sorted before it, in words (0 for
    the first of a group): in text order, each is at most one less than the one at
    the place before."""
    before = {sa[t]: t for t in range(1, len(sa)) if group[t] == group[t - 1]}
    out = [0] * len(sa)
    last, h = -2, seed
    for i in sorted(before):
        t = before[i]
        j = sa[t - 1]
        h = max(h - 1, seed) if i == last + 1 else seed
        while words[i + h] == words[j + h]:
            h += 1
        out[t] = h
        last = i
    return out


def _join_children(l: int, children: list, words: list, min_length: int,
                   found: set) -> list:
    """The occurrences of an interval in text order; runs of its neighbours."""
    big = max(children, key=len)
    added = [x for c in children if c is not big for x in c]
    if 8 * len(added) > len(big):
        big = sorted(big + added)
    else:
        for x in added:
            insort(big, x)
    for x in added:
        at = bisect_left(big, x)
        for i, j in zip(big[max(at - 1, 0):at + 1], big[max(at, 1):at + 2]):
            q = j - i
            if q <= l and q + l >= min_length and words[i - 1] != words[j - 1] \
                    and words[i + l] != words[j + l]:
                found.add((i, l + q, q))
    return big


def maximal_pairs(words: list, sa: list, lcp: list, min_length: int) -> set:
    """Runs as ``(place, length, period)``, from the intervals bottom-up."""
    found: set = set()
    stack: list[tuple[int, list]] = []
    for t in range(1, len(sa) + 1):
        l = lcp[t] if t < len(sa) else 0
        node = [sa[t - 1]]
        while stack and stack[-1][0] > l:
            top, children = stack.pop()
            children.append(node)
            node = _join_children(top, children, words, min_length, found)
        if l:
            if stack and stack[-1][0] == l:
                stack[-1][1].append(node)
            else:
                stack.append((l, [node]))
    return found


def find_runs(texts: list[np.ndarray], min_length: int = MIN_LENGTH) -> list[list[Run]]:
    """Runs of each text, given as numbers of its words, by start, then period."""
    seed = (min_length + 1) // 2
    out: list[list[Run]] = [[] for _ in texts]
    lens = np.array([len(t) + seed for t in texts], np.int64)
    if not len(texts):
        return out
    w = np.full(int(lens.sum()), -1, np.int64)
    first = np.cumsum(lens) - lens
    for lo, t in zip(first, texts):
        w[lo:lo + len(t)] = t
    doc = np.repeat(np.arange(len(texts)), lens)
    places = repeated_seeds(w, doc, seed)
    if not len(places):
        return out
    sa, group = sorted_suffixes(w, doc, places, seed)
    words, order = w.tolist(), sa.tolist()
    lcp = common_prefixes(words, order, group.tolist(), seed)
    for place, length, period in sorted(maximal_pairs(words, order, lcp, min_length),
                                        key=lambda r: (r[0], r[2])):
        d = int(doc[place])
        out[d].append((place - int(first[d]), length, period))
    return out


def collapse(words: list, runs: list[Run]) -> list:
    """The words outside every run's part after its first period."""
    keep = bytearray(b"\1") * len(words)
    for start, length, period in runs:
        keep[start + period:start + length] = bytes(length - period)
    return list(compress(words, keep))


def detect(docs: DataFrame, min_length: int = MIN_LENGTH, text: str = "text",
           keep: list[str] | None = None) -> DataFrame:
    """``row`` (all columns, or those of ``keep``), ``runs`` (array of ``start``,
    ``length``, ``period``) and ``collapsed``, the text freed of the repetitions:
    its kept words joined by one space."""
    longs = ["start", "length", "period"]
    fields = [T.StructField("runs", T.ArrayType(T.StructType(
        [T.StructField(n, T.LongType()) for n in longs]))), T.StructField("collapsed", T.StringType())]
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in longs]))

    def make():
        ids: defaultdict = defaultdict(count().__next__)

        def run(texts: list) -> tuple:
            nonlocal ids
            runs: list = []
            collapsed: list = []

            def search(chunk: list) -> None:
                numbers = [np.fromiter(map(ids.__getitem__, c), np.int64, len(c)) for c in chunk]
                for c, found in zip(chunk, find_runs(numbers, min_length)):
                    runs.append(found)
                    collapsed.append(b" ".join(collapse(c, found) if found else c))

            chunk, n = [], 0
            for t in texts:
                if len(ids) > WORD_LIMIT and not chunk:
                    ids = defaultdict(count().__next__)
                chunk.append((t or "").encode("utf-8").split())  # ASCII white space
                n += len(chunk[-1])
                if n >= CHUNK_WORDS:
                    search(chunk)
                    chunk, n = [], 0
            search(chunk)
            return pa.array(runs, kind), pa.array(collapsed, pa.binary()).cast(pa.string())

        return run

    return map_texts(docs, make, fields, text=text, keep=keep)


def digest(found: DataFrame) -> list:
    """Columns over ``detect``'s output: number of runs, the longest one (ties:
    smallest start, then period), and digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"),
        (-r["period"]).alias("period"))))
    period = -best["period"]
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    return [F.size("runs").cast("long").alias("n_runs"), (-best["start"]).alias("start"),
            best["length"].alias("length"), period.alias("period"),
            F.floor(best["length"] * 1000 / period).cast("long").alias("exponent_milli"),
            F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
            F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")]


def with_planted_runs(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` in which the words of about a tenth of the texts, chosen by the CRC-32
    h of the id, repeat from a word on: with h % 10 = 0, g = h div 10 and n > 0 words,
    word i >= a = g % n becomes word a + (i - a) % p, p = 1 + (n - a) div (3 + g % 8).
    Such a text holds its words joined by one space; others are unchanged."""
    docs = docs.withColumn("_tm_h", F.crc32(F.col(key).cast("string").cast("binary")))
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    chosen = docs.withColumn("_tm", F.when(F.col("_tm_h") % 10 == 0, F.struct(
        words.alias("words"), F.size(words).cast("long").alias("n"),
        F.expr("_tm_h div 10").alias("g"))))
    repeated = F.expr("""
        array_join(transform(_tm.words, (x, i) -> if(i < _tm.g % _tm.n, x,
            get(_tm.words, cast(_tm.g % _tm.n + (i - _tm.g % _tm.n)
                % (1 + (_tm.n - _tm.g % _tm.n) div (3 + _tm.g % 8)) as int)))), ' ')""")
    return (chosen.withColumn(text, F.when(F.col("_tm.n") > 0, repeated).otherwise(F.col(text)))
            .drop("_tm", "_tm_h"))
