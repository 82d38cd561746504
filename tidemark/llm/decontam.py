"""Benchmark decontamination by greedy string tiling.

Tokens are lower-cased runs of letters and digits.  A document and a test item
that share a run of ``seed`` tokens (the join of shared-token seeds) are tiled:
the longest common runs that touch no marked token are marked, again and again,
down to ``min_match`` tokens.  Common runs are found by running Karp-Rabin: the
hashes of the item's unmarked windows of the present search length are looked up
in those of the document; the search length runs up to the longest match and down
again as matches are marked, each confirmed token by token.  The share of the item's
tokens that lie in tiles is its coverage; as tiles may stand in any order,
reordered passages are caught.  A document leaks an item at ``coverage`` or
more.

The test set is the query side.  It is cut into blocks of at most
``block_tokens`` tokens; each block goes to the executors as one index and every
document is held against it, so memory is bounded for any size of the test set.

Defined cases: null, empty and token-less texts match nothing; an item of fewer
than ``seed`` tokens is matched as a whole; repeated documents each get their
rows; very long texts, also of one token over and over, cost their tokens times
the search lengths tried, not the equal pairs of places; an empty test set or table gives no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textmap import map_texts, mix64

TOKEN = re.compile(r"[^\W_]+")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Params:
    seed: int = 5            # tokens of a shared seed
    min_match: int = 4       # tokens of the shortest tile
    coverage: float = 0.5    # share of an item's tokens in tiles
    block_tokens: int = 1_000_000


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def _rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``n`` token numbers."""
    if len(ids) < n:
        return np.empty(0, np.uint64)
    end = len(ids) - n + 1
    h = np.full(end, n, np.uint64)
    for k in range(n):
        h = h * MULTIPLIER + ids[k:k + end].astype(np.uint64)
    return mix64(h)


def _ladder(ids: np.ndarray, longest: int) -> list[np.ndarray]:
    """Window hashes of the lengths 1, 2, 4, ... up to ``longest``, each made
    of two of the length before."""
    out = [mix64(ids.astype(np.uint64) + np.uint64(3))]
    n = 1
    while 2 * n <= min(longest, len(ids)):
        h = out[-1]
        out.append(mix64(h[:len(h) - n] * MULTIPLIER + h[n:]))
        n *= 2
    return out


def _windows(ladder: list[np.ndarray], n: int) -> np.ndarray:
    """Hashes of all windows of ``n`` tokens: two windows of the ladder that
    overlap to ``n``."""
    if n > len(ladder[0]):
        return np.empty(0, np.uint64)
    h = ladder[n.bit_length() - 1]
    rest = n - (1 << (n.bit_length() - 1))
    return mix64(h[:len(h) - rest] * MULTIPLIER + h[rest:]) if rest else h


def _free(used: np.ndarray, n: int) -> np.ndarray:
    """Whether each window of ``n`` tokens is without a marked one."""
    marked = np.concatenate([[0], np.cumsum(used)])
    return marked[n:] == marked[:-n]


def _among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Whether each value is one of ``wanted``."""
    if not len(wanted):
        return np.zeros(len(values), bool)
    wanted = np.unique(wanted)
    return wanted[np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)] == values


def tile(doc: np.ndarray, item: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(start in doc, start in item, length)``, longest first;
    ties go to the earliest place in the item, then in the document.

    The search length runs: from the least one it doubles while unmarked windows
    of that length are shared, is narrowed to the longest shared one, and goes
    on below it once all matches of that length are marked.  A step costs the
    tokens of both sides, whatever the number of equal pairs of places."""
    least, top = min(min_match, len(item)), min(len(item), len(doc))
    if not 0 < least <= top:
        return []
    used_doc, used_item = np.zeros(len(doc), bool), np.zeros(len(item), bool)
    rungs_doc, rungs_item = _ladder(doc, top), _ladder(item, top)
    tiles: list[tuple[int, int, int]] = []

    def hits(n: int) -> np.ndarray:
        """Places of the document with an unmarked window that the item has."""
        there = _windows(rungs_item, n)[_free(used_item, n)]
        return np.flatnonzero(_free(used_doc, n) & _among(_windows(rungs_doc, n), there))

    while top >= least and len(hits(least)):
        n = least
        while 2 * n <= top and len(hits(2 * n)):
            n *= 2
        high = min(2 * n - 1, top)
        while n < high:
            mid = (n + high + 1) // 2
            n, high = (mid, high) if len(hits(mid)) else (n, mid - 1)
        _mark(doc, item, n, hits(n), _windows(rungs_doc, n), _windows(rungs_item, n),
              used_doc, used_item, tiles)
        top = n - 1
    return tiles


def _mark(doc, item, n, at, hash_doc, hash_item, used_doc, used_item, tiles) -> None:
    """Mark the matches of ``n`` tokens at the places ``at`` of the document.
    Places of one hash are passed once, since a place that is taken stays so;
    marked stretches of this length meet a window at its first or last token."""
    keys = hash_doc[at]
    order = np.argsort(keys, kind="stable")
    places, keys = at[order].tolist(), keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])).tolist()
    ends = [*starts[1:], len(places)]
    left = {k: [a, b] for k, a, b in zip(keys[starts].tolist(), starts, ends)}
    free = _free(used_item, n)
    for i in np.flatnonzero(free & _among(hash_item, keys)).tolist():
        if used_item[i] or used_item[i + n - 1]:
            continue
        span = left[int(hash_item[i])]
        while span[0] < span[1]:
            j = places[span[0]]
            span[0] += 1
            if not used_doc[j] and not used_doc[j + n - 1] \
                    and np.array_equal(doc[j:j + n], item[i:i + n]):
                used_item[i:i + n] = True
                used_doc[j:j + n] = True
                tiles.append((j, i, n))
                break


def within_reach(doc: np.ndarray, item: np.ndarray, p: Params) -> bool:
    """Whether the item's tokens in windows of the least length that the document
    has, too, are enough for the coverage: an upper bound of any tiling."""
    least = min(p.min_match, len(item))
    at = np.flatnonzero(_among(_rolling(item, least), _rolling(doc, least)))
    near = np.zeros(len(item) + 1, np.int64)
    np.add.at(near, at, 1)
    np.add.at(near, at + least, -1)
    return bool((np.cumsum(near) > 0).sum() >= p.coverage * len(item))


def tile_long(doc: np.ndarray, item: np.ndarray, p: Params) -> list[tuple[int, int, int]]:
    """Tiles of a whole document, however long: only its stretches around
    tokens that the item has can hold tiles, so the rest is cut away."""
    if len(doc) < 4 * len(item):
        return tile(doc, item, p.min_match)
    least = min(p.min_match, len(item))
    hit = np.flatnonzero(_among(_rolling(doc, least), _rolling(item, least)))
    if not len(hit):
        return []
    keep = np.unique((hit[:, None] + np.arange(least)).ravel())
    # a gap becomes one token that no item has
    cut = np.flatnonzero(np.diff(keep) > 1) + 1
    short = np.insert(doc[keep], cut, -2)
    place = np.insert(keep, cut, -1)
    return [(int(place[j]), i, n) for j, i, n in tile(short, item, p.min_match)]


def _index(items: list[tuple[int, str]], p: Params):
    """Token numbers, token-number arrays and seed hashes of a block."""
    names: dict[str, int] = {}
    arrays = [np.fromiter((names.setdefault(t, len(names)) for t in tokens(x)), np.int64)
              for _, x in items]
    seeds: dict[int, set[int]] = defaultdict(set)
    for k, a in enumerate(arrays):
        for h in _rolling(a, min(p.seed, len(a))).tolist() if len(a) else ():
            seeds[h].add(k)
    sizes = sorted({min(p.seed, len(a)) for a in arrays if len(a)})
    return names, arrays, dict(seeds), sizes


def _block_matches(docs: DataFrame, items: list[tuple[int, str]], p: Params) -> DataFrame:
    """``row`` and ``found`` (array of item, coverage, tiles) against one block."""
    ids = [i for i, _ in items]
    block = _index(items, p)
    found = T.ArrayType(T.StructType([
        T.StructField("item_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_covered", T.LongType()), T.StructField("n_tiles", T.LongType()),
        T.StructField("longest", T.LongType())]))
    arrow = pa.list_(pa.struct([("item_id", pa.int64()), ("n_tokens", pa.int64()),
                                ("n_covered", pa.int64()), ("n_tiles", pa.int64()),
                                ("longest", pa.int64())]))

    def make():
        names, arrays, seeds, sizes = block
        known = np.array(sorted(seeds), np.uint64)

        def hold(texts: list) -> tuple:
            split = [tokens(t) for t in texts]
            lens = np.fromiter(map(len, split), np.int64, len(split))
            # every text ends with a token that no item has
            flat = np.fromiter((names.get(w, -1) for s in split for w in (*s, "")), np.int64,
                               int(lens.sum()) + len(split))
            ends = np.cumsum(lens + 1)
            pairs: dict[int, set[int]] = defaultdict(set)
            for n in sizes:
                alive = np.convolve(flat >= 0, np.ones(n, np.int64), "valid") == n \
                    if len(flat) >= n else np.zeros(0, bool)
                at = np.flatnonzero(alive)
                if len(at):
                    h = _rolling(flat, n)[at]
                    seed = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    hit = known[seed] == h
                    text = np.searchsorted(ends, at[hit], side="right")
                    # a seed that a text repeats is joined once
                    for code in np.unique(text * len(known) + seed[hit]).tolist():
                        pairs[code // len(known)] |= seeds[int(known[code % len(known)])]
            out = []
            for k in range(len(texts)):
                rows = []
                doc = flat[ends[k] - lens[k] - 1:ends[k] - 1]
                for item in sorted(pairs.get(k, ())):
                    if not within_reach(doc, arrays[item], p):
                        continue
                    tiles = tile_long(doc, arrays[item], p)
                    covered = sum(n for _, _, n in tiles)
                    if tiles and covered >= p.coverage * len(arrays[item]):
                        rows.append({"item_id": ids[item], "n_tokens": len(arrays[item]),
                                     "n_covered": covered, "n_tiles": len(tiles),
                                     "longest": max(n for _, _, n in tiles)})
                out.append(rows)
            return (pa.array(out, arrow),)

        return hold

    return map_texts(docs, make, [T.StructField("found", found)])


def item_blocks(benchmark: DataFrame, p: Params):
    """The test set in blocks of at most about ``block_tokens`` tokens, each
    read in its own job (a token has one character at least)."""
    rows = benchmark.where(F.col("text").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // (2 * p.block_tokens)))
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k)
        yield [(r["item_id"], r["text"]) for r in part.distinct().collect()]


def matches(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """One row per document row and leaked item: ``row``, ``item_id``,
    ``n_tokens``, ``n_covered``, ``n_tiles``, ``longest``, ``coverage``."""
    out = None
    for block in item_blocks(benchmark, p):
        part = _block_matches(docs, block, p).where(F.size("found") > 0) \
            .select("row", F.inline("found"))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("coverage", F.col("n_covered") / F.col("n_tokens"))


def without_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame,
                  p: Params = Params()) -> DataFrame:
    """The rows of ``docs`` that leak no item, with their columns."""
    out = docs
    for block in item_blocks(benchmark, p):
        out = _block_matches(out, block, p).where(F.size("found") == 0).select("row.*")
    return out
