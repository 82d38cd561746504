"""Target-distribution importance resampling with a head-tail vocabulary.

Features of a text are its words and its pairs of neighbouring words, hashed by
CRC-32 into ``buckets``.  The bucket totals of the whole corpus and of the target
texts give each bucket a gain (1000 times the logarithm of the smoothed ratio of
its shares); a document's weight is the mean gain of its features.  Weight plus
Gumbel noise from a hash of the id is its score, and the highest scores are drawn
(Gumbel top-k: sampling without replacement by importance).

Method: the head of the vocabulary, the most frequent words and pairs of such
words, is found by counting all texts in blocks (a block reports the features that
hold 1 / ``REPORT`` of its words) and broadcast: the CRC-32 states of its words and
the buckets of its pairs.  Its features have reports of 1 / ``HEAD`` of all words or
more, so there are at most ``HEAD`` words and as many pairs, of ``HEAD_BYTES`` a word.  In a task, words
and pairs of the head are array look-ups; a tail word takes its CRC-32 itself, and
a tail pair continues the state of its first word over the second.  Both give the
same bucket, so the head never changes a result, and the bucket totals are exact:
each task adds up all its features, and tasks give ``buckets`` rows each.

The draw: the histogram of scores (whole numbers from a bounded range: weights lie
within 1000 times the logarithm of the feature count, noise within -3,200 and
23,000) gives the lowest drawn score; only documents from that score on are sorted,
by range over all tasks, and numbered by their place in a task and the sizes of
the tasks before.

Defined cases: a null, empty or wordless text has no features, weight 0, and is
never drawn; a null id hashes as the empty text; repeated rows are counted and
drawn each (ties beyond the id by weight, then features); an empty corpus gives no
rows, an empty target gives gains by the corpus alone; columns of the input are
carried in ``row``, so their names can't clash.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from dataclasses import dataclass
from itertools import count, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textmap import SLICE_ROWS, map_texts, stored

#: Words, and pairs, of the head at most: each holds this share of all words.
HEAD = 1 << 18
#: A feature is reported by a block in which it holds this share of the words.
REPORT = 1 << 16
#: Bytes of a word of the head at most.
HEAD_BYTES = 64
#: Words of a block, about.
BLOCK_WORDS = 500_000
#: Slots of the pair table; of two head pairs on one slot one is left to the tail.
SLOTS = 1 << 20

#: A-Z in lower case, other ASCII characters but digits and a-z as blanks.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122
             else 32 for c in range(256))


@dataclass(frozen=True)
class Params:
    buckets: int = 10_000
    percent: int = 25     # of the documents with at least ``min_words`` words
    min_words: int = 20
    seed: int = 7


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(FOLD).split()


@dataclass(frozen=True)
class Head:
    """Frequent words, and frequent pairs as places in ``words``."""
    words: tuple[bytes, ...] = ()
    pairs: tuple[tuple[int, int], ...] = ()


def _frequent(block: list[list[bytes]]) -> list[tuple[bytes, bytes | None, int]]:
    """Words and pairs that a block reports, and their counts; last, its words."""
    ids: defaultdict = defaultdict(count().__next__)
    flat = np.fromiter((ids[w] for ws in block for w in ws), np.int64)
    least = max(2, -(-len(flat) // REPORT))
    names = list(ids)
    counts = np.bincount(flat, minlength=len(names))
    often = (counts >= least) & (np.fromiter(map(len, names), np.int64, len(names)) <= HEAD_BYTES)
    out = [(names[i], None, int(counts[i])) for i in np.flatnonzero(often)]
    ends = np.cumsum([len(ws) for ws in block])
    inside = np.ones(len(flat), bool)
    inside[ends[ends > 0] - 1] = False
    left = np.flatnonzero(inside[:-1] & often[flat[:-1]] & often[flat[1:]]) if len(flat) else flat
    codes, n = np.unique(flat[left] * len(names) + flat[left + 1], return_counts=True)
    for code, k in zip(codes[n >= least].tolist(), n[n >= least].tolist()):
        a, b = divmod(code, len(names))
        out.append((names[a], names[b], k))
    return [*out, (None, None, len(flat))]


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col(f"`{text}`").cast("string").alias("t"))


def find_head(docs: DataFrame, text: str = "text") -> Head:
    """Words and pairs with reports of 1 / ``HEAD`` of all words."""
    schema = "a binary, b binary, n long"

    def run(batches):
        def rows(block):
            found = _frequent(block)
            return pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], t) for k, t in
                 enumerate((pa.binary(), pa.binary(), pa.int64()))], ["a", "b", "n"])

        block, n = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                for t in batch.column(0).slice(lo, SLICE_ROWS).to_pylist():
                    block.append(words_of(t))
                    n += len(block[-1])
                    if n >= BLOCK_WORDS:
                        yield rows(block)
                        block, n = [], 0
        if n:
            yield rows(block)

    counts = _texts(docs, text).mapInArrow(run, schema).groupBy("a", "b").agg(
        F.sum("n").alias("n"))
    counts = stored(docs.sparkSession, counts, "head")
    total = counts.where("a IS NULL").agg(F.max("n")).first()[0] or 0
    often = [(bytes(r["a"]), r["b"] and bytes(r["b"])) for r in
             counts.where(F.col("a").isNotNull() & (F.col("n") * HEAD >= total)).collect()]
    words = sorted(a for a, b in often if b is None)
    place = {w: i for i, w in enumerate(words)}
    # a pair is reported with its words, so they are in the head, too
    pairs = sorted((place[a], place[b]) for a, b in often if b is not None)
    return Head(tuple(words), tuple(pairs))


class Buckets:
    """Buckets of all features of a list of texts."""

    def __init__(self, head: Head, buckets: int):
        self.n = buckets
        self.ids = {w: i for i, w in enumerate(head.words)}
        self.width = np.int64(len(head.words) + 1)
        self.states = np.array([*map(zlib.crc32, head.words), 0], np.int64)
        self.keys = np.full(SLOTS, -1, np.int64)
        self.values = np.zeros(SLOTS, np.int64)
        if head.pairs:
            a, b = np.array(head.pairs, np.int64).T
            codes = a * self.width + b
            made = [zlib.crc32(b" " + head.words[y], int(self.states[x])) % buckets
                    for x, y in head.pairs]
            slots = self._slots(codes)
            self.keys[slots] = codes
            won = self.keys[slots] == codes
            self.values[slots[won]] = np.array(made)[won]

    @staticmethod
    def _slots(codes: np.ndarray) -> np.ndarray:
        mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)

    def __call__(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of each text; buckets of all words; buckets of all pairs."""
        each = [words_of(t) for t in texts]
        lens = np.fromiter(map(len, each), np.int64, len(each))
        words = [w for ws in each for w in ws]
        ids = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))
        state = self.states[ids]
        tail = np.flatnonzero(ids < 0)
        state[tail] = np.fromiter((zlib.crc32(words[i]) for i in tail.tolist()), np.int64,
                                  len(tail))
        inside = np.ones(len(words), bool)
        inside[np.cumsum(lens)[lens > 0] - 1] = False
        left = np.flatnonzero(inside)
        known = (ids[left] >= 0) & (ids[left + 1] >= 0)
        codes = np.where(known, ids[left] * self.width + ids[left + 1], -2)
        slots = self._slots(codes)
        pairs = self.values[slots]
        miss = np.flatnonzero(self.keys[slots] != codes)
        second = [b" " + words[i] for i in (left[miss] + 1).tolist()]
        pairs[miss] = np.fromiter(map(zlib.crc32, second, state[left[miss]].tolist()), np.int64,
                                  len(miss)) % self.n
        return lens, state % self.n, pairs


def bucket_totals(docs: DataFrame, head: Head, p: Params, text: str = "text") -> np.ndarray:
    """Features of all texts in each bucket."""
    def run(batches):
        buckets = Buckets(head, p.buckets)
        total = np.zeros(p.buckets, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                _, words, pairs = buckets(batch.column(0).slice(lo, SLICE_ROWS).to_pylist())
                total += np.bincount(words, minlength=p.buckets)
                total += np.bincount(pairs, minlength=p.buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    sums = _texts(docs, text).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n"))
    out = np.zeros(p.buckets, np.int64)
    for r in sums.collect():  # one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket, in thousandths, floored."""
    k = len(corpus)
    s_all, t_all = float(corpus.sum() + k), float(target.sum() + k)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise of an id, in thousandths, floored."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def scores(docs: DataFrame, target: DataFrame, p: Params = Params(), key: str = "doc_id",
           text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (all columns, or those of ``keep``), ``n_words``, ``n_features``,
    ``weight`` and ``score`` of every document."""
    head = find_head(docs, text)
    gain = gains(bucket_totals(docs, head, p, text), bucket_totals(target, head, p, text))

    def make():
        buckets = Buckets(head, p.buckets)

        def run(texts: list) -> tuple:
            lens, words, pairs = buckets(texts)
            n_pairs = np.maximum(lens - 1, 0)
            total = np.zeros(len(lens), np.int64)
            for found, n in ((words, lens), (pairs, n_pairs)):
                sums = np.concatenate([[0], np.cumsum(gain[found])])
                ends = np.cumsum(n)
                total += sums[ends] - sums[ends - n]
            features = lens + n_pairs
            return lens, features, np.where(features > 0, total // np.maximum(features, 1), 0)

        return run

    longs = [T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight")]
    found = map_texts(docs, make, longs, text=text, keep=keep)
    return found.withColumn("score", F.col("weight") + noise(F.col(f"row.`{key}`"), p.seed))


def ranked(spark: SparkSession, scored: DataFrame, p: Params = Params(),
           key: str = "doc_id") -> DataFrame:
    """``scored`` (a stored table) plus ``rank``: 1, 2, 3... of the drawn documents by
    score, ties to the smaller id; null for others."""
    able = scored.where(F.col("n_words") >= p.min_words)
    # whole numbers from a bounded range, see above
    sizes = sorted(((r["score"], r["n"]) for r in
                    able.groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    wanted = p.percent * sum(n for _, n in sizes) // 100
    lowest, above = None, 0
    for lowest, n in sizes:
        above += n
        if above >= wanted:
            break
    if not wanted:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    candidate = (F.col("n_words") >= p.min_words) & (F.col("score") >= lowest)
    order = [F.desc("score"), F.col(f"row.`{key}`").asc_nulls_first(), "weight", "n_features"]
    top = stored(spark, scored.where(candidate).repartitionByRange(*order)
                 .sortWithinPartitions(*order)
                 .withColumn("_tm_at", F.monotonically_increasing_id()), "ranked")
    task = F.shiftright("_tm_at", 33)
    before = Window.orderBy("_tm_task").rowsBetween(Window.unboundedPreceding, -1)
    first = (top.groupBy(task.alias("_tm_task")).agg(F.count("*").alias("n"))  # a row per task
             .select("_tm_task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_tm_first")))
    place = F.col("_tm_first") + F.col("_tm_at").bitwiseAND((1 << 33) - 1) + 1
    numbered = (top.withColumn("_tm_task", task).join(F.broadcast(first), "_tm_task")
                .withColumn("rank", F.when(place <= wanted, place).cast("long")))
    others = scored.where(~candidate).withColumn("rank", F.lit(None).cast("long"))
    return numbered.select(*others.columns).unionByName(others)


def resample(docs: DataFrame, target: DataFrame, p: Params = Params(), key: str = "doc_id",
             text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every document with ``n_words``, ``n_features``, ``weight``, ``score`` and
    ``rank``; the drawn ones are those with a rank."""
    spark = docs.sparkSession
    scored = stored(spark, scores(docs, target, p, key, text, keep), "scores")
    return ranked(spark, scored, p, key)
