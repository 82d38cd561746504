"""MinHash near-dedup with fast similarity sketching.

Words are lower-cased (A-Z) runs of anything but the six ASCII white-space
characters; a document's set holds its distinct ``words``-word shingles (all its
words as one shingle if it has fewer).  Two documents are linked if their sets'
Jaccard similarity is at least ``percent`` / 100.

1. *Sketch.*  Fast similarity sketching: in round ``i`` each element is hashed
   to one bin and to a value ``(i, hash)``; each bin keeps its smallest value.
   From round ``t`` on, round ``t + j`` throws all elements into bin ``j``, so
   every coordinate is filled after ``2 t`` rounds at the latest, and a document
   stops as soon as all its bins are filled.
2. *Classes.*  Documents with equal sets (128-bit fingerprints) form one class;
   only classes go on, so large groups of copies cost one row each.
3. *Banding.*  ``bands`` bands of ``rows`` coordinates.  In each bucket every
   class is paired with the bucket's leader only, the class that shares buckets
   with the most others.
4. *Exact verification* of the pairs on the full sets, in tasks that read two
   sets at a time.  Links are closed to components.
5. *The rest.*  In buckets whose classes are not yet in one component, the
   classes outside the leader's component are compared with those of all other
   components; pairs inside a component are never made.  Candidates come from a
   prefix join, not from the pairs of a bucket: the elements of each of these sets
   are ordered by rarity over these sets, and two sets of sizes ``m`` and ``n`` that
   share ``least`` elements, as a link needs, have one in common among the first
   ``m - least + 1`` of one and ``n - least + 1`` of the other.  Elements that only one
   set has come first in its order and meet nothing, so texts around a common
   passage and copies with edits of their own make no candidate at all.
6. *Parity bound.*  Each set has a bitmap of ``BITS`` parities (how many of its
   elements fall on each bit, odd or even).  What two sets share cancels out, so
   the bits in which two bitmaps differ are a lower bound of the elements that only
   one of the sets has, whatever the sizes.  Pairs whose bound rules a link out are
   not verified on the full sets, in step 4 and in step 5.

Both filters are exact: no pair that shares a bucket and could join two components
is left out.

Size filters (``percent`` of the larger set must not exceed the smaller) are
necessary conditions for a link.  Sets of fewer than ``100 / (100 - percent) - 1``
shingles can only be linked to equal sets and skip the bands.

Bands are a filter that finds a pair at the threshold with probability
``1 - (1 - s^rows)^bands`` (3e-6 missed at 0.8 with the defaults).

Defined cases: null, empty and blank texts have no shingle and are linked with
nothing; each row gets its result, rows that share a ``doc_id`` keep apart if
their texts differ; a null ``doc_id`` is never the smallest of a component with
others.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textmap import WordTable, map_texts, mix64, stored

#: Rows of a batch of texts.
BATCH_ROWS = 512
#: Distinct words whose hashes a task remembers.
WORDS = 150_000
#: Bits of the bitmap of wanted texts.
BITMAP = 1 << 26
#: Bits of a set's parity bitmap.
BITS = 2048
#: Bytes A-Z to a-z.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


@dataclass(frozen=True)
class Params:
    words: int = 5        # words of a shingle
    percent: int = 80     # least similarity of a link
    rows: int = 6         # coordinates of a band
    bands: int = 42

    @property
    def size(self) -> int:
        return self.rows * self.bands


def word_hashes(words: list) -> tuple[np.ndarray]:
    """64-bit hashes of words (bytes)."""
    import xxhash

    return (np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words)),)


def shingle_sets(texts: list, table: WordTable, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and set sizes."""
    split = [(t or "").encode("utf-8", "surrogatepass").translate(LOWER).split() for t in texts]
    lens = np.fromiter(map(len, split), np.int64, len(split))
    sizes = np.zeros(len(texts), np.int64)
    words = [w for s in split for w in s]
    if not words:
        return np.empty(0, np.uint64), sizes
    at = table.lookup(words)
    h = table.cols[0][at]
    sets = []
    lo = 0
    for i, n in enumerate(lens.tolist()):
        if n:
            w = h[lo:lo + n]
            m = min(k, n)
            s = np.full(n - m + 1, m, np.uint64)
            for j in range(m):
                s = (s ^ (s >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) \
                    + w[j:j + n - m + 1]
            s = np.unique(mix64(s))
            sizes[i] = len(s)
            sets.append(s)
        lo += n
    return np.concatenate(sets), sizes


def sketch(elements: np.ndarray, sizes: np.ndarray, t: int) -> np.ndarray:
    """Fast similarity sketches, one row of ``t`` values per set."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(len(sizes) * t, empty, np.uint64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    active, at = elements, owner
    for i in range(2 * t):
        if not len(active):
            break
        h = mix64(active + np.uint64((i + 1) * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF))
        bins = (h >> np.uint64(32)) % np.uint64(t) if i < t else np.uint64(i - t)
        value = (np.uint64(i) << np.uint64(48)) | (mix64(h) >> np.uint64(16))
        np.minimum.at(out, at * t + bins.astype(np.int64), value)
        if i < 4 or i % 8 == 0:  # filled sets may stay in: later values are larger
            keep = (out.reshape(-1, t) == empty).any(axis=1)[at]
            active, at = active[keep], at[keep]
    return out.reshape(-1, t)


def fingerprints(elements: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """128-bit fingerprint of each set (of its sorted elements)."""
    import xxhash

    out, lo = [], 0
    for n in sizes.tolist():
        out.append(xxhash.xxh3_128_digest(elements[lo:lo + n].tobytes()) if n else None)
        lo += n
    return out


def _signatures(docs: DataFrame, p: Params) -> DataFrame:
    """``row`` (``doc_id``, ``text_hash``), ``n_shingles``, ``set_id`` (null: empty set),
    ``keys`` (bands)."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    least = 100 // (100 - p.percent) - 1  # smaller sets are linked to equal ones only

    def make():
        table = WordTable(word_hashes, WORDS)

        def run(texts: list) -> tuple:
            elements, sizes = shingle_sets(texts, table, p.words)
            names = fingerprints(elements, sizes)
            values = sketch(elements, sizes, p.size).reshape(len(texts), p.bands, p.rows)
            key = np.zeros((len(texts), p.bands), np.uint64) \
                + np.arange(1, p.bands + 1, dtype=np.uint64)
            for r in range(p.rows):
                key = mix64(key) + values[:, :, r]
            key = mix64(key).view(np.int64)
            bands = [k if n >= least else [] for k, n in zip(key, sizes.tolist())]
            return (sizes, pa.array(names, pa.binary()), pa.array(bands, pa.list_(pa.int64())))

        return run

    return map_texts(docs, make, [T.StructField("n_shingles", T.LongType()),
                                  T.StructField("set_id", T.BinaryType()),
                                  T.StructField("keys", T.ArrayType(T.LongType()))],
                     keep=["doc_id", "text_hash"])


def parities(elements: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One row of ``BITS`` / 64 words per set: the parities of its elements by bit."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = owner * BITS + (elements % np.uint64(BITS)).astype(np.int64)
    odd = np.bincount(at, minlength=len(sizes) * BITS).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64).reshape(len(sizes), BITS // 64)


def _shingles(texts: DataFrame, p: Params) -> DataFrame:
    """``row``, ``elements`` (the sorted shingle hashes) and ``parity``."""

    def make():
        table = WordTable(word_hashes, WORDS)

        def run(batch: list) -> tuple:
            elements, sizes = shingle_sets(batch, table, p.words)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            return (pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                             pa.array(elements.view(np.int64))),
                    pa.array(list(parities(elements, sizes)), pa.list_(pa.int64())))

        return run

    return map_texts(texts, make, [T.StructField("elements", T.ArrayType(T.LongType())),
                                   T.StructField("parity", T.ArrayType(T.LongType()))],
                     keep=["class"])


def _bitmap(hashes: DataFrame) -> DataFrame:
    """Pages of a bitmap of the ``hash`` values: ``BITMAP`` / 8 bytes in all at most."""
    bit = F.pmod("hash", F.lit(BITMAP))
    return hashes.select(bit.alias("bit")).groupBy(F.expr("bit div 32768").alias("page")).agg(
        F.bitmap_construct_agg(F.col("bit") % 32768).alias("bits"))


def _bit_set(value: str) -> Column:
    """Whether the bit of a hash is set in its page's ``bits``."""
    at = F.pmod(value, F.lit(BITMAP)) % 32768
    byte = F.conv(F.hex(F.substring("bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), (at % 8).cast("int")) == 1


def _on_page(value: str) -> Column:
    return F.floor(F.pmod(value, F.lit(BITMAP)) / 32768) == F.col("page")


def _likely(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``docs`` (with ``text_hash``) whose bit is set in a bitmap of the wanted
    ``hash`` values: all wanted rows, and few others as long as the wanted are well below
    ``BITMAP`` in number."""
    return (docs.join(F.broadcast(_bitmap(wanted)), _on_page("text_hash"))
            .where(_bit_set("text_hash")).drop("page", "bits"))


def _sets(spark: SparkSession, wanted: DataFrame, classes: DataFrame, docs: DataFrame,
          p: Params) -> DataFrame:
    """``(class, elements, size, parity)`` of the wanted classes, made again from one
    text of each, so nothing but those texts is shuffled."""
    named = wanted.join(classes.select("class", F.col("doc_id").alias("id"),
                                       F.col("text_hash").alias("hash")), "class")
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    texts = (_likely(hashed, named.select("hash"))
             .join(named, F.col("doc_id").eqNullSafe(F.col("id"))
                   & (F.col("text_hash") == F.col("hash")))
             .groupBy("id", "hash", "class").agg(F.first("text").alias("text")))
    with _small_batches(spark):
        return stored(spark, _shingles(texts, p).select(
            "row.class", "elements", F.size("elements").cast("long").alias("size"), "parity"),
            "sets")


def _least(m: Column, n: Column, p: Params) -> Column:
    """How many elements linked sets of sizes ``m`` and ``n`` share at least."""
    return F.floor((p.percent * (m + n) + 99 + p.percent) / (100 + p.percent))


def _within_reach(pairs: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """The pairs that the parity bound does not rule out."""
    left = sets.select(F.col("class").alias("a"), F.col("size").alias("m"),
                       F.col("parity").alias("x"))
    right = sets.select(F.col("class").alias("b"), F.col("size").alias("n"),
                        F.col("parity").alias("y"))
    differ = reduce(lambda s, i: s + F.bit_count(F.col("x")[i].bitwiseXOR(F.col("y")[i])),
                    range(BITS // 64), F.lit(0))
    m, n = F.col("m"), F.col("n")
    return (pairs.join(right, "b").join(left, "a")
            .where(differ <= m + n - 2 * _least(m, n, p)).select("a", "b"))


def _links(pairs: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """The pairs ``(a, b)`` that are links, confirmed on the full sets."""
    left = sets.select(F.col("class").alias("a"), F.col("size").alias("m"),
                       F.col("elements").alias("x"))
    right = sets.select(F.col("class").alias("b"), F.col("size").alias("n"),
                        F.col("elements").alias("y"))
    shared, m, n = F.size(F.array_intersect("x", "y")).cast("long"), F.col("m"), F.col("n")
    return (pairs.join(right, "b").join(left, "a")
            .where(100 * shared >= p.percent * (m + n - shared)).select("a", "b"))


def _prefixes(sets: DataFrame, p: Params) -> DataFrame:
    """``(class, size, element, at)``: of each set's elements by rarity (how many of
    the sets hold them, then value) those that a link to a smaller or larger set may
    rest on, with their places.  Elements of one set only come first and are left
    out, since no other set meets them."""
    each = sets.select("class", "size", F.explode("elements").alias("element"))
    met = each.groupBy("element").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    ordered = (each.join(met, "element").groupBy("class", "size")
               .agg(F.sort_array(F.collect_list(F.struct("n", "element"))).alias("common")))
    size, own = F.col("size"), F.col("size") - F.size("common")
    longest = size - F.floor((p.percent * size + 99) / 100) + 1 - own
    return (ordered.where(longest > 0)
            .select("class", "size", own.alias("own"),
                    F.posexplode(F.slice("common", F.lit(1), longest.cast("int"))))
            .select("class", "size", F.col("col.element").alias("element"),
                    (F.col("own") + F.col("pos")).alias("at")))


def _candidates(open_: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """Pairs ``(a, b)`` of different components that share an element early enough
    in both orders; one at least is ``outside``.  ``open_``: ``class``, ``component``,
    ``outside``."""
    early = _prefixes(sets, p).join(open_, "class")
    other = early.where("outside").select(
        "element", F.col("class").alias("x"), F.col("size").alias("x_size"),
        F.col("at").alias("x_at"), F.col("component").alias("x_component"))
    least = _least(F.col("size"), F.col("x_size"), p)
    return (other.join(early, "element")
            .where((F.col("component") != F.col("x_component"))
                   & (~F.col("outside") | (F.col("x") < F.col("class")))
                   & (F.col("at") <= F.col("size") - least)
                   & (F.col("x_at") <= F.col("x_size") - least))
            .select(F.least("x", "class").alias("a"), F.greatest("x", "class").alias("b"))
            .distinct())


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``(node, component)`` of the nodes of ``edges (a, b)``: the smallest node
    reachable.  Neighbour minima and pointer jumping, a stored table per round,
    until nothing changes."""
    both = stored(spark, edges.select("a", "b").union(edges.select("b", "a"))
                  .where(F.col("a") != F.col("b")).distinct(), "edges")
    label = stored(spark, both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                   .select("node", F.least("node", "least").alias("component")), "labels")
    while True:
        near = (both.join(label, F.col("b") == F.col("node"))
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        step = label.join(near, "node").select(
            "node", F.col("component").alias("old"),
            F.least("component", "near").alias("component"))
        jump = step.select(F.col("node").alias("component"), F.col("component").alias("next"))
        fresh = stored(spark, step.join(jump, "component", "left").select(
            "node", "old", F.least("component", F.coalesce("next", "component"))
            .alias("component")), "labels")
        label = fresh.select("node", "component")
        if fresh.where(F.col("old") != F.col("component")).isEmpty():
            return label


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of ``BATCH_ROWS`` rows for what is run inside, so the memory of a
    task does not rest on the length of its texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def _signed(spark: SparkSession, slim: DataFrame, p: Params) -> DataFrame:
    with _small_batches(spark):
        return stored(spark, _signatures(slim, p).select(
            "row.doc_id", "row.text_hash", "n_shingles", "set_id", "keys"), "signatures")


def link(docs: DataFrame, p: Params = Params(),
         before: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rows, classes)``: every row's ``doc_id`` and ``text_hash`` with ``n_shingles``
    and ``set_id``, and ``(set_id, first_doc, component_id)`` for every set.  With
    ``before`` its other texts of the ids of ``docs`` are rows, too (not ``now``), and the
    texts of one id are linked."""
    spark = docs.sparkSession
    slim = docs.select("doc_id", "text")
    signed = _signed(spark, slim, p).withColumn("now", F.lit(True))
    if before is not None:
        old = before.select("doc_id", F.col("text").cast("string").alias("text"))
        slim = slim.select("doc_id", F.col("text").cast("string").alias("text")).unionByName(old)
        # numbers only: the texts are not shuffled to find those that changed
        other = (_signed(spark, old, p)
                 .join(signed.select("doc_id").distinct(), "doc_id", "left_semi")
                 .join(signed.select("doc_id", "text_hash"), ["doc_id", "text_hash"], "left_anti"))
        signed = signed.unionByName(other.withColumn("now", F.lit(False)))
    # one row per set: its smallest document names the class
    classes = stored(spark, signed.where(F.col("set_id").isNotNull()).groupBy("set_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")).alias("m"),
        F.first("n_shingles").alias("size"), F.first("keys").alias("keys"))
        # stored with the rows, so it stays the same number
        .select(F.monotonically_increasing_id().alias("class"), "set_id", F.col("m.doc_id").alias("doc_id"),
                F.col("m.text_hash").alias("text_hash"), "size", "keys"), "classes")
    buckets = classes.select("class", "size", F.explode("keys").alias("key"))
    near = F.least("size", "lead_size") * 100 >= F.greatest("size", "lead_size") * p.percent
    counts = buckets.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    shared = stored(spark, buckets.join(counts, "key"), "buckets")
    # the class that meets the most others leads: in a group of near copies that
    # is the text they were made from, which is linked to nearly all of them
    degree = shared.groupBy("class").agg(F.sum("n").alias("degree"))
    ranked = shared.join(degree, "class")
    leaders = ranked.groupBy("key").agg(F.max(F.struct("degree", "class", "size")).alias("lead")) \
        .select("key", F.col("lead.class").alias("a"), F.col("lead.size").alias("lead_size"))
    full = stored(spark, shared.join(leaders, "key")
                  .select("key", "a", F.col("class").alias("b"), "size", "lead_size"), "buckets")
    star = full.where((F.col("a") != F.col("b")) & near).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    if before is not None:  # the texts of one document are one component in any case
        of_doc = stored(spark, signed.where("doc_id IS NOT NULL").join(
            classes.select("set_id", "class"), "set_id").select("doc_id", "class").distinct(),
            "texts-of-doc")
        first = of_doc.groupBy("doc_id").agg(F.min("class").alias("a"))
        same_doc = stored(spark, of_doc.join(first, "doc_id").select(
            "a", F.col("class").alias("b")).where("a < b").distinct(), "same-doc")
        star = star.join(same_doc, ["a", "b"], "left_anti")
    ends = star.select(F.col("a").alias("class")).union(star.select("b")).distinct()
    sets = _sets(spark, ends, classes, slim, p)
    edges = stored(spark, _links(_within_reach(star, sets, p), sets, p), "links")
    if before is not None:
        edges = edges.union(same_doc)
    label = components(spark, edges)
    # buckets in which several components meet
    placed = stored(spark, full.join(label, F.col("b") == F.col("node"), "left").select(
        "key", "a", "b", "size", F.coalesce("component", "b").alias("component")), "placed")
    mixed = (placed.groupBy("key").agg(F.min("component").alias("lo"),
                                       F.max("component").alias("hi"), F.count("*").alias("n"))
             .where((F.col("lo") != F.col("hi")) & (F.col("n") > 2)).select("key"))
    open_ = placed.join(mixed, "key")
    sets = _sets(spark, open_.select(F.col("b").alias("class")).distinct(), classes, slim, p)
    lead = open_.where(F.col("a") == F.col("b")).select("key", F.col("component").alias("main"))
    sides = open_.join(lead, "key").groupBy(F.col("b").alias("class"), "component").agg(
        F.max(F.col("component") != F.col("main")).alias("outside"))
    rest = stored(spark, _candidates(sides, sets, p).join(star, ["a", "b"], "left_anti"),
                  "candidates")
    more = stored(spark, _links(_within_reach(rest, sets, p), sets, p), "links")
    if not more.isEmpty():
        label = components(spark, edges.union(more))
    named = classes.join(label, F.col("class") == F.col("node"), "left").select(
        "set_id", F.col("doc_id").alias("first_doc"),
        F.coalesce("component", "class").alias("component"))
    smallest = named.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    return signed, named.join(smallest, "component").select("set_id", "first_doc", "component_id")


def near_duplicates(docs: DataFrame, p: Params = Params(),
                    before: DataFrame | None = None) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` per row."""
    signed, classes = link(docs, p, before)
    return (signed.join(classes, "set_id", "left")
            .withColumn("component_id", F.coalesce("component_id", "doc_id"))
            .select("doc_id", "n_shingles", "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
                    "text_hash", "set_id", "now"))


def _either_text(docs: DataFrame, before: DataFrame, p: Params) -> DataFrame:
    """``doc_id``, ``text_hash``, ``set_id`` and ``kept`` of the rows of ``docs``, linked by
    their texts and by those of ``before``: kept is the smallest document of a component
    that still has a shingle."""
    spark = docs.sparkSession
    found = stored(spark, near_duplicates(docs, p, before), "found")
    had = found.where("n_shingles > 0").select(F.col("doc_id").alias("had")).distinct()
    rows = (found.where("now")
            .withColumn("component", F.col("component_id"))
            .join(had, F.col("doc_id") == F.col("had"), "left"))
    full = F.col("n_shingles") > 0
    keeper = rows.where(full).groupBy(F.col("component").alias("of")).agg(
        F.min("doc_id").alias("keeper"))
    return (rows.join(keeper, F.col("component").eqNullSafe(F.col("of")), "left")
            .withColumn("kept", F.when(full, F.col("doc_id").eqNullSafe(F.col("keeper")))
                        .otherwise(F.col("had").isNull())))


def drop_duplicates(docs: DataFrame, p: Params = Params(),
                    before: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component (one of
    repeated rows), and all without a shingle.

    ``before`` (``doc_id``, ``text``) holds texts as they were before some step
    changed them.  Documents are then linked by either text, and one without a
    shingle goes if it had one before.
    """
    spark = docs.sparkSession
    found = stored(spark, near_duplicates(docs, p) if before is None
                   else _either_text(docs, before, p), "found")
    each = stored(spark, found.groupBy("doc_id", "text_hash").agg(
        F.max("kept").alias("kept"), F.count("*").alias("n"),
        F.max(F.col("set_id").isNotNull()).alias("linked")), "found")
    # a row whose bit is not set stays for certain, and its text is not shuffled
    doubt = each.where(~F.col("kept") | (F.col("linked") & (F.col("n") > 1)))
    bits = F.broadcast(_bitmap(doubt.select(F.xxhash64("doc_id", "text_hash").alias("hash"))))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")) \
        .withColumn("_tm_text", F.xxhash64("row.text")) \
        .withColumn("_tm_hash", F.xxhash64("row.doc_id", "_tm_text")) \
        .join(bits, _on_page("_tm_hash"), "left") \
        .withColumn("_tm_doubt", F.coalesce(_bit_set("_tm_hash"), F.lit(False)))
    keep = each.where("kept").select(F.col("doc_id").alias("_tm_id"),
                                     F.col("text_hash").alias("_tm_kept"), "linked")
    stay = rows.where("_tm_doubt").join(keep, F.col("row.doc_id").eqNullSafe(F.col("_tm_id"))
                                        & (F.col("_tm_text") == F.col("_tm_kept")))
    once = stay.where("linked").dropDuplicates(["_tm_id", "_tm_kept"])
    out = rows.where("NOT _tm_doubt").select("row").unionByName(once.select("row"))
    return out.unionByName(stay.where("NOT linked").select("row")).select("row.*")
