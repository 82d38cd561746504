"""Packing: shortest-pack-first over the length histogram.

Documents are tokenised, closed with an end id and cut into pieces of at most
``size`` tokens.  Only the histogram of piece lengths (at most ``size`` rows)
goes to the driver.  Lengths are placed longest first; each goes to the open
pack with the most room, and equal packs are handled together by their count, so
the plan has a few placements per length however many documents there are.  A
placement says: the pieces of length L with ranks lo..hi go to sequences from
``seq`` on, so many in each, at ``offset``.  Ranking the pieces of each length (in bounded
buckets, for a length may hold most rows) and joining the placements by rank
gives every piece its place.

Token ids equal those of the ``tokenizers`` file.

Defined cases: a null or empty text is the end id alone; repeated rows are
packed each; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textmap import map_texts, stored

SIZE = 2048
END_ID = 1
#: Pieces ranked in one window task, about.
RANK_ROWS = 1024
#: White-space run from which on a text goes through the tokenizer itself: the
#: faster one's pattern overflows its stack somewhat above 10^6 signs.
LONG_BLANK = 100_000
_BLANK = re.compile(r"\s+")


def long_blank(text: str) -> bool:
    """Whether a run of white space has ``LONG_BLANK`` signs or more; each sign is
    looked at once, and only in texts that long."""
    return len(text) >= LONG_BLANK and any(
        m.end() - m.start() >= LONG_BLANK for m in _BLANK.finditer(text))


class Encoder:
    """Ids of texts as packed little-endian 32-bit numbers.

    ``ranks`` is the vocabulary file beside the tokenizer's own and gives the
    same ids several times faster; a text that holds a special token of the
    tokenizer or a very long run of white space (``LONG_BLANK``) goes through the
    tokenizer itself.
    """

    def __init__(self, tokenizer: str, ranks: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.own = Tokenizer.from_file(tokenizer)
        self.special = [t.content for t in self.own.get_added_tokens_decoder().values()]
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table,
                                      special_tokens={}).encode_ordinary

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special) or long_blank(text):
            return array("I", self.own.encode(text, add_special_tokens=False).ids).tobytes()
        return array("I", self.fast(text)).tobytes()


def cut(data: bytes, size: int) -> list[tuple[int, int, bytes]]:
    """``(start, length, ids)`` of the pieces of one document."""
    step = 4 * size
    return [(lo // 4, len(part) // 4, part)
            for lo in range(0, len(data), step) for part in (data[lo:lo + step],)]


def tokenized_pieces(docs: DataFrame, tokenizer: str, ranks: str, pattern: str,
                     size: int = SIZE, with_ids: bool = True, text: str = "text") -> DataFrame:
    """``row`` plus ``start``, ``length``, ``doc_tokens``, ``ids_crc32`` and, if
    asked for, ``ids`` of every piece."""
    kinds = [("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
             ("ids_crc32", pa.int64()), *([("ids", pa.list_(pa.int32()))] if with_ids else [])]
    longs = [T.StructField(n, T.LongType()) for n, _ in kinds[:4]]
    schema = T.StructType([*longs, *([T.StructField("ids", T.ArrayType(T.IntegerType()))]
                                     if with_ids else [])])
    end = array("I", [END_ID]).tobytes()

    def make():
        encoder = Encoder(tokenizer, ranks, pattern)

        def run(texts: list) -> tuple:
            out = []
            for t in texts:
                data = encoder.encode(t or "") + end
                rows = []
                for start, length, part in cut(data, size):
                    r = {"start": start, "length": length, "doc_tokens": len(data) // 4,
                         "ids_crc32": zlib.crc32(part)}
                    if with_ids:
                        r["ids"] = array("I", part).tolist()
                    rows.append(r)
                out.append(rows)
            return (pa.array(out, pa.list_(pa.struct(kinds))),)

        return run

    found = map_texts(docs, make, [T.StructField("pieces", T.ArrayType(schema))], text=text)
    return found.select("row", F.inline("pieces"))


@dataclass(frozen=True)
class Placement:
    """Pieces of ``length`` with ranks ``lo`` <= r < ``hi``: ``per`` of them, one
    behind the other from ``offset`` on, in each sequence from ``seq`` on."""
    length: int
    lo: int
    hi: int
    seq: int
    offset: int
    per: int = 1


def shortest_pack_first(histogram: dict[int, int], size: int = SIZE) -> list[Placement]:
    """Placements of all lengths of a histogram."""
    room: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]  # by room: (seq, count)
    top = 0  # no open pack has more room
    plan: list[Placement] = []
    n_seq = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            while top > 0 and not room[top]:
                top -= 1
            per = 1
            if top >= length:
                seq, packs = room[top].pop()
                if left < packs:
                    room[top].append((seq + left, packs - left))
                    packs = left
                free = top
            else:  # a new pack has the most room until the length no longer fits
                per = min(left, size // length)
                seq, packs, free = n_seq, left // per, size
                n_seq += packs
            plan.append(Placement(length, rank, rank + packs * per, seq, size - free, per))
            rank += packs * per
            left -= packs * per
            free -= length * per
            if free:
                room[free].append((seq, packs))
                top = max(top, free)
    return plan


def _ranked(spark: SparkSession, pieces: DataFrame, histogram: dict[int, int],
            order: list[str]) -> DataFrame:
    """``pieces`` with ``rank``, the 0-based place among those of one length.
    Buckets by hash keep each window small, also for a very common length."""
    sizes = spark.createDataFrame(sorted(histogram.items()), "length long, n_length long")
    dealt = (pieces.join(F.broadcast(sizes), "length")  # at most `size` rows
             .withColumn("bucket", F.pmod(F.xxhash64(*order),
                                          F.ceil(F.col("n_length") / RANK_ROWS))))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    first = (dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
             .select("length", "bucket",
                     F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    inside = Window.partitionBy("length", "bucket").orderBy(*order)
    return (dealt.withColumn("place", F.row_number().over(inside) - 1)
            .join(first, ["length", "bucket"])
            .withColumn("rank", F.col("first") + F.col("place"))
            .drop("bucket", "place", "first", "n_length"))


def place_pieces(spark: SparkSession, pieces: DataFrame, order: list[str],
                 size: int = SIZE) -> DataFrame:
    """``pieces`` (with ``length``) plus ``sequence_id`` and ``offset``.

    ``pieces`` is read three times, so pass a stored table; ``order`` names
    columns that tell its rows apart.
    """
    histogram = {r["length"]: r["n"] for r in
                 pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = shortest_pack_first(histogram, size)
    placements = spark.createDataFrame(
        [(p.length, p.lo, p.hi, p.seq, p.offset, p.per) for p in plan],
        "p_length long, lo long, hi long, seq long, at long, per long")
    nth = F.col("rank") - F.col("lo")
    ranked = _ranked(spark, pieces, histogram, order)
    # a few placements per length, whatever the number of pieces
    return (ranked.join(F.broadcast(placements),
                        (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("lo"))
                        & (F.col("rank") < F.col("hi")))
            .withColumn("sequence_id", F.col("seq") + F.expr("(rank - lo) div per"))
            .withColumn("offset", F.col("at") + nth % F.col("per") * F.col("length"))
            .drop("p_length", "lo", "hi", "seq", "at", "per", "rank"))


def pack(docs: DataFrame, tokenizer: str, ranks: str, pattern: str, size: int = SIZE,
         with_ids: bool = False, key: str = "doc_id") -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` (and ``ids`` if asked for)."""
    spark = docs.sparkSession
    cut_up = tokenized_pieces(docs.select(F.col(key).alias("doc_id"), "text"), tokenizer, ranks,
                              pattern, size, with_ids)
    pieces = stored(spark, cut_up.select(F.col("row.doc_id").alias("doc_id"), "start", "length",
                                         "ids_crc32", "doc_tokens", *(["ids"] * with_ids)),
                    "pieces")
    return place_pieces(spark, pieces, ["doc_id", "start", "ids_crc32", "doc_tokens"], size)
