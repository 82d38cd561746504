"""Best-fit packing: best-fit decreasing with a segment tree over remaining
capacities.

Documents are tokenised and closed with an end id; one that is longer than
``size`` is cut into pieces of ``size`` tokens, the last of which may be shorter.
Pieces are placed longest first, each into the open sequence with the least room
that still takes it.  A segment tree over the capacities 0..``size`` finds that
room in logarithmic time; its leaf holds the open sequences with that much room.

Pieces of one length are alike, so only the histogram of lengths (at most ``size``
rows) goes to the driver, and sequences with the same room are filled together: a
placement says which ranks of a length go to which sequences.  That is the result
of placing the pieces one by one: after a piece of length L went into the tightest
sequence, the rest of that sequence is the tightest room for the next piece of
length L as long as it fits.  A length opens or splits at most four groups of
sequences, and a sequence holds at most sqrt(2 ``size``) different lengths, so the
plan has at most 4 * ``size`` * sqrt(2 ``size``) placements whatever the number of
documents (some thousands in practice).  It is broadcast and joined to the ranked
pieces.

The ids are those of ``tokenizers``.  This vocabulary drops white space before it
splits a text, and no token and no composed character spans white space, so the
ids of a text are those of its parts between ASCII white space; each task
remembers the ids of the parts it has met, up to a bound.  Parts of plain signs are
split here and only their pieces go through the tokenizer's model.

Defined cases: a null, empty or blank text is the end id alone; repeated rows are
packed each; rows with a null id are packed like others; an empty table gives no
rows; the names of other columns do not matter.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .packing import END_ID, Placement, _ranked, cut
from .textmap import map_texts, stored

SIZE = 4096
#: Parts of texts, and pieces of them, a task remembers before it starts over.
PART_LIMIT = 500_000


#: Parts of printable ASCII, Latin-1 and Latin Extended-A signs (but for the one
#: whose lower case is two): composition leaves them alone, and their letters,
#: digits and lower cases are those of every Unicode version.
PLAIN = re.compile("[!-~\u00a1-\u012f\u0131-\u017f]*")
#: Normalisation of a tokenizer whose plain parts are split here.
KNOWN = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
         {"type": "Lowercase"}]


def byte_signs() -> dict[int, str]:
    """The printable sign of each byte in a byte-level vocabulary: printable Latin-1
    bytes are themselves, the others the signs from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + k) for k, b in enumerate(rest)}}


class _Known(dict):
    """A dict that makes the values it lacks and keeps those of short keys."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= 64:
            self[key] = value
        return value


class PartEncoder:
    """Ids of texts as packed little-endian 32-bit numbers.

    A plain part without a special token is lowered and split by the tokenizer's own
    pattern, and each new piece goes through the tokenizer's model; any other part
    goes through the whole tokenizer.
    """

    def __init__(self, tokenizer: str, limit: int = PART_LIMIT):
        import regex
        from tokenizers import Tokenizer

        with open(tokenizer, encoding="utf-8") as f:
            conf = json.load(f)
        self.own = Tokenizer.from_file(tokenizer)
        self.model = self.own.model
        self.special = [t.content for t in self.own.get_added_tokens_decoder().values()]
        steps = conf["pre_tokenizer"]["pretokenizers"]
        known = (conf["normalizer"] or {}).get("normalizers") == KNOWN and len(steps) == 2 \
            and (steps[0]["behavior"], steps[0]["invert"]) == ("Removed", True) \
            and (steps[1]["type"], steps[1]["use_regex"]) == ("ByteLevel", False) \
            and not steps[1]["add_prefix_space"]
        self.split = regex.compile(steps[0]["pattern"]["Regex"]).findall if known else None
        self.signs = byte_signs()
        self.limit = limit
        self.parts, self.pieces = _Known(self._part), _Known(self._piece)

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else \
            piece.encode("utf-8").decode("latin-1").translate(self.signs)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _part(self, part: bytes) -> bytes:
        text = part.decode("utf-8")
        if self.split is None or not PLAIN.fullmatch(text) or (
                "<" in text and any(s in text for s in self.special)):
            return array("I", self.own.encode(text, add_special_tokens=False).ids).tobytes()
        text = text.lower()
        if text.isalpha():
            return self.pieces[text]
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def encode(self, text: str) -> bytes:
        if len(self.parts) > self.limit:
            self.parts = _Known(self._part)
        if len(self.pieces) > self.limit:
            self.pieces = _Known(self._piece)
        return b"".join(map(self.parts.__getitem__, text.encode("utf-8").split()))


def tokenized_pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, with_ids: bool = False,
                     text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` plus ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for,
    ``ids`` of every piece."""
    kinds = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
             ("ids_crc32", pa.int64()), *([("ids", pa.list_(pa.int32()))] if with_ids else [])]
    schema = T.StructType([
        T.StructField("piece", T.IntegerType()),
        *[T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")],
        *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])])
    end = array("I", [END_ID]).tobytes()

    def make():
        encoder = PartEncoder(tokenizer)

        def run(texts: list) -> tuple:
            out = []
            for t in texts:
                pieces = cut(encoder.encode(t or "") + end, size)
                out.append([(n, start, length, zlib.crc32(part),
                             *([array("I", part).tolist()] if with_ids else []))
                            for n, (start, length, part) in enumerate(pieces)])
            return (pa.array(out, pa.list_(pa.struct(kinds))),)

        return run

    found = map_texts(docs, make, [T.StructField("pieces", T.ArrayType(schema))], text=text,
                      keep=keep)
    return found.select("row", F.inline("pieces"))


class OpenBins:
    """Groups of sequences with equal room, by room; ``tightest`` descends a
    segment tree that marks the ranges of capacities with an open sequence."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.marked = bytearray(2 * self.leaves)
        self.groups: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]

    def push(self, room: int, seq: int, count: int) -> None:
        self.groups[room].append((seq, count))
        node = room + self.leaves
        while node and not self.marked[node]:
            self.marked[node] = 1
            node >>= 1

    def pop(self, room: int) -> tuple[int, int]:
        group = self.groups[room].pop()
        node = room + self.leaves
        if not self.groups[room]:
            self.marked[node] = 0
            node >>= 1
            while node and not (self.marked[2 * node] or self.marked[2 * node + 1]):
                self.marked[node] = 0
                node >>= 1
        return group

    def tightest(self, length: int) -> int | None:
        """Least room of at least ``length`` that an open sequence has."""
        node = length + self.leaves
        if not self.marked[node]:
            while node > 1 and (node & 1 or not self.marked[node + 1]):
                node >>= 1  # up until the sibling to the right holds something
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.marked[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_decreasing(histogram: dict[int, int], size: int = SIZE) -> list[Placement]:
    """Placements of all lengths of a histogram."""
    bins = OpenBins(size)
    plan: list[Placement] = []
    n_seq = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = bins.tightest(length)
            if room is None:
                room = size
                per = min(left, room // length)
                seq, packs = n_seq, left // per
                n_seq += packs
            else:
                seq, packs = bins.pop(room)
                per = min(left, room // length)
                used = min(packs, left // per)
                if used < packs:
                    bins.push(room, seq + used, packs - used)
                packs = used
            plan.append(Placement(length, rank, rank + packs * per, seq, size - room, per))
            rank += packs * per
            left -= packs * per
            if room > per * length:
                bins.push(room - per * length, seq, packs)
    return plan


def place_pieces(spark: SparkSession, pieces: DataFrame, uid: str, size: int = SIZE) -> DataFrame:
    """``pieces`` (with ``length``) plus ``sequence_id`` and ``offset``.

    ``pieces`` is read three times, so pass a stored table; ``uid`` names a column
    with a number of its own for each row, so equal rows spread over tasks.
    """
    histogram = {r["length"]: r["n"] for r in
                 pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    placements = spark.createDataFrame(
        [(p.length, p.lo, p.hi, p.seq, p.offset, p.per)
         for p in best_fit_decreasing(histogram, size)],
        "p_length long, lo long, hi long, seq long, at long, per long")
    nth = F.col("rank") - F.col("lo")
    return (_ranked(spark, pieces, histogram, [uid])
            .join(F.broadcast(placements),  # bounded by ``size`` alone, see above
                  (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("lo"))
                  & (F.col("rank") < F.col("hi")))
            .withColumn("sequence_id", F.col("seq") + F.expr("(rank - lo) div per"))
            .withColumn("offset", F.col("at") + nth % F.col("per") * F.col("length"))
            .drop("p_length", "lo", "hi", "seq", "at", "per", "rank"))


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, with_ids: bool = False,
         key: str = "doc_id") -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset`` (and ``ids`` if asked for)."""
    spark = docs.sparkSession
    cut_up = tokenized_pieces(docs.select(F.col(key).alias("doc_id"), "text"), tokenizer, size,
                              with_ids, keep=["doc_id"])
    pieces = stored(spark, cut_up.select(
        F.col("row.doc_id").alias("doc_id"), "piece", "start", "length", "ids_crc32",
        *(["ids"] * with_ids), F.monotonically_increasing_id().alias("uid")), "bestfit-pieces")
    return place_pieces(spark, pieces, "uid", size).drop("uid")
