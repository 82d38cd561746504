"""CSV records with line breaks in quoted values, read in splits.

Spark's own multi-line reader gives a file to one task.  Here files are read as
lines in splits of ordinary size, and a record is put together from its lines:

1. Whether a line starts inside a quoted value depends on the lines before it.  As
   seen from a line, there are two cases, so a line maps "closed or open before" to
   "closed or open after", and a split does the same.  One pass gives each split's
   map and the parts of records at its two ends, for both cases: one row per split.
2. Over the splits of a file in order, the maps give the true state at every split's
   start, and the parts at the ends the records that cross a border.
3. When rows are read, each split glues the lines of the records that lie inside it,
   from its state on; the records that cross borders are added.

Steps 1 and 3 look at the lines of a split in order, which no built-in function does
without shuffling all lines; they run on Arrow batches, with no shuffle, and touch
only lines with quotes one by one.  A file in which no line ends inside a quoted
value needs none of it: ``scan_borders`` says so, and Spark's line reader is used.

A quoted value opens at the start of a field; quotes are doubled inside it; text
after its closing quote belongs to the field.  Quotes inside an unquoted field mean
nothing.  Lines end with a line feed, one carriage return before it is not part of
the record; blank records are skipped; each file starts with its header.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: Characters of a record's part at the end of a split that are kept by the pass over
#: the borders.
PART_CHARS = 4_000_000
#: Rows of the table of splits that are broadcast (some 50 MB).
BROADCAST_SPLITS = 1_000_000

BORDERS = ("file long, start long, after_closed boolean, after_open boolean, breaks boolean, "
           "head string, tail_closed string, tail_open string, header string")


class UnclosedQuote(ValueError):
    """A quoted value that does not end."""


def line_effect(sep: str) -> Callable[[str], tuple[bool, bool]]:
    """State after a line that starts (closed, open)."""
    s = re.escape(sep)
    field = rf'(?:"(?:[^"]|"")*+"[^{s}]*+|(?!")[^{s}]*+)'
    closed = re.compile(rf"{field}(?:{s}{field})*+", re.S).fullmatch
    ends = re.compile(r'(?:[^"]|"")*+"', re.S).match
    rest = re.compile(rf"[^{s}]*+(?:{s}{field})*+", re.S).fullmatch

    def effect(line: str) -> tuple[bool, bool]:
        end = ends(line)
        return not closed(line), end is None or not rest(line, end.end())

    return effect


class _Case:
    """One of the two cases of a split: its state, and the part of a record it is in."""

    def __init__(self, open_: bool):
        self.open, self.part, self.size, self.too_long = open_, [], 0, False
        self.head: str | None = None
        self.in_head = open_

    def add(self, lines: list) -> None:
        if self.open and not self.too_long:
            self.part.extend(lines)
            self.size += sum(map(len, lines)) + len(lines)
            if self.size > PART_CHARS:
                self.too_long, self.part = True, []

    def step(self, line: str, after: bool) -> None:
        was, self.open = self.open, True
        if not was:
            self.part, self.size, self.too_long = [], 0, False
        if was or after:
            self.add([line])
        self.open = after
        if not after and self.in_head:
            self.head = None if self.too_long else "\n".join(self.part)
            self.in_head = False

    @property
    def tail(self) -> str | None:
        whole = self.open and not self.in_head and not self.too_long
        return "\n".join(self.part) if whole else None


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, int]]:
    """Rows ``lo`` to ``hi`` of a batch that are of one split, with its key."""
    files, starts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    cuts = ((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])).nonzero()[0] + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for lo, hi in zip(edges, edges[1:]):
        if hi > lo:
            yield (int(files[lo]), int(starts[lo])), lo, hi


def _quoted(batch: pa.RecordBatch, lo: int, hi: int) -> list[int]:
    has = pc.match_substring(batch.column(2).slice(lo, hi - lo), '"')
    return (pc.indices_nonzero(has).to_numpy() + lo).tolist()


def _borders(sep: str):
    """Batch function: one row of ``BORDERS`` per split."""
    def run(batches: Iterable[pa.RecordBatch]):
        effect = line_effect(sep)
        rows: list[dict] = []
        key, cases, header, first, breaks = None, [], None, [], False

        def close() -> None:
            a, b = cases
            rows.append({
                "file": key[0], "start": key[1], "after_closed": a.open, "after_open": b.open,
                "breaks": breaks, "head": b.head, "tail_closed": a.tail, "tail_open": b.tail,
                "header": header})

        for batch in batches:
            lines = batch.column(2).to_pylist()
            for found, lo, hi in _stretches(batch):
                if found != key:
                    if key is not None:
                        close()
                    key, cases = found, [_Case(False), _Case(True)]
                    header, first, breaks = None, [], False
                at = lo
                for q in [*_quoted(batch, lo, hi), hi]:
                    plain = lines[at:q]
                    for c in cases:
                        c.add(plain)
                    if header is None and key[1] == 0:  # the first record of the file
                        if first:
                            first.extend(plain)
                        else:
                            header = next((x for x in plain if x.strip()), None)
                    if q < hi:
                        effect_ = effect(lines[q])
                        for c in cases:
                            c.step(lines[q], effect_[c.open])
                        breaks = breaks or effect_[0]
                        if header is None and key[1] == 0:
                            first.append(lines[q])
                            if not cases[0].open:
                                header = "\n".join(first)
                    at = q + 1
        if key is not None:
            close()
        schema = pa.schema([(n, {"long": pa.int64(), "boolean": pa.bool_(),
                                 "string": pa.string()}[t])
                            for n, t in (c.split() for c in BORDERS.split(", "))])
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def _records(sep: str):
    """Batch function: the records that lie inside a split, one row each."""
    def run(batches: Iterable[pa.RecordBatch]):
        effect = line_effect(sep)
        key, open_, inside, part, skip = None, False, False, [], False
        for batch in batches:
            lines = batch.column(2).to_pylist()
            out: list = []
            for found, lo, hi in _stretches(batch):
                if found != key:
                    key, part = found, []
                    state = batch.column(3)[lo].as_py()
                    if state is None:
                        raise RuntimeError("the files were split differently in two passes; "
                                           "set spark.sql.files.minPartitionNum and read again")
                    open_, inside, skip = state, not state, key[1] == 0
                at = lo
                for q in [*_quoted(batch, lo, hi), hi]:
                    plain = lines[at:q]
                    if open_:
                        part.extend(plain if inside else ())
                    elif skip:
                        at = next((i for i, x in enumerate(plain) if x.strip()), None)
                        if at is not None:  # the header
                            out.extend(plain[at + 1:])
                            skip = False
                    else:
                        out.extend(plain)
                    if q < hi:
                        open_ = effect(lines[q])[open_]
                        if inside:
                            part.append(lines[q])
                        if not open_:
                            if inside and not skip:
                                out.append("\n".join(part))
                            inside, skip, part = True, False, []
                    at = q + 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["record"])

    return run


def _lines(spark: SparkSession, paths: Sequence[str], glob: str | None) -> DataFrame:
    reader = spark.read.option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(list(paths)).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"), "value")


@dataclass(frozen=True)
class Borders:
    """What the pass over the splits found: the splits, the records that cross their
    borders, whether a line may end inside a quoted value, and whether the files are
    beyond this reader (a record that fills a whole split, a part beyond
    ``PART_CHARS``, more splits than are broadcast): then the unsplit one reads them."""
    splits: DataFrame
    crossing: DataFrame
    breaks: bool
    unsplit: bool


def scan_borders(spark: SparkSession, paths: Sequence[str], sep: str = ",",
                 glob: str | None = None) -> Borders:
    """One pass over the files; raises for headers that differ and for a quoted value
    that does not end in its file."""
    path = scratch_path(spark, "csv-splits")
    _lines(spark, paths, glob).mapInArrow(_borders(sep), BORDERS).write.parquet(path)
    found = spark.read.schema(BORDERS).parquet(path)
    in_order = Window.partitionBy("file").orderBy("start")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    flip = (F.col("after_closed") & ~F.col("after_open")).cast("int")
    # the last split before whose end does not depend on its start, and the flips since
    fixed = F.when(F.col("after_closed") == F.col("after_open"),
                   F.struct("start", F.col("after_closed").cast("int").alias("state"), "flips"))
    at = (found.withColumn("flips", F.sum(flip).over(in_order))
          .withColumn("known", F.max(fixed).over(before))
          .withColumn("so_far", F.coalesce(F.sum(flip).over(before), F.lit(0)))
          .withColumn("open", (F.coalesce(F.col("known.state"), F.lit(0)) + F.col("so_far")
                               - F.coalesce(F.col("known.flips"), F.lit(0))) % 2 == 1))
    at = (at.withColumn("ends_open", F.when(F.col("open"), F.col("after_open"))
                        .otherwise(F.col("after_closed")))
          .withColumn("tail", F.when(F.col("open"), F.col("tail_open"))
                      .otherwise(F.col("tail_closed")))
          .withColumn("next_head", F.lead("head").over(in_order))
          .withColumn("last", F.lead("start").over(in_order).isNull()))
    lost = F.col("ends_open") & ~F.col("last") & (
        F.col("tail").isNull() | F.col("next_head").isNull())
    no_header = (F.col("start") == 0) & F.col("header").isNull() & ~F.col("last")
    n, breaks, unsplit, unclosed, headers = at.agg(
        F.count(F.lit(1)), F.max("breaks"), F.max(lost | no_header),
        F.max(F.col("ends_open") & F.col("last")),
        F.count_distinct(F.when(F.col("start") == 0, F.rtrim(F.coalesce("header", F.lit("")),
                                                             F.lit("\r"))))).first()
    if unclosed:
        raise UnclosedQuote("a quoted value does not end in its file")
    if headers > 1:
        raise ValueError("the files of a source differ in their header")
    crossing = at.where("ends_open").select(
        F.concat_ws("\n", "tail", "next_head").alias("record"))
    return Borders(at.select("file", "start", "open"), crossing, bool(breaks),
                   bool(unsplit) or n > BROADCAST_SPLITS)


def read_records(spark: SparkSession, paths: Sequence[str], borders: Borders, sep: str = ",",
                 glob: str | None = None) -> DataFrame:
    """``record``: the text of every record but the headers."""
    # at most BROADCAST_SPLITS rows; the lines stay where and in the order they are
    lines = (_lines(spark, paths, glob)
             .join(F.broadcast(borders.splits), ["file", "start"], "left")
             .select("file", "start", "value", "open"))
    inside = lines.mapInArrow(_records(sep), "record string")
    record = F.regexp_replace("record", "\r$", "")
    return (inside.unionByName(borders.crossing).select(record.alias("record"))
            .where(F.trim("record") != ""))
