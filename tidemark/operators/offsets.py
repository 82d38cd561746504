"""Offset ranges of a replay, and offsets that are missing from a log.

A range takes the two forms a topic source knows: ``"earliest"`` / ``"latest"``, or
offsets per topic and partition, ``{"topic": {"0": 23, "1": -2}}`` (also as JSON
text), where -2 is the earliest and -1 the latest offset.  Starts are inclusive, ends
exclusive.  The ranges become a filter on topic, partition and offset that reaches the
scan.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EARLIEST, LATEST = -2, -1
#: Offsets whose neighbours are compared in one window task at most.
GAP_WIDTH = 1 << 20
Offsets = str | Mapping[str, Mapping[str, int]]
#: (topic, partition) -> first offset, offset after the last; None: no bound.
Ranges = dict[tuple[str, int], tuple[int | None, int | None]]


class LostOffsets(ValueError):
    """Offsets of a requested range that the log does not hold any more."""


def parse_offsets(offsets: Offsets, end: bool = False) -> dict[tuple[str, int], int | None] | None:
    """Offsets per topic and partition (None: no bound); None for a bound that leaves
    everything in.  ``latest`` as a start, or ``earliest`` as an end, leaves nothing of a
    replay and raises."""
    if isinstance(offsets, str):
        word = offsets.strip()
        if word == ("latest" if end else "earliest"):
            return None
        if word in ("latest", "earliest"):
            raise ValueError(f"a replay can't {'end' if end else 'start'} at {word}")
        offsets = json.loads(word)
    out: dict[tuple[str, int], int | None] = {}
    for topic, parts in offsets.items():
        for part, at in parts.items():
            if at in (EARLIEST, LATEST):
                if (at == LATEST) != end:
                    raise ValueError(f"a replay can't {'end' if end else 'start'} at {at}")
                at = None
            elif at < 0:
                raise ValueError(f"offset {at} of {topic}-{part}")
            out[(topic, int(part))] = at
    return out


def offset_ranges(starting: Offsets = "earliest", ending: Offsets = "latest") -> Ranges | None:
    """One range per topic-partition that either bound names; None: everything.  If both
    name partitions, they must name the same ones."""
    lo, hi = parse_offsets(starting), parse_offsets(ending, end=True)
    if lo is None and hi is None:
        return None
    if lo is not None and hi is not None and lo.keys() != hi.keys():
        raise ValueError(f"starting and ending offsets differ in {sorted(lo.keys() ^ hi.keys())}")
    return {k: ((lo or {}).get(k), (hi or {}).get(k)) for k in (lo if lo is not None else hi)}


def in_ranges(ranges: Ranges) -> Column:
    """Filter of the records of the ranges, one disjunct per topic-partition; the
    topics also as a list, for sources that take a list only."""
    def one(topic: str, part: int, lo: int | None, hi: int | None) -> Column:
        c = (F.col("topic") == topic) & (F.col("partition") == part)
        c = c if lo is None else c & (F.col("offset") >= lo)
        return c if hi is None else c & (F.col("offset") < hi)

    if not ranges:
        return F.lit(False)
    either = reduce(lambda a, b: a | b, [one(t, p, lo, hi) for (t, p), (lo, hi) in ranges.items()])
    return F.col("topic").isin(sorted({t for t, _ in ranges})) & either


def _wanted(records: DataFrame, ranges: Ranges) -> DataFrame:
    """The literal ranges as rows (as many as the caller named)."""
    return records.sparkSession.createDataFrame(
        [(t, p, lo, hi) for (t, p), (lo, hi) in ranges.items()],
        "topic string, partition int, lo long, hi long")


def offset_gaps(records: DataFrame, starting: Offsets = "earliest", ending: Offsets = "latest",
                width: int = GAP_WIDTH) -> DataFrame:
    """``topic``, ``partition``, ``first_missing``, ``last_missing``, ``missing``: stretches of
    offsets that the log lacks between its first and last one, and from a named start
    or to a named end.  A named partition without any record lacks its whole range, if
    both ends are named.

    Islands are found in buckets of ``width`` offsets, so a topic-partition with a third
    of all records makes no large task; the borders of the buckets (records / width
    rows) are compared in a second step.
    """
    ranges = offset_ranges(starting, ending)
    rows = records if ranges is None else records.where(in_ranges(ranges))
    group = ["topic", "partition"]
    rows = rows.select(*group, "offset", F.expr(f"offset div {int(width)}").alias("bucket"))
    inside = Window.partitionBy(*group, "bucket").orderBy("offset")
    stepped = rows.withColumn("before", F.lag("offset").over(inside))
    within = stepped.where(F.col("offset") > F.col("before") + 1).select(
        *group, (F.col("before") + 1).alias("first_missing"),
        (F.col("offset") - 1).alias("last_missing"))
    edges = rows.groupBy(*group, "bucket").agg(F.min("offset").alias("lo"),
                                               F.max("offset").alias("hi"))
    across = Window.partitionBy(*group).orderBy("bucket")
    between = (edges.withColumn("before", F.lag("hi").over(across))
               .where(F.col("lo") > F.col("before") + 1)
               .select(*group, (F.col("before") + 1).alias("first_missing"),
                       (F.col("lo") - 1).alias("last_missing")))
    out = within.unionByName(between)
    if ranges is not None:
        ends = edges.groupBy(*group).agg(F.min("lo").alias("first"), F.max("hi").alias("last"))
        named = _wanted(records, ranges).join(ends, group, "left")
        head = named.select(*group, F.col("lo").alias("first_missing"),
                            (F.coalesce("first", "hi") - 1).alias("last_missing"))
        tail = named.where("last IS NOT NULL").select(
            *group, (F.col("last") + 1).alias("first_missing"),
            (F.col("hi") - 1).alias("last_missing"))
        out = out.unionByName(head).unionByName(tail)
    return (out.where(F.col("first_missing") <= F.col("last_missing"))
            .withColumn("missing", F.col("last_missing") - F.col("first_missing") + 1))


def replay_range(records: DataFrame, starting: Offsets = "earliest", ending: Offsets = "latest",
                 fail_on_data_loss: bool = True) -> DataFrame:
    """Records of the ranges, batch or stream.  A batch with ``fail_on_data_loss`` raises if
    the log lacks offsets of the ranges (aged out, or lost in between)."""
    ranges = offset_ranges(starting, ending)
    if fail_on_data_loss and not records.isStreaming:
        lost = [f"{r['topic']}-{r['partition']}: {r['first_missing']} to {r['last_missing']}"
                for r in offset_gaps(records, starting, ending)
                .orderBy("topic", "partition", "first_missing").limit(5).collect()]
        if lost:
            raise LostOffsets("offsets missing from the log: " + "; ".join(lost))
    return records if ranges is None else records.where(in_ranges(ranges))
