"""Packing closed batches of a lake into files of a good size.

A stream that writes a batch every ten seconds makes three million folders a year,
which each read would list.  ``pack_batches`` rewrites the closed ones (all ids below
one that the checkpoint has passed) as one pack: a folder whose files hold the rows
of many batches, sorted by ``batch_id``, so row groups of other batches are skipped.

The steps survive a crash at any point.  The pack is written under a new name and
nobody reads it until a note names it; the note is written whole or not at all.  From
then on the pack stands for its batches, and their folders are ignored.  They are
deleted by the next packing (or ``drop_packed_folders``), so a reader that planned
before has that long to end.  One packing runs at a time.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, list_names, write_note
from ..sources.lake import (PACK_NOTES, PACKED, Pack, pack_names, read_lake, read_packs,
                            schema_notes)

#: Notes kept besides the newest, for readers that listed them before.
OLD_NOTES = 2


def _folders(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[9:]) for n in list_names(spark, path) if n.startswith("batch_id="))


def closed_below(spark: SparkSession, checkpoint: str) -> int:
    """First batch id that a stream may still write: the one after the newest batch
    in the checkpoint's commit log (0 without one)."""
    done = [int(n) for n in list_names(spark, f"{checkpoint.rstrip('/')}/commits") if n.isdigit()]
    return max(done, default=-1) + 1


def drop_packed_folders(spark: SparkSession, path: str) -> int:
    """Delete the folders of batches that are in a pack, packs that no note names
    and old notes; returns the folders of batches deleted."""
    packs, root = read_packs(spark, path), path.rstrip("/")
    old = [b for b in _folders(spark, path) if any(k.lo <= b <= k.hi for k in packs)]
    for b in old:
        delete_path(spark, f"{root}/batch_id={b}")
    named = {k.name for k in packs}
    for name in list_names(spark, f"{root}/{PACKED}"):
        if name not in named:
            delete_path(spark, f"{root}/{PACKED}/{name}")
    for name in pack_names(spark, path)[:-1 - OLD_NOTES]:
        delete_path(spark, f"{root}/{PACK_NOTES}/{name}")
    return len(old)


def _written(df: DataFrame, folder: str) -> int:
    """``df`` in files of a good size, whole batches together where they fit; a batch
    larger than that is split.  Returns the rows."""
    obs = Observation("packed")
    (df.hint("rebalance", F.col("batch_id")).sortWithinPartitions("batch_id")
     .observe(obs, F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").parquet(folder))
    return obs.get["rows"]


def pack_batches(spark: SparkSession, path: str, below: int) -> Pack | None:
    """Pack the batches with ids below ``below`` that are in no pack yet; None if
    there are none.  ``below`` is a batch that the stream's checkpoint has passed, so
    none of them is written again (the lake's writers refuse it).  All batches need a
    schema note, as this library writes them.  Batches of changed columns or types
    are packed in their common schema."""
    if not schema_notes(spark, path):
        raise ValueError(f"{path} has no schema notes: only lakes of this library are packed")
    drop_packed_folders(spark, path)
    packs = read_packs(spark, path)
    ids = [b for b in _folders(spark, path) if 0 <= b < below]
    if not ids:
        return None
    # packs don't overlap: ids between two packs, if any, are a pack of their own
    lo = ids[0]
    hi = min([k.lo for k in packs if k.lo > lo] + [below]) - 1
    rows = read_lake(spark, path, upto=-1).where(F.col("batch_id").between(lo, hi))
    name = f"{lo:020d}-{hi:020d}-{uuid.uuid4().hex}"
    n = _written(rows, f"{path.rstrip('/')}/{PACKED}/{name}")
    if n != rows.count():
        raise RuntimeError(f"batches {lo} to {hi} of {path} changed while they were packed")
    pack = Pack(lo, hi, name, rows.drop("batch_id").schema)
    note = sorted([*packs, pack], key=lambda k: k.lo)
    names = pack_names(spark, path)
    order = max(time.time_ns(), int(names[-1][:-5]) + 1 if names else 0)
    write_note(spark, f"{path.rstrip('/')}/{PACK_NOTES}/{order:020d}.json", json.dumps(
        [{"lo": k.lo, "hi": k.hi, "name": k.name, "schema": k.schema.jsonValue()} for k in note]))
    return pack
