"""Lake table reads: whole table, versions, history.

Layout written by ``streaming.sinks.write_lake_batch``: one folder per
micro-batch, ``<lake>/batch_id=<n>/part-*.parquet``.  The batch id is a
partition column, so version reads prune folders instead of scanning them.  A
batch is there once its write job has committed its files; a crash before that
leaves only a ``_temporary`` folder, which no reader looks at, and the replay
overwrites the folder.  With the Delta jar present, ``fmt="delta"`` reads a Delta
table instead.

Columns and types may change from batch to batch.  ``<lake>/_schemas`` holds a note
for each change: "from batch n on the schema is S" (one note per change, not per
batch), written before the batch.  A read folds the schemas of all notes into their
least common one (``operators.evolution``), so no footer is opened to plan it, and
every column ever written is there.  Batches whose schemas only lack columns are
one scan; a group of batches with another type in a column is read under its own
schema, cast and stacked by name.

Stretches of closed batches may be packed (``operators.compaction``):
``<lake>/_packed/<name>`` holds the rows of many batches in files of a good size, with
``batch_id`` as a column, and the newest note of ``<lake>/_packs`` lists all packs.
A batch inside a pack is read from there; a folder of it that is still there is not
looked at.
"""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.evolution import agrees, common_schema, conform, nullable
from ..session import list_names, read_note, write_note

NOTES = "_schemas"
PACK_NOTES = "_packs"
PACKED = "_packed"
BATCH = T.StructField("batch_id", T.LongType())


@dataclass(frozen=True)
class SchemaNote:
    """Batches ``lo`` to ``hi`` (None: all later ones, too) have ``schema``, unless a
    later note says otherwise."""
    lo: int
    hi: int | None
    schema: T.StructType
    order: int = 0

    def covers(self, batch_id: int) -> bool:
        return self.lo <= batch_id and (self.hi is None or batch_id <= self.hi)


@dataclass(frozen=True)
class Pack:
    """Batches ``lo`` to ``hi`` are in the folder ``name``, all in ``schema``."""
    lo: int
    hi: int
    name: str
    schema: T.StructType


def pack_names(spark: SparkSession, path: str) -> list[str]:
    """Notes about packs, oldest first."""
    return [n for n in list_names(spark, f"{path.rstrip('/')}/{PACK_NOTES}")
            if n.endswith(".json")]


def read_packs(spark: SparkSession, path: str) -> list[Pack]:
    """All packs of a lake, in order of their batches: one listing and one note."""
    names = pack_names(spark, path)
    if not names:
        return []
    note = json.loads(read_note(spark, f"{path.rstrip('/')}/{PACK_NOTES}/{names[-1]}"))
    return [Pack(k["lo"], k["hi"], k["name"], T.StructType.fromJson(k["schema"])) for k in note]


def schema_notes(spark: SparkSession, path: str) -> list[SchemaNote]:
    """Notes of a lake in the order they were written."""
    folder = f"{path.rstrip('/')}/{NOTES}"
    notes = [json.loads(read_note(spark, f"{folder}/{name}"))
             for name in list_names(spark, folder) if name.endswith(".json")]
    return sorted((SchemaNote(n["lo"], n["hi"], T.StructType.fromJson(n["schema"]), n["order"])
                   for n in notes), key=lambda n: n.order)


def _schema_at(notes: Sequence[SchemaNote], batch_id: int) -> T.StructType | None:
    return next((n.schema for n in reversed(notes) if n.covers(batch_id)), None)


def note_schema(spark: SparkSession, path: str, schema: T.StructType,
                ranges: Sequence[tuple[int, int]]) -> None:
    """Write down that the batches of ``ranges`` (first and last ids) have ``schema``.
    Nothing is written where the notes say so already.  The last range stays open
    if no later batch is there, so a stream writes a note per change only."""
    schema = nullable(schema)
    notes = schema_notes(spark, path)
    folder = path.rstrip("/")
    for lo, hi in ranges:
        edges = [lo, *(e for n in notes for e in (n.lo, (n.hi if n.hi is not None else lo) + 1)
                       if lo < e <= hi)]
        if all(_schema_at(notes, e) == schema for e in edges):
            continue
        later = any(int(name[9:]) > hi for name in list_names(spark, folder)
                    if name.startswith("batch_id="))
        open_end = not later and hi == max(h for _, h in ranges)
        note = SchemaNote(lo, None if open_end else hi, schema,
                          max(time.time_ns(), (notes[-1].order if notes else 0) + 1))
        write_note(spark, f"{folder}/{NOTES}/{note.order:020d}.json", json.dumps(
            {"lo": note.lo, "hi": note.hi, "order": note.order, "schema": schema.jsonValue()}))
        notes.append(note)


def schema_epochs(notes: Sequence[SchemaNote]
                  ) -> list[tuple[int | None, int | None, T.StructType | None]]:
    """The batch ids cut into stretches ``(lo, hi, schema)`` of one schema (None:
    without a note), in order; the first and the last are open."""
    cuts = sorted({n.lo for n in notes} | {n.hi + 1 for n in notes if n.hi is not None})
    out: list = []
    for lo, after in zip([None, *cuts], [*cuts, None]):
        schema = None if lo is None else _schema_at(notes, lo)
        if out and out[-1][2] == schema:
            out[-1] = (out[-1][0], None if after is None else after - 1, schema)
        else:
            out.append((lo, None if after is None else after - 1, schema))
    return out


def _within(stretches: Sequence[tuple[int | None, int | None]]) -> Column:
    b = F.col("batch_id")
    either = [(F.lit(True) if lo is None else b >= lo) & (F.lit(True) if hi is None else b <= hi)
              for lo, hi in stretches]
    return reduce(lambda x, y: x | y, either)


def _scan(spark: SparkSession, path: str, schema: T.StructType | None,
          merge_schema: bool = False) -> DataFrame:
    reader = spark.read
    if schema is not None:
        named = "batch_id" in schema.names
        reader = reader.schema(schema if named else T.StructType([*schema.fields, BATCH]))
    elif merge_schema:
        reader = reader.option("mergeSchema", "true")
    df = reader.parquet(path)
    return df.withColumn("batch_id", F.col("batch_id").cast("bigint"))


def read_lake(spark: SparkSession, path: str, fmt: str = "parquet",
              schema: T.StructType | None = None, merge_schema: bool = False,
              upto: int | None = None) -> DataFrame:
    """The lake table with all columns ever written, in the types that hold all
    batches.  With a known ``schema`` that one is read as it is.  For batches
    without a note (a lake written by something else) the columns come from one
    file, or with ``merge_schema`` from the footers of all files.  Packs that start
    after batch ``upto`` are not opened."""
    if fmt == "delta":
        return spark.read.format("delta").load(path)
    loose = _read_folders(spark, path, schema, merge_schema)
    packs = read_packs(spark, path)
    if not packs:
        return loose
    parts = [loose.where(~_within([(k.lo, k.hi) for k in packs]))]
    groups: dict[str, list[Pack]] = {}
    for k in packs:
        if upto is None or k.lo <= upto:
            groups.setdefault(k.schema.json(), []).append(k)
    for group in groups.values():
        folders = [f"{path.rstrip('/')}/{PACKED}/{k.name}" for k in group]
        scan = spark.read.schema(T.StructType([*group[0].schema.fields, BATCH])).parquet(*folders)
        parts.append(conform(scan, loose.schema))
    return reduce(DataFrame.unionByName, parts)


def _read_folders(spark: SparkSession, path: str, schema: T.StructType | None,
                  merge_schema: bool) -> DataFrame:
    """What the folders of single batches hold."""
    notes = [] if schema is not None else schema_notes(spark, path)
    if not notes:
        return _scan(spark, path, schema, merge_schema)
    epochs = schema_epochs(notes)
    noted = [e for e in epochs if e[2] is not None]
    if any(s is None and (hi is None or hi >= 0) for _, hi, s in epochs):
        # ids are looked at only where some batches may lack a note
        ids = [int(n[9:]) for n in list_names(spark, path) if n.startswith("batch_id=")]
        if any(_schema_at(notes, i) is None for i in ids):
            return _stack(spark, path, epochs, merge_schema)
    return _stack(spark, path, noted, merge_schema)


def _stack(spark: SparkSession, path: str, epochs: list, merge_schema: bool) -> DataFrame:
    whole = common_schema([s for _, _, s in epochs if s is not None])
    unknown = [(lo, hi) for lo, hi, s in epochs if s is None]
    extra = None
    if unknown:  # batches written without a note
        extra = _scan(spark, path, None, merge_schema).where(_within(unknown))
        whole = common_schema([whole, extra.drop("batch_id").schema])
    parts, plain = [], [(lo, hi) for lo, hi, s in epochs if s is not None and agrees(s, whole)]
    if plain:
        part = _scan(spark, path, whole)
        parts.append(part if len(plain) == len(epochs) else part.where(_within(plain)))
    other: dict[str, list] = {}
    for lo, hi, s in epochs:
        if s is not None and not agrees(s, whole):
            other.setdefault(s.json(), []).append((lo, hi, s))
    want = T.StructType([*whole.fields, BATCH])
    for group in other.values():
        scan = _scan(spark, path, group[0][2]).where(_within([(lo, hi) for lo, hi, _ in group]))
        parts.append(conform(scan, want))
    if extra is not None:
        parts.append(conform(extra, want))
    return reduce(DataFrame.unionByName, parts)


def as_of_version(lake: DataFrame, version: int) -> DataFrame:
    """Table as it was after batch ``version`` (partition-pruned)."""
    return lake.where(F.col("batch_id") <= F.lit(version))


def as_of_timestamp(lake: DataFrame, ts: str) -> DataFrame:
    """Table as it was at ``ts``: batches committed at or before it.  A file
    holds one value of ``committed_at``, so the pushed filter skips whole row
    groups of later batches."""
    return lake.where(F.col("committed_at") <= F.lit(ts).cast("timestamp"))


def read_version(spark: SparkSession, path: str, version: int | None = None,
                 timestamp: str | None = None, fmt: str = "parquet",
                 schema: T.StructType | None = None, merge_schema: bool = False) -> DataFrame:
    """``versionAsOf`` / ``timestampAsOf`` in one call.  The columns are those of the
    whole table; a column added later is NULL."""
    if fmt == "delta":
        r = spark.read.format("delta")
        if version is not None:
            r = r.option("versionAsOf", version)
        if timestamp is not None:
            r = r.option("timestampAsOf", timestamp)
        return r.load(path)
    lake = read_lake(spark, path, schema=schema, merge_schema=merge_schema, upto=version)
    if version is not None:
        lake = as_of_version(lake, version)
    if timestamp is not None:
        lake = as_of_timestamp(lake, timestamp)
    return lake


def history(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One row per batch; for Delta the table's own history."""
    if fmt == "delta":
        return spark.sql(f"DESCRIBE HISTORY delta.`{path}`")
    return table_history(read_lake(spark, path))


def table_history(lake: DataFrame) -> DataFrame:
    """Rows written and commit time of each batch (reads one column)."""
    return (lake.groupBy("batch_id")
            .agg(F.count(F.lit(1)).alias("row_count"),
                 F.max("committed_at").alias("committed_at"))
            .orderBy("batch_id"))


def preview(lake: DataFrame, n: int = 20, order_by=("kafka_topic", "kafka_partition",
                                                    "kafka_offset")) -> DataFrame:
    """``show(20)`` as a DataFrame, made deterministic by an order."""
    return lake.orderBy(*order_by).limit(n)
