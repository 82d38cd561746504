"""Micro-batch sinks: replay-safe lake batches and the text batch report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text_prefix
from ..operators.evolution import nullable
from ..session import list_names
from ..sources.lake import note_schema, read_packs, schema_epochs, schema_notes


# Lines of the text batch report (same text as the reference).
REPORT_TITLE = "=== Spark Streaming Output ==="
BATCH_HEADER = "=== Micro-batch %d (%d rows) ==="
RECORD_LINE = "Key: %s, Topic: %s, Partition: %s, Offset: %s, Table: %s"
DISPLAY_ISSUE = "(Serialization issue - data processed but cannot display details)"
DISPLAY_ERROR_PREFIX = "Error: "
BATCH_ERROR = "=== Batch %d error: %s ==="
NONE_TEXT = "None"

#: Batch id of the line that opens a report.
TITLE_BATCH = -1


def batch_dir(root: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/batch_id={int(batch_id)}"


def write_lake_batch(batch: DataFrame, lake_path: str, batch_id: int,
                     committed_at: Column | None = None,
                     skip_empty: bool = True, fmt: str = "parquet",
                     app_id: str | None = None) -> int | None:
    """Write one micro-batch as ``<lake>/batch_id=<id>/`` (overwrite).

    A replay of the same batch id (restart after a crash between the write
    and the checkpoint commit) replaces the folder instead of appending a
    second copy, so the table stays exactly-once.  Errors are raised: the
    stream stops rather than moving its checkpoint past a lost batch.
    Rows are counted with ``observe`` during the write (one pass).  Returns the
    rows written, or None for an empty batch (``skip_empty``), which has no row
    in the table and none in its history.

    ``fmt="delta"`` appends to a Delta table instead, made idempotent by
    Delta's ``txnAppId`` / ``txnVersion`` options (a replayed batch id is
    skipped); needs the Delta package (absent here, so untested).
    """
    stamp = committed_at if committed_at is not None else F.current_timestamp()
    obs = Observation(f"lake_batch_{int(batch_id)}")
    out = batch.withColumn("committed_at", stamp.cast("timestamp")).observe(
        obs, F.count(F.lit(1)).alias("rows"))
    if fmt == "delta":
        if not app_id:
            raise ValueError("fmt='delta' needs app_id (stable per stream)")
        if skip_empty and batch.isEmpty():
            return None
        (out.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
         .write.format("delta").mode("append")
         .option("txnAppId", app_id).option("txnVersion", int(batch_id))
         .option("mergeSchema", "true").save(lake_path))
        return obs.get["rows"]
    if any(k.lo <= batch_id <= k.hi for k in read_packs(batch.sparkSession, lake_path)):
        raise ValueError(f"batch {batch_id} of {lake_path} is packed: it can't be written again")
    # before the batch: a reader never meets a batch whose schema it does not know
    note_schema(batch.sparkSession, lake_path, out.schema, [(int(batch_id), int(batch_id))])
    out.write.mode("overwrite").parquet(batch_dir(lake_path, batch_id))
    rows = obs.get["rows"]
    return None if skip_empty and not rows else rows


def _batch_ranges(df: DataFrame, lake_path: str, schema: T.StructType) -> list[tuple[int, int]]:
    """Stretches of consecutive batch ids of ``df``.  A new lake, or one whose
    batches all have this schema, needs no look at the rows."""
    spark = df.sparkSession
    notes = schema_notes(spark, lake_path)
    noted = schema_epochs(notes) if notes else []
    if all(s == nullable(schema) or (hi is not None and hi < 0) for _, hi, s in noted) \
            and (noted or not list_names(spark, lake_path)):
        return [(0, 0)]
    ids = df.select("batch_id").distinct()
    island = F.col("batch_id") - F.row_number().over(Window.orderBy("batch_id"))
    rows = (ids.withColumn("island", island).groupBy("island")
            .agg(F.min("batch_id").alias("lo"), F.max("batch_id").alias("hi")).collect())
    return sorted((r["lo"], r["hi"]) for r in rows)


def write_lake_batches(df: DataFrame, lake_path: str, batch_col: str = "batch_id",
                       committed_at: Column | None = None) -> None:
    """Backfill many batches in one distributed write (same layout as
    ``write_lake_batch``): rows carry their batch id, the table is
    partitioned by it, and dynamic partition overwrite replaces exactly the
    batches present, so re-running a backfill is idempotent.  The rebalance
    brings the rows of a batch together in files of a good size; a large batch
    is split over several tasks."""
    stamp = committed_at if committed_at is not None else F.current_timestamp()
    out = (df.withColumn("committed_at", stamp.cast("timestamp"))
           .withColumnRenamed(batch_col, "batch_id")
           .withColumn("batch_id", F.col("batch_id").cast("bigint")))
    for k in read_packs(df.sparkSession, lake_path):
        if not out.where(F.col("batch_id").between(k.lo, k.hi)).isEmpty():
            raise ValueError(f"batches {k.lo} to {k.hi} of {lake_path} are packed: "
                             "they can't be written again")
    schema = out.drop("batch_id").schema
    note_schema(df.sparkSession, lake_path, schema, _batch_ranges(out, lake_path, schema))
    (out.hint("rebalance", F.col("batch_id"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(lake_path))


def batch_report_lines(batch: DataFrame, batch_id: int) -> DataFrame:
    """The text report of one batch as lines: a header
    ``=== Micro-batch <id> (<n> rows) ===`` then one line per record.
    Built as DataFrames and written by executors (no collect)."""
    rows = batch.select(
        F.lit(1).alias("part"),
        F.format_string(RECORD_LINE,
                        F.coalesce(F.col("kafka_key"), F.lit(NONE_TEXT)),
                        "kafka_topic", "kafka_partition", "kafka_offset",
                        F.coalesce(F.col("source_table"), F.lit(NONE_TEXT)))
        .alias("line"))
    header = batch.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(0).alias("part"),
        F.format_string(BATCH_HEADER, F.lit(int(batch_id)),
                        F.col("n")).alias("line"))
    return header.unionByName(rows)


def error_line(batch_id: int, message: Column) -> Column:
    """``=== Batch <id> error: <message> ===`` for a batch that failed."""
    return F.format_string(BATCH_ERROR, F.lit(int(batch_id)), message)


def display_error_lines(message: Column) -> list[Column]:
    """The two lines written when rows could not be shown: a fixed note and
    ``Error: <first 100 characters>`` (``error_line`` keeps the whole text)."""
    return [F.lit(DISPLAY_ISSUE),
            F.concat(F.lit(DISPLAY_ERROR_PREFIX), text_prefix(message, 100))]


def _write_lines(spark: SparkSession, lines: list[Column], path: str) -> None:
    spark.range(1).select(F.explode(F.array(*lines)).alias("line")) \
        .write.mode("overwrite").text(path)


def write_report_title(spark: SparkSession, report_path: str) -> None:
    """The line that opens a report (under ``batch_id=-1``; a restart writes
    the same line again)."""
    _write_lines(spark, [F.lit(REPORT_TITLE)], f"{batch_dir(report_path, TITLE_BATCH)}/part=0")


def write_report_batch(batch: DataFrame, report_path: str, batch_id: int,
                       skip_empty: bool = True) -> bool:
    """Write the report of a batch under ``<report>/batch_id=<id>/``:
    ``part=1`` the record lines (one pass over the batch, rows counted with
    ``observe``), then ``part=0`` the header with that count; an empty batch
    gets no header (``skip_empty``).  A batch that fails leaves the note, the
    shortened and the whole error text in ``part=2`` and raises.  A replay
    overwrites all parts."""
    root = batch_dir(report_path, batch_id)
    obs = Observation(f"report_batch_{int(batch_id)}")
    lines = batch_report_lines(batch, batch_id).where(F.col("part") == 1) \
        .select("line").observe(obs, F.count(F.lit(1)).alias("rows"))
    spark = batch.sparkSession
    try:
        lines.write.mode("overwrite").text(f"{root}/part=1")
        rows = obs.get["rows"]
        if skip_empty and not rows:
            return False
        header = F.format_string(BATCH_HEADER, F.lit(int(batch_id)), F.lit(rows))
        _write_lines(spark, [header], f"{root}/part=0")
    except Exception as ex:
        text = F.lit(" ".join(str(ex).split()))
        _write_lines(spark, [*display_error_lines(text), error_line(batch_id, text)],
                     f"{root}/part=2")
        raise
    return True
