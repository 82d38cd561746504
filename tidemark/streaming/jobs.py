"""Structured Streaming jobs: stateless enrichment and the lake writer.

Both use the same ``enrich`` as the batch path.  Triggers are arguments:
``{"processingTime": "10 seconds"}`` in production, ``{"availableNow":
True}`` in tests (drain what is there, then stop).  The checkpoint location
is mandatory and must be durable (it is what makes a restart resume).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.enrich import enrich
from ..session import delete_path
from ..sources.lake import read_lake
from ..sources.records import read_record_files
from .sinks import batch_dir, write_lake_batch, write_report_batch, write_report_title

Clock = Callable[[int], Column]
#: A batch writer with the arguments of ``write_lake_batch``.
BatchWriter = Callable[..., int | None]


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or {"availableNow": True}))


def start_enrich_stream(records: DataFrame, sink_path: str, checkpoint: str,
                        processing_timestamp: Column | None = None,
                        trigger: dict | None = None,
                        fmt: str = "parquet") -> StreamingQuery:
    """Append-mode, stateless: records -> enriched rows -> file sink."""
    out = enrich(records, processing_timestamp)
    writer = (out.writeStream.format(fmt).outputMode("append")
              .option("path", sink_path).option("checkpointLocation", checkpoint))
    return _trigger(writer, trigger).start()


def start_lake_stream(records: DataFrame, lake_path: str, checkpoint: str,
                      clock: Clock | None = None, trigger: dict | None = None,
                      keep_extra: Callable[[int], bool] | None = None,
                      fmt: str = "parquet", app_id: str | None = None,
                      write: BatchWriter = write_lake_batch) -> StreamingQuery:
    """records -> enrich -> ``foreachBatch``: write the batch to the lake.

    Without ``clock`` the enrichment is part of the streaming plan, so
    ``current_timestamp()`` is the micro-batch time that Spark records in
    the offset log: one value per batch, the same again when a batch is
    replayed after a crash; it is also the batch's ``committed_at``.
    ``clock(batch_id)`` sets the processing time per batch instead (tests).
    ``keep_extra(batch_id)`` lets batches differ in columns (schema
    evolution).  ``fmt="delta"`` with a stable ``app_id`` appends to a Delta
    table.  ``write`` replaces the batch writer (same arguments as
    ``write_lake_batch``).
    """
    from pyspark.sql import functions as F

    from ..schemas import ENRICHED_EXTRA_COLUMNS

    source = records if clock else enrich(records)

    def each(batch: DataFrame, batch_id: int) -> None:
        extra = keep_extra(batch_id) if keep_extra else True
        if clock:
            out = enrich(batch, clock(batch_id), keep_extra=extra)
        else:
            out = batch if extra else batch.drop(*ENRICHED_EXTRA_COLUMNS)
        write(out, lake_path, batch_id, committed_at=F.col("processing_timestamp"),
              fmt=fmt, app_id=app_id)

    writer = (source.writeStream.foreachBatch(each).outputMode("append")
              .option("checkpointLocation", checkpoint))
    return _trigger(writer, trigger).start()


def start_report_stream(records: DataFrame, report_path: str, checkpoint: str,
                        clock: Clock | None = None,
                        trigger: dict | None = None) -> StreamingQuery:
    """records -> enriched -> text report: the title, then each batch (written
    by executors)."""
    source = records if clock else enrich(records)
    write_report_title(records.sparkSession, report_path)

    def each(batch: DataFrame, batch_id: int) -> None:
        out = enrich(batch, clock(batch_id)) if clock else batch
        write_report_batch(out, report_path, batch_id)

    writer = (source.writeStream.foreachBatch(each)
              .option("checkpointLocation", checkpoint))
    return _trigger(writer, trigger).start()


def start_decode_stream(records: DataFrame, schema: T.StructType, good_path: str,
                        bad_path: str, checkpoint: str,
                        trigger: dict | None = None) -> StreamingQuery:
    """records -> decoded messages under ``good_path``, those that do not parse
    with their whole text under ``bad_path`` (one folder per batch, a replay
    overwrites)."""
    from pyspark.sql import functions as F

    from ..operators.envelope import decode_json, split_decoded

    base = records.select("topic", "partition", "offset", F.col("key").cast("string").alias("key"),
                          "value")

    def each(batch: DataFrame, batch_id: int) -> None:
        good, bad = split_decoded(decode_json(batch, schema, into="message"), into="message")
        good.drop("value").write.mode("overwrite").parquet(batch_dir(good_path, batch_id))
        bad.drop("value").write.mode("overwrite").parquet(batch_dir(bad_path, batch_id))

    writer = (base.writeStream.foreachBatch(each)
              .option("checkpointLocation", checkpoint))
    return _trigger(writer, trigger).start()


def await_drained(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` query to finish and re-raise its error.
    With ``timeout_s`` a query that runs longer is stopped."""
    finished = query.awaitTermination() if timeout_s is None \
        else query.awaitTermination(timeout_s)
    if finished is False:
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} still running "
                           f"after {timeout_s}s")
    err = query.exception()
    if err is not None:
        raise err


def run_until_stopped(query: StreamingQuery) -> None:
    """Block on a long-running query; stop it cleanly on Ctrl-C."""
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        query.stop()


def record_stream(spark: SparkSession, source_dir: str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    return read_record_files(spark, source_dir, stream=True,
                             max_files_per_trigger=max_files_per_trigger)


def state_writer(keys: list[str], state_path: str, compact_every: int,
                 drop_deleted: bool = False) -> Callable[[DataFrame, int], None]:
    """Writes the keys that a batch changed (``_last`` beside the keys) as one folder;
    every ``compact_every``-th batch writes the newest row of all keys, and the batch
    after it deletes the folders before.

    With ``drop_deleted`` a compacted batch leaves out keys whose delete stands in the
    compacted batch before it: folders with older rows of such a key are deleted by
    then, so its delete hides nothing any more.
    """
    from pyspark.sql import functions as F

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        whole = batch_id > 0 and batch_id % compact_every == 0
        if batch_id > 1 and (batch_id - 1) % compact_every == 0:
            # the batch before holds all keys; with compact_every=1 each one does
            for b in range(max(0, batch_id - 1 - compact_every), batch_id - 1):
                delete_path(spark, batch_dir(state_path, b))
        out = batch
        if whole:
            before = read_lake(spark, state_path).where(F.col("batch_id") < batch_id)
            rows = before.select(*batch.columns, "batch_id").unionByName(
                batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")))
            newest = rows.groupBy(*keys).agg(F.max_by("_last", "batch_id").alias("_last"),
                                             F.max("batch_id").alias("since"))
            last_whole = batch_id - compact_every
            if drop_deleted and last_whole > 0:
                # kept where the operation is null: reading raises for it
                newest = newest.where(~((F.col("since") <= last_whole)
                                        & F.col("_last.op").eqNullSafe("d")))
            out = newest.drop("since")
        write_lake_batch(out, state_path, batch_id)

    return each


def start_current_state_stream(changes: DataFrame, key: str | list[str],
                               order: list[str], state_path: str,
                               checkpoint: str, image: str = "after",
                               op_col: str = "op",
                               trigger: dict | None = None,
                               state_partitions: int | None = None,
                               compact_every: int = 16) -> StreamingQuery:
    """Current state per key, maintained by Spark's state store.

    A streaming aggregation keeps, per key, the change with the greatest
    ``order`` (``max_by``).  In update mode each micro-batch emits only the
    keys it changed; they are written as ``<state>/batch_id=<id>/`` (replay
    overwrites).  ``read_current_state`` takes the newest row per key.

    Every ``compact_every``-th batch writes the newest row of all keys so far,
    and the batch after it deletes the folders before: by then the compacted
    batch is in the checkpoint and is not replayed any more.  So what is read
    grows with the keys, not with the changes.

    State grows with the number of keys (deleted keys keep a tombstone):
    use the RocksDB state store provider on clusters.  ``state_partitions``
    fixes the number of state partitions when the checkpoint is first
    created (Spark keeps it in the checkpoint; adaptive execution does not
    resize stateful shuffles); by default the session's shuffle partitions.
    """
    from pyspark.sql import functions as F

    keys = [key] if isinstance(key, str) else list(key)
    payload = F.struct(F.col(op_col).alias("op"), *[F.col(o) for o in order],
                       F.col(image).alias("image"))
    agg = changes.groupBy(*keys).agg(
        F.max_by(payload, F.struct(*[F.col(o) for o in order])).alias("_last"))

    each = state_writer(keys, state_path, compact_every)
    writer = (agg.writeStream.outputMode("update").foreachBatch(each)
              .option("checkpointLocation", checkpoint))
    spark = changes.sparkSession
    if state_partitions is None:
        return _trigger(writer, trigger).start()
    key_conf = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key_conf)
    spark.conf.set(key_conf, str(int(state_partitions)))
    try:
        return _trigger(writer, trigger).start()
    finally:
        spark.conf.set(key_conf, previous)


def read_current_state(spark: SparkSession, state_path: str,
                       key: str | list[str], order: list[str]) -> DataFrame:
    """Newest state row per key across the written batches, deletes dropped.
    A change without an operation raises: it is neither kept nor dropped in
    silence."""
    from pyspark.sql import functions as F

    from ..operators.cdc import live

    keys = [key] if isinstance(key, str) else list(key)
    log = read_lake(spark, state_path)
    newest = log.groupBy(*keys).agg(F.max_by("_last", "batch_id").alias("_last"))
    return (newest.where(live(F.col("_last.op")))
            .select(*keys, "_last.op", *[f"_last.{o}" for o in order],
                    "_last.image.*"))
