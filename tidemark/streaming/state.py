"""Current state per key on a stream, with deleted keys that expire.

``jobs.start_current_state_stream`` keeps the last change of every key in a
streaming aggregation, so a deleted key stays in the state for ever.  Here an
arbitrary stateful operator (``transformWithState``, RocksDB) keeps two values per
key: ``last``, the order of the last change of a key that exists, and ``gone``, that
of a delete, which Spark removes once ``keep_deleted`` has passed.

Only order columns are in the state; row images pass through.  Before the shuffle
each Arrow batch is reduced to the newest change per key, so a key that holds a
third of all changes ships one row per batch of rows, not each change.

Defined cases: a change older than the last one of its key, or of equal order, is
left out; after ``keep_deleted`` a late change of a deleted key counts as a new one
(the time must exceed the longest delay of a change); null order values are smaller
than others; a null key is a key; a change without an operation is kept and makes
``read_current_state`` raise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from .jobs import state_writer

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _newest_of_batch(keys: list[str], order: list[str]) -> Callable:
    """Arrow batches reduced to the change of greatest ``order`` per key."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if table.num_rows > 1:
                by = table.select(keys + [o for o in order if o not in keys])
                at = pc.sort_indices(by, sort_keys=[(o, "ascending") for o in order],
                                     null_placement="at_start")
                place = by.select(keys).take(at).append_column(
                    "_place", pa.array(range(len(at)), pa.int64()))
                last = place.group_by(keys).aggregate([("_place", "max")])["_place_max"]
                table = table.take(at.take(last.combine_chunks()))
            yield from table.to_batches()

    return run


def _processor(order: list[str], order_type: T.StructType, keep_ms: int) -> StatefulProcessor:
    """Emits a change that is newer than all of its key before it."""

    class Newest(StatefulProcessor):  # a local class: shipped by value
        def init(self, handle) -> None:
            self.last = handle.getValueState("last", order_type)
            self.gone = handle.getValueState("gone", order_type, ttlDurationMs=keep_ms)

        def handleInputRows(self, key, rows, timerValues) -> Iterator:
            def rank(values):
                return tuple((v is not None, v) for v in values)

            newest = max(rows, key=lambda r: rank(r["_last"][o] for o in order))
            place = tuple(newest["_last"][o] for o in order)
            seen = self.last.get() if self.last.exists() else \
                self.gone.get() if self.gone.exists() else None
            if seen is not None and rank(place) <= rank(seen):
                return
            if newest["_last"]["op"] == "d":
                self.gone.update(place)
                self.last.clear()
            else:
                self.last.update(place)
                self.gone.clear()
            yield newest

        def close(self) -> None:
            pass

    return Newest()


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str | None]) -> Iterator[None]:
    """Session settings for what is started inside: a query keeps its own copy."""
    usual = {k: spark.conf.get(k) for k, v in settings.items() if v is not None}
    try:
        for k in usual:
            spark.conf.set(k, settings[k])
        yield
    finally:
        for k, v in usual.items():
            spark.conf.set(k, v)


def start_expiring_state_stream(changes: DataFrame, key: str | list[str], order: list[str],
                                state_path: str, checkpoint: str, keep_deleted_ms: int,
                                image: str = "after", op_col: str = "op",
                                trigger: dict | None = None,
                                state_partitions: int | None = None,
                                compact_every: int = 16) -> StreamingQuery:
    """Current state as ``jobs.start_current_state_stream`` writes it (read it with
    ``read_current_state``), with the state of deleted keys gone ``keep_deleted_ms``
    after the delete, in processing time.

    Compacted batches leave out keys whose delete the compacted batch before held: by
    then no folder has an older row of such a key.  So neither the state nor the
    written rows grow with the keys that were deleted.
    """
    spark = changes.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    rows = changes.select(*keys, F.struct(
        F.col(op_col).alias("op"), *[F.col(o) for o in order],
        F.col(image).alias("image")).alias("_last"))
    # order columns beside the struct, for the reduction only
    flat = rows.select("*", *[F.col(f"_last.{o}").alias(f"_order{i}")
                              for i, o in enumerate(order)])
    few = flat.mapInArrow(_newest_of_batch(keys, [f"_order{i}" for i in range(len(order))]),
                          flat.schema).select(*rows.columns)
    last = rows.schema["_last"].dataType
    order_type = T.StructType([T.StructField(o, last[o].dataType) for o in order])
    newest = few.groupBy(*keys).transformWithState(
        _processor(order, order_type, int(keep_deleted_ms)), rows.schema, "Update",
        "ProcessingTime")
    each = state_writer(keys, state_path, compact_every, drop_deleted=True)
    writer = (newest.writeStream.outputMode("update").foreachBatch(each)
              .option("checkpointLocation", checkpoint))
    drains = trigger is None or trigger.get("availableNow") or trigger.get("once")
    with _settings(spark, {
            "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
            "spark.sql.shuffle.partitions":
                None if state_partitions is None else str(int(state_partitions)),
            # a run that drains its input would wait for deletes to expire
            "spark.sql.streaming.noDataMicroBatches.enabled": "false" if drains else None}):
        return writer.trigger(**(trigger or {"availableNow": True})).start()
