"""Progress of streams as a table: one row per micro-batch of every query.

``ProgressTable`` listens to the session's streams and appends what Spark reports about
each batch as JSON lines below ``path``, some batches per file; ``read_progress`` reads
the files as a table, a replayed batch once.  The listener runs on the driver and sees
figures only, no data.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..session import list_names, write_note

_STATE = T.StructType([T.StructField("operatorName", T.StringType())] + [
    T.StructField(n, T.LongType()) for n in (
        "numRowsTotal", "numRowsUpdated", "numRowsRemoved", "numRowsDroppedByWatermark",
        "memoryUsedBytes")])
#: What is read of a progress report (Spark's own field names).
REPORT = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("runId", T.StringType()),
    T.StructField("name", T.StringType()), T.StructField("timestamp", T.TimestampType()),
    T.StructField("batchId", T.LongType()),
    T.StructField("durationMs", T.MapType(T.StringType(), T.LongType())),
    T.StructField("eventTime", T.MapType(T.StringType(), T.StringType())),
    T.StructField("stateOperators", T.ArrayType(_STATE)),
    T.StructField("sources", T.ArrayType(T.StructType([
        T.StructField("description", T.StringType()),
        T.StructField("numInputRows", T.LongType())]))),
])


class ProgressTable(StreamingQueryListener):
    """Appends the progress of all queries of the session to ``path``.  Reports wait
    until ``per_file`` of them are there, a query ends, or ``flush`` is called."""

    def __init__(self, spark: SparkSession, path: str, per_file: int = 100):
        self.spark, self.path, self.per_file = spark, path.rstrip("/"), per_file
        self._lines: list[str] = []
        self._ended: set[str] = set()
        self._turn = threading.Condition()

    def __enter__(self) -> "ProgressTable":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's names
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        with self._turn:
            self._lines.append(" ".join(event.progress.json.split()))
            full = len(self._lines) >= self.per_file
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.flush()
        with self._turn:
            self._ended.add(str(event.runId))
            self._turn.notify_all()

    def flush(self) -> None:
        with self._turn:
            lines, self._lines = self._lines, []
        if lines:
            write_note(self.spark, f"{self.path}/{uuid.uuid4().hex}.json", "\n".join(lines) + "\n")

    def wait_for(self, query: StreamingQuery, timeout_s: float = 60.0) -> bool:
        """Wait until the reports of a query that has ended are written (Spark hands
        them over after the query's end)."""
        with self._turn:
            return self._turn.wait_for(lambda: str(query.runId) in self._ended, timeout_s)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch of a query: rows read, rates, durations and rows of state.  A
    batch that was replayed after a restart has the figures of its last run."""
    if not list_names(spark, path):
        reports = spark.createDataFrame([], REPORT)
    else:
        reports = spark.read.schema(REPORT).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSX") \
            .json(path)
    last = F.row_number().over(Window.partitionBy("id", "batchId").orderBy(F.desc("timestamp")))

    def total(items: str, field: str) -> F.Column:
        return F.aggregate(items, F.lit(0).cast("bigint"),
                           lambda a, x: a + F.coalesce(x[field], F.lit(0)))

    seconds = F.col("durationMs")["triggerExecution"] / 1000
    rows = total("sources", "numInputRows")
    return (reports.withColumn("_last", last).where("_last = 1").select(
        F.col("id").alias("query_id"), F.col("runId").alias("run_id"), "name",
        F.col("batchId").alias("batch_id"), F.col("timestamp").alias("started_at"),
        rows.alias("input_rows"), F.col("durationMs").alias("durations_ms"),
        F.when(seconds > 0, rows / seconds).alias("rows_per_second"),
        F.col("eventTime")["watermark"].try_cast("timestamp").alias("watermark"),
        total("stateOperators", "numRowsTotal").alias("state_rows"),
        total("stateOperators", "numRowsUpdated").alias("state_rows_updated"),
        total("stateOperators", "numRowsRemoved").alias("state_rows_removed"),
        total("stateOperators", "memoryUsedBytes").alias("state_bytes")))
