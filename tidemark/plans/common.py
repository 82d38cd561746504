"""Shared inputs of the registered queries: table loading and the record
fixtures derived from ``events`` (see FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.enrich import enrich
from ..session import app_id, scratch_path, use_utc
from ..sources.records import events_as_records, records_only

# Fixed values of the fixtures (shared with the oracle SQL).
PROCESSING_TS = "2024-02-01 00:00:00"
EPOCH = 1706745600  # 2024-02-01T00:00:00Z, used for seed rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def processing_ts() -> F.Column:
    return F.lit(PROCESSING_TS).cast("timestamp")


def records(spark: SparkSession, sf_dir: str, keep_ids: bool = False,
            kind: str = "events") -> DataFrame:
    """Topic records of fixture ``kind`` (the Kafka record contract; with
    ``keep_ids`` also ``event_id``, ``ts`` and the arrival ``cut``)."""
    log = topic_log(spark, sf_dir, kind)
    return log if keep_ids else records_only(log)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(records(spark, sf_dir), processing_ts())


def ntz(df: DataFrame) -> DataFrame:
    """Session-independent output: instants as UTC wall-clock TIMESTAMP_NTZ
    and no raw binary columns (text/hex forms are kept)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        elif isinstance(f.dataType, T.BinaryType):
            continue
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def change_op() -> F.Column:
    """Fixture rule for the change kind of an event (FIXTURES.md)."""
    r = F.col("event_id") % 10
    return (F.when(r == 0, F.lit("d"))
            .when(r.between(1, 3), F.lit("u"))
            .otherwise(F.lit("c")))


def _envelope_value(damaged: F.Column | None = None) -> F.Column:
    """JSON change envelope of each event; ``damaged`` rows carry only the
    first 20 characters (a faulty producer)."""
    from ..operators.envelope import envelope_json, envelope_struct

    op = change_op()
    image = F.struct(F.col("user_id"), F.col("value"))
    env = envelope_struct(
        before=F.when(op.isin("u", "d"), image),
        after=F.when(op != "d", image),
        op=op,
        source=F.struct(F.col("event_type")),
        ts_ms=F.unix_millis(F.col("ts").cast("timestamp")),
        lsn=F.col("event_id"),
        key=F.col("user_id"))
    js = envelope_json(env)
    if damaged is not None:
        js = F.when(damaged, F.substring(js, 1, 20)).otherwise(js)
    return js.cast("binary")


def _framed_value() -> F.Column:
    """Registry-framed props (schema id = length of the event type), except
    topic ``view`` which carries plain JSON."""
    from ..operators.envelope import frame

    return (F.when(F.col("event_type") == "view", F.col("props").cast("binary"))
            .otherwise(frame(F.col("props"), F.length("event_type"))))


# Topic fixtures: the value each record carries.
TOPIC_VALUES = {
    "events": lambda: F.col("props").cast("binary"),
    "envelopes": lambda: _envelope_value(),
    "envelopes_damaged": lambda: _envelope_value(F.col("event_type") == "error"),
    "framed": _framed_value,
}
_STORED: dict[tuple, str] = {}


def stored_path(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """Path of a fixture that is built once per application by
    ``build(path)``."""
    key = (app_id(spark), sf_dir.rstrip("/"), name)
    if key not in _STORED:
        path = scratch_path(spark, name)
        build(path)
        _STORED[key] = path
    return _STORED[key]


def _numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as topic records, stored once per application: offsets
    numbered per topic-partition, one value column per fixture kind
    (``value_<kind>``), event id, event time and arrival cut; partitioned by
    cut.  One job: the numbering shuffle plus a narrow projection."""
    return spark.read.parquet(log_path(spark, sf_dir))


def log_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the stored topic log (``cut=<n>`` below it)."""
    from ..schemas import RECORD

    def build(path: str) -> None:
        ev = table(spark, sf_dir, "events")
        rec = events_as_records(ev, value=F.col("props").cast("binary"),
                                carry=["user_id", "event_type", "props",
                                       F.col("value").alias("event_value")])
        events_view = rec.drop("value").withColumnRenamed("event_value", "value")
        kinds = [TOPIC_VALUES[k]().alias(f"value_{k}") for k in TOPIC_VALUES]
        (events_view.select(*[c for c in RECORD.fieldNames() if c != "value"], *kinds,
                            "event_id", "ts", cut_of(F.col("ts")).alias("cut"))
         .write.mode("overwrite").partitionBy("cut").parquet(path))

    return stored_path(spark, sf_dir, "topic-log", build)


def topic_log(spark: SparkSession, sf_dir: str, kind: str = "events") -> DataFrame:
    """The topic fixture ``kind`` as stored data: records with offsets,
    event id, event time and arrival cut (partition column).

    A real topic carries its offsets; the fixture has to number ``events``
    per topic-partition (``sequence.number_within``), which is a full
    shuffle.  That is done once per Spark application into one stored log
    holding every kind's value column; a kind is a projection of it (the
    scan reads only that value column).  Queries read it like a topic dump
    and the stream queries release it cut by cut.
    """
    from ..schemas import RECORD

    if kind not in TOPIC_VALUES:
        raise ValueError(f"unknown topic fixture {kind!r}")
    log = _numbered_events(spark, sf_dir)
    cols = [F.col(f"value_{kind}").alias("value") if c == "value" else F.col(c)
            for c in RECORD.fieldNames()]
    return log.select(*cols, "event_id", "ts", "cut")


def envelope_records(spark: SparkSession, sf_dir: str, damaged: bool = False,
                     keep_ids: bool = False) -> DataFrame:
    return records(spark, sf_dir, keep_ids,
                   kind="envelopes_damaged" if damaged else "envelopes")


def framed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir, kind="framed")


# Fixed values (fixture choice): the two snapshots of `orders`.
SNAPSHOT_A_TAKEN = "2001-01-01 00:00:00"   # A holds orders placed before this
ARCHIVED_BEFORE = "1996-01-01 00:00:00"    # B no longer holds orders placed before this
PENDING_CLOSED_BEFORE = "2000-01-01 00:00:00"  # in B, pending ('P') orders placed
                                               # before this are finished ('F')


def order_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two snapshots of ``orders`` (FIXTURES.md): A was taken on
    SNAPSHOT_A_TAKEN; B is today's table after old orders were archived and
    old pending orders were finished.  A -> B has inserts, updates and
    deletes."""
    o = table(spark, sf_dir, "orders")
    ts = lambda v: F.lit(v).cast("timestamp_ntz")
    a = o.where(F.col("o_orderdate") < ts(SNAPSHOT_A_TAKEN))
    b = (o.where(F.col("o_orderdate") >= ts(ARCHIVED_BEFORE))
         .withColumn("o_orderstatus",
                     F.when((F.col("o_orderstatus") == "P")
                            & (F.col("o_orderdate") < ts(PENDING_CLOSED_BEFORE)), F.lit("F"))
                     .otherwise(F.col("o_orderstatus"))))
    return a, b


# --- replayed topic files, cut into arrival batches ------------------------

# Arrival cuts of the event log (upper bounds of `ts`, UTC);
# cut i holds events before bound i and at or after bound i-1; the last cut
# holds the rest.
CUT_BOUNDS = ["2024-01-08 00:00:00", "2024-01-16 00:00:00", "2024-01-24 00:00:00"]
N_CUTS = len(CUT_BOUNDS) + 1


def cut_of(ts: F.Column) -> F.Column:
    c = F.lit(N_CUTS - 1)
    for i in reversed(range(len(CUT_BOUNDS))):
        c = F.when(ts < F.lit(CUT_BOUNDS[i]).cast("timestamp_ntz"), F.lit(i)).otherwise(c)
    return c


def batch_clock(batch_id: int) -> F.Column:
    """Processing time of micro-batch ``b``: PROCESSING_TS plus ``b`` days."""
    return batch_clock_col(F.lit(int(batch_id)))


def batch_clock_col(batch_id: F.Column) -> F.Column:
    return F.lit(PROCESSING_TS).cast("timestamp") + F.make_interval(
        days=batch_id.cast("int"))


def cut_stream(spark: SparkSession, sf_dir: str, cuts: Sequence[int],
               kind: str = "events", batches: int | None = None) -> DataFrame:
    """The topic as a stream to which the given cuts have arrived so far: the
    stored log's folders themselves, no copy.  ``batches``: how many micro-batches
    its files are dealt to (as many as Spark likes if not given)."""
    from ..schemas import RECORD

    log = _numbered_events(spark, sf_dir)
    folders = ",".join(str(c) for c in sorted(cuts))
    path = f"{log_path(spark, sf_dir)}/cut={{{folders}}}"
    stream = spark.readStream.schema(log.drop("cut").schema)
    if batches is not None:
        files = len(spark.read.schema(log.drop("cut").schema).parquet(path).inputFiles())
        stream = stream.option("maxFilesPerTrigger", max(1, -(-files // batches)))
    raw = stream.parquet(path)
    return raw.select(*[F.col(f"value_{kind}").alias("value") if c == "value" else F.col(c)
                        for c in RECORD.fieldNames()])


class InjectedFailure(RuntimeError):
    """Raised by ``failing_once`` (replay fixture)."""


def failing_once(write: Callable, batch_id: int) -> Callable:
    """A batch writer that writes and then, once, crashes after batch
    ``batch_id``: between the write and the checkpoint's commit."""
    state = {"failed": False}

    def run(batch: DataFrame, path: str, b: int, **kwargs):
        rows = write(batch, path, b, **kwargs)
        if b == batch_id and not state["failed"]:
            state["failed"] = True
            raise InjectedFailure(f"injected failure after batch {b}")
        return rows

    return run
