"""Topic-shaped record sources.

Every source yields the ``schemas.RECORD`` contract (Spark's Kafka source
schema), so the same operators run on Kafka, on replayed files and on
batch tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sequence import number_within
from ..schemas import RECORD

# Topic naming of the reference (<server>.<schema>.<table>) and
# the registry subject suffix of a topic's value schema.
TOPIC_PREFIX = "pg.public"
SUBJECT_SUFFIX = "-value"
# Fixture choice (ours): partitions per topic.
TOPIC_PARTITIONS = 3


def events_as_records(events: DataFrame, topic_prefix: str = TOPIC_PREFIX,
                      partitions: int = TOPIC_PARTITIONS,
                      value: Column | None = None,
                      carry: Sequence[str | Column] = ()) -> DataFrame:
    """Turn the ``events`` table into topic records, one topic per event type.

    key = user id as text, value = ``props`` bytes (or ``value``), partition
    = user id mod ``partitions`` (keys stick to a partition), offset = 0-based
    position in the topic-partition by ``event_id``, timestamp = event time.
    Keeps ``event_id`` and ``ts`` (and the ``carry`` columns) next to the
    record columns for callers that cut the stream into files.
    """
    payload = value if value is not None else F.col("props").cast("binary")
    base = events.select(
        F.col("event_id"),
        F.col("ts"),
        F.col("user_id").cast("string").cast("binary").alias("key"),
        payload.alias("value"),
        F.concat(F.lit(topic_prefix + "."), F.col("event_type")).alias("topic"),
        F.pmod(F.col("user_id"), F.lit(partitions)).cast("int").alias("partition"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        *[F.col(c) if isinstance(c, str) else c for c in carry],
    )
    numbered = number_within(base, ["topic", "partition"], "event_id",
                             out="offset", start=0)
    carried = base.columns[len(base.columns) - len(carry):] if carry else []
    return numbered.select(*RECORD.fieldNames(), "event_id", "ts", *carried)


def records_only(df: DataFrame) -> DataFrame:
    return df.select(*RECORD.fieldNames())


def read_kafka(spark: SparkSession, servers: str, topics: Sequence[str] | str,
               starting_offsets: str = "earliest", stream: bool = True,
               fail_on_data_loss: bool = True,
               options: dict | None = None) -> DataFrame:
    """Kafka adapter (needs the spark-sql-kafka package on the classpath;
    not available in this repository's test image, so untested here).  Offsets
    that have aged out stop the query unless ``fail_on_data_loss`` is off."""
    topic_list = topics if isinstance(topics, str) else ",".join(topics)
    reader = spark.readStream if stream else spark.read
    reader = (reader.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic_list)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def read_record_files(spark: SparkSession, path: str, stream: bool = False,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Replayed topic records stored as Parquet (offline stand-in for Kafka)."""
    if stream:
        reader = spark.readStream.schema(RECORD)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.parquet(path)
    return spark.read.schema(RECORD).parquet(path)
