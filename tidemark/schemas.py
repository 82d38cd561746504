"""Schemas shared by sources, operators and sinks."""

from pyspark.sql import types as T

# Topic record: the column contract of every record source (Kafka, file
# replay, batch table).  Same names and types as Spark's Kafka source.
RECORD = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("timestampType", T.IntegerType(), True),
])

# Enriched record, in output order.  The first eleven columns are the
# reference contract; the last three are additions that keep information the
# reference loses (raw bytes, a faithful hex form, millisecond age).
ENRICHED_COLUMNS = [
    "kafka_key", "kafka_topic", "kafka_partition", "kafka_offset",
    "kafka_timestamp", "avro_value_hex", "processing_timestamp",
    "source_table", "is_primary_partition", "message_age_ms",
    "message_sequence",
]
ENRICHED_EXTRA_COLUMNS = ["value", "value_hex", "message_age_exact_ms"]

# Row image carried by the change envelopes built from `events`.
EVENT_IMAGE = T.StructType([
    T.StructField("user_id", T.LongType(), True),
    T.StructField("value", T.DoubleType(), True),
])

# Change envelope (public change-capture JSON format, subset).
ENVELOPE = T.StructType([
    T.StructField("before", EVENT_IMAGE, True),
    T.StructField("after", EVENT_IMAGE, True),
    T.StructField("op", T.StringType(), True),
    T.StructField("source", T.StructType([
        T.StructField("event_type", T.StringType(), True),
    ]), True),
    T.StructField("ts_ms", T.LongType(), True),
    T.StructField("lsn", T.LongType(), True),
    T.StructField("k", T.LongType(), True),
])

CORRUPT_COLUMN = "_corrupt_record"


def with_corrupt_column(schema: T.StructType,
                        name: str = CORRUPT_COLUMN) -> T.StructType:
    """Schema plus a string column that receives unparsable input."""
    if name in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(name, T.StringType(), True)])
