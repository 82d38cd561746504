"""Metadata projection and enrichment of topic records (batch = stream)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import age_ms_exact, age_ms_seconds, as_text, topic_part

from .sequence import number_within


def metadata_projection(records: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Kafka metadata renamed ``kafka_*``; key as text; value kept binary;
    ``carry`` columns passed through unchanged."""
    return records.select(
        *[F.col(c) for c in carry],
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    )


def enrich(records: DataFrame, processing_timestamp: Column | None = None,
           keep_extra: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """The enriched record: one projection, usable on a batch or a stream.

    ``processing_timestamp`` defaults to ``current_timestamp()`` (one value
    per query / micro-batch); pass a literal for reproducible output, or an
    expression of ``carry`` columns (e.g. a batch id) for a per-row value.
    """
    proc = processing_timestamp if processing_timestamp is not None \
        else F.current_timestamp()
    m = metadata_projection(records, carry)
    cols = {
        "kafka_key": F.col("kafka_key"),
        "kafka_topic": F.col("kafka_topic"),
        "kafka_partition": F.col("kafka_partition"),
        "kafka_offset": F.col("kafka_offset"),
        "kafka_timestamp": F.col("kafka_timestamp"),
        "avro_value_hex": as_text("value"),
        "processing_timestamp": proc.cast("timestamp"),
        "source_table": topic_part("kafka_topic", 2),
        "is_primary_partition": F.col("kafka_partition") == 0,
        "message_age_ms": age_ms_seconds(proc.cast("timestamp"),
                                         F.col("kafka_timestamp")),
        # Reference rule: the offset stands in for the sequence number.
        "message_sequence": F.col("kafka_offset"),
    }
    out = [c.alias(n) for n, c in cols.items()]
    if keep_extra:
        out += [
            F.col("value"),
            F.hex("value").alias("value_hex"),
            age_ms_exact(proc.cast("timestamp"), F.col("kafka_timestamp"))
            .alias("message_age_exact_ms"),
        ]
    return m.select(*out, *[F.col(c) for c in carry])


def message_sequence(enriched: DataFrame, out: str = "message_sequence",
                     bucket_width: int | None = None) -> DataFrame:
    """Batch form of the sequence: 1-based row number of each record inside
    its topic-partition by offset (differs from the offset after retention
    or compaction).  Split into bounded buckets, see ``sequence``."""
    kw = {"bucket_width": bucket_width} if bucket_width else {}
    base = enriched.drop(out) if out in enriched.columns else enriched
    return number_within(base, ["kafka_topic", "kafka_partition"],
                         "kafka_offset", out=out, **kw)
