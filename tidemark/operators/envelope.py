"""Change envelopes: build, frame, decode (with a bad-record side), flatten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import as_text, topic_part, wire_magic, wire_payload, wire_schema_id
from ..schemas import CORRUPT_COLUMN, with_corrupt_column


def envelope_struct(before: Column, after: Column, op: Column, source: Column,
                    ts_ms: Column, lsn: Column, key: Column) -> Column:
    """``{before, after, op, source, ts_ms, lsn, k}``: ``before`` is NULL for
    creates and snapshot reads, ``after`` is NULL for deletes."""
    return F.struct(before.alias("before"), after.alias("after"),
                    op.alias("op"), source.alias("source"),
                    ts_ms.alias("ts_ms"), lsn.alias("lsn"), key.alias("k"))


def envelope_json(envelope: Column) -> Column:
    return F.to_json(envelope)


def frame(payload: Column, schema_id: Column) -> Column:
    """Registry wire framing: magic byte 0, 4-byte big-endian schema id,
    payload."""
    header = F.unhex(F.concat(F.lit("00"), F.lpad(F.hex(schema_id.cast("bigint")), 8, "0")))
    return F.concat(header, payload.cast("binary"))


def wire_header(records: DataFrame) -> DataFrame:
    """Split framed values into magic byte, schema id and payload (NULL id
    and payload when the value is not framed)."""
    return records.select(
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        wire_magic("value").alias("magic"),
        wire_schema_id("value").alias("schema_id"),
        as_text(wire_payload("value")).alias("payload_text"),
        F.is_valid_utf8(as_text("value")).alias("value_is_utf8"),
    )


def decode_json(df: DataFrame, schema: T.StructType, source: str = "value",
                into: str = "envelope") -> DataFrame:
    """Parse a JSON payload (binary or text) with an explicit schema.

    PERMISSIVE: a malformed payload never stops the job; its text lands in
    ``<into>._corrupt_record``.  A NULL payload (tombstone) gives a NULL
    struct.  Use ``split_decoded`` to route good and bad rows.

    The parse sits behind a generator (``inline_outer`` of a one-element
    array): filters on the parsed fields cannot be pushed below it, so
    ``from_json`` runs once per row instead of once per referenced field.
    """
    text = F.col(source).cast("string")
    parsed = F.from_json(text, with_corrupt_column(schema),
                         {"mode": "PERMISSIVE",
                          "columnNameOfCorruptRecord": CORRUPT_COLUMN})
    return df.select("*", F.inline_outer(F.array(F.struct(parsed.alias(into)))))


def split_decoded(decoded: DataFrame, into: str = "envelope"
                  ) -> tuple[DataFrame, DataFrame]:
    """(good, bad): bad rows keep every input column (the raw payload
    included) plus ``corrupt_record``, the whole text that failed to parse."""
    bad_flag = F.col(f"{into}.{CORRUPT_COLUMN}").isNotNull()
    good = decoded.where(~bad_flag | F.col(into).isNull()) \
        .withColumn(into, F.col(into).dropFields(CORRUPT_COLUMN))
    bad = decoded.where(bad_flag).select(
        *[c for c in decoded.columns if c != into],
        F.col(f"{into}.{CORRUPT_COLUMN}").alias("corrupt_record"),
    )
    return good, bad


def flatten_envelope(decoded: DataFrame, into: str = "envelope") -> DataFrame:
    """Envelope struct to columns: ``op, lsn, k, ts_ms, source_*, before_*,
    after_*`` (other columns kept)."""
    e = F.col(into)
    keep = [c for c in decoded.columns if c != into]
    st = decoded.schema[into].dataType
    cols = [e["op"].alias("op"), e["lsn"].alias("lsn"), e["k"].alias("k"),
            e["ts_ms"].alias("ts_ms")]
    for part in ("source", "before", "after"):
        sub = st[part].dataType
        for f in sub.fields:
            cols.append(e[part][f.name].alias(f"{part}_{f.name}"))
    return decoded.select(*keep, *cols)


def decode_envelopes(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Records -> good envelopes flattened, with the source table and log
    position kept (``kafka_topic``, ``kafka_partition``, ``kafka_offset``)."""
    base = records.select(
        F.col("topic").alias("kafka_topic"),
        topic_part("topic", 2).alias("source_table"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("value"))
    good, _ = split_decoded(decode_json(base, schema))
    return flatten_envelope(good.drop("value"))


def decode_by_schema_id(df: DataFrame, schemas: dict[int, T.StructType],
                        unframed: T.StructType | None = None,
                        source: str = "value", into: str = "decoded") -> DataFrame:
    """Decode registry-framed JSON whose schema depends on the schema id.

    One pass: each row parses its payload only with the schema of its id
    (``CASE`` evaluates one branch), unframed values with ``unframed``; the
    per-schema results are merged into one struct whose fields are the union
    of all schemas (a field missing from a row's schema is NULL).  Rows of
    unknown ids get a NULL struct and ``schema_id`` kept for routing.  A
    payload that does not parse keeps its whole text in ``corrupt_record``
    (PERMISSIVE: the job goes on).
    """
    all_schemas = list(schemas.values()) + ([unframed] if unframed else [])
    fields: dict[str, T.DataType] = {}
    for sch in all_schemas:
        for f in sch.fields:
            fields[f.name] = _wider(fields.get(f.name), f.dataType, f.name)
    sid = wire_schema_id(source)
    payload = wire_payload(source).cast("string")
    branches = []
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    for i, (schema_id, sch) in enumerate(sorted(schemas.items())):
        branches.append((f"_s{i}", sch, F.when(
            sid == F.lit(schema_id),
            F.from_json(payload, with_corrupt_column(sch), opts))))
    if unframed is not None:
        branches.append(("_plain", unframed, F.when(
            sid.isNull(),
            F.from_json(F.col(source).cast("string"), with_corrupt_column(unframed), opts))))
    parsed = F.struct(sid.alias("schema_id"),
                      *[expr.alias(name) for name, _, expr in branches])
    staged = df.select("*", F.inline_outer(F.array(F.struct(parsed.alias("_dec")))))
    merged = []
    for name, dtype in fields.items():
        sources = [F.col(f"_dec.{b}.{name}") for b, sch, _ in branches
                   if name in sch.fieldNames()]
        merged.append((F.coalesce(*sources) if len(sources) > 1 else sources[0])
                      .cast(dtype).alias(name))
    corrupt = F.coalesce(*[F.col(f"_dec.{b}.{CORRUPT_COLUMN}") for b, _, _ in branches])
    parsed_ok = F.lit(False)
    for b, _, _ in branches:
        parsed_ok = parsed_ok | (F.col(f"_dec.{b}").isNotNull()
                                 & F.col(f"_dec.{b}.{CORRUPT_COLUMN}").isNull())
    return staged.select(*df.columns, F.col("_dec.schema_id").alias("schema_id"),
                         F.when(parsed_ok, F.struct(*merged)).alias(into),
                         corrupt.alias("corrupt_record"))


_NUMERIC_ORDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                  T.FloatType, T.DoubleType]


def _wider(a: T.DataType | None, b: T.DataType, name: str) -> T.DataType:
    """Type of a field seen with two types across schemas: numeric types
    widen (int -> bigint -> double); anything else must agree."""
    if a is None or a == b:
        return b
    rank = {t: i for i, t in enumerate(_NUMERIC_ORDER)}
    if type(a) in rank and type(b) in rank:
        return a if rank[type(a)] >= rank[type(b)] else b
    raise ValueError(f"field {name} has incompatible types {a} and {b} across schemas")


def decode_avro(df: DataFrame, avro_schema_json: str, source: str = "value",
                into: str = "decoded", framed: bool = True) -> DataFrame:
    """Avro payloads with a writer schema (JSON text).  Needs the spark-avro
    package on the classpath (absent in this repository's test image, so
    untested here); the payload after the registry header is decoded."""
    from pyspark.sql.avro.functions import from_avro

    payload = wire_payload(source) if framed else F.col(source)
    return df.withColumn(into, from_avro(payload, avro_schema_json,
                                         {"mode": "PERMISSIVE"}))
