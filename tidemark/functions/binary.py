"""Binary payload helpers: text view, hex view, schema-registry framing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_text(value: Column | str) -> Column:
    """Bytes as text (the reference's ``avro_value_hex``; lossy on invalid
    UTF-8, kept for compatibility)."""
    return _col(value).cast("string")


def is_valid_utf8(value: Column | str) -> Column:
    return F.is_valid_utf8(_col(value).cast("string"))


def wire_magic(value: Column | str) -> Column:
    """First byte of a framed payload as INT (0 for the usual framing)."""
    return F.conv(F.hex(F.substring(_col(value), 1, 1)), 16, 10).cast("int")


def wire_schema_id(value: Column | str) -> Column:
    """Schema id from bytes 2-5 (big endian) when the payload is framed:
    magic byte 0 and at least 5 bytes; NULL otherwise."""
    v = _col(value)
    framed = (F.octet_length(v) >= 5) & (wire_magic(v) == 0)
    return F.when(framed, F.conv(F.hex(F.substring(v, 2, 4)), 16, 10).cast("bigint"))


def wire_payload(value: Column | str) -> Column:
    """Payload after the 5-byte frame header; NULL when not framed."""
    v = _col(value)
    return F.when(wire_schema_id(v).isNotNull(), F.substr(v, F.lit(6)))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
