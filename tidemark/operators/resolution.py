"""Messages of all versions of a subject, resolved to one reader schema.

A subject's versions are registered under schema ids.  A message is parsed with the
version it was written in, then resolved to the reader's: fields are matched by name
or by the reader field's aliases (renamed fields), numbers are promoted (int -> long ->
float -> double, decimals as in ``evolution``), a field that the writer lacks takes its
default, and fields that the reader lacks are dropped.  Versions that can't be resolved
raise before a message is read.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import wire_payload, wire_schema_id
from ..schemas import CORRUPT_COLUMN, with_corrupt_column
from .evolution import nullable


class NoDefault:
    """A field that every writer has to have."""

    def __repr__(self) -> str:
        return "NO_DEFAULT"


NO_DEFAULT = NoDefault()


@dataclass(frozen=True)
class Field:
    name: str
    type: T.DataType
    default: Any = NO_DEFAULT
    aliases: tuple[str, ...] = ()


@dataclass(frozen=True)
class Version:
    """A record schema as registered: its fields in order."""
    fields: tuple[Field, ...]

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, nullable(f.type)) for f in self.fields])


class Unresolvable(ValueError):
    """A writer's version that the reader's can't take."""


PROMOTED = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    T.IntegerType: (T.LongType, T.FloatType, T.DoubleType),
    T.LongType: (T.FloatType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
    T.StringType: (T.BinaryType,),
    T.BinaryType: (T.StringType,),
}


def _promoted(c: Column, have: T.DataType, want: T.DataType, at: str) -> Column:
    have, want = nullable(have), nullable(want)
    if have == want:
        return c
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        types = {f.name: f.dataType for f in have.fields}
        lacking = [f.name for f in want.fields if f.name not in types]
        if lacking:
            raise Unresolvable(f"{at}: the writer has no {', '.join(lacking)}")
        return F.when(c.isNotNull(), F.struct(*[
            _promoted(c.getField(f.name), types[f.name], f.dataType, f"{at}.{f.name}")
            .alias(f.name) for f in want.fields]))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        _promoted(F.lit(None).cast(have.elementType), have.elementType, want.elementType, at + "[]")
        return F.transform(c, lambda x: _promoted(x, have.elementType, want.elementType, at + "[]"))
    if isinstance(have, T.DecimalType) and isinstance(want, T.DecimalType) \
            and want.scale >= have.scale \
            and want.precision - want.scale >= have.precision - have.scale:
        return c.cast(want)
    if type(want) in PROMOTED.get(type(have), ()):
        return c.cast(want)
    raise Unresolvable(f"{at}: {have.simpleString()} can't be read as {want.simpleString()}")


def resolve(parsed: Column, writer: Version, reader: Version) -> Column:
    """Struct of the reader's fields out of a struct of the writer's."""
    written = {f.name: f for f in writer.fields}
    out = []
    for f in reader.fields:
        name = next((n for n in (f.name, *f.aliases) if n in written), None)
        if name is not None:
            value = _promoted(parsed.getField(name), written[name].type, f.type, f.name)
        elif f.default is NO_DEFAULT:
            raise Unresolvable(f"{f.name}: the writer lacks it and it has no default")
        else:
            value = F.lit(f.default).cast(f.type)
        out.append(value.alias(f.name))
    return F.struct(*out)


def decode_latest(df: DataFrame, versions: Mapping[int, Version], latest: int | None = None,
                  unframed: int | None = None, source: str = "value",
                  into: str = "message") -> DataFrame:
    """``df`` with ``schema_id``, ``into`` (the reader's struct; NULL for a tombstone, an
    unknown id or a text that does not parse) and ``corrupt_record`` (that text).

    ``latest`` is the id of the reader's version, the greatest by default; ``unframed``
    the id of the version that messages without a frame are written in.  Each row is
    parsed once, with its own version.
    """
    reader = versions[max(versions) if latest is None else latest]
    sid = wire_schema_id(source)
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    parts: list[tuple[str, Version, Column]] = []
    for i, (schema_id, version) in enumerate(sorted(versions.items())):
        schema = with_corrupt_column(version.struct())
        text = wire_payload(source).cast("string")
        mine = F.when(sid == F.lit(schema_id), text)
        if schema_id == unframed:
            mine = F.when(sid.isNull(), F.col(source).cast("string")).otherwise(mine)
        parts.append((f"_v{i}", version, F.from_json(mine, schema, opts)))
    staged = df.select("*", F.inline_outer(F.array(F.struct(
        sid.alias("schema_id"), F.struct(*[c.alias(n) for n, _, c in parts]).alias("_dec")))))
    good = [F.when(F.col(f"_dec.{n}").isNotNull() & F.col(f"_dec.{n}.{CORRUPT_COLUMN}").isNull(),
                   resolve(F.col(f"_dec.{n}"), v, reader)) for n, v, _ in parts]
    corrupt = F.coalesce(*[F.col(f"_dec.{n}.{CORRUPT_COLUMN}") for n, _, _ in parts])
    return staged.select(*df.columns, "schema_id", F.coalesce(*good).alias(into),
                         corrupt.alias("corrupt_record"))

