"""Schemas that change over time: the least common type of several versions, and
rows of one version conformed to another.

The lattice of types: null below everything; byte < short < int < bigint <
decimal(20) and more < double, float < double (whole numbers beyond 2^53 lose
digits there, as in any table of doubles); date < timestamp; what has no other
type in common meets at string (the text of a scalar holds it).  Structs meet field
by field (by name; a field that one side lacks is NULL there), arrays and maps by
their elements.  A nested type and a scalar, or binary and anything else, have
nothing in common: that raises, so no value is turned into something else in
silence.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Decimal digits that hold every value of an integer type.
INTEGERS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
NESTED = (T.StructType, T.ArrayType, T.MapType)


class SchemaConflict(ValueError):
    """Two versions of a column with no type in common."""


def _decimals(a: T.DataType, b: T.DataType) -> T.DataType:
    def parts(t: T.DataType) -> tuple[int, int]:
        if isinstance(t, T.DecimalType):
            return t.precision - t.scale, t.scale
        return INTEGERS[type(t)], 0

    (whole_a, scale_a), (whole_b, scale_b) = parts(a), parts(b)
    scale = max(scale_a, scale_b)
    digits = max(whole_a, whole_b) + scale
    return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()


def common_type(a: T.DataType, b: T.DataType, at: str = "") -> T.DataType:
    """Least type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_struct(a, b, at)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType, f"{at}[]"))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType, f"{at}{{}}"),
                         common_type(a.valueType, b.valueType, f"{at}{{}}"))
    if isinstance(a, (*NESTED, T.BinaryType)) or isinstance(b, (*NESTED, T.BinaryType)):
        raise SchemaConflict(f"column {at}: {a.simpleString()} and {b.simpleString()} have no "
                             "type in common")
    kinds = {type(a), type(b)}
    if kinds <= set(INTEGERS):
        return max(a, b, key=lambda t: INTEGERS[type(t)])
    if kinds <= {*INTEGERS, T.DecimalType}:
        return _decimals(a, b)
    if kinds <= {*INTEGERS, T.DecimalType, T.FloatType, T.DoubleType}:
        return T.DoubleType()
    for dated in (T.TimestampType, T.TimestampNTZType):
        if kinds == {T.DateType, dated}:
            return dated()
    return T.StringType()


def common_struct(a: T.StructType, b: T.StructType, at: str = "") -> T.StructType:
    """Fields of ``a`` in their order, then those that only ``b`` has."""
    other = {f.name: f.dataType for f in b.fields}
    known = {f.name for f in a.fields}
    path = f"{at}." if at else ""
    return T.StructType(
        [T.StructField(f.name, common_type(f.dataType, other[f.name], path + f.name)
                       if f.name in other else f.dataType) for f in a.fields]
        + [T.StructField(f.name, f.dataType) for f in b.fields if f.name not in known])


def common_schema(schemas: Iterable[T.StructType]) -> T.StructType:
    """Schema that holds the rows of all versions."""
    return reduce(common_struct, map(nullable, schemas), T.StructType([]))


def nullable(t: T.DataType) -> T.DataType:
    """The type with every part nullable and without metadata."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(nullable(t.elementType))
    if isinstance(t, T.MapType):
        return T.MapType(nullable(t.keyType), nullable(t.valueType))
    return t


def agrees(version: T.StructType, whole: T.StructType) -> bool:
    """Whether rows of ``version`` can be read under ``whole`` as they are: it only
    lacks columns."""
    types = {f.name: f.dataType for f in whole.fields}
    return all(types.get(f.name) == f.dataType for f in nullable(version).fields)


def conform_column(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """``c`` of type ``have`` as ``want``; struct fields are matched by name."""
    if have == want:
        return c
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        types = {f.name: f.dataType for f in have.fields}
        made = F.struct(*[
            (conform_column(c.getField(f.name), types[f.name], f.dataType) if f.name in types
             else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields])
        return F.when(c.isNotNull(), made)
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: conform_column(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        return F.map_from_arrays(
            conform_column(F.map_keys(c), T.ArrayType(have.keyType), T.ArrayType(want.keyType)),
            conform_column(F.map_values(c), T.ArrayType(have.valueType),
                           T.ArrayType(want.valueType)))
    return c.cast(want)


def conform(df: DataFrame, want: T.StructType) -> DataFrame:
    """``df`` with the columns of ``want``, by name; a missing one is NULL."""
    types = {f.name: nullable(f.dataType) for f in df.schema.fields}
    return df.select(*[
        (conform_column(F.col(f"`{f.name}`"), types[f.name], f.dataType) if f.name in types
         else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields])
