"""Reader and writer versions of a subject."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import resolution as rs
from tidemark.operators.envelope import frame

LONG, INT, TEXT, DOUBLE = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()
V = {1: rs.Version((rs.Field("id", INT), rs.Field("name", TEXT))),
     2: rs.Version((rs.Field("id", LONG), rs.Field("title", TEXT, aliases=("name",)),
                    rs.Field("tags", T.ArrayType(INT), None))),
     3: rs.Version((rs.Field("id", DOUBLE), rs.Field("label", TEXT, aliases=("title", "name")),
                    rs.Field("tags", T.ArrayType(LONG), None), rs.Field("n", INT, 7)))}


def decode(spark, messages, **kw):
    df = spark.createDataFrame([(i, m) for i, (_, m) in enumerate(messages)], "i int, text string")
    ids = F.element_at(F.array(*[F.lit(s).cast("int") for s, _ in messages]), F.col("i") + 1)
    value = F.when(ids.isNull(), F.col("text").cast("binary")).otherwise(frame(F.col("text"), ids))
    out = rs.decode_latest(df.withColumn("value", value), V, **kw).orderBy("i")
    return [(r["schema_id"], r["message"] and r["message"].asDict(), r["corrupt_record"])
            for r in out.collect()]


def test_old_versions_are_read_as_the_latest(spark):
    got = decode(spark, [(1, '{"id": 5, "name": "x"}'), (2, '{"id": 6, "title": "y", "tags": [1, 2]}'),
                         (3, '{"id": 1.5, "label": "z", "n": null}'), (None, '{"id": 8, "name": "w"}')],
                 unframed=1)
    assert got == [
        (1, {"id": 5.0, "label": "x", "tags": None, "n": 7}, None),
        (2, {"id": 6.0, "label": "y", "tags": [1, 2], "n": 7}, None),
        (3, {"id": 1.5, "label": "z", "tags": None, "n": None}, None),
        (None, {"id": 8.0, "label": "w", "tags": None, "n": 7}, None)]


def test_unknown_ids_tombstones_and_bad_texts(spark):
    got = decode(spark, [(9, '{"id": 5}'), (1, '{"id":'), (1, "{}")])
    assert got == [(9, None, None), (1, None, '{"id":'),
                   (1, {"id": None, "label": None, "tags": None, "n": 7}, None)]
    df = spark.createDataFrame([(None,)], "value binary")
    assert rs.decode_latest(df, V, unframed=1).first()["message"] is None


def test_an_older_reader_can_be_asked_for(spark):
    with pytest.raises(rs.Unresolvable, match="id: double can't be read as bigint"):
        decode(spark, [(1, "{}")], latest=2)


@pytest.mark.parametrize("writer,reader,error", [
    (rs.Field("a", TEXT), rs.Field("a", INT), "string can't be read as int"),
    (rs.Field("b", TEXT), rs.Field("a", INT), "no default"),
    (rs.Field("a", T.DecimalType(9, 2)), rs.Field("a", T.DecimalType(9, 3)), "can't be read"),
    (rs.Field("a", T.ArrayType(TEXT)), rs.Field("a", T.ArrayType(INT)), r"a\[\]"),
    (rs.Field("a", T.StructType([T.StructField("x", INT)])),
     rs.Field("a", T.StructType([T.StructField("y", INT)])), "the writer has no y")])
def test_what_can_not_be_resolved_raises(spark, writer, reader, error):
    versions = {1: rs.Version((writer,)), 2: rs.Version((reader,))}
    df = spark.createDataFrame([(None,)], "value binary")
    with pytest.raises(rs.Unresolvable, match=error):
        rs.decode_latest(df, versions)
