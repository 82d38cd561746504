"""Lakes whose columns and types change from batch to batch."""

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import evolution as ev
from tidemark.sources import lake
from tidemark.streaming.sinks import write_lake_batch, write_lake_batches

def stamp():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def put(spark, path, batch_id, sql):
    write_lake_batch(spark.sql(sql), path, batch_id, stamp())


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


TYPES = [T.NullType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(),
         T.DoubleType(), T.DecimalType(10, 2), T.DecimalType(38, 0), T.StringType(), T.BooleanType(),
         T.DateType(), T.TimestampType(), T.TimestampNTZType()]


@settings(max_examples=200, deadline=None)
@given(st.sampled_from(TYPES), st.sampled_from(TYPES))
def test_lattice_is_commutative_and_idempotent(a, b):
    both = ev.common_type(a, b)
    assert both == ev.common_type(b, a)
    assert ev.common_type(both, a) == both and ev.common_type(both, b) == both
    assert ev.common_type(a, a) == a


@pytest.mark.parametrize("a,b,want", [
    ("int", "bigint", "bigint"), ("int", "double", "double"), ("bigint", "double", "double"),
    ("tinyint", "smallint", "smallint"), ("float", "double", "double"),
    ("int", "decimal(5,2)", "decimal(12,2)"), ("bigint", "decimal(38,30)", "double"),
    ("date", "timestamp", "timestamp"), ("int", "string", "string"), ("boolean", "int", "string"),
    ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>"),
    ("array<int>", "array<double>", "array<double>"),
    ("map<string,int>", "map<string,bigint>", "map<string,bigint>")])
def test_common_types(spark, a, b, want):
    got = ev.common_type(T._parse_datatype_string(a), T._parse_datatype_string(b))
    assert got.simpleString() == want


@pytest.mark.parametrize("a,b", [("struct<a:int>", "int"), ("array<int>", "string"),
                                 ("binary", "string"), ("map<string,int>", "array<int>")])
def test_types_without_a_common_one_raise(spark, a, b):
    with pytest.raises(ev.SchemaConflict, match="column c: "):
        ev.common_struct(T._parse_datatype_string(f"c {a}"), T._parse_datatype_string(f"c {b}"))


def test_conform_nested(spark):
    df = spark.sql("select struct(1 as a) as s, array(struct(2 as x)) as l, map('k', 1) as m, 3 as n "
                   "union all select null, null, null, null")
    want = T._parse_datatype_string("n double, s struct<b:string,a:bigint>, "
                                    "l array<struct<x:bigint,y:int>>, m map<string,bigint>, z date")
    out = ev.conform(df, want)
    assert ev.nullable(out.schema) == want
    assert out.where("n = 3").first().asDict(recursive=True) == {
        "n": 3.0, "s": {"b": None, "a": 1}, "l": [{"x": 2, "y": None}], "m": {"k": 1}, "z": None}
    assert tuple(out.where("n is null").first()) == (None, None, None, None, None)


def test_added_column_shows_in_a_default_and_a_version_read(spark, tmp_dir):
    put(spark, tmp_dir, 0, "select 1 as a")
    put(spark, tmp_dir, 1, "select 2 as a, 'x' as b")
    assert rows(lake.read_lake(spark, tmp_dir), "batch_id", "a", "b") == [(0, 1, None), (1, 2, "x")]
    assert rows(lake.read_version(spark, tmp_dir, version=1), "a", "b") == [(1, None), (2, "x")]
    assert rows(lake.read_version(spark, tmp_dir, version=0), "a", "b") == [(1, None)]
    plan = lake.read_lake(spark, tmp_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1  # added columns alone need one scan


def test_widened_types_and_text(spark, tmp_dir):
    big = 2 ** 40
    put(spark, tmp_dir, 0, "select 1 as a, 10 as b")
    put(spark, tmp_dir, 1, f"select cast({big} as bigint) as a, 11 as b")
    put(spark, tmp_dir, 2, "select cast(0.5 as double) as a, 'twelve' as b")
    put(spark, tmp_dir, 3, "select 4 as a, 10 as b")
    got = lake.read_lake(spark, tmp_dir)
    assert dict(got.dtypes)["a"] == "double" and dict(got.dtypes)["b"] == "string"
    assert rows(got, "batch_id", "a", "b") == [(0, 1.0, "10"), (1, float(big), "11"),
                                               (2, 0.5, "twelve"), (3, 4.0, "10")]
    version = lake.read_version(spark, tmp_dir, version=1)
    assert rows(version, "a", "b") == [(1.0, "10"), (float(big), "11")]
    assert "PartitionFilters" in version._jdf.queryExecution().executedPlan().toString()
    assert [r["batch_id"] for r in lake.history(spark, tmp_dir).collect()] == [0, 1, 2, 3]


def notes(path):
    return [n for n in os.listdir(f"{path}/_schemas") if not n.startswith(".")]


def test_one_note_per_change(spark, tmp_dir):
    for b in range(4):
        put(spark, tmp_dir, b, "select 1 as a")
    assert len(notes(tmp_dir)) == 1
    put(spark, tmp_dir, 4, "select 1 as a, 2 as b")
    put(spark, tmp_dir, 5, "select 1 as a, 2 as b")
    put(spark, tmp_dir, 5, "select 1 as a, 2 as b")
    assert len(notes(tmp_dir)) == 2


def test_a_batch_replayed_under_another_schema(spark, tmp_dir):
    for b in range(3):
        put(spark, tmp_dir, b, "select 1 as a")
    put(spark, tmp_dir, 1, "select 'one' as a, 5 as c")     # later batches keep theirs
    got = lake.read_lake(spark, tmp_dir)
    assert rows(got, "batch_id", "a", "c") == [(0, "1", None), (1, "one", 5), (2, "1", None)]
    put(spark, tmp_dir, 1, "select 1 as a")                 # and back
    assert rows(lake.read_lake(spark, tmp_dir), "batch_id", "a") == [(0, 1), (1, 1), (2, 1)]


def test_backfill_into_a_lake_of_another_schema(spark, tmp_dir):
    for b in range(6):
        put(spark, tmp_dir, b, "select 1 as a")
    df = spark.sql("select explode(array(1, 2, 4, 9)) as batch_id").withColumn("a", F.lit(2.5))
    write_lake_batches(df, tmp_dir, committed_at=stamp())
    assert rows(lake.read_lake(spark, tmp_dir), "batch_id", "a") == \
        [(0, 1.0), (1, 2.5), (2, 2.5), (3, 1.0), (4, 2.5), (5, 1.0), (9, 2.5)]
    put(spark, tmp_dir, 10, "select 1 as a")
    assert lake.read_lake(spark, tmp_dir).count() == 8


def test_batches_without_a_note(spark, tmp_dir):
    spark.sql("select 1 as a, timestamp'2024-02-01 00:00:00' as committed_at") \
        .write.parquet(f"{tmp_dir}/batch_id=0")
    assert rows(lake.read_lake(spark, tmp_dir), "a") == [(1,)]
    put(spark, tmp_dir, 1, "select cast(2 as bigint) as a, 'x' as b")
    assert rows(lake.read_lake(spark, tmp_dir), "batch_id", "a", "b") == [(0, 1, None), (1, 2, "x")]


def test_a_crash_between_note_and_batch_leaves_the_old_batch_readable(spark, tmp_dir):
    put(spark, tmp_dir, 0, "select 1 as a")
    lake.note_schema(spark, tmp_dir, T._parse_datatype_string(
        "a int, b string, committed_at timestamp"), [(0, 0)])
    assert rows(lake.read_lake(spark, tmp_dir), "a", "b") == [(1, None)]


def test_conflicting_batches_raise(spark, tmp_dir):
    put(spark, tmp_dir, 0, "select 1 as a")
    put(spark, tmp_dir, 1, "select array(1) as a")
    with pytest.raises(ev.SchemaConflict):
        lake.read_lake(spark, tmp_dir)


def test_epochs():
    a, b = T.StructType([T.StructField("a", T.LongType())]), T.StructType([])
    note = lake.SchemaNote
    assert lake.schema_epochs([note(0, None, a, 1), note(5, None, b, 2), note(7, 7, a, 3)]) == [
        (None, -1, None), (0, 4, a), (5, 6, b), (7, 7, a), (8, None, b)]
    assert lake.schema_epochs([note(2, 3, a, 1)]) == [(None, 1, None), (2, 3, a), (4, None, None)]
