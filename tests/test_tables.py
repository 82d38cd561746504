"""Catalog tables created once: later loads keep their columns and types."""

import json
import os
import uuid

import pytest

from tidemark.operators import ingest, tables
from tidemark.operators.tables import Appended, MisfitRows


@pytest.fixture()
def name(spark):
    n = "t_" + uuid.uuid4().hex[:10]
    yield n
    for t in (n, f"{n}_aside"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def make(spark, name, tmp_dir, ddl):
    tables.ensure_table(spark, name, spark.createDataFrame([], ddl).schema, f"{tmp_dir}/{name}")


def rows(spark, name):
    return sorted(map(tuple, spark.table(name).collect()), key=repr)


def test_the_first_schema_stays(spark, tmp_dir, name):
    make(spark, name, tmp_dir, "a int, b string")
    got = tables.ensure_table(spark, name, spark.createDataFrame([], "a string, z int").schema)
    assert got.simpleString() == "struct<a:int,b:string>"


@pytest.mark.parametrize("ddl,good,bad", [
    ("a bigint", ["1", " 2 ", "-9223372036854775808", None], ["x", "1.5", "", "9223372036854775808"]),
    ("a double", ["1", "2.5", "1e3", None], ["x", "1,5"]),
    ("a boolean", ["true", "False", None], ["maybe", "7"]),
    ("a date", ["2024-02-29", None], ["2023-02-29", "soon"]),
    ("a decimal(5,2)", ["123.45", None], ["12345.6", "x"])])
def test_texts_that_fit_and_do_not(spark, tmp_dir, name, ddl, good, bad):
    make(spark, name, tmp_dir, ddl)
    df = spark.createDataFrame([(v,) for v in [*good, *bad]], "a string")
    got = tables.fit_rows(df, spark.table(name).schema)
    assert [json.loads(r["source"]).get("a") for r in got.where("misfit is null").collect()] == good
    assert [r["misfit"] for r in got.where("misfit is not null").collect()] == [{"a": v} for v in bad]


@pytest.mark.parametrize("have,want,fits,misfits", [
    ("bigint", "int", [1, None, -5], [2 ** 40]), ("double", "bigint", [1.0, None], [1.5, 1e300]),
    ("double", "float", [0.5, None, float("nan")], [0.1]), ("bigint", "double", [7], [2 ** 53 + 1]),
    ("boolean", "string", [True, None], []), ("array<int>", "string", [None], [[1]])])
def test_typed_values(spark, tmp_dir, name, have, want, fits, misfits):
    make(spark, name, tmp_dir, f"a {want}")
    df = spark.createDataFrame([(v,) for v in [*fits, *misfits]], f"a {have}")
    got = tables.fit_rows(df, spark.table(name).schema)
    assert got.where("misfit is null").count() == len(fits)
    assert got.where("misfit is not null").count() == len(misfits)


def test_a_refused_load_writes_nothing(spark, tmp_dir, name):
    make(spark, name, tmp_dir, "a int, b string")
    tables.append_rows(spark, name, spark.createDataFrame([(1, "x")], "a int, b string"))
    before = sorted(os.listdir(f"{tmp_dir}/{name}"))
    df = spark.createDataFrame([("2", "y"), ("two", "z")], "a string, b string")
    with pytest.raises(MisfitRows, match="1 of 2 rows do not fit.*two"):
        tables.append_rows(spark, name, df)
    assert sorted(os.listdir(f"{tmp_dir}/{name}")) == before
    assert rows(spark, name) == [(1, "x")]


def test_misfits_aside_columns_by_name(spark, tmp_dir, name):
    make(spark, name, tmp_dir, "a int, b string, c double")
    df = spark.createDataFrame([("y", "2"), ("z", "two")], "B string, A string")
    assert tables.append_rows(spark, name, df, f"{name}_aside") == Appended(1, 1)
    assert rows(spark, name) == [(2, "y", None)]
    aside = spark.table(f"{name}_aside").collect()
    assert [(json.loads(r["source"]), r["misfit"]) for r in aside] == \
        [({"B": "z", "A": "two"}, {"a": "two"})]
    assert tables.append_rows(spark, name, df.limit(0), f"{name}_aside") == Appended(0, 0)


def test_unknown_and_clashing_columns_raise(spark, tmp_dir, name):
    make(spark, name, tmp_dir, "a int")
    with pytest.raises(MisfitRows, match="does not have: extra"):
        tables.append_rows(spark, name, spark.createDataFrame([(1, 2)], "a int, extra int"))
    df = spark.createDataFrame([(1, 2)], ["x", "y"]).toDF("a", "A")
    with pytest.raises(MisfitRows, match="differ in case"):
        tables.append_rows(spark, name, df)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_two_csv_loads_into_the_catalog(spark, tmp_dir, name):
    write(f"{tmp_dir}/1/{name}.csv", "key,value\n1,x\n2,y\n")
    write(f"{tmp_dir}/2/{name}.csv", "value,key\nz,three\nw,4\n")
    load = lambda k, **kw: ingest.load_catalog_tables(
        spark, {name: [f"{tmp_dir}/{k}/{name}.csv"]}, location=f"{tmp_dir}/tables", **kw)
    assert load(1) == {name: Appended(2, 0)}
    with pytest.raises(MisfitRows, match="three"):
        load(2)
    assert load(2, aside="_aside") == {name: Appended(1, 1)}
    assert rows(spark, name) == [(1, "x"), (2, "y"), (4, "w")]
    assert load(1) == {name: Appended(2, 0)}       # a re-run adds its rows again
    assert spark.table(name).count() == 5


def test_append_load_into_files_keeps_a_readable_table(spark, tmp_dir):
    write(f"{tmp_dir}/a/x.csv", "k,v\n1,5\n")
    write(f"{tmp_dir}/b/x.csv", "k,v\n2,text\n")
    write(f"{tmp_dir}/c/x.csv", "v,k\n6,3\n")
    out = f"{tmp_dir}/out"
    first = ingest.load_csv_tables(spark, f"{tmp_dir}/a", out, mode="append")
    with pytest.raises(MisfitRows, match="text"):
        ingest.load_csv_tables(spark, f"{tmp_dir}/b", out, mode="append")
    assert ingest.load_csv_tables(spark, f"{tmp_dir}/c", out, mode="append") == first
    assert sorted(map(tuple, spark.read.parquet(f"{out}/x").collect())) == [(1, 5), (3, 6)]
