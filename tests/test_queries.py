"""Every registered query against its DuckDB oracle on sf0.001 (the
driver's own check runs at sf0.01)."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.plans.catalog import REGISTRY
from tidemark.plans.oracle import SQL

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("set timezone='UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(SQL)
    assert set(REGISTRY) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["source_table", "count"]
    assert df.count() == 5


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string",
                 "DOUBLE": "double", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    duck_types = {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == \
        _rows(rel.columns, rel.fetchall())
