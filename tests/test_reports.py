"""Reports and data-quality checks on small hand-made inputs."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality, reports
from tidemark.schemas import RECORD


def _records(spark, rows):
    return spark.createDataFrame([(None, None, t, p, o, None, 0) for t, p, o in rows], RECORD)


def test_end_offsets_sum_partitions_and_absent_topics(spark):
    rec = _records(spark, [("pg.public.data1", 0, 0), ("pg.public.data1", 0, 2),
                           ("pg.public.data1", 1, 0), ("pg.public.data2", 0, 0)])
    got = {r["topic"]: r["messages"] for r in reports.topic_end_offsets(
        rec, expected_topics=["pg.public.data1", "pg.public.data2", "pg.public.data3"]).collect()}
    assert got == {"pg.public.data1": 4, "pg.public.data2": 1, "pg.public.data3": 0}


def test_table_counts_reference_golden(spark):
    rows = {"data1": [("asdf", "ghjk"), ("satuk", "gamma"), ("ble", "bleble")],
            "data2": [("zxcv", "bnm"), ("pizza", "hut")],
            "data3": [("kng", "gzzrd"), ("rtct", "mnks")]}
    tables = {n: spark.createDataFrame(r, "key string, value string") for n, r in rows.items()}
    got = {r["table_name"]: r["row_count"] for r in reports.table_counts(tables).collect()}
    assert got == {"data1": 3, "data2": 2, "data3": 2}
    from tidemark.operators.ingest import with_seed_rows
    seeded = with_seed_rows(tables, 1700000000)
    got = {r["table_name"]: r["row_count"] for r in reports.table_counts(seeded).collect()}
    assert got == {"data1": 4, "data2": 3, "data3": 3}
    assert seeded["data1"].where("key = 'seed_data1_1700000000'").count() == 1


def test_filters(spark):
    df = spark.createDataFrame([("pg.public.data1",), ("pg.public.data10",), ("other.x",)],
                               "topic string")
    assert df.where(reports.anchored_any("topic", ["pg.public.data1"])).count() == 1
    assert reports.filter_prefix(df, "topic", "pg.").count() == 2
    assert df.where(reports.topic_list("topic", "pg.public.data1, other.x")).count() == 2
    assert df.where(reports.include_patterns(F.col("topic"), [r"pg\.public\..*"])).count() == 2


def test_quality_checks(spark):
    found = spark.createDataFrame([("data1",), ("data2",), ("extra",)], "t string")
    assert [r[0] for r in quality.missing(["data1", "data3"], found, "t").collect()] == ["data3"]
    assert [r[0] for r in quality.unexpected(["data1", "data2"], found, "t").collect()] == ["extra"]
    ok = quality.non_empty({"a": found, "b": found.limit(0)})
    with pytest.raises(AssertionError):
        quality.require(ok)
    quality.require(ok.where("table_name = 'a'"))
    n = spark.createDataFrame([(0,)], "n long")
    assert quality.at_least("schemas", n, "n").first()["severity"] == "warn"


def test_require_counts_all_failures(spark):
    checks = spark.range(500).select(F.col("id").alias("check"), F.lit(False).alias("passed"))
    with pytest.raises(AssertionError, match="500 check"):
        quality.require(checks)


def test_included_topics(spark):
    rec = _records(spark, [("pg.public.a", 0, 0), ("pg.other.b", 0, 0), ("pg.public.a", 0, 1)])
    got = reports.included_topics(rec, F.expr("substring_index(topic, '.', -2)"), [r"public\..*"])
    assert [r["topic"] for r in got.collect()] == ["pg.public.a"] * 2
    assert reports.table_topics(["a"]) == ["pg.public.a"]
