"""Envelopes and change data capture."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import cdc, envelope
from tidemark.schemas import ENVELOPE


def test_decode_split_good_bad_tombstone(spark):
    df = spark.createDataFrame([
        ('{"op":"c","lsn":1,"k":7,"after":{"user_id":7,"value":1.5}}',),
        ('{"op":',),
        (None,)], "value string")
    good, bad = envelope.split_decoded(envelope.decode_json(df, ENVELOPE))
    assert bad.count() == 1
    assert bad.first()["corrupt_record"] == '{"op":'
    g = good.orderBy("value").collect()
    assert len(g) == 2
    assert g[0]["envelope"] is None                      # tombstone kept
    assert g[1]["envelope"]["after"]["value"] == 1.5


def test_snapshot_diff_ops(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, v string")
    b = spark.createDataFrame([(2, "y2"), (3, None), (4, "z")], "id int, v string")
    got = {r["id"]: r["op"] for r in cdc.snapshot_diff(a, b, ["id"]).collect()}
    assert got == {1: "d", 2: "u", 4: "c"}          # 3 unchanged (NULL = NULL)


@pytest.mark.parametrize("side", [0, 1])
def test_snapshot_diff_duplicate_key_fails(spark, side):
    dup = spark.createDataFrame([(1, "x"), (1, "y")], "id int, v string")
    one = spark.createDataFrame([(1, "x")], "id int, v string")
    pair = (dup, one) if side == 0 else (one, dup)
    with pytest.raises(Exception, match="duplicate key"):
        cdc.snapshot_diff(*pair, ["id"]).collect()


def test_snapshot_diff_null_keys_and_widened_type(spark):
    a = spark.createDataFrame([(None, "x"), (1, "y")], "id int, v string")
    b = spark.createDataFrame([(None, "x"), (1, "z")], "id bigint, v string")
    got = [(r["id"], r["op"]) for r in cdc.snapshot_diff(a, b, ["id"]).collect()]
    assert got == [(1, "u")]
    c = b.withColumn("v", F.lit("new"))
    assert sorted(r["op"] for r in cdc.snapshot_diff(b, c, ["id"]).collect()) == ["u", "u"]


def test_digest_diff_ops_nulls_and_widened_types(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, "y", None), (3, None, 7), (None, "n", 4)],
                              "id int, v string, w int")
    b = spark.createDataFrame([(2, None, "y"), (3, "7", None), (4, "1", "z"), (None, "4", "n")],
                              "id bigint, w string, v string")
    diff = cdc.snapshot_diff_by_digest(a, b, ["id"])
    assert {r["id"]: r["op"] for r in diff.collect()} == {1: "d", 4: "c"}
    swapped = spark.createDataFrame([(2, "y", None)], "id int, w string, v string")
    got = cdc.snapshot_diff_by_digest(a.where("id = 2"), swapped, ["id"]).collect()
    assert [r["op"] for r in got] == ["u"]      # (y, NULL) is not (NULL, y)


@pytest.mark.parametrize("side", [0, 1])
def test_digest_diff_duplicate_key_fails(spark, side):
    dup = spark.createDataFrame([(1, "x"), (1, "x")], "id int, v string")
    one = spark.createDataFrame([(1, "x")], "id int, v string")
    pair = (dup, one) if side == 0 else (one, dup)
    with pytest.raises(Exception, match="duplicate key"):
        cdc.snapshot_diff_by_digest(*pair, ["id"]).collect()


def test_digest_diff_touches_changed_keys_only(spark):
    a = spark.range(20_000).select("id", (F.col("id") % 7).alias("k2"), F.struct(
        F.lit("image").alias("t"), F.array(F.col("id")).alias("l")).alias("row"))
    b = a.where("id <> 5").withColumn("row", F.when(F.col("id") == 77, F.lit(None))
                                      .otherwise(F.col("row"))).union(
        spark.range(1).select(F.lit(-1).cast("long"), F.lit(0).cast("long"), F.struct(
            F.lit("new").alias("t"), F.array(F.lit(1).cast("long")).alias("l"))))
    for buckets in (1, 64, cdc.DIGEST_BUCKETS):
        old, new = cdc.changed_rows(a, b, ["id", "k2"], buckets)
        assert sorted(r["id"] for r in old.collect()) == [5, 77]
        assert sorted(r["id"] for r in new.collect()) == [-1, 77]
    ops = cdc.snapshot_diff_by_digest(a, b, ["id", "k2"]).collect()
    assert {r["id"]: r["op"] for r in ops} == {-1: "c", 5: "d", 77: "u"}
    assert cdc.snapshot_diff_by_digest(a, a, ["id", "k2"]).count() == 0
    empty = a.limit(0)
    assert cdc.snapshot_diff_by_digest(empty, a, ["id", "k2"]).where("op = 'c'").count() == 20_000


def test_change_without_an_operation_raises(spark):
    df = spark.createDataFrame([(1, None, 5, (1,))], "k long, op string, lsn long, "
                                                     "after struct<v:long>")
    with pytest.raises(Exception, match="without an operation"):
        cdc.current_state(df, "k", ["lsn"]).collect()


def _apply(snapshot, changes, keys):
    """Reference semantics of a change set: drop changed keys, add images."""
    changed = changes.select(*keys).distinct()
    kept = snapshot.join(changed, keys, "left_anti")
    added = changes.where(F.col("op") != "d").select("after.*")
    return kept.unionByName(added)


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 30), st.one_of(st.none(), st.integers(0, 3))),
       st.dictionaries(st.integers(0, 30), st.one_of(st.none(), st.integers(0, 3))))
def test_diff_applied_to_a_gives_b(spark, a_rows, b_rows):
    a = spark.createDataFrame(list(a_rows.items()), "id int, v int")
    b = spark.createDataFrame(list(b_rows.items()), "id int, v int")
    out = _apply(a, cdc.snapshot_diff(a, b, ["id"]), ["id"])
    assert sorted(out.collect()) == sorted(b.collect())
    by_digest = cdc.snapshot_diff_by_digest(a, b, ["id"], buckets=4)
    assert sorted(by_digest.collect()) == sorted(cdc.snapshot_diff(a, b, ["id"]).collect())


def test_current_state_last_by_lsn_and_deletes(spark):
    rows = [(1, "c", 1, (1, 1.0)), (1, "u", 5, (1, 5.0)), (1, "u", 3, (1, 3.0)),
            (2, "c", 2, (2, 2.0)), (2, "d", 4, None)]
    df = spark.createDataFrame(rows, "k long, op string, lsn long, "
                                     "after struct<user_id:long,value:double>")
    got = cdc.current_state(df, "k", ["lsn"]).collect()
    assert len(got) == 1 and got[0]["k"] == 1 and got[0]["value"] == 5.0


def test_current_state_tie_break(spark):
    rows = [(1, "u", 5, 0, (1, 1.0)), (1, "u", 5, 1, (1, 2.0))]
    df = spark.createDataFrame(rows, "k long, op string, lsn long, seq int, "
                                     "after struct<user_id:long,value:double>")
    got = cdc.current_state(df, "k", ["lsn", "seq"]).first()
    assert got["value"] == 2.0


def test_current_state_hot_key(spark):
    """One key holds most changes: still one output row, the last one."""
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 10 < 7, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.lit("u").alias("op"), F.col("id").alias("lsn"),
        F.struct(F.col("id").alias("user_id"), F.col("id").cast("double").alias("value"))
        .alias("after"))
    got = cdc.current_state(df, "k", ["lsn"]).where("k = 0").first()
    assert got["lsn"] == 19996


def test_route_topic(spark):
    df = spark.createDataFrame([("data1",)], "t string")
    assert df.select(cdc.route_topic("t")).first()[0] == "pg.public.data1"


def test_decode_by_schema_id(spark):
    from pyspark.sql import types as T
    k_long = T.StructType([T.StructField("k", T.LongType())])
    k_and_s = T.StructType([T.StructField("k", T.IntegerType()),
                            T.StructField("s", T.StringType())])
    df = spark.createDataFrame([('{"k": 1}', 5), ('{"k": 2, "s": "x"}', 6),
                                ('{"k": 3}', 9)], "p string, id int")
    df = df.select(envelope.frame(F.col("p"), F.col("id")).alias("value"))
    df = df.unionByName(spark.createDataFrame([(bytearray(b'{"k": 4}'),)], "value binary"))
    out = envelope.decode_by_schema_id(df, {5: k_long, 6: k_and_s})
    rows = sorted((r["schema_id"] is None, r["schema_id"], r["decoded"]) for r in out.collect())
    assert rows[0][1:] == (5, (1, None))
    assert rows[1][1:] == (6, (2, "x"))
    assert rows[2][1:] == (9, None)              # unknown id: kept, not decoded
    assert rows[3][1:] == (None, None)           # not framed, no plain schema
    assert out.schema["decoded"].dataType["k"].dataType == T.LongType()


def test_decode_by_schema_id_rejects_conflicts(spark):
    from pyspark.sql import types as T
    a = T.StructType([T.StructField("k", T.LongType())])
    b = T.StructType([T.StructField("k", T.StringType())])
    df = spark.createDataFrame([(bytearray(b"x"),)], "value binary")
    with pytest.raises(ValueError):
        envelope.decode_by_schema_id(df, {1: a, 2: b})


def test_snapshot_diff_schema_change(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    b = spark.createDataFrame([(1, "x", None), (2, "y", 5)], "id int, v string, w int")
    got = {r["id"]: r["op"] for r in cdc.snapshot_diff(a, b, ["id"]).collect()}
    assert got == {2: "u"}


def test_snapshot_and_insert_events_carry(spark):
    df = spark.createDataFrame([("a", "1", 5)], "key string, value string, lsn long")
    r = cdc.snapshot_events(df, ["key"], carry=["lsn"]).first()
    assert (r["op"], r["before"], tuple(r["after"]), r["lsn"]) == ("r", None, ("a", "1"), 5)
    c = cdc.snapshot_events(df, ["key"], op="c", carry=["lsn"]).first()
    assert c["op"] == "c"


def test_decode_by_schema_id_flags_bad_payload(spark):
    from pyspark.sql import types as T
    k_long = T.StructType([T.StructField("k", T.LongType())])
    df = spark.createDataFrame([('{"k": 1}', 5), ('{"k":', 5)], "p string, id int")
    df = df.select(envelope.frame(F.col("p"), F.col("id")).alias("value"))
    rows = {r["corrupt_record"]: r["decoded"] for r in
            envelope.decode_by_schema_id(df, {5: k_long}).collect()}
    assert rows == {None: (1,), '{"k":': None}
