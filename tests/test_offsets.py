"""Offset ranges of a replay and missing offsets."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import offsets


def log(spark, rows):
    return spark.createDataFrame([(t, p, o, f"k{o}") for t, p, o in rows],
                                 "topic string, partition int, offset long, key string")


def gaps(df, *args, **kw):
    return sorted(tuple(r) for r in offsets.offset_gaps(df, *args, **kw).collect())


def test_parse():
    assert offsets.offset_ranges() is None
    got = offsets.offset_ranges('{"t": {"0": 5, "1": -2}}', {"t": {"0": -1, "1": 9}})
    assert got == {("t", 0): (5, None), ("t", 1): (None, 9)}
    for bad in ((("latest",)), ({"t": {"0": -1}},), ("earliest", "earliest"),
                ("earliest", {"t": {"0": -2}}), ({"t": {"0": -7}},), ({"t": {"0": 1}}, {"t": {"1": 2}})):
        with pytest.raises(ValueError):
            offsets.offset_ranges(*bad)


def test_range_is_pushed_to_the_scan(spark, tmp_dir):
    log(spark, [("t", p, o) for p in range(2) for o in range(10)]).write.parquet(f"{tmp_dir}/log")
    df = spark.read.parquet(f"{tmp_dir}/log")
    got = offsets.replay_range(df, {"t": {"0": 4, "1": -2}}, {"t": {"0": 6, "1": 2}})
    assert sorted((r["partition"], r["offset"]) for r in got.collect()) == [(0, 4), (0, 5), (1, 0), (1, 1)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(offset,4)" in plan and "Exchange" not in plan
    assert offsets.replay_range(df, {}, "latest").count() == 0


def test_lost_offsets_raise_or_are_skipped(spark):
    df = log(spark, [("t", 0, o) for o in (3, 4, 7, 8)])
    with pytest.raises(offsets.LostOffsets, match="t-0: 0 to 2; t-0: 5 to 6; t-0: 9 to 9"):
        offsets.replay_range(df, {"t": {"0": 0}}, {"t": {"0": 10}})
    assert offsets.replay_range(df, {"t": {"0": 0}}, fail_on_data_loss=False).count() == 4
    assert offsets.replay_range(df, {"t": {"0": 7}}).count() == 2
    with pytest.raises(offsets.LostOffsets, match="t-1: 0 to 3"):
        offsets.replay_range(df, {"t": {"0": 7, "1": 0}}, {"t": {"0": 9, "1": 4}})


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 1), st.integers(0, 40)), max_size=40),
       st.integers(1, 12))
def test_gaps_property(spark, rows, width):
    want = []
    for key in sorted({(t, p) for t, p, _ in rows}):
        held = sorted({o for t, p, o in rows if (t, p) == key})
        want += [(*key, a + 1, b - 1, b - a - 1) for a, b in zip(held, held[1:]) if b > a + 1]
    assert gaps(log(spark, rows), width=width) == want
