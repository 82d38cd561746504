"""Plan shapes that matter at scale, checked on the physical plan (before
adaptive re-planning) of the registered queries."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from tidemark.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        E.queries()[name](spark, SF).explain("formatted")
    return buf.getvalue()


def _tree(plan):
    return plan.split("\n\n")[0]


def _count(tree, op):
    return len(re.findall(rf"\b{op} \(\d+\)", tree))


@pytest.mark.parametrize("name,shuffles", [
    ("enrich", 0), ("wire_header", 0), ("decode_envelope", 0), ("decode_framed", 0),
    ("snapshot_events", 0), ("table_names", 0),
    ("infer_types", 1), ("current_state", 1), ("op_counts", 1), ("decode_errors", 1),
    ("snapshot_diff", 1),
])
def test_shuffle_counts(spark, name, shuffles):
    assert _count(_tree(_plan(spark, name)), "Exchange") == shuffles


def test_filters_reach_the_scan(spark):
    assert "EqualTo(source_table,error)" in _plan(spark, "filter_table")
    assert "StringStartsWith(topic,pg.)" in _plan(spark, "topics_by_prefix")
    assert re.search(r"PushedFilters: \[In\(topic", _plan(spark, "topic_replay"))
    assert re.search(r"PushedFilters: \[In\(topic", _plan(spark, "expected_tables"))


def test_version_read_prunes_partitions(spark):
    plan = _plan(spark, "as_of_version")
    assert re.search(r"PartitionFilters: \[.*batch_id.* <= 1\)", plan)
    assert "Join" not in _tree(plan)


def test_columns_are_pruned(spark):
    plan = _plan(spark, "count_by_table")
    assert "ReadSchema: struct<source_table:string>" in plan
    assert "Join" not in _tree(plan)
    assert "ReadSchema: struct<value_envelopes:binary>" in _plan(spark, "current_state")


# Stream queries return a read of their sink; their work ran in the stream.
STREAMED = {"stream_enrich", "stream_lake", "stream_resume", "stream_replay",
            "schema_evolution", "batch_report", "stream_current_state",
            "stream_expiring_state"}


def test_no_python_in_any_plan(spark):
    for name in sorted(set(REGISTRY) - STREAMED):
        plan = _plan(spark, name)
        for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas",
                     "FlatMapGroupsInPandas"):
            assert node not in plan, (name, node)
