"""Packed batches: reads unchanged, crashes, refused replays, changed columns."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import compaction
from tidemark.operators.compaction import drop_packed_folders, pack_batches
from tidemark.sources import lake
from tidemark.streaming.sinks import write_lake_batch, write_lake_batches


def stamp():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def batch(spark, n, lo=0):
    return spark.range(lo, lo + n).select(F.col("id").cast("int").alias("k"))


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def filled(spark, path, n=6):
    for b in range(n):
        write_lake_batch(batch(spark, b + 1, 100 * b), path, b, stamp())


def test_reads_are_unchanged(spark, tmp_dir):
    filled(spark, tmp_dir)
    want = rows(lake.read_lake(spark, tmp_dir))
    versions = [rows(lake.read_version(spark, tmp_dir, version=v)) for v in range(6)]
    history = lake.history(spark, tmp_dir).collect()
    first = pack_batches(spark, tmp_dir, 3)
    assert (first.lo, first.hi) == (0, 2)
    assert os.path.isdir(f"{tmp_dir}/batch_id=1")  # a reader that planned before may need it
    second = pack_batches(spark, tmp_dir, 5)
    assert (second.lo, second.hi) == (3, 4) and not os.path.isdir(f"{tmp_dir}/batch_id=1")
    assert pack_batches(spark, tmp_dir, 5) is None
    assert rows(lake.read_lake(spark, tmp_dir)) == want
    assert [rows(lake.read_version(spark, tmp_dir, version=v)) for v in range(6)] == versions
    assert lake.history(spark, tmp_dir).collect() == history
    assert len([n for n in os.listdir(tmp_dir) if n.startswith("batch_id=")]) == 1


def test_a_version_read_opens_only_its_packs(spark, tmp_dir):
    filled(spark, tmp_dir)
    first, second = pack_batches(spark, tmp_dir, 2), pack_batches(spark, tmp_dir, 6)
    drop_packed_folders(spark, tmp_dir)
    files = lake.read_version(spark, tmp_dir, version=1).inputFiles()
    assert files and all(first.name in f for f in files)
    assert any(second.name in f for f in lake.read_lake(spark, tmp_dir).inputFiles())
    assert lake.read_lake(spark, tmp_dir).count() == 21


def test_crashes_lose_and_double_nothing(spark, tmp_dir, monkeypatch):
    filled(spark, tmp_dir)
    want = rows(lake.read_lake(spark, tmp_dir))

    def fail(*_):
        raise OSError("no note")

    with monkeypatch.context() as m:
        m.setattr(compaction, "write_note", fail)  # the pack is there, the note is not
        with pytest.raises(OSError):
            pack_batches(spark, tmp_dir, 4)
    assert rows(lake.read_lake(spark, tmp_dir)) == want
    pack = pack_batches(spark, tmp_dir, 4)         # folders of its batches are still there
    assert rows(lake.read_lake(spark, tmp_dir)) == want
    assert os.listdir(f"{tmp_dir}/_packed") == [pack.name]
    assert drop_packed_folders(spark, tmp_dir) == 4
    assert rows(lake.read_lake(spark, tmp_dir)) == want


def test_packed_batches_are_not_written_again(spark, tmp_dir):
    filled(spark, tmp_dir, 3)
    pack_batches(spark, tmp_dir, 2)
    with pytest.raises(ValueError, match="packed"):
        write_lake_batch(batch(spark, 1), tmp_dir, 1, stamp())
    again = batch(spark, 4).withColumn("batch_id", F.lit(0))
    with pytest.raises(ValueError, match="packed"):
        write_lake_batches(again, tmp_dir, committed_at=stamp())
    assert write_lake_batch(batch(spark, 5), tmp_dir, 2, stamp()) == 5  # an open batch is
    assert lake.read_lake(spark, tmp_dir).count() == 1 + 2 + 5


def test_changed_columns_and_types(spark, tmp_dir):
    write_lake_batch(batch(spark, 2), tmp_dir, 0, stamp())
    write_lake_batch(batch(spark, 2).withColumn("b", F.lit("x")), tmp_dir, 1, stamp())
    write_lake_batch(batch(spark, 2).select(F.col("k").cast("long")), tmp_dir, 2, stamp())
    want = rows(lake.read_lake(spark, tmp_dir))
    pack_batches(spark, tmp_dir, 2)
    assert rows(lake.read_lake(spark, tmp_dir)) == want
    pack_batches(spark, tmp_dir, 3)
    drop_packed_folders(spark, tmp_dir)
    assert rows(lake.read_lake(spark, tmp_dir)) == want
    write_lake_batch(batch(spark, 2).select((F.col("k") / 2).alias("k"), F.lit(1).alias("c")),
                     tmp_dir, 3, stamp())
    df = lake.read_lake(spark, tmp_dir)
    assert dict(df.dtypes)["k"] == "double" and df.count() == 8 and {"b", "c"} <= set(df.columns)
    one = lake.read_lake(spark, tmp_dir, schema=batch(spark, 1).select(
        F.col("k").cast("long")).schema)
    assert one.columns == ["k", "batch_id"]


def test_late_batch_between_packs_and_empty_lake(spark, tmp_dir):
    for b in (0, 1, 4, 5):
        write_lake_batch(batch(spark, 1), tmp_dir, b, stamp())
    pack_batches(spark, tmp_dir, 2)
    pack_batches(spark, tmp_dir, 6)
    assert [(k.lo, k.hi) for k in lake.read_packs(spark, tmp_dir)] == [(0, 1), (4, 5)]
    write_lake_batch(batch(spark, 3), tmp_dir, 2, stamp())
    assert (pack_batches(spark, tmp_dir, 4).lo, lake.read_lake(spark, tmp_dir).count()) == (2, 7)
    with pytest.raises(ValueError, match="schema notes"):
        pack_batches(spark, f"{tmp_dir}/none", 3)
