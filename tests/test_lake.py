"""Lake sink: empty batches, replay, schema evolution, versions."""

from pyspark.sql import functions as F

from tidemark.sources import lake
from tidemark.streaming.sinks import batch_report_lines, write_lake_batch


def _batch(spark, n, extra=False):
    df = spark.range(n).select(F.col("id").alias("kafka_offset"),
                               F.lit("pg.public.t").alias("kafka_topic"))
    return df.withColumn("extra", F.lit("e")) if extra else df


def test_empty_batch_skipped(spark, tmp_dir):
    assert write_lake_batch(_batch(spark, 0), tmp_dir, 0) is None
    assert write_lake_batch(_batch(spark, 2), tmp_dir, 1) == 2
    assert lake.read_lake(spark, tmp_dir).count() == 2
    assert [r["batch_id"] for r in lake.history(spark, tmp_dir).collect()] == [1]


def test_replayed_batch_keeps_count(spark, tmp_dir):
    ts = F.lit("2024-02-01 00:00:00").cast("timestamp")
    assert write_lake_batch(_batch(spark, 5), tmp_dir, 0, ts) == 5
    write_lake_batch(_batch(spark, 3), tmp_dir, 1, ts)
    write_lake_batch(_batch(spark, 3), tmp_dir, 1, ts)   # replay
    t = lake.read_lake(spark, tmp_dir)
    assert t.count() == 8
    hist = {r["batch_id"]: r["row_count"] for r in lake.table_history(t).collect()}
    assert hist == {0: 5, 1: 3}


def test_schema_evolution_and_versions(spark, tmp_dir):
    write_lake_batch(_batch(spark, 2), tmp_dir, 0,
                     F.lit("2024-02-01 00:00:00").cast("timestamp"))
    write_lake_batch(_batch(spark, 2, extra=True), tmp_dir, 1,
                     F.lit("2024-02-02 00:00:00").cast("timestamp"))
    t = lake.read_lake(spark, tmp_dir, merge_schema=True)
    assert "extra" in t.columns
    assert t.where("extra is null").count() == 2
    assert lake.as_of_version(t, 0).count() == 2
    assert lake.as_of_timestamp(t, "2024-02-01 12:00:00").count() == 2
    plan = lake.as_of_version(t, 0)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "batch_id" in plan


def test_report_lines(spark):
    df = spark.createDataFrame([(None, "pg.public.t", 0, 3, "t")],
                               "kafka_key string, kafka_topic string, kafka_partition int, "
                               "kafka_offset long, source_table string")
    lines = sorted(r["line"] for r in batch_report_lines(df, 4).collect())
    assert lines == ["=== Micro-batch 4 (1 rows) ===",
                     "Key: None, Topic: pg.public.t, Partition: 0, Offset: 3, Table: t"]


def test_backfill_is_idempotent_and_matches_batches(spark, tmp_dir):
    from tidemark.streaming.sinks import write_lake_batches
    df = spark.range(10).select(F.col("id").alias("kafka_offset"),
                                (F.col("id") % 3).alias("batch_id"))
    ts = F.lit("2024-02-01 00:00:00").cast("timestamp")
    write_lake_batches(df, tmp_dir, committed_at=ts)
    write_lake_batches(df.where("batch_id = 1"), tmp_dir, committed_at=ts)  # re-run one batch
    t = lake.read_lake(spark, tmp_dir)
    hist = {r["batch_id"]: r["row_count"] for r in lake.table_history(t).collect()}
    assert hist == {0: 4, 1: 3, 2: 3}


def test_error_line_keeps_whole_message(spark):
    from tidemark.streaming.sinks import error_line
    df = spark.createDataFrame([("x" * 250,)], "m string")
    line = df.select(error_line(7, F.col("m"))).first()[0]
    assert line == "=== Batch 7 error: " + "x" * 250 + " ==="


def test_csv_paths_filter():
    from tidemark.sources.files import csv_paths
    assert csv_paths(["b.CSV", "a.txt", "c.csv"]) == ["b.CSV", "c.csv"]


def test_display_error_lines(spark):
    from tidemark.streaming.sinks import DISPLAY_ISSUE, display_error_lines
    df = spark.createDataFrame([("y" * 150,)], "m string")
    a, b = df.select(*display_error_lines(F.col("m"))).first()
    assert a == DISPLAY_ISSUE and b == "Error: " + "y" * 100


def test_unfinished_write_is_invisible_and_replaced(spark, tmp_dir):
    """A crash before the write job's commit leaves only a temporary folder."""
    import os

    from tidemark.streaming.sinks import batch_dir
    write_lake_batch(_batch(spark, 4), tmp_dir, 0)
    left = f"{batch_dir(tmp_dir, 1)}/_temporary/0/task_1"
    os.makedirs(left)
    with open(f"{left}/part-0.parquet", "wb") as f:
        f.write(b"half a file")
    assert lake.read_lake(spark, tmp_dir).count() == 4
    write_lake_batch(_batch(spark, 9), tmp_dir, 1)
    assert lake.read_lake(spark, tmp_dir).count() == 13
    hist = lake.history(spark, tmp_dir).collect()
    assert [(r["batch_id"], r["row_count"]) for r in hist] == [(0, 4), (1, 9)]


def test_backfill_shows_its_batches_only(spark, tmp_dir):
    from tidemark.streaming.sinks import write_lake_batches
    df = spark.range(6).select(F.col("id").alias("kafka_offset"),
                               F.when(F.col("id") < 2, 1).otherwise(5).alias("batch_id"))
    write_lake_batches(df, tmp_dir)
    hist = lake.history(spark, tmp_dir).collect()
    assert [(r["batch_id"], r["row_count"]) for r in hist] == [(1, 2), (5, 4)]


def test_version_read_needs_no_other_batch(spark, tmp_dir):
    """With a known schema a version read opens only its own folders."""
    import glob

    for b in range(3):
        write_lake_batch(_batch(spark, 2), tmp_dir, b,
                         F.lit(f"2024-02-0{b + 1} 00:00:00").cast("timestamp"))
    schema = lake.read_lake(spark, tmp_dir).schema
    for path in glob.glob(f"{tmp_dir}/batch_id=2/*.parquet"):
        with open(path, "r+b") as f:
            f.truncate(3)
    t = lake.read_version(spark, tmp_dir, version=1, schema=schema)
    assert t.count() == 4
    assert "PartitionFilters" in t._jdf.queryExecution().executedPlan().toString()


def test_timestamp_read(spark, tmp_dir):
    for b in range(3):
        write_lake_batch(_batch(spark, 2), tmp_dir, b,
                         F.lit(f"2024-02-0{b + 1} 00:00:00").cast("timestamp"))
    t = lake.read_version(spark, tmp_dir, timestamp="2024-02-02 12:00:00")
    assert t.count() == 4
    assert lake.read_version(spark, tmp_dir, timestamp="2024-01-01 00:00:00").count() == 0
    assert "LessThanOrEqual(committed_at" in t._jdf.queryExecution().toString()


def test_failed_report_leaves_its_error(spark, tmp_dir):
    import pytest

    from tidemark.streaming.sinks import REPORT_TITLE, write_report_batch, write_report_title
    write_report_title(spark, tmp_dir)
    write_report_title(spark, tmp_dir)
    df = spark.createDataFrame([("k", "pg.public.t", 0, 3, "t")],
                               "kafka_key string, kafka_topic string, kafka_partition int, "
                               "kafka_offset long, source_table string")
    bad = df.withColumn("kafka_key", F.raise_error(F.lit("broken " * 40)).cast("string"))
    with pytest.raises(Exception):
        write_report_batch(bad, tmp_dir, 2)
    lines = [r["value"] for r in spark.read.text(tmp_dir).collect()]
    assert lines.count(REPORT_TITLE) == 1
    whole = next(x for x in lines if x.startswith("=== Batch 2 error: "))
    assert "broken " * 39 in whole
    assert len(next(x for x in lines if x.startswith("Error: "))) == len("Error: ") + 100
    write_report_batch(df, tmp_dir, 3)
    assert spark.read.text(tmp_dir).where("value like 'Key: k,%'").count() == 1


def test_shared_folder_is_needed_off_local_mode(monkeypatch):
    import pytest

    from tidemark import session

    class Conf:
        def __init__(self, master):
            self.values = {"spark.master": master}

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Context:
        def __init__(self, master):
            self.conf = Conf(master)

        def getConf(self):
            return self.conf

        def getCheckpointDir(self):
            return None

    class Session:
        def __init__(self, master):
            self.conf, self.sparkContext = Conf(master), Context(master)

    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            session.checkpoint_root(Session(master))


def test_scratch_is_cleared(spark):
    import os

    from tidemark import session
    path = session.scratch_path(spark, "x")
    spark.range(1).write.parquet(path)
    assert path.startswith(session.scratch_root(spark))
    session.delete_path(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))
    session.delete_path(spark, path)
