"""Stream progress as a table."""

import json

from pyspark.sql import functions as F

from tidemark.streaming import jobs, metrics


def report(**kw):
    base = {"id": "q", "runId": "r1", "name": None, "timestamp": "2024-02-01T00:00:00.000Z",
            "batchId": 0, "durationMs": {"triggerExecution": 500, "addBatch": 400},
            "eventTime": {}, "stateOperators": [], "sources": [{"numInputRows": 10}]}
    return json.dumps({**base, **kw})


def test_reports_as_rows(spark, tmp_dir):
    with open(f"{tmp_dir}/a.json", "w") as f:
        f.write(report() + "\n")
        f.write(report(batchId=1, sources=[{"numInputRows": 4}, {"numInputRows": 3}],
                       eventTime={"watermark": "2024-01-31T00:00:00.000Z"},
                       stateOperators=[{"numRowsTotal": 5, "numRowsUpdated": 2},
                                       {"numRowsTotal": 6, "numRowsRemoved": 1}]) + "\n")
        f.write(report(runId="r2", timestamp="2024-02-01T00:01:00.000Z",
                       sources=[{"numInputRows": 12}]) + "\n")
    rows = {r["batch_id"]: r for r in metrics.read_progress(spark, tmp_dir).collect()}
    assert rows[0]["input_rows"] == 12 and rows[0]["run_id"] == "r2"   # the replay's figures
    assert rows[0]["rows_per_second"] == 24.0 and rows[0]["watermark"] is None
    assert (rows[1]["input_rows"], rows[1]["state_rows"]) == (7, 11)
    assert (rows[1]["state_rows_updated"], rows[1]["state_rows_removed"]) == (2, 1)
    assert rows[1]["watermark"] is not None


def test_no_reports(spark, tmp_dir):
    assert metrics.read_progress(spark, f"{tmp_dir}/none").count() == 0


def test_rows_of_state(spark, tmp_dir):
    source = f"{tmp_dir}/in"
    with metrics.ProgressTable(spark, f"{tmp_dir}/progress") as progress:
        for n in (10, 25):
            spark.range(n).withColumn("k", F.col("id") % 20).write.mode("append").parquet(source)
            stream = spark.readStream.schema("id long, k long").parquet(source).groupBy("k").count()
            q = (stream.writeStream.outputMode("update").option("checkpointLocation", f"{tmp_dir}/c")
                 .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{tmp_dir}/out/{i}"))
                 .trigger(availableNow=True).start())
            jobs.await_drained(q)
            assert progress.wait_for(q)
    rows = metrics.read_progress(spark, f"{tmp_dir}/progress").orderBy("batch_id").collect()
    assert [(r["input_rows"], r["state_rows"]) for r in rows] == [(10, 10), (25, 20)]
    assert all(r["durations_ms"]["triggerExecution"] > 0 for r in rows)
