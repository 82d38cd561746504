"""Skew experiment: one group holds a third of all rows.

usage: python tools/skew_demo.py [rows]
Numbers the rows per group with plain ``row_number()`` and with
``sequence.number_within``; reads task times and shuffle-read records from
Spark's event log (written to a fresh scratch folder) and prints, per
variant, the wall time, the largest task's records and time, and the total.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _event_lines(logdir: str):
    """Lines of every event-log file under ``logdir`` (plain or zstd)."""
    for path in sorted(glob.glob(f"{logdir}/**/*", recursive=True)):
        if not os.path.isfile(path) or os.path.basename(path).startswith("appstatus"):
            continue
        if path.endswith(".zstd"):
            import io

            import zstandard
            with open(path, "rb") as raw:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw),
                                        encoding="utf-8")
                yield from text
        else:
            with open(path) as f:
                yield from f


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 6_000_000
    logdir = tempfile.mkdtemp(prefix="tidemark-eventlog-")
    from pyspark.sql import SparkSession, Window
    from pyspark.sql import functions as F

    from tidemark.operators.cdc import current_state
    from tidemark.operators.sequence import number_within

    spark = (SparkSession.builder.master("local[8]").appName("skew-demo")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", logdir)
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    df = spark.range(0, rows).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("g"),
        F.col("id").alias("o"))
    changes = df.select(F.col("g").alias("k"), F.lit("u").alias("op"),
                        F.col("o").alias("lsn"),
                        F.struct(F.col("o").alias("v")).alias("after"))
    variants = {
        "row_number": lambda: df.withColumn(
            "n", F.row_number().over(Window.partitionBy("g").orderBy("o"))),
        "number_within": lambda: number_within(df, ["g"], "o", out="n",
                                               bucket_width=1 << 16),
        # latest change per key: window (one task per key) vs max_by
        "latest_by_window": lambda: changes.withColumn(
            "r", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("lsn"))))
            .where("r = 1").drop("r"),
        "current_state": lambda: current_state(changes, "k", ["lsn"]),
    }
    jobs = {}
    for name, build in variants.items():
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.time()
        build().write.format("noop").mode("overwrite").save()
        jobs[name] = round(time.time() - t0, 2)
    spark.stop()

    tasks = {}
    stage_group = {}
    for line in _event_lines(logdir):
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    info, metrics = ev["Task Info"], ev.get("Task Metrics") or {}
                    read = metrics.get("Shuffle Read Metrics") or {}
                    tasks.setdefault(ev["Stage ID"], []).append(
                        (info["Finish Time"] - info["Launch Time"],
                         read.get("Total Records Read", 0)))
    out = {}
    for sid, ts in tasks.items():
        group = stage_group.get(sid)
        if group not in jobs:
            continue
        top = max(ts, key=lambda t: t[1])
        cur = out.setdefault(group, {"wall_s": jobs[group], "max_task_records": 0,
                                     "max_task_ms": 0, "shuffle_records": 0})
        cur["max_task_records"] = max(cur["max_task_records"], top[1])
        cur["max_task_ms"] = max(cur["max_task_ms"], max(t[0] for t in ts))
        cur["shuffle_records"] += sum(t[1] for t in ts)
    print(json.dumps({"rows": rows, "hot_group_rows": (rows + 2) // 3, "variants": out}))


if __name__ == "__main__":
    main()
