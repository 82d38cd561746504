"""Command-line jobs: the pipeline steps as ``spark-submit``-able entry points.

    python -m tidemark.cli load-csv --data-dir data --out /lake/tables
    python -m tidemark.cli load-csv --out /lake/tables a.csv b.csv
    python -m tidemark.cli stream-report --kafka host:9092 --topics t1,t2 \
        --report /lake/report --checkpoint /ckpt/report
    python -m tidemark.cli stream-lake --kafka host:9092 --topics t1,t2 \
        --lake /lake/changes --checkpoint /ckpt/lake --trigger "10 seconds"
    python -m tidemark.cli consume --kafka host:9092 --topics t1 --schema "k long" \
        --out /lake/messages --errors /lake/bad --checkpoint /ckpt/consume
    python -m tidemark.cli read-lake /lake/changes
    python -m tidemark.cli pack-lake /lake/changes --checkpoint /ckpt/changes

``--source-dir`` replaces ``--kafka`` with a folder of replayed records
(Parquet, Kafka record schema).  Paths should be on shared storage; the
session (master, object-store settings) comes from ``spark-submit``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _session(app: str, args) -> SparkSession:
    from .session import object_store_conf

    builder = SparkSession.builder.appName(app)
    if args.s3_endpoint:
        for key, value in object_store_conf(args.s3_endpoint).items():
            builder = builder.config(key, value)
    return builder.getOrCreate()


def _records(spark: SparkSession, args) -> "DataFrame":  # noqa: F821
    from .sources.records import read_kafka, read_record_files
    if args.source_dir:
        return read_record_files(spark, args.source_dir, stream=True)
    if not args.topics:
        raise SystemExit("--kafka needs --topics")
    return read_kafka(spark, args.kafka, args.topics)


def _trigger(args) -> dict:
    if args.trigger == "available-now":
        return {"availableNow": True}
    return {"processingTime": args.trigger}


def cmd_load_csv(args) -> int:
    from .operators.ingest import csv_sources, load_sources, sources_of_files
    from .sources.files import csv_paths, discover_csv

    spark = _session("tidemark-load-csv", args)
    if args.files:
        files = csv_paths(args.files)
        sources = sources_of_files(spark, files) if files else {}
        if not files:
            print("no CSV files given")
    else:
        sources = csv_sources(spark, args.data_dir, args.max_files)
        if not sources:
            print(f"no CSV files in {args.data_dir}")
        elif args.max_files:
            left = discover_csv(spark, args.data_dir).count() - args.max_files
            if left > 0:
                print(f"{left} more CSV file(s) left out by --max-files {args.max_files}")
    loaded = load_sources(spark, sources, args.out, args.mode, args.compat,
                          multi_line=args.multi_line) if sources else {}
    for name, types in loaded.items():
        print(f"{', '.join(sources[name])} -> {name}: {types}")
    return 0


def cmd_stream_report(args) -> int:
    from .streaming.jobs import run_until_stopped, start_report_stream
    spark = _session("tidemark-stream-report", args)
    q = start_report_stream(_records(spark, args), args.report, args.checkpoint,
                            trigger=_trigger(args))
    run_until_stopped(q)
    return 0


def cmd_stream_lake(args) -> int:
    from .streaming.jobs import run_until_stopped, start_lake_stream
    spark = _session("tidemark-stream-lake", args)
    q = start_lake_stream(_records(spark, args), args.lake, args.checkpoint,
                          trigger=_trigger(args), fmt=args.format, app_id=args.app_id)
    run_until_stopped(q)
    return 0


def cmd_consume(args) -> int:
    """Decoded messages to ``--out``, those that do not parse to ``--errors``;
    prints how many of each there are."""
    from pyspark.sql.types import StructType

    from .streaming.jobs import run_until_stopped, start_decode_stream
    spark = _session("tidemark-consume", args)
    q = start_decode_stream(_records(spark, args), StructType.fromDDL(args.schema), args.out,
                            args.errors, args.checkpoint, trigger=_trigger(args))
    run_until_stopped(q)
    good = spark.read.parquet(args.out)
    good.orderBy("topic", "partition", "offset").show(args.show, truncate=False)
    print(f"decoded: {good.count()}, failed: {spark.read.parquet(args.errors).count()}")
    return 0


def cmd_read_lake(args) -> int:
    """Schema, row count, 20 rows, counts per source table and per topic."""
    from .operators.reports import count_by, total_count
    from .sources.lake import preview, read_lake
    spark = _session("tidemark-read-lake", args)
    lake = read_lake(spark, args.lake, fmt=args.format)
    lake.printSchema()
    print(f"Total rows: {total_count(lake).first()[0]}")
    preview(lake, 20).show(20, truncate=False)
    count_by(lake, "source_table").show()
    count_by(lake, "kafka_topic").show()
    return 0


def cmd_pack_lake(args) -> int:
    from .operators.compaction import closed_below, pack_batches

    spark = _session("tidemark-pack-lake", args)
    pack = pack_batches(spark, args.lake, closed_below(spark, args.checkpoint))
    print(f"Packed batches {pack.lo} to {pack.hi}" if pack else "no closed batch to pack")
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("--s3-endpoint", help="S3-compatible store of s3a:// paths (credentials come "
                                         "from the cluster's provider chain)")
    sub = p.add_subparsers(dest="cmd", required=True)

    lc = sub.add_parser("load-csv", help="CSV files -> typed Parquet tables")
    lc.add_argument("files", nargs="*")
    lc.add_argument("--data-dir", default="data")
    lc.add_argument("--out", required=True)
    lc.add_argument("--max-files", type=int, default=None,
                    help="only the first N files of --data-dir by path (default: all)")
    lc.add_argument("--multi-line", action="store_true",
                    help="quoted values may hold line breaks (files are not split)")
    lc.add_argument("--mode", choices=["overwrite", "append"], default="overwrite")
    lc.add_argument("--compat", choices=["reference", "spark"], default="reference")
    lc.set_defaults(fn=cmd_load_csv)

    for name, fn, out, default_trigger in (
            ("stream-report", cmd_stream_report, "--report", "5 seconds"),
            ("stream-lake", cmd_stream_lake, "--lake", "10 seconds"),
            ("consume", cmd_consume, "--out", "10 seconds")):
        sp = sub.add_parser(name)
        src = sp.add_mutually_exclusive_group(required=True)
        src.add_argument("--kafka")
        src.add_argument("--source-dir")
        sp.add_argument("--topics", help="comma-separated; needed with --kafka")
        sp.add_argument(out, required=True, dest=out.strip("-"))
        sp.add_argument("--checkpoint", required=True)
        sp.add_argument("--trigger", default=default_trigger,
                        help='processing time like "10 seconds", or available-now')
        sp.set_defaults(fn=fn)
        if name == "stream-lake":
            sp.add_argument("--format", choices=["parquet", "delta"], default="parquet")
            sp.add_argument("--app-id", help="stable id of this stream (needed for delta)")
        if name == "consume":
            sp.add_argument("--errors", required=True)
            sp.add_argument("--schema", required=True, help="fields of a message as DDL")
            sp.add_argument("--show", type=int, default=20)

    rl = sub.add_parser("read-lake")
    rl.add_argument("lake")
    rl.add_argument("--format", choices=["parquet", "delta"], default="parquet")
    rl.set_defaults(fn=cmd_read_lake)

    pl = sub.add_parser("pack-lake", help="closed batches of a lake -> files of a good size")
    pl.add_argument("lake")
    pl.add_argument("--checkpoint", required=True, help="checkpoint of the stream that writes it")
    pl.set_defaults(fn=cmd_pack_lake)

    args = p.parse_args(argv)
    return args.fn(args)


if __name__ == "__main__":
    sys.exit(main())
