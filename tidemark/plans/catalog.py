"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each one reads the given tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (delimited_int, json_list_length, json_path_or_default,
                         table_name_from_path, topic_part)
from ..operators.compaction import pack_batches
from ..operators import (cdc, envelope, inference, ingest, offsets, quality, reports, resolution,
                         tables)
from ..operators.enrich import enrich, message_sequence
from ..schemas import ENVELOPE
from ..session import parallelism, scratch_path
from ..sources import files
from ..sources import lake as lakes
from ..sources.records import SUBJECT_SUFFIX
from ..streaming import jobs, metrics
from ..streaming.sinks import (display_error_lines, error_line, write_lake_batch,
                               write_lake_batches)
from ..streaming.state import start_expiring_state_stream
from .common import (EPOCH, N_CUTS, InjectedFailure, batch_clock, batch_clock_col, cut_stream,
                     enriched, envelope_records, failing_once, framed_records, log_path,
                     ntz, order_versions, processing_ts, records, stored_path, table)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# --- enrichment (P1, P2, P6, P7) and sequence (W1) -------------------------

@register("enrich")
def q_enrich(spark, sf_dir):
    return ntz(enriched(spark, sf_dir))


@register("message_sequence")
def q_message_sequence(spark, sf_dir):
    e = enriched(spark, sf_dir).select("kafka_topic", "kafka_partition",
                                       "kafka_offset", "kafka_key")
    return message_sequence(e)


# --- aggregations (A2-A5, U1, P5) -------------------------------------------

@register("count_by_table")
def q_count_by_table(spark, sf_dir):
    """Rows of the lake table per source table, sorted."""
    return reports.count_by(_read(spark, _lake_by_batches(spark, sf_dir)), "source_table")


@register("count_by_topic")
def q_count_by_topic(spark, sf_dir):
    """Rows of the lake table per topic, sorted."""
    return reports.count_by(_read(spark, _lake_by_batches(spark, sf_dir)), "kafka_topic")


@register("topic_end_offsets")
def q_topic_end_offsets(spark, sf_dir):
    return reports.topic_end_offsets(records(spark, sf_dir))


@register("table_counts")
def q_table_counts(spark, sf_dir):
    return reports.table_counts({
        name: table(spark, sf_dir, name)
        for name in ("customer", "orders", "lineitem")
    })


# --- filters, names, JSON, lines (F1-F5, P4, P10, P11, S4, S11, A6) --------


EXPECTED_TABLES = ["click", "purchase", "view"]


@register("filter_table")
def q_filter_table(spark, sf_dir):
    """Equality filter on the lake table (pushed to the Parquet scan)."""
    return ntz(reports.filter_equal(_read(spark, _lake_by_batches(spark, sf_dir)),
                                    "source_table", "error"))


@register("topics_by_prefix")
def q_topics_by_prefix(spark, sf_dir):
    rec = reports.filter_prefix(records(spark, sf_dir), "topic", "pg.")
    return reports.count_by(rec, "topic")


@register("expected_tables")
def q_expected_tables(spark, sf_dir):
    e = enriched(spark, sf_dir).where(
        reports.topic_list("kafka_topic", reports.table_topics(EXPECTED_TABLES)))
    return reports.count_by(e, "source_table")


@register("include_list")
def q_include_list(spark, sf_dir):
    rec = records(spark, sf_dir)
    qualified = F.concat_ws(".", topic_part("topic", 1), topic_part("topic", 2))
    return reports.count_by(reports.included_topics(rec, qualified, [r"public\..*"]), "topic")


@register("topic_replay")
def q_topic_replay(spark, sf_dir):
    return reports.topic_replay(records(spark, sf_dir),
                                "pg.public.click,pg.public.view")


#: Ranges of the replay queries (fixture choice): two topics, with open and closed ends.
STARTING = {"pg.public.click": {"0": 3, "1": -2, "2": 10},
            "pg.public.view": {"0": 0, "1": 7, "2": 5}}
ENDING = {"pg.public.click": {"0": 20, "1": 12, "2": -1},
          "pg.public.view": {"0": -1, "1": 30, "2": 6}}


@register("replay_range")
def q_replay_range(spark, sf_dir):
    """Records between starting and ending offsets of each topic-partition."""
    rec = offsets.replay_range(records(spark, sf_dir), STARTING, ENDING)
    return rec.select("topic", "partition", "offset", F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"))


@register("offset_gaps")
def q_offset_gaps(spark, sf_dir):
    """Offsets missing from a log that lost some: two of every seven, and the first
    five of each topic-partition, which a replay from offset 0 asks for."""
    rec = records(spark, sf_dir).where((F.col("offset") >= 5) & (F.col("offset") % 7 > 1))
    from_zero = {f"pg.public.{t}": {str(p): 0 for p in range(3)} for t in EXPECTED_TABLES}
    return offsets.offset_gaps(rec, from_zero, width=64)


@register("table_names")
def q_table_names(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", table_name_from_path("url").alias("table_name"))


@register("json_status")
def q_json_status(spark, sf_dir):
    rec = envelope_records(spark, sf_dir, damaged=True)
    status = json_path_or_default(F.col("value").cast("string"), "$.op")
    return reports.count_by(rec.select(status.alias("status")), "status")


@register("json_lists")
def q_json_lists(spark, sf_dir):
    """Lengths of JSON arrays (words of a priority); every fifth text is cut
    and counts as no list."""
    listing = F.to_json(F.split("o_orderpriority", "[- ]"))
    cut = F.when(F.col("o_orderkey") % 5 == 0, F.substring(listing, 1, 3)).otherwise(listing)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", json_list_length(cut).cast("bigint").alias("n"))


@register("offset_lines")
def q_offset_lines(spark, sf_dir):
    ends = (records(spark, sf_dir).groupBy("topic", "partition")
            .agg((F.max("offset") + 1).alias("end_offset")))
    lines = ends.select(F.format_string("%s:%d:%d", "topic", "partition",
                                       "end_offset").alias("line"))
    parsed = lines.select(F.get(F.split("line", ":"), 0).alias("topic"),
                          delimited_int("line", ":", 2).alias("n"))
    return parsed.groupBy("topic").agg(F.sum("n").cast("bigint").alias("messages"))


@register("table_sample")
def q_table_sample(spark, sf_dir):
    return ntz(reports.table_sample(table(spark, sf_dir, "orders"), 5, ["o_orderkey"]))


@register("schema_count")
def q_schema_count(spark, sf_dir):
    subjects = F.concat(F.col("topic"), F.lit(SUBJECT_SUFFIX))
    return records(spark, sf_dir).agg(F.count_distinct(subjects).alias("schema_count"))


# --- envelopes and change data capture (P8, P9, F7, C1-C6) -----------------

@register("wire_header")
def q_wire_header(spark, sf_dir):
    return envelope.wire_header(framed_records(spark, sf_dir))


@register("decode_envelope")
def q_decode_envelope(spark, sf_dir):
    return envelope.decode_envelopes(envelope_records(spark, sf_dir), ENVELOPE)


@register("decode_errors")
def q_decode_errors(spark, sf_dir):
    rec = envelope_records(spark, sf_dir, damaged=True)
    base = rec.select(topic_part("topic", 2).alias("source_table"), "value")
    decoded = envelope.decode_json(base, ENVELOPE)
    bad = F.col("envelope._corrupt_record").isNotNull()
    return decoded.groupBy("source_table").agg(
        F.count(F.when(~bad, 1)).alias("decoded"),
        F.count(F.when(bad, 1)).alias("failed"))


def _good_changes(spark, sf_dir):
    rec = envelope_records(spark, sf_dir)
    good, _ = envelope.split_decoded(envelope.decode_json(rec, ENVELOPE))
    return good.select("envelope.k", "envelope.op", "envelope.lsn", "envelope.after")


@register("current_state")
def q_current_state(spark, sf_dir):
    return cdc.current_state(_good_changes(spark, sf_dir), "k", ["lsn"], image="after")


@register("op_counts")
def q_op_counts(spark, sf_dir):
    return cdc.op_counts(_good_changes(spark, sf_dir))


@register("decode_latest")
def q_decode_latest(spark, sf_dir):
    """Messages of four versions of a subject, all as the latest one: a number becomes
    wider and is renamed, fields come with defaults, one goes."""
    from pyspark.sql import types as T

    field = resolution.Field
    versions = {
        5: resolution.Version((field("k", T.IntegerType()),)),
        6: resolution.Version((field("k", T.LongType()), field("old", T.StringType(), None))),
        8: resolution.Version((field("key_no", T.LongType(), aliases=("k",)),
                               field("kind", T.StringType(), "none"))),
        9: resolution.Version((
            field("key_no", T.DoubleType(), aliases=("k",)), field("kind", T.StringType(), "none"),
            field("weight", T.DoubleType(), 1.5), field("note", T.StringType(), None)))}
    rec = records(spark, sf_dir, keep_ids=True)
    k = F.get_json_object(F.col("value").cast("string"), "$.k").cast("bigint")
    kind = topic_part("topic", 2)
    texts = {5: F.struct(k.alias("k")), 6: F.struct(k.alias("k"), kind.alias("old")),
             8: F.struct(k.alias("key_no"), kind.alias("kind")),
             9: F.struct((k + 0.25).alias("key_no"), kind.alias("kind"),
                         (k / 2).alias("weight"), F.lit("n").alias("note"))}
    written = F.element_at(F.array(*[F.lit(i) for i in versions]),
                           (F.col("event_id") % 4 + 1).cast("int"))
    text = F.coalesce(*[F.when(written == i, F.to_json(t)) for i, t in texts.items()])
    value = F.when(F.col("event_id") % 13 == 0, F.col("value")).otherwise(
        envelope.frame(text, written))
    out = resolution.decode_latest(rec.withColumn("value", value), versions, unframed=5)
    return out.select(F.col("topic").alias("kafka_topic"),
                      F.col("partition").alias("kafka_partition"),
                      F.col("offset").alias("kafka_offset"), "schema_id", "message.*")


@register("snapshot_events")
def q_snapshot_events(spark, sf_dir):
    ev = cdc.flatten_change(cdc.snapshot_events(table(spark, sf_dir, "orders"),
                                                ["o_orderkey"]))
    return ntz(ev.select("o_orderkey", "op",
                         *[c for c in ev.columns if c.startswith("after_")]))


@register("snapshot_diff")
def q_snapshot_diff(spark, sf_dir):
    a, b = order_versions(spark, sf_dir)
    return ntz(cdc.flatten_change(cdc.snapshot_diff(a, b, ["o_orderkey"])))


@register("snapshot_diff_digest")
def q_snapshot_diff_digest(spark, sf_dir):
    """The same changes by folded digests: images of changed keys only."""
    a, b = order_versions(spark, sf_dir)
    return ntz(cdc.flatten_change(cdc.snapshot_diff_by_digest(a, b, ["o_orderkey"])))


@register("route_topics")
def q_route_topics(spark, sf_dir):
    """Initial snapshots of three tables, each row with its topic, key and row
    image (as fields, so the images are compared, too)."""
    names = {"customer": "c_custkey", "nation": "n_nationkey", "supplier": "s_suppkey"}
    tagged = cdc.tag_tables({n: table(spark, sf_dir, n) for n in names}, names)
    field = lambda *f: F.coalesce(*[F.get_json_object("after_json", f"$.{x}")
                                    for x in f])
    return tagged.select(cdc.route_topic("table_name").alias("topic"), "k", "op",
                         field("c_name", "n_name", "s_name").alias("name"),
                         field("c_nationkey", "n_regionkey", "s_nationkey").alias("parent_key"))


# --- ingest: discovery, CSV scan, inference, table load, seeds (S1, S2, S10,
# --- A7, P3, K1-K4) ----------------------------------------------------------


CSV_TABLES = ("customer", "orders", "supplier")
TEXT_TABLES = ("documents", "pages")


def _csv_tree(spark, sf_dir, names=CSV_TABLES):
    """The CSV source tree (one Spark CSV folder per table) under the shared
    scratch root, written once per application."""
    def build(root):
        for name in names:
            files.write_csv(table(spark, sf_dir, name), f"{root}/{name}.csv")

    return stored_path(spark, sf_dir, f"csv-{names[0]}", build)


def _loaded(spark, sf_dir, names, multi_line=False):
    """All tables of a CSV tree after the load, stacked by column name."""
    root = _csv_tree(spark, sf_dir, names)
    out = scratch_path(spark, "tables")
    ingest.load_csv_tables(spark, root, out, table_from="parent", multi_line=multi_line)
    stacked = None
    for name in names:
        df = spark.read.parquet(f"{out}/{name}").withColumn("table_name", F.lit(name))
        stacked = df if stacked is None else stacked.unionByName(df, allowMissingColumns=True)
    return stacked


def _relative(root):
    """Folder of a listed file, relative to ``root``'s last part."""
    base = root.rstrip("/").rsplit("/", 1)[-1]
    return F.regexp_extract("path", rf"/{base}/(.*)/[^/]*$", 1)


@register("csv_inventory")
def q_csv_inventory(spark, sf_dir):
    """CSV sources of a tree: table, folder below the root, whether there is
    any content (part files of one table make one row)."""
    root = _csv_tree(spark, sf_dir)
    found = files.discover_csv(spark, root, recursive=True, table_from="parent", ordered=False)
    return found.groupBy("table_name", _relative(root).alias("path")).agg(
        (F.max("length") > 0).alias("has_rows"))


@register("file_inventory")
def q_file_inventory(spark, sf_dir):
    """Folders below a prefix with whether their objects hold anything."""
    root = _csv_tree(spark, sf_dir)
    return files.file_inventory(spark, root).groupBy(_relative(root).alias("path")).agg(
        (F.sum("length") > 0).alias("has_rows"))


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    """Three tables written as CSV and loaded again, all rows of all three."""
    return _loaded(spark, sf_dir, CSV_TABLES)


@register("csv_text_roundtrip")
def q_csv_text_roundtrip(spark, sf_dir):
    """The same for texts and web pages with quotes and line breaks."""
    return _loaded(spark, sf_dir, TEXT_TABLES, multi_line=True)


def _infer(spark, sf_dir, name):
    t = table(spark, sf_dir, name)
    as_text = t.select(*[F.col(c).cast("string").alias(c) for c in t.columns])
    return inference.infer_types(inference.null_na_tokens(as_text))


@register("infer_types")
def q_infer_types(spark, sf_dir):
    return _infer(spark, sf_dir, "orders")


@register("infer_types_text")
def q_infer_types_text(spark, sf_dir):
    """Inference over texts, and over numbers with blanks around them, with
    missing values and beyond 64 bits, derived from ``documents``."""
    d = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    shown = d.select(
        i.cast("string").alias("doc_id"), "text", "lang",
        F.concat(F.lit(" "), i.cast("string"), F.lit(" ")).alias("padded"),
        F.when(i % 3 != 0, i.cast("string")).alias("sparse"),
        F.concat(F.lit("98765432109876"), F.lpad(i.cast("string"), 9, "0")).alias("huge"),
        F.when(i % 2 == 0, "True").otherwise("false").alias("flag"),
        F.lit("NA").alias("nothing"))
    return inference.infer_types(inference.null_na_tokens(shown))


@register("append_load")
def q_append_load(spark, sf_dir):
    """Customers in two loads into one catalog table, which the first one creates; the
    second one comes as text, with balances that are no numbers in every seventh row
    and keys with a fraction in every eleventh: those rows go to a table aside."""
    def build(root):
        name = "append_load_" + root.rsplit("-", 1)[-1]
        c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
        key = F.col("c_custkey")
        first = c.where(key % 2 == 0)
        tables.ensure_table(spark, name, first.schema, f"{root}/rows")
        tables.append_rows(spark, name, first)
        text = c.where(key % 2 == 1).select(
            F.when(key % 7 == 0, F.concat(F.lit("about "), F.col("c_acctbal").cast("string")))
            .otherwise(F.col("c_acctbal").cast("string")).alias("C_ACCTBAL"),
            F.when(key % 11 == 0, F.concat(key.cast("string"), F.lit(".5")))
            .otherwise(F.concat(F.lit(" "), key.cast("string"))).alias("c_custkey"))
        tables.ensure_table(spark, f"{name}_aside", tables.MISFITS, f"{root}/aside")
        tables.append_rows(spark, name, text, f"{name}_aside")

    name = "append_load_" + stored_path(spark, sf_dir, "append", build).rsplit("-", 1)[-1]
    rows = spark.table(name).select("c_custkey", "c_name", "c_acctbal",
                                    F.lit("").alias("misfit"))
    wrong = F.concat_ws(",", F.array_sort(F.map_keys("misfit")))
    key = F.get_json_object("source", "$.c_custkey")
    aside = spark.table(f"{name}_aside").select(
        F.floor(F.trim(key).cast("double")).cast("bigint").alias("c_custkey"),
        F.lit(None).cast("string").alias("c_name"), F.lit(None).cast("double").alias("c_acctbal"),
        wrong.alias("misfit"))
    return rows.unionByName(aside)


@register("seed_rows")
def q_seed_rows(spark, sf_dir):
    kv = {
        "nation": ingest.key_value_view(table(spark, sf_dir, "nation"), "n_name", "n_regionkey"),
        "region": ingest.key_value_view(table(spark, sf_dir, "region"), "r_name", "r_regionkey"),
        "supplier": ingest.key_value_view(table(spark, sf_dir, "supplier"), "s_name", "s_nationkey"),
    }
    return reports.table_counts(ingest.with_seed_rows(kv, EPOCH))


@register("seeded_rows")
def q_seeded_rows(spark, sf_dir):
    """The rows of the key/value tables with the seeds, their texts included."""
    kv = {
        "nation": ingest.key_value_view(table(spark, sf_dir, "nation"), "n_name", "n_regionkey"),
        "customer": ingest.key_value_view(table(spark, sf_dir, "customer"), "c_name", "c_custkey"),
    }
    parts = [df.withColumn("table_name", F.lit(n))
             for n, df in ingest.with_seed_rows(kv, EPOCH).items()]
    return parts[0].unionByName(parts[1])


@register("report_error_lines")
def q_report_error_lines(spark, sf_dir):
    """The lines a report gets for rows that can't be shown and for batches that
    failed, with the texts of documents as messages."""
    docs = table(spark, sf_dir, "documents").where(F.col("text").isNotNull())
    lines = F.array(*display_error_lines(F.col("text")), error_line(4, F.col("text")))
    return docs.select("doc_id", F.posexplode(lines).alias("n", "line"))


# --- lake sink, versions and streams (S3, S6-S9, K5-K8, T1-T7, A1) ---------


def _read(spark, lake_path, **kwargs):
    return lakes.read_lake(spark, lake_path, **kwargs)


def _lake_by_batches(spark, sf_dir):
    """Batch backfill: every arrival cut becomes its lake batch in one
    partitioned write (the stream path writes the same layout batch by
    batch), once per application.  Returns the lake path."""
    def build(lake):
        rec = records(spark, sf_dir, keep_ids=True).withColumnRenamed("cut", "batch_id")
        clock = batch_clock_col(F.col("batch_id"))
        write_lake_batches(enrich(rec, clock, carry=["batch_id"]), lake, committed_at=clock)

    return stored_path(spark, sf_dir, "lake", build)


def _lake_by_stream(spark, sf_dir, releases=None, keep_extra=None, write=write_lake_batch):
    """Stream writer: cuts arrive in the topic; after each arrival an
    ``availableNow`` run of the same checkpointed query drains it.  A run that
    ends with the injected failure is started again, as a supervisor would;
    any other error is raised.  Returns the lake path."""
    lake = scratch_path(spark, "lake")
    ckpt = scratch_path(spark, "checkpoint")
    arrived = []
    for group in releases or [[c] for c in range(N_CUTS)]:
        arrived += group
        for attempt in range(2):
            q = jobs.start_lake_stream(cut_stream(spark, sf_dir, arrived), lake, ckpt,
                                       clock=batch_clock, keep_extra=keep_extra, write=write)
            try:
                jobs.await_drained(q)
                break
            except StreamingQueryException as ex:
                if attempt == 1 or InjectedFailure.__name__ not in str(ex):
                    raise
    return lake


@register("stream_enrich")
def q_stream_enrich(spark, sf_dir):
    sink, ckpt = scratch_path(spark, "enriched"), scratch_path(spark, "checkpoint")
    q = jobs.start_enrich_stream(cut_stream(spark, sf_dir, range(N_CUTS)), sink, ckpt,
                                 processing_timestamp=processing_ts())
    jobs.await_drained(q)
    return ntz(spark.read.parquet(sink))


@register("stream_lake")
def q_stream_lake(spark, sf_dir):
    return ntz(_read(spark, _lake_by_stream(spark, sf_dir)))


@register("lake_read")
def q_lake_read(spark, sf_dir):
    return ntz(_read(spark, _lake_by_batches(spark, sf_dir)))


@register("lake_count")
def q_lake_count(spark, sf_dir):
    return reports.total_count(_read(spark, _lake_by_batches(spark, sf_dir)))


@register("lake_preview")
def q_lake_preview(spark, sf_dir):
    return ntz(lakes.preview(_read(spark, _lake_by_batches(spark, sf_dir)), 20))


@register("as_of_version")
def q_as_of_version(spark, sf_dir):
    return ntz(lakes.read_version(spark, _lake_by_batches(spark, sf_dir), version=1))


@register("as_of_timestamp")
def q_as_of_timestamp(spark, sf_dir):
    return ntz(lakes.read_version(spark, _lake_by_batches(spark, sf_dir),
                                  timestamp="2024-02-03 12:00:00"))


@register("table_history")
def q_table_history(spark, sf_dir):
    return ntz(lakes.history(spark, _lake_by_batches(spark, sf_dir)))


def _packed_lake(spark, sf_dir):
    """A lake of its own, whose batches 0 to 2 are packed in two steps."""
    lake = scratch_path(spark, "lake")
    rec = records(spark, sf_dir, keep_ids=True).withColumnRenamed("cut", "batch_id")
    clock = batch_clock_col(F.col("batch_id"))
    write_lake_batches(enrich(rec, clock, carry=["batch_id"]), lake, committed_at=clock)
    for below in (2, 3):
        pack_batches(spark, lake, below)
    return lake


@register("packed_lake")
def q_packed_lake(spark, sf_dir):
    return ntz(_read(spark, _packed_lake(spark, sf_dir)))


@register("packed_version")
def q_packed_version(spark, sf_dir):
    return ntz(lakes.read_version(spark, _packed_lake(spark, sf_dir), version=1))


@register("packed_history")
def q_packed_history(spark, sf_dir):
    return ntz(lakes.history(spark, _packed_lake(spark, sf_dir)))


@register("schema_evolution")
def q_schema_evolution(spark, sf_dir):
    return ntz(_read(spark, _lake_by_stream(spark, sf_dir, keep_extra=lambda b: b >= 1),
                     merge_schema=True))


def widening_batch(rec, batch_id):
    """Fixture rule: what batch ``batch_id`` holds of the records (FIXTURES.md)."""
    text = F.format_string("u%s", F.col("kafka_key"))
    cols = {
        0: [F.col("event_id").cast("int").alias("k"), F.length("kafka_key").alias("who")],
        1: [F.col("event_id").alias("k"), F.length("kafka_key").alias("who"),
            F.struct(F.col("kafka_partition").cast("short").alias("part")).alias("place")],
        2: [F.col("event_id").cast("double").alias("k"), text.alias("who")],
        3: [text.alias("who"), F.struct(F.col("kafka_topic").alias("topic"),
                                        F.col("kafka_partition").alias("part")).alias("place")],
    }[batch_id]
    return rec.select(F.col("kafka_offset").alias("at"), *cols)


@register("schema_widening")
def q_schema_widening(spark, sf_dir):
    """Batches in which columns come, go and change their types (int, bigint, double;
    int, text; a struct that gains a field), read whole without asking for it."""
    def build(lake):
        rec = records(spark, sf_dir, keep_ids=True)
        rec = rec.select("event_id", F.col("key").cast("string").alias("kafka_key"),
                         F.col("topic").alias("kafka_topic"),
                         F.col("partition").alias("kafka_partition"),
                         F.col("offset").alias("kafka_offset"), "cut")
        for b in range(N_CUTS):
            write_lake_batch(widening_batch(rec.where(F.col("cut") == b), b), lake, b,
                             committed_at=batch_clock(b))

    lake = _read(spark, stored_path(spark, sf_dir, "widening", build))
    return ntz(lake.select("batch_id", "at", "k", "who", F.col("place.part").alias("part"),
                           F.col("place.topic").alias("topic"), "committed_at"))


@register("stream_resume")
def q_stream_resume(spark, sf_dir):
    return ntz(_read(spark, _lake_by_stream(spark, sf_dir, releases=[[0, 1], [2, 3]])))


@register("stream_replay")
def q_stream_replay(spark, sf_dir):
    """History after a crash between a write and its checkpoint commit: the
    replayed batch is there once."""
    lake = _lake_by_stream(spark, sf_dir, write=failing_once(write_lake_batch, 1))
    return ntz(lakes.history(spark, lake))


@register("batch_report")
def q_batch_report(spark, sf_dir):
    report, ckpt = scratch_path(spark, "report"), scratch_path(spark, "checkpoint")
    for c in range(N_CUTS):
        q = jobs.start_report_stream(cut_stream(spark, sf_dir, range(c + 1)), report, ckpt,
                                     clock=batch_clock)
        jobs.await_drained(q)
    lines = spark.read.text(report)
    return lines.select(F.col("batch_id").cast("bigint").alias("batch_id"),
                        F.col("value").alias("line"))


@register("stream_metrics")
def q_stream_metrics(spark, sf_dir):
    """Progress of the lake stream as a table: rows that each micro-batch read."""
    lake, ckpt = scratch_path(spark, "lake"), scratch_path(spark, "checkpoint")
    path, ids = scratch_path(spark, "progress"), set()
    with metrics.ProgressTable(spark, path, per_file=2) as progress:
        for c in range(N_CUTS):
            q = jobs.start_lake_stream(cut_stream(spark, sf_dir, range(c + 1)), lake, ckpt,
                                       clock=batch_clock)
            jobs.await_drained(q)
            progress.wait_for(q)
            ids.add(q.id)
    rows = metrics.read_progress(spark, path).where(F.col("query_id").isin(sorted(ids)))
    return rows.select("batch_id", "input_rows", "state_rows",
                       (F.col("durations_ms")["addBatch"] >= 0).alias("timed"))


#: What is stored once per application, in the order it is built.
FIXTURES = {"topic_log": log_path, "lake": _lake_by_batches, "csv": _csv_tree,
            "csv_text": lambda spark, sf_dir: _csv_tree(spark, sf_dir, TEXT_TABLES)}


# --- data quality (D1-D4) ----------------------------------------------------


EXPECTED_TOPICS = ["pg.public.click", "pg.public.error", "pg.public.purchase",
                   "pg.public.refund", "pg.public.signup", "pg.public.view"]


@register("dq_non_empty")
def q_dq_non_empty(spark, sf_dir):
    return quality.non_empty({n: table(spark, sf_dir, n)
                              for n in ("customer", "orders", "lineitem", "labels")})


@register("dq_missing")
def q_dq_missing(spark, sf_dir):
    return quality.missing(EXPECTED_TOPICS, records(spark, sf_dir), "topic")


@register("dq_unexpected")
def q_dq_unexpected(spark, sf_dir):
    """Topics found that are not in an (incomplete) expected list."""
    return quality.unexpected(EXPECTED_TOPICS[:3], records(spark, sf_dir), "topic")


@register("dq_schemas")
def q_dq_schemas(spark, sf_dir):
    subjects = F.concat(F.col("topic"), F.lit(SUBJECT_SUFFIX))
    n = records(spark, sf_dir).agg(F.count_distinct(subjects).alias("n"))
    return quality.at_least("schemas_registered", n, "n", 1, "warn")


def _change_stream(spark, sf_dir, cuts, batches=None):
    """Well-formed change envelopes of the first ``cuts`` arrival cuts, as a stream."""
    arrived = cut_stream(spark, sf_dir, range(cuts), "envelopes", batches)
    decoded = envelope.decode_json(arrived, ENVELOPE)
    good = decoded.where(F.col("envelope._corrupt_record").isNull()
                         & F.col("envelope").isNotNull())
    return good.select("envelope.k", "envelope.op", "envelope.lsn", "envelope.after")


@register("stream_current_state")
def q_stream_current_state(spark, sf_dir):
    """Current state (C4) maintained on a stream of change envelopes."""
    state, ckpt = scratch_path(spark, "state"), scratch_path(spark, "checkpoint")
    for c in range(N_CUTS):
        q = jobs.start_current_state_stream(
            _change_stream(spark, sf_dir, c + 1), "k", ["lsn"], state, ckpt,
            state_partitions=parallelism(spark), compact_every=2)
        jobs.await_drained(q)
    return jobs.read_current_state(spark, state, "k", ["lsn"])


@register("stream_expiring_state")
def q_stream_expiring_state(spark, sf_dir):
    """Current state (C4) on a stream whose deleted keys leave the state after a week:
    one run of several micro-batches, in the order of files, not of changes."""
    state = scratch_path(spark, "state")
    q = start_expiring_state_stream(
        _change_stream(spark, sf_dir, N_CUTS, batches=N_CUTS), "k", ["lsn"], state,
        scratch_path(spark, "checkpoint"), keep_deleted_ms=7 * 24 * 3_600_000,
        state_partitions=parallelism(spark), compact_every=2)
    jobs.await_drained(q)
    return jobs.read_current_state(spark, state, "k", ["lsn"])


@register("decode_framed")
def q_decode_framed(spark, sf_dir):
    """Registry-framed JSON, schema chosen by the id in each message."""
    from pyspark.sql import types as T
    k_long = T.StructType([T.StructField("k", T.LongType())])
    k_int = T.StructType([T.StructField("k", T.IntegerType())])
    rec = framed_records(spark, sf_dir)
    out = envelope.decode_by_schema_id(rec, {5: k_long, 6: k_int, 8: k_long},
                                       unframed=k_long)
    return out.select(F.col("topic").alias("kafka_topic"),
                      F.col("partition").alias("kafka_partition"),
                      F.col("offset").alias("kafka_offset"), "schema_id",
                      F.col("decoded.k").alias("k"))
