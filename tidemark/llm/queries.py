"""The thin queries ``opN_<name>`` over the given tables, and their SQL.

A query derives the columns of its contract from its operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bestfit, decontam, langid, linededup, neardup, packing, periodic, quality, quoting,
               resample, rules, tokencount, toxicity)
from .textmap import held_out

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out(3, 1))
    return quality.score_documents(docs, model).select(
        "row.doc_id", held_out(3, 1, F.col("row.doc_id")).alias("held_out"), "score", "predicted")


def op2_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quoting.conversations(table(spark, sf_dir, "conversations"))
    return out.withColumn("path", F.concat_ws("/", F.col("path").cast("array<string>")))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs, ~held_out(3, 1))
    return langid.predict_documents(docs.select("doc_id", "text"), model).select(
        "row.doc_id", held_out(3, 1, F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    order = rules.cascade_order(rules.estimate(docs))
    return rules.apply_rules(docs, order).select("row.doc_id", *rules.BASE, "base_failed", "kept")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, neardup.Params(words=4)).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"),
                        public_tokenizers.PATTERN)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", "item_id", "n_tokens", "n_covered", "n_tiles", "longest",
                        "coverage")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocab = tokencount.load_sentencepiece(vocabulary("piece_bpe_32k.model"))
    return tokencount.count_tokens(docs, vocab).select("row.doc_id", "n_tokens")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out(5, 0))
    return toxicity.score_documents(docs, model).select(
        "row.doc_id", held_out(5, 0, F.col("row.doc_id")).alias("held_out"), "score", "predicted")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    clean = linededup.drop_lines(docs, removed="n_dropped")
    return clean.select("doc_id", "n_dropped", F.length("text").cast("long").alias("n_chars"),
                        F.md5(F.col("text").cast("binary")).alias("text_md5"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = resample.resample(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return out.select("row.doc_id", "n_features", "weight", "score", "rank")


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bestfit.pack(docs, vocabulary("word_bpe_49k.json"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic.detect(periodic.with_planted_runs(docs), keep=["doc_id"])
    return found.select("row.doc_id", *periodic.digest(found))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_quality_classifier, op2_quotation_linking, op3_language_id, op4_quality_rules,
    op5_near_duplicates, op6_packing, op7_decontamination, op8_token_counts, op9_toxicity,
    op10_line_dedup, op11_importance_resampling, op12_best_fit_packing, op13_periodic_runs)}

SQL: dict[str, str] = {"op4_quality_rules": rules.SQL}
