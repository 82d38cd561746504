"""Corpus pipeline: quality classifier, line dedup, MinHash near-dedup,
benchmark decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows of ``docs`` and
returns a DataFrame; ``run`` writes each result as Parquet in the shared folder
and rereads it as the next stage's ``docs``.  All stages but the last return the
columns of ``documents``; the last returns the pieces of the packed sequences.

SQL can express neither the classifier nor the tokenizer, so ``ORACLE_SQL`` is
None; ``tests/llm/test_pipeline.py`` holds the stages against brute force.

Defined cases are those of the operators: null and empty texts pass the filters
unless the classifier's prior rejects them, repeated rows are reduced to one by
the near-dedup stage (rows without a word stay, unless the line stage took the words),
empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, linededup, neardup, packing, quality
from tidemark.llm.queries import table, vocabulary
from tidemark.llm.textmap import held_out, stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (trained outside the held-out rows of
    ``op1``) accepts."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out(3, 1))
    scored = quality.score_documents(docs, model, once=True)  # whole rows: each text once
    return scored.where("predicted = 1").select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, freed of lines of recurring templates; ``n_chars`` follows
    the text."""
    clean = linededup.drop_lines(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity
    of 0.8 or more), by its text here or as it was before the line stage, which takes
    copies apart: the copies of a text lose the lines that its first document keeps.
    A document that the line stage has emptied goes, too."""
    whole = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.drop_duplicates(docs, neardup.Params(), before=whole)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontam.without_leaks(spark, docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    import public_tokenizers

    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"),
                        public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
