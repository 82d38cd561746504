import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

#: Columns of ``documents`` plus some whose names the operators use themselves.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()),
    T.StructField("row", T.LongType()), T.StructField("key", T.StringType()),
    T.StructField("class", T.StringType()), T.StructField("length", T.StringType())])

LONG = " ".join(f"word{i % 97} filler" for i in range(30_000))
#: Nulls in any column, empty, blank and very long texts, repeated rows.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "one"), (None, "a text without an id"),
       (None, None), (7, "same row twice here today"), (7, "same row twice here today"),
       (8, "漢字 😀 é x"), (9, "\n\n\n"), (10, "a\x00b \x0b c")]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        return spark.createDataFrame(
            [(i, t, None, None, None if t is None else len(t), "s", 7, "k", "c", "l")
             for i, t in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd(make_docs):
    return make_docs(ODD)


@pytest.fixture(scope="session")
def empty(make_docs):
    return make_docs([])


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def sf_rows(documents):
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
