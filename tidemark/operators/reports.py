"""Counts, offsets, filters, samples and unions over records and tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def total_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """Global count as a one-row DataFrame (partial counts, one exchange)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def count_by(df: DataFrame, *keys: str, name: str = "count",
             ordered: bool = True) -> DataFrame:
    """``groupBy(keys).count()`` sorted by the keys (few groups: the
    partial aggregate cuts the shuffle to one row per key per task)."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return out.orderBy(*keys) if ordered else out


def topic_end_offsets(records: DataFrame,
                      expected_topics: Sequence[str] | None = None,
                      spark: SparkSession | None = None) -> DataFrame:
    """Messages per topic = sum over its partitions of (last offset + 1).

    With ``expected_topics``, topics without records report 0.  The expected
    list is a caller-given literal list, so joining it is bounded by its
    length, not by the data.
    """
    per_partition = (records.groupBy("topic", "partition")
                     .agg((F.max("offset") + 1).alias("end_offset")))
    per_topic = per_partition.groupBy("topic").agg(
        F.sum("end_offset").cast("bigint").alias("messages"))
    if expected_topics is None:
        return per_topic
    s = spark or records.sparkSession
    wanted = s.createDataFrame([(t,) for t in expected_topics], "topic string")
    return (wanted.join(per_topic, "topic", "left")
            .select("topic", F.coalesce("messages", F.lit(0)).cast("bigint")
                    .alias("messages")))


def table_counts(tables: Mapping[str, DataFrame],
                 count_name: str = "row_count",
                 name_col: str = "table_name") -> DataFrame:
    """One row per table: ``count(*)`` and the table name, stacked with
    UNION ALL (each count is its own partial aggregate)."""
    parts = [df.agg(F.count(F.lit(1)).alias(count_name))
             .select(F.col(count_name), F.lit(name).alias(name_col))
             for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def filter_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Equality filter (pushed to the Parquet scan by Catalyst)."""
    return df.where(F.col(column) == F.lit(value))


def filter_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.where(F.col(column).startswith(prefix))


def anchored_any(column: Column | str, names: Sequence[str]) -> Column:
    """``^(a|b|c)$`` on the whole value, names taken literally."""
    import re
    c = F.col(column) if isinstance(column, str) else column
    return c.rlike("^(" + "|".join(re.escape(n) for n in names) + ")$")


def include_patterns(column: Column | str, patterns: Sequence[str]) -> Column:
    """Include-list semantics: each pattern is a regular expression that
    must match the whole value; the list is OR-ed."""
    c = F.col(column) if isinstance(column, str) else column
    conds = [c.rlike("^(?:" + p + ")$") for p in patterns]
    return reduce(lambda a, b: a | b, conds)


def table_topics(tables: Sequence[str], prefix: str = "pg", schema: str = "public") -> list[str]:
    """Topic names of literal table names, for a filter on the topic itself
    that reaches the scan as ``In``."""
    return [f"{prefix}.{schema}.{t}" for t in tables]


def included_topics(records: DataFrame, qualified: Column, patterns: Sequence[str]) -> DataFrame:
    """Rows whose topic matches the include list: the patterns run on the
    distinct topics (few) and the rows are semi-joined with those that match."""
    topics = records.select("topic").distinct().where(include_patterns(qualified, patterns))
    return records.join(topics, "topic", "left_semi")


def topic_list(column: Column | str, topics: str | Sequence[str]) -> Column:
    """Comma-separated topic list (the ``subscribe`` option form) as a filter."""
    names = topics.split(",") if isinstance(topics, str) else list(topics)
    c = F.col(column) if isinstance(column, str) else column
    return c.isin([t.strip() for t in names if t.strip()])


def topic_replay(records: DataFrame, topics: str | Sequence[str]) -> DataFrame:
    """Console-consumer style replay: key and value as text in log order."""
    return (records.where(topic_list("topic", topics))
            .select("topic", "partition", "offset",
                    F.col("key").cast("string").alias("key"),
                    F.col("value").cast("string").alias("value"))
            .orderBy("topic", "partition", "offset"))


def table_sample(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """``LIMIT n`` made deterministic by an explicit order (top-n sort: each
    task keeps n rows, one small merge)."""
    return df.orderBy(*order_by).limit(n)
