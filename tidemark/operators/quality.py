"""Data-quality checks as DataFrames: one row per check, with a verdict."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .reports import table_counts


def non_empty(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row-count report: ``table_name, row_count, passed`` (passed when the
    table has at least one row)."""
    return table_counts(tables).withColumn("passed", F.col("row_count") > 0)


def missing(expected: Sequence[str], found: DataFrame, column: str,
            spark: SparkSession | None = None) -> DataFrame:
    """Expected names absent from ``found[column]``: a left anti join of the
    caller's literal list (bounded by its length) with the distinct found
    names (partial aggregate before the shuffle)."""
    s = spark or found.sparkSession
    want = s.createDataFrame([(e,) for e in expected], f"{column} string")
    present = found.select(column).distinct()
    return want.join(present, column, "left_anti")


def unexpected(expected: Sequence[str], found: DataFrame, column: str,
               spark: SparkSession | None = None) -> DataFrame:
    """Found names outside the expected list (with ``missing``: the found set
    equals the expected one when both are empty)."""
    s = spark or found.sparkSession
    want = s.createDataFrame([(e,) for e in expected], f"{column} string")
    return found.select(column).distinct().join(want, column, "left_anti")


def require(checks: DataFrame, passed: str = "passed", show: int = 20) -> None:
    """Raise when any check row did not pass.  The message has the true number
    of failures and shows at most ``show`` of them."""
    failed = ~F.col(passed) | F.col(passed).isNull()
    bad = checks.where(failed).limit(show).collect()
    if bad:
        n = checks.where(failed).count()
        raise AssertionError(f"{n} check(s) failed, e.g. {[r.asDict() for r in bad]}")


def at_least(check: str, value: DataFrame, column: str, minimum: int = 1,
             severity: str = "warn") -> DataFrame:
    """``check, value, severity``: ``ok`` when ``value >= minimum``, else the
    given severity (``warn`` or ``fail``)."""
    return value.select(
        F.lit(check).alias("check"),
        F.col(column).cast("bigint").alias("value"),
        F.when(F.col(column) >= minimum, F.lit("ok")).otherwise(F.lit(severity))
        .alias("severity"))
