"""Column type inference for text tables (CSV), in one distributed pass.

Rules follow pandas' default CSV reading, which the reference relies on:
a column is INTEGER when every value is an integer and none is missing,
BOOLEAN when every value is a true/false word and none is missing, REAL when
every present value is a number (so integers with blanks become REAL), and
TEXT otherwise.  Blanks around a number do not count.  An integer beyond 64
bits makes its column TEXT, so no digit is lost.  An all-missing column is REAL,
a table without rows has TEXT columns only.  ``compat="spark"`` keeps integer
columns with blanks as INTEGER (nullable BIGINT) instead.

All tests of all columns are folded into one ``agg`` (partial aggregates per
task, one row per task shuffled), then unpacked with ``inline``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# pandas' default missing-value tokens and boolean words.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
TRUE_WORDS = ["True", "TRUE", "true"]
FALSE_WORDS = ["False", "FALSE", "false"]

INT_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
FLOAT_PATTERN = (r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
                 r"|(?i:inf|infinity|nan))\s*$")

SQL_TO_SPARK = {"INTEGER": "bigint", "REAL": "double", "BOOLEAN": "boolean",
                "TEXT": "string"}


def null_na_tokens(df: DataFrame, tokens: Sequence[str] = NA_TOKENS,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Missing-value tokens to NULL (Spark's CSV reader keeps ``NA``)."""
    cols = set(columns or df.columns)
    return df.select(*[
        F.when(F.col(c).isin(list(tokens)), F.lit(None).cast("string"))
        .otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
        for c in df.columns])


# Bit flags of the value classes seen in a column.
_INT, _REAL, _BOOL, _TEXT = 1, 2, 4, 8


def _value_class(v):
    """One ``CASE`` per value: the first class that fits (integer, number,
    true/false word, text); NULL for missing.  At most two regular
    expressions run per value, one for most values."""
    return (F.when(v.isNull(), F.lit(None).cast("int"))
            .when(v.rlike(INT_PATTERN),
                  F.when(v.try_cast("bigint").isNotNull(), F.lit(_INT)).otherwise(F.lit(_TEXT)))
            .when(v.rlike(FLOAT_PATTERN), F.lit(_REAL))
            .when(v.isin(TRUE_WORDS + FALSE_WORDS), F.lit(_BOOL))
            .otherwise(F.lit(_TEXT)))


def infer_types(df: DataFrame, compat: str = "reference") -> DataFrame:
    """(position, column_name, sql_type) for every column of a string table,
    after NA tokens are nulled.  One aggregate over the whole table: per
    column the OR of the value classes seen and the count of present values
    (two aggregate functions per column, partial per task)."""
    if compat not in ("reference", "spark"):
        raise ValueError("compat must be 'reference' or 'spark'")
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(df.columns):
        aggs += [F.count(F.col(c)).alias(f"n{i}"),
                 F.bit_or(_value_class(F.col(c))).alias(f"k{i}")]
    stats = df.agg(*aggs)
    entries = []
    for i, c in enumerate(df.columns):
        n, k = F.col(f"n{i}"), F.coalesce(F.col(f"k{i}"), F.lit(0))
        complete = n == F.col("_rows")
        ints_only = k == _INT
        int_ok = ints_only & (complete if compat == "reference" else F.lit(True))
        numbers_only = (k.bitwiseAND(F.lit(_BOOL | _TEXT)) == 0)
        sql_type = (F.when(F.col("_rows") == 0, F.lit("TEXT"))
                    .when(n == 0, F.lit("REAL"))
                    .when(int_ok, F.lit("INTEGER"))
                    .when((k == _BOOL) & complete, F.lit("BOOLEAN"))
                    .when(numbers_only, F.lit("REAL"))
                    .otherwise(F.lit("TEXT")))
        entries.append(F.struct(F.lit(i).alias("position"),
                                F.lit(c).alias("column_name"),
                                sql_type.alias("sql_type")))
    return stats.select(F.inline(F.array(*entries)))


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast each column to the Spark type of its SQL type (``TEXT`` stays)."""
    out = []
    for c in df.columns:
        t = SQL_TO_SPARK[types.get(c, "TEXT")]
        if t == "boolean":
            out.append(F.when(F.col(c).isNotNull(), F.col(c).isin(TRUE_WORDS))
                       .alias(c))
        elif t == "string":
            out.append(F.col(c))
        else:
            out.append(F.col(c).cast(t).alias(c))
    return df.select(*out)


def types_of(inferred: DataFrame) -> dict[str, str]:
    """Collect the inferred types (one row per column: bounded by the
    schema width, not by the data)."""
    return {r["column_name"]: r["sql_type"]
            for r in inferred.orderBy("position").collect()}
