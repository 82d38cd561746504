"""Files to typed tables: header clean-up, type inference, table writes,
seed rows."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean_column_name, table_name_from_path
from ..session import list_names
from ..sources.files import discover_csv, read_csv_union
from .inference import SQL_TO_SPARK, apply_types, infer_types, null_na_tokens, types_of
from .tables import Appended, append_rows, ensure_table, fit_rows, quoted, refuse_misfits


#: SQL type names of the loaded tables' column types.
SQL_TYPES = {spark: sql for sql, spark in SQL_TO_SPARK.items()}

# The seed row written per table (same text as the reference).
SEED_KEY = "seed_{table}_{epoch}"
SEED_VALUE = "value_{epoch}"


def clean_headers(df: DataFrame) -> DataFrame:
    """Strip names and turn spaces into underscores; two columns that end up
    with the same name are an error (they would overwrite each other)."""
    names = [clean_column_name(c) for c in df.columns]
    seen: dict[str, int] = {}
    for n in names:
        seen[n] = seen.get(n, 0) + 1
    dup = sorted(n for n, k in seen.items() if k > 1)
    if dup:
        raise ValueError(f"column names collide after clean-up: {dup}")
    return df.toDF(*names)


def typed_table(raw: DataFrame, compat: str = "reference"
                ) -> tuple[DataFrame, dict[str, str]]:
    """String table -> (typed table, {column: SQL type}).  One pass for the
    inference, the cast stays lazy."""
    df = null_na_tokens(clean_headers(raw))
    types = types_of(infer_types(df, compat=compat))
    return apply_types(df, types), types


def csv_sources(spark: SparkSession, data_dir: str, max_files: int | None = None,
                table_from: str = "file") -> dict[str, list[str]]:
    """Table name -> what to read for it.  ``table_from="file"`` (reference
    rule: each file is a table) lists files; ``"parent"`` (folders written by
    Spark, many part files per table) returns one folder per table, so the
    driver holds one entry per table, not per file."""
    listing = discover_csv(spark, data_dir, max_files=max_files,
                           recursive=(table_from == "parent"), table_from=table_from,
                           ordered=False)
    if table_from == "parent":
        parent = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
        rows = listing.select("table_name", parent.alias("src")).distinct().collect()
    else:
        rows = listing.select("table_name", F.col("path").alias("src")).collect()
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["table_name"], r["src"])):
        out.setdefault(r["table_name"], []).append(r["src"])
    return out


def load_sources(spark: SparkSession, sources: Mapping[str, list[str]], out_root: str,
                 mode: str = "overwrite", compat: str = "reference", glob: str | None = None,
                 multi_line: bool = False, at_once: int = 4) -> dict[str, dict[str, str]]:
    """Load ``{table: sources}`` into ``<out_root>/<table>`` (Parquet).

    All sources of a table are one load, matched by column name, so none
    overwrites another.  Each table is its own distributed job: one aggregate
    for the types, one pass for the typed write; ``at_once`` tables run side by
    side.  ``mode="append"`` keeps the columns and types of a table that is there: rows
    that do not fit them refuse the load.  Returns the SQL types per table.
    """
    def load(name: str) -> dict[str, str]:
        raw = read_csv_union(spark, sources[name], glob=glob, multi_line=multi_line)
        target = f"{out_root}/{name}"
        if mode == "append" and list_names(spark, target):
            schema = spark.read.parquet(target).schema
            fitted = fit_rows(null_na_tokens(clean_headers(raw)), schema)
            refuse_misfits(fitted, name)
            fitted.select("row.*").write.mode("append").parquet(target)
            return {f.name: SQL_TYPES.get(f.dataType.simpleString(), "TEXT") for f in schema}
        typed, types = typed_table(raw, compat=compat)
        typed.write.mode(mode).parquet(target)
        return types

    names = sorted(sources)
    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        return dict(zip(names, pool.map(load, names)))


def load_catalog_tables(spark: SparkSession, sources: Mapping[str, list[str]],
                        database: str | None = None, location: str | None = None,
                        compat: str = "reference", glob: str | None = None,
                        multi_line: bool = False, aside: str | None = None,
                        at_once: int = 4) -> dict[str, Appended]:
    """Load ``{table: sources}`` into tables of the session catalog.

    A table that is not there is created with the types inferred from this load
    (below ``location`` if given); one that is there keeps its columns and types.
    Rows that do not fit refuse the table's load, or with ``aside`` (a suffix) go to
    the table ``<table><aside>``.  A second load adds its rows, as the reference's does.
    """
    def load(name: str) -> Appended:
        full = f"{database}.{name}" if database else name
        raw = read_csv_union(spark, sources[name], glob=glob, multi_line=multi_line)
        rows = null_na_tokens(clean_headers(raw))
        if not spark.catalog.tableExists(quoted(full)):
            typed, _ = typed_table(raw, compat=compat)
            ensure_table(spark, full, typed.schema, f"{location}/{name}" if location else None)
        return append_rows(spark, full, rows, f"{full}{aside}" if aside else None)

    names = sorted(sources)
    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        return dict(zip(names, pool.map(load, names)))


def sources_of_files(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Explicit files by the table they load into."""
    rows = (spark.createDataFrame([(p,) for p in paths], "path string")
            .select("path", table_name_from_path("path").alias("t")).collect())
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r["t"], []).append(r["path"])
    return out


def load_csv_tables(spark: SparkSession, data_dir: str, out_root: str,
                    max_files: int | None = None, table_from: str = "file",
                    mode: str = "overwrite", compat: str = "reference",
                    multi_line: bool = False) -> dict[str, dict[str, str]]:
    """Load every CSV of ``data_dir`` into ``<out_root>/<table>`` (Parquet).

    ``mode`` ``overwrite`` makes a re-run idempotent; ``append`` is the
    reference's behaviour.  No files -> ``{}``.  ``max_files`` is for callers
    that want the first files only; all by default.
    """
    sources = csv_sources(spark, data_dir, max_files, table_from)
    return load_sources(spark, sources, out_root, mode, compat,
                        "*.[cC][sS][vV]" if table_from == "parent" else None, multi_line)


def seed_row(spark: SparkSession, table: str, epoch: int,
             key_col: str = "key", value_col: str = "value") -> DataFrame:
    """One marker row ``(seed_<table>_<epoch>, value_<epoch>)``."""
    return spark.createDataFrame([(SEED_KEY.format(table=table, epoch=epoch),
                                   SEED_VALUE.format(epoch=epoch))],
                                 f"{key_col} string, {value_col} string")


def with_seed_rows(tables: Mapping[str, DataFrame], epoch: int,
                   key_col: str = "key", value_col: str = "value"
                   ) -> dict[str, DataFrame]:
    """Append one seed row to each key/value table (by name, other columns
    NULL)."""
    out = {}
    for name, df in tables.items():
        seed = seed_row(df.sparkSession, name, epoch, key_col, value_col)
        out[name] = df.unionByName(seed, allowMissingColumns=True)
    return out


def key_value_view(df: DataFrame, key: str, value: str) -> DataFrame:
    """A table as the ``key, value`` text shape of the reference's tables."""
    return df.select(F.col(key).cast("string").alias("key"),
                     F.col(value).cast("string").alias("value"))
