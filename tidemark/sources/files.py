"""File discovery and CSV scans (listing is metadata; contents stay on
executors)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ends_with_ci, table_name_from_path
from .csvsplit import read_records, scan_borders

LISTING = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modificationTime", T.TimestampType()),
])


def file_inventory(spark: SparkSession, root: str, glob: str | None = None,
                   recursive: bool = True) -> DataFrame:
    """Objects under a prefix: path, size, modification time.

    ``binaryFile`` reads file contents only when ``content`` is selected, so
    this is a listing (partitioned over executors for large trees).  A
    missing root gives an empty result.
    """
    reader = (spark.read.format("binaryFile")
              .option("recursiveFileLookup", str(recursive).lower()))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        df = reader.load(root)
    except AnalysisException as ex:
        if "PATH_NOT_FOUND" in str(ex) or "Path does not exist" in str(ex):
            return spark.createDataFrame([], LISTING)
        raise
    return df.select("path", "length", "modificationTime")


def discover_csv(spark: SparkSession, data_dir: str,
                 max_files: int | None = None, recursive: bool = False,
                 table_from: str = "file", ordered: bool = True) -> DataFrame:
    """CSV files of a folder: suffix ``.csv`` in any case, sorted by path,
    first ``max_files`` (all when None).  Adds ``table_name`` from the file
    name (``table_from="file"``) or from the parent folder
    (``"parent"``, for folders written by Spark)."""
    listing = file_inventory(spark, data_dir, recursive=recursive)
    csv = listing.where(ends_with_ci("path", ".csv"))
    source = (F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
              if table_from == "parent" else F.col("path"))
    csv = csv.withColumn("table_name", table_name_from_path(source))
    if ordered or max_files:
        csv = csv.orderBy("path")
    return csv.limit(max_files) if max_files else csv


def csv_paths(paths: Sequence[str]) -> list[str]:
    """Explicit path arguments: keep those ending in ``.csv`` (any case), in
    the given order, no cap (the command-line form of discovery)."""
    return [p for p in paths if p.lower().endswith(".csv")]


CORRUPT = "_tm_corrupt"
# A complete quoted field, and a quote that opens a field.
_QUOTED = r'(^|{sep})"([^"]|"")*"(?={sep}|$)'
_OPENING = r'(^|{sep})"'


def _reader(spark: SparkSession, sep: str, multi_line: bool, glob: str | None):
    """Options of every CSV scan: quotes are doubled inside quoted fields (RFC
    4180, no backslash escapes) and headers are checked in each file."""
    reader = (spark.read.option("header", True).option("sep", sep).option("quote", '"')
              .option("escape", '"').option("multiLine", multi_line)
              .option("inferSchema", False).option("mode", "PERMISSIVE")
              .option("enforceSchema", False))
    return reader.option("pathGlobFilter", glob) if glob else reader


def open_quotes(spark: SparkSession, paths: Sequence[str], sep: str = ",",
                glob: str | None = None) -> int:
    """Lines on which a quoted field does not end (values with line breaks,
    which a line-by-line scan would cut)."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    s = re.escape(sep)
    line = F.col("value")
    rest = F.regexp_replace(line, _QUOTED.format(sep=s), "")
    return (reader.text(list(paths))
            .where(line.contains('"') & rest.rlike(_OPENING.format(sep=s))).count())


def _parsed(records: DataFrame, names: Sequence[str], sep: str) -> DataFrame:
    """Columns of texts of records, with the whole text of those that do not parse."""
    cols = [f"c{i}" for i in range(len(names))]
    ddl = ", ".join(f"{c} string" for c in [*cols, CORRUPT])
    fields = F.from_csv("record", ddl, {
        "sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT})
    # behind a generator a record is parsed once, not once per column
    rows = records.select(F.inline(F.array(fields)))
    return rows.select(*[F.col(c).alias(n) for c, n in zip(cols, names)], CORRUPT)


def read_csv_strings(spark: SparkSession, paths: str | Sequence[str],
                     sep: str = ",", glob: str | None = None,
                     multi_line: bool = False) -> DataFrame:
    """Header CSV with every column as text (types are inferred afterwards,
    see ``operators.inference``).  ``glob`` filters file names inside folders.

    Nothing is lost: a row with more fields than the header raises when it is
    read, files whose headers differ from the first one's raise, and with
    ``multi_line`` off a quoted value that goes on over several lines raises.
    ``multi_line`` reads such values, large files in splits (``csvsplit``).
    Rows with fewer fields than the header get NULL in the rest.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    borders = None
    if multi_line:
        borders = scan_borders(spark, paths, sep, glob)
        multi_line = borders.breaks and borders.unsplit
    else:
        broken = open_quotes(spark, paths, sep, glob)
        if broken:
            raise ValueError(f"{broken} line(s) open a quoted value that does not end on the "
                             "line; read with multi_line=True")
    names = _reader(spark, sep, borders is not None, glob).csv(paths).columns
    if borders is not None and borders.breaks and not multi_line:
        raw = _parsed(read_records(spark, paths, borders, sep, glob), names, sep)
    else:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
        raw = (_reader(spark, sep, multi_line, glob).schema(schema)
               .option("columnNameOfCorruptRecord", CORRUPT).csv(paths))
    bare = F.regexp_replace(F.col(CORRUPT), '"([^"]|"")*"', "")
    fields = F.size(F.split(bare, re.escape(sep), -1))
    wide = F.raise_error(F.concat(F.lit(f"row with more than {len(names)} fields: "),
                                  F.col(CORRUPT)))
    checked = F.when(F.col(CORRUPT).isNotNull() & (fields > len(names)), wide.cast("boolean")) \
        .otherwise(F.lit(True))
    return raw.where(checked).select(*[F.col(f"`{c}`") for c in names])


def read_csv_union(spark: SparkSession, sources: Sequence[str], sep: str = ",",
                   glob: str | None = None, multi_line: bool = False) -> DataFrame:
    """Several sources of one table, matched by column name: each is read under
    its own header; columns that a source lacks are NULL."""
    parts = [read_csv_strings(spark, s, sep, glob, multi_line) for s in sources]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV with doubled quotes and plain timestamp text
    (``yyyy-MM-dd HH:mm:ss``)."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
     .csv(path))
