"""Tables of the session catalog that are created once and then added to.

``ensure_table`` is CREATE TABLE IF NOT EXISTS: the first load fixes the columns
and their types, later ones don't change them.  ``append_rows`` binds its rows to
the table's types before any file is written: a value that the column can't hold
(text in a number, a fraction in a whole number, a number beyond the range) makes
its row a misfit.  With misfits, the load is refused as a whole, or they go to a
table of their own with the columns and texts that did not fit, and the rest is
added.  So a table stays readable whatever is loaded into it.

Both passes are narrow: the check is one aggregate over the source, the write one
scan; nothing is shuffled.  A load with ``load_id`` is recorded as a property of the
table once its rows are in, and skipped when it comes again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .evolution import NESTED, nullable

#: Rows quoted in the error of a refused load.
EXAMPLES = 3
#: Columns of a table of misfits.
MISFITS = T.StructType([T.StructField("source", T.StringType()),
                        T.StructField("misfit", T.MapType(T.StringType(), T.StringType()))])


class MisfitRows(ValueError):
    """Rows that do not fit the columns of their table."""


@dataclass(frozen=True)
class Appended:
    rows: int
    misfits: int


def quoted(name: str) -> str:
    """A table name of one or several parts, each in backticks."""
    return ".".join("`" + p.strip("`").replace("`", "``") + "`" for p in name.split("."))


def ensure_table(spark: SparkSession, name: str, schema: T.StructType,
                 location: str | None = None, fmt: str = "parquet") -> T.StructType:
    """Create the table if it is not there; the schema it has, whoever made it."""
    columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}"
                        for f in nullable(schema).fields)
    at = " LOCATION '" + location.replace("'", "\\'") + "'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({columns}) USING {fmt}{at}")
    return spark.table(quoted(name)).schema


def _fitted(c: Column, have: T.DataType, want: T.DataType) -> tuple[Column, Column]:
    """The value as the column's type, and whether nothing of it is lost."""
    have, want = nullable(have), nullable(want)
    if have == want:
        return c, F.lit(True)
    if isinstance(have, NESTED) or isinstance(want, NESTED):
        return F.lit(None).cast(want), c.isNull()
    if isinstance(want, T.StringType):
        return c.cast(want), F.lit(True)
    if isinstance(have, T.StringType):
        value = F.trim(c).try_cast(want)
        return value, c.isNull() | value.isNotNull()
    value = c.try_cast(want)
    return value, value.try_cast(have).eqNullSafe(c)  # back again: no digit, no hour lost


def fit_rows(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``row`` (the columns of ``schema``, by name in any case; missing ones NULL),
    ``misfit`` (map of column -> text of the values that do not fit, NULL if all do) and
    ``source`` (the row as JSON).  A column that the table does not have raises."""
    have = {f.name.lower(): f for f in rows.schema.fields}
    if len(have) < len(rows.columns):
        raise MisfitRows("two columns of the rows differ in case only: "
                         + ", ".join(sorted(rows.columns)))
    unknown = set(have) - {f.name.lower() for f in schema.fields}
    if unknown:
        raise MisfitRows("columns that the table does not have: " + ", ".join(
            sorted(have[n].name for n in unknown)))
    values, bad = [], []
    for f in schema.fields:
        src = have.get(f.name.lower())
        if src is None:
            values.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f"`{src.name}`")
        value, ok = _fitted(c, src.dataType, f.dataType)
        values.append(value.alias(f.name))
        if nullable(src.dataType) != nullable(f.dataType):
            shown = F.to_json(F.struct(c)) if isinstance(src.dataType, NESTED) else c.cast("string")
            bad.append(F.when(~ok, F.struct(F.lit(f.name).alias("key"), shown.alias("value"))))
    listed = F.filter(F.array(*bad), lambda x: x.isNotNull()) if bad else None
    misfit = (F.when(F.size(listed) > 0, F.map_from_entries(listed)) if bad
              else F.lit(None).cast("map<string,string>"))
    source = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
    return rows.select(F.struct(*values).alias("row"), misfit.alias("misfit"),
                       source.alias("source"))


def refuse_misfits(fitted: DataFrame, name: str) -> None:
    """Raise with some examples if any row of ``fit_rows`` does not fit."""
    n, bad = fitted.agg(F.count(F.lit(1)), F.count("misfit")).first()
    if bad:
        shown = [str(r["misfit"]) for r in
                 fitted.where("misfit IS NOT NULL").select("misfit").limit(EXAMPLES).collect()]
        raise MisfitRows(f"{bad} of {n} rows do not fit table {name}: " + "; ".join(shown))


def append_rows(spark: SparkSession, name: str, rows: DataFrame,
                aside: str | None = None) -> Appended:
    """Add ``rows`` to a table under the table's own types.

    Without ``aside`` a misfit refuses the load before a file is written; with it
    misfits go to the table of that name (``source``, ``misfit``), the others are
    added.
    """
    fitted = fit_rows(rows, spark.table(quoted(name)).schema)
    if aside is None:
        refuse_misfits(fitted, name)
    n = Observation()
    good = fitted.observe(n, F.count(F.when(F.col("misfit").isNull(), 1)).alias("rows"),
                          F.count("misfit").alias("misfits"))
    good.where("misfit IS NULL").select("row.*").write.insertInto(quoted(name))
    found = n.get
    if found["misfits"]:
        out = fitted.where("misfit IS NOT NULL").select("source", "misfit")
        ensure_table(spark, aside, MISFITS)
        out.write.insertInto(quoted(aside))
    return Appended(found["rows"], found["misfits"])
