"""Change data capture as Spark jobs: snapshot diff, initial snapshot,
current state, change counts, topic routing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .evolution import common_schema, conform


def _image(df: DataFrame, name: str) -> Column:
    return F.struct(*[F.col(c) for c in df.columns]).alias(name)


def _aligned(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both snapshots with the same columns: a column present on one side
    only (schema change between versions) is NULL on the other."""
    types = {f.name: f.dataType for f in after.schema.fields}
    types.update({f.name: f.dataType for f in before.schema.fields})
    names = before.columns + [c for c in after.columns if c not in before.columns]

    def fill(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c) if c in df.columns
                           else F.lit(None).cast(types[c]).alias(c) for c in names])

    if before.columns == after.columns:
        return before, after
    return fill(before), fill(after)


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change rows turning ``before`` into ``after``: ``c`` (key only in
    after), ``d`` (key only in before), ``u`` (row image differs; NULLs
    compare equal, also in keys).  Unchanged keys give no row.

    Both sides are stacked and grouped by key: one shuffle, no join.  Keys must
    be unique per side; a duplicate raises when its group is read.  A column
    added or dropped between the versions counts as NULL on the side that lacks
    it.
    """
    keys = list(keys)
    before, after = _aligned(before, after)
    both = before.select(*keys, _image(before, "_row"), F.lit(0).alias("_side")).union(
        after.select(*keys, _image(after, "_row"), F.lit(1).alias("_side")))

    def side(n: int, name: str) -> list[Column]:
        row = F.when(F.col("_side") == n, F.col("_row"))
        return [F.first(row, ignorenulls=True).alias(name),
                F.count(F.when(F.col("_side") == n, 1)).alias(f"_n{n}")]

    grouped = both.groupBy(*keys).agg(*side(0, "before"), *side(1, "after"))
    fail = F.raise_error(F.concat(F.lit("duplicate key in a snapshot: "),
                                  F.to_json(F.struct(*keys)))).cast("string")
    op = (F.when((F.col("_n0") > 1) | (F.col("_n1") > 1), fail)
          .when(F.col("_n0") == 0, F.lit("c"))
          .when(F.col("_n1") == 0, F.lit("d"))
          .when(~F.col("before").eqNullSafe(F.col("after")), F.lit("u")))
    return (grouped.select(*keys, op.alias("op"), "before", "after")
            .where(F.col("op").isNotNull()))


#: Buckets of keys whose digests are folded by ``changed_rows``.
DIGEST_BUCKETS = 1 << 16


def _digest(df: DataFrame, salt: int) -> Column:
    """64-bit digest of a row; NULLs count, also inside nested values."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    parts = [F.to_json(F.struct(F.col(f"`{f.name}`")), {"ignoreNullFields": "false"})
             if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in df.schema.fields]
    holes = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "0").otherwise("1") for c in df.columns])
    return F.xxhash64(F.lit(salt), *parts, holes)


def _with_digests(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``_b``, ``_h0``, ``_h1`` beside the columns: bucket of the key and two digests."""
    key = df.select(*keys)
    return df.select("*", F.pmod(_digest(key, 2), F.lit(buckets)).alias("_b"),
                     _digest(df, 0).alias("_h0"), _digest(df, 1).alias("_h1"))


def _folded(df: DataFrame, side: str) -> DataFrame:
    """Per bucket, the number of rows and sums of the halves of their digests."""
    half = [F.sum(part).alias(f"s{i}{j}") for i in (0, 1) for j, part in enumerate(
        (F.shiftright(f"_h{i}", 32), F.col(f"_h{i}").bitwiseAND(0xFFFFFFFF)))]
    folded = df.groupBy("_b").agg(F.count(F.lit(1)).alias("n"), *half)
    return folded.select("_b", F.struct("n", "s00", "s01", "s10", "s11").alias(side))


def changed_rows(before: DataFrame, after: DataFrame, keys: Sequence[str],
                 buckets: int = DIGEST_BUCKETS) -> tuple[DataFrame, DataFrame]:
    """The rows of two snapshots (with the same columns) whose keys changed.

    1. Each side folds two 64-bit digests of its rows per bucket of keys: at most
       ``buckets`` rows per task are shuffled.  Buckets that agree hold equal rows.
    2. In the others the digests are compared key by key: keys and digests are
       shuffled, of these buckets only.
    3. Rows of the keys that differ are kept by a semi join, by broadcast where the
       keys are few.

    What is shuffled grows with the changes, not with the snapshots, which are
    scanned three times instead.
    """
    spark, keys = before.sparkSession, list(keys)
    sides = [_with_digests(df, keys, buckets) for df in (before, after)]
    both = _folded(sides[0], "x").join(_folded(sides[1], "y"), "_b", "full_outer")
    differ = _kept(spark, both.where(~F.col("x").eqNullSafe(F.col("y"))).select("_b"), "buckets")
    # at most `buckets` numbers
    open_ = [s.join(F.broadcast(differ), "_b", "left_semi") for s in sides]
    digest = F.struct("_h0", "_h1")
    stacked = open_[0].select(*keys, digest.alias("h"), F.lit(0).alias("side")).union(
        open_[1].select(*keys, digest.alias("h"), F.lit(1).alias("side")))
    on = [F.when(F.col("side") == i, F.col("h")) for i in (0, 1)]
    grouped = stacked.groupBy(*keys).agg(
        *[F.max(c).alias(f"h{i}") for i, c in enumerate(on)],
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(on)])
    changed = _kept(spark, grouped.where(
        ~F.col("h0").eqNullSafe(F.col("h1")) | (F.col("n0") > 1) | (F.col("n1") > 1))
        .select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]), "changed-keys")

    def reduced(side: DataFrame, columns: list[str]) -> DataFrame:
        same = [side[k].eqNullSafe(changed[f"_k{i}"]) for i, k in enumerate(keys)]
        return side.join(changed, reduce(lambda a, b: a & b, same), "left_semi").select(
            *[F.col(f"`{c}`") for c in columns])

    return reduced(open_[0], before.columns), reduced(open_[1], after.columns)


def _kept(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def snapshot_diff_by_digest(before: DataFrame, after: DataFrame, keys: Sequence[str],
                            buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """``snapshot_diff`` for snapshots that are mostly alike: images are shuffled for
    the keys of ``changed_rows`` only.  A duplicate key raises if its bucket changed
    (the same duplicate on both sides is no change)."""
    before, after = conform_both(before, after)
    return snapshot_diff(*changed_rows(before, after, keys, buckets), keys)


def conform_both(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both snapshots with all columns of either, in their common types."""
    want = common_schema([before.schema, after.schema])
    return conform(before, want), conform(after, want)


def snapshot_events(snapshot: DataFrame, keys: Sequence[str], op: str = "r",
                    carry: Sequence[str] = ()) -> DataFrame:
    """Every row as a change event without a prior image: ``r`` for the
    initial snapshot, ``c`` for inserted rows (no shuffle).  ``carry``
    columns (e.g. a change position) stay outside the row image."""
    image_cols = [c for c in snapshot.columns if c not in carry]
    image = F.struct(*[F.col(c) for c in image_cols]).alias("after")
    image_type = snapshot.select(image).schema[0].dataType
    return snapshot.select(*keys, F.lit(op).alias("op"),
                           F.lit(None).cast(image_type).alias("before"), image,
                           *[F.col(c) for c in carry])


def flatten_change(changes: DataFrame) -> DataFrame:
    """``before``/``after`` structs to ``before_<col>``/``after_<col>``."""
    others = [c for c in changes.columns if c not in ("before", "after")]
    cols = [F.col(c) for c in others]
    for side in ("before", "after"):
        for f in changes.schema[side].dataType.fields:
            cols.append(F.col(side)[f.name].alias(f"{side}_{f.name}"))
    return changes.select(*cols)


def live(op: Column) -> Column:
    """Whether a last change leaves a row; raises where there is no operation,
    so such a change is not dropped in silence."""
    return F.when(op.isNull(), F.raise_error(F.lit("change without an operation"))
                  .cast("boolean")).otherwise(op != "d")


def current_state(changes: DataFrame, key: str | Sequence[str],
                  order: Sequence[str], image: str = "after",
                  op_col: str = "op") -> DataFrame:
    """Last change per key by ``order`` (e.g. ``lsn``), deletes removed.

    ``max_by`` is an aggregate: each task keeps one row per key and only
    those partial winners are shuffled, so a key holding a third of all
    changes makes no large task.  (Its rows are sorted in each task first; the
    sort spills.)  Ties on ``order`` must be broken by adding columns to
    ``order``.  A change without an operation raises.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order_col = F.struct(*[F.col(o) for o in order])
    payload = F.struct(F.col(op_col).alias("op"),
                       *[F.col(o) for o in order],
                       F.col(image).alias("image"))
    last = (changes.groupBy(*keys)
            .agg(F.max_by(payload, order_col).alias("_last")))
    return (last.where(live(F.col("_last.op")))
            .select(*keys, "_last.op", *[f"_last.{o}" for o in order],
                    "_last.image.*"))


def op_counts(changes: DataFrame, op_col: str = "op") -> DataFrame:
    return changes.groupBy(op_col).agg(F.count(F.lit(1)).alias("count"))


def route_topic(table: Column | str, prefix: str = "pg",
                schema: str = "public") -> Column:
    """Table name -> ``<prefix>.<schema>.<table>``."""
    t = F.col(table) if isinstance(table, str) else table
    return F.concat_ws(".", F.lit(prefix), F.lit(schema), t)


def tag_tables(tables: Mapping[str, DataFrame], keys: Mapping[str, str]) -> DataFrame:
    """Initial snapshots of several tables, one change stream with the table
    name attached (row image as JSON text, since the schemas differ)."""
    parts = []
    for name, df in tables.items():
        parts.append(df.select(
            F.lit(name).alias("table_name"),
            F.col(keys[name]).cast("string").alias("k"),
            F.lit("r").alias("op"),
            F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("after_json")))
    return reduce(lambda a, b: a.unionByName(b), parts)
