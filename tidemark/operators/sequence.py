"""Row numbers inside very large groups without one task per group.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends every row of a group
to one task.  A topic-partition can hold a third of all records, so the
numbering is split in two levels instead:

1. rows are cut into buckets of ``bucket_width`` consecutive order values
   (``floor(o / bucket_width)``); a bucket of a unique integral order key has
   at most ``bucket_width`` rows, so the per-bucket window is bounded;
2. a small table of bucket sizes (partial aggregate, pruned scan) gets a
   running sum per group: the first number of each bucket;
3. both are joined on ``(g, bucket)``; the big side is already hash
   partitioned on those keys by the window, so only the small side moves.

The result equals ``row_number()`` exactly when the order key is unique in
its group (offsets, event ids, log sequence numbers) and group and order
keys are not NULL (Kafka records never have NULL topic/partition/offset).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_WIDTH = 1 << 20


def number_within(df: DataFrame, group_cols: Sequence[str], order_col: str,
                  out: str = "row_number",
                  bucket_width: int = DEFAULT_BUCKET_WIDTH,
                  start: int = 1) -> DataFrame:
    """Add ``out`` = 1-based (or ``start``-based) position of each row in its
    group ordered by the integral, unique ``order_col`` (for a timestamp
    order, pass ``unix_micros(ts)`` as a column first)."""
    g = list(group_cols)
    # Exact integral division (no trip through double): buckets stay
    # contiguous and ordered for any 64-bit order key.
    bucket = F.expr(f"`{order_col}` div {int(bucket_width)}").cast("bigint")
    tagged = df.withColumn("_tm_bkt", bucket)

    sizes = (df.select(*g, bucket.alias("_tm_bkt"))
               .groupBy(*g, "_tm_bkt").agg(F.count(F.lit(1)).alias("_tm_n")))
    before = Window.partitionBy(*g).orderBy("_tm_bkt").rowsBetween(
        Window.unboundedPreceding, -1)
    firsts = sizes.select(*g, "_tm_bkt",
                          F.coalesce(F.sum("_tm_n").over(before), F.lit(0))
                          .alias("_tm_first"))

    local = F.row_number().over(Window.partitionBy(*g, "_tm_bkt").orderBy(order_col))
    numbered = tagged.withColumn("_tm_local", local)
    # Left equi-join: every row finds its bucket, and when the number is not
    # used downstream Catalyst drops the join altogether (the right side is
    # unique on the keys).  Rows with a NULL group or order key get NULL.
    return (numbered.join(firsts, on=[*g, "_tm_bkt"], how="left")
            .withColumn(out, (F.col("_tm_first") + F.col("_tm_local")
                              + F.lit(start - 1)).cast("bigint"))
            .drop("_tm_bkt", "_tm_local", "_tm_first"))
