"""Contiguous surrogate keys in a sort order, without a
single-partition sort.

1. Range-partition on the sort key (sampled bounds) and sort within
   partitions: partition i holds only keys below partition i+1, and a hot
   date is split across partitions by the secondary key.
2. ``monotonically_increasing_id`` = (partition index, position).  The frame
   is then checkpointed to ``spark.checkpoint.dir`` so that the ids are fixed
   once: the count branch and the numbering branch read the same rows even
   if AQE coalesced shuffle reads differently, and a lost executor cannot
   renumber anything.
3. Rows per partition -> running offsets.  That table has one row per
   partition (bounded by the partition count) and is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equiframe.operators.columns import relocate
from equiframe.session import checkpoint_dir

_POS_BITS = 33  # low bits of monotonically_increasing_id: position in partition


def assign_keys(df: DataFrame, order: list[str], key: str = "num_key", start: Column | int = 0,
                partitions: int | None = None) -> DataFrame:
    """Number the rows ``start + 1 .. start + n`` in ``order`` (which must be
    a total order, e.g. the table key) and put ``key`` first."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    # Without an explicit count AQE may coalesce adjacent (small) ranges --
    # a one-day load does not fan out over a cluster-sized partition count;
    # merged neighbours keep the global order.
    by_range = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    ranged = (by_range.sortWithinPartitions(*order)
                .withColumn("_id", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    part = F.shiftright(F.col("_id"), _POS_BITS)
    pos = F.col("_id").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    counts = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        "_part",
        F.coalesce(F.sum("_cnt").over(Window.orderBy("_part")
                                      .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_off"))
    start_col = F.lit(start) if isinstance(start, int) else start
    out = (ranged.withColumn("_part", part)
                 .join(F.broadcast(offsets), on="_part", how="inner")
                 .withColumn(key, (start_col + F.col("_off") + pos + 1).cast("long")))
    return relocate(out.select(*[c for c in df.columns if c != key], key), [key])


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: where rows that share a key differ, the largest by
    their other columns in order (NULL least).  Aggregated before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)
