"""Join helpers (J1-J13 shapes that need more than ``df.join``).

Broadcast policy: a side is broadcast only when its size is bounded --
either structurally (a calendar has at most one row per day of the data's
span; a quarter list at most four per year) or by a runtime check of its
bytes (``broadcast_if_small``).  Everything else is left to the planner, with AQE
converting to a broadcast at runtime once a shuffle stage proves small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equiframe.session import checkpoint_dir

# Byte bound for the runtime-checked broadcast.
MAX_BROADCAST_BYTES = 128 << 20


def _row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: 8 a fixed-width value, texts by their length."""
    fixed = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
    out = F.lit(16)
    for f in df.schema.fields:
        out = out + (F.lit(8) if isinstance(f.dataType, fixed)
                     else F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0)) + 16)
    return out.cast("long")


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast-hint ``df`` only if its rows take at most ``max_bytes``.

    The frame is first materialised with ``checkpoint()`` (in the cluster's
    ``spark.checkpoint.dir``) so the size and the join read the same stored
    rows -- nothing is computed twice.  Beyond the bound the checkpointed
    frame is returned unhinted and joins by shuffle.
    """
    checkpoint_dir(df.sparkSession)
    stored = df.checkpoint(eager=True)
    size = stored.agg(F.sum(_row_bytes(stored))).first()[0] or 0
    return F.broadcast(stored) if size <= max_bytes else stored


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a side whose size is bounded by construction (calendar
    days, quarters, a partition-count table).  Callers state the bound."""
    return F.broadcast(df)


def value_set(df: DataFrame, col: str) -> Column:
    """Sorted distinct values of ``col`` as one array-valued scalar
    subquery (computed once by the planner, attached to every row)."""
    return df.agg(F.sort_array(F.collect_set(F.col(col)))).scalar()


def expand_grid(df: DataFrame, row_key: str, col_key: str) -> DataFrame:
    """Every distinct ``row_key`` paired with every distinct
    ``col_key`` of ``df`` (tidyr ``expand``).

    The column side is the quarter list (bounded); it travels as a scalar
    subquery and is exploded per row key, so there is no join at all.
    """
    return (df.select(row_key).where(F.col(row_key).isNotNull()).distinct()
              .withColumn(col_key, F.explode(value_set(df.where(F.col(col_key).isNotNull()), col_key))))


def complete_grid(df: DataFrame, row_key: str, col_key: str, values: DataFrame | None = None) -> DataFrame:
    """R2: ``expand(row_key, col_key)`` of ``df`` left-joined with
    ``values`` (default ``df`` itself); missing combinations are NULL rows."""
    grid = expand_grid(df, row_key, col_key)
    return grid.join(values if values is not None else df, on=[row_key, col_key], how="left")


def after_high_water_mark(df: DataFrame, col: str, mark_df: DataFrame, mark_col: str,
                          inclusive: bool = False) -> DataFrame:
    """Rows of ``df`` beyond the maximum ``mark_col`` of ``mark_df``.

    The maximum is a scalar subquery.  An empty (or all-NULL) mark keeps
    every row, which is what a first load needs.
    """
    mark = mark_df.agg(F.max(F.col(mark_col))).scalar()
    cmp = F.col(col) >= mark if inclusive else F.col(col) > mark
    return df.filter(mark.isNull() | cmp)
