"""Set operations and reshaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(*frames: DataFrame) -> DataFrame:
    """``bind_rows``: union by column name, missing columns NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def unpivot_columns(df: DataFrame, ids: list[str], cols: list[str], name: str = "name",
                    value: str = "value") -> DataFrame:
    """``pivot_longer``: one row per (ids, column) with its value."""
    return df.unpivot(ids, cols, name, value)


def tag(df: DataFrame, **constants) -> DataFrame:
    """A loop parameter becomes a column (e.g. market, index, day)."""
    return df.select(*[F.lit(v).alias(k) for k, v in constants.items()], "*")
