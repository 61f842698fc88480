"""High-water marks of stored tables from file metadata.

The largest (or least) value of a date or number column, and the row count,
stand in every Parquet file's footer.  ``stored_marks`` asks Spark's Parquet
source to push the aggregate down, so the scan reads footers and no data page:
its cost is one footer a file however many rows a file holds.  It runs in a
session of its own, because the push-down is a session setting that the
caller's other reads need not share.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equiframe.sources import files
from equiframe.sources.sinks import read_table

PUSHED = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def marks_frame(spark: SparkSession, path: str, columns: list[str], least: bool = False) -> DataFrame:
    """One row: the largest value of each column and ``rows``, read from
    footers; a text column has no exact value there and is scanned."""
    other = spark.newSession()
    for k, v in PUSHED.items():
        other.conf.set(k, v)
    fn = F.min if least else F.max
    return other.read.parquet(path).agg(*[fn(c).alias(c) for c in columns], F.count(F.lit(1)).alias("rows"))


def stored_marks(spark: SparkSession, path: str, columns: list[str], least: bool = False) -> dict[str, Any]:
    """``{column: value}`` and ``rows`` of the table at ``path``: ``None`` and 0
    where it holds no row.  While a swap is under way the table as readers see
    it is aggregated, from its data."""
    if files.exists(spark, f"{path.rstrip('/')}._swap"):
        table = read_table(spark, path)
        if table is None:
            return {**dict.fromkeys(columns), "rows": 0}
        fn = F.min if least else F.max
        return table.agg(*[fn(c).alias(c) for c in columns], F.count(F.lit(1)).alias("rows")).first().asDict()
    if not files.partition_folders(spark, path):
        return {**dict.fromkeys(columns), "rows": 0}
    return marks_frame(spark, path, columns, least).first().asDict()
