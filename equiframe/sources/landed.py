"""Vendor exports landed as text files.

``read_export`` reads delimited lines with a declared column list.  A line that
does not fit -- another number of fields, an unclosed quote, a NULL key -- does
not fail the load and is not dropped: it goes to a quarantine frame with its
file and the reason, so that rows read plus rows quarantined are the lines
landed.  Values stay text: the normalisers of ``vendor`` type them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equiframe.sources.sinks import read_if_present

QUARANTINE = ["file", "line", "reason"]


class Export(NamedTuple):
    rows: DataFrame        # the declared columns, as text
    quarantine: DataFrame  # file, line, reason ("fields" or "key")


def read_export(spark: SparkSession, path: str, columns: list[str], keys: list[str], sep: str = ",",
                header: bool = True) -> Export:
    """The export files under ``path``.

    One pass splits the lines; both frames are lazy and read only what they
    need.  ``header``: lines that repeat the column names are skipped, in
    whichever file they stand.  A field holds no line break.
    """
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("file"))
    if header:
        lines = lines.filter(F.col("line") != F.lit(sep.join(columns)))
    lines = lines.filter(F.trim("line") != "")
    schema = ", ".join(f"`{c}` string" for c in columns) + ", `_misfit` string"
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_misfit", "escape": '"'}
    split = lines.select("file", "line", F.from_csv("line", schema, options).alias("r"))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(f"r.{k}").isNull() | (F.trim(F.col(f"r.{k}")) == "")
    reason = F.when(F.col("r._misfit").isNotNull(), "fields").when(no_key, "key")
    split = split.withColumn("reason", reason)
    return Export(split.filter(F.col("reason").isNull()).select(*[F.col(f"r.`{c}`").alias(c) for c in columns]),
                  split.filter(F.col("reason").isNotNull()).select(*QUARANTINE))


def quarantine_counts(quarantine: DataFrame) -> DataFrame:
    """Quarantined lines by file and reason."""
    return quarantine.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("lines"))


def land_export(spark: SparkSession, path: str, columns: list[str], keys: list[str], quarantine_path: str,
                **options) -> DataFrame:
    """``read_export`` with the quarantine appended to a stored table: a file
    that is landed again adds no line twice."""
    export = read_export(spark, path, columns, keys, **options)
    fresh, stored = export.quarantine.distinct(), read_if_present(spark, quarantine_path)
    if stored is not None:
        fresh = fresh.join(stored.select(*QUARANTINE), on=QUARANTINE, how="left_anti")
    fresh.write.mode("append").parquet(quarantine_path)
    return export.rows
