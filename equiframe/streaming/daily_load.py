"""Incremental daily load as a Structured Streaming job.

The reference asks "which trading days are after the last loaded one?",
fetches them and upserts the daily tables.  Here the landed day files of
``stock_daily`` (no other table) are a file stream: each micro-batch holds the
newly landed files, and ``foreachBatch``

1. keeps one row per (base_dt, sym_cd) of the batch,
2. builds the stock_daily rows (vendor items, attribute version as of the
   day; a listing already stored keeps its ``num_key``, the others get
   contiguous ones after the stored maximum),
3. upserts them on (base_dt, sym_cd) into the year-partitioned table
   (only touched years are rewritten; staged, then swapped), so a replayed
   batch changes nothing and a corrected day replaces the old values.

Offsets live in the checkpoint location under ``spark.checkpoint.dir``; run
with ``available_now=True`` for a catch-up batch job, or with a processing
trigger as a standing job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from equiframe.plans.ingest import stock_daily
from equiframe.session import checkpoint_dir
from equiframe.operators.keys import one_per_key
from equiframe.sources.sinks import finish_swap, read_if_present, upsert_table

UNIVERSE_SCHEMA = T.StructType([
    T.StructField("base_dt", T.DateType()),
    T.StructField("sym_cd", T.StringType()),
    T.StructField("trd_vol", T.DoubleType()),
    T.StructField("trd_val", T.DoubleType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("base_p", T.DoubleType()),
])


def load_batch(spark: SparkSession, batch: DataFrame, table_path: str, vendor: DataFrame,
               info: DataFrame) -> None:
    """One micro-batch into stock_daily: a row per listing, stored listings
    keep their key and take the landed values, upserted by year partition."""
    finish_swap(spark, table_path)
    existing = read_if_present(spark, table_path)
    keys = ["base_dt", "sym_cd"]
    rows = stock_daily(one_per_key(batch, keys), one_per_key(vendor, keys), info, existing.drop("year") if existing is not None else None)
    rows = rows.withColumn("year", F.year("base_dt"))
    upsert_table(spark, table_path, rows, ["base_dt", "sym_cd"], partition_by=["year"])


def start_daily_load(spark: SparkSession, landing_dir: str, table_path: str,
                     vendor: Callable[[], DataFrame], info: Callable[[], DataFrame],
                     checkpoint: str | None = None, available_now: bool = True,
                     schema: T.StructType = UNIVERSE_SCHEMA,
                     prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Start the stream; ``vendor``/``info`` are read fresh per batch.

    ``schema`` is the landed files' schema; ``prepare`` turns a micro-batch
    of landed rows into universe rows (e.g. ``listed_universe`` over raw
    exchange listings carrying ``base_dt``).
    """
    # stable across restarts: the offsets of a table's load always live in
    # the same place
    digest = hashlib.sha1(table_path.encode()).hexdigest()[:16]
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/daily-load-{digest}"
    src = spark.readStream.schema(schema).parquet(landing_dir)
    writer = (src.writeStream
                 .foreachBatch(lambda df, _id: load_batch(spark, prepare(df) if prepare else df,
                                                          table_path, vendor(), info()))
                 .option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
