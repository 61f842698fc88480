"""A symbol holding most of the rows is spread over many tasks by the
blocked windows (SURVEY: one key may hold a third of all rows)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from equiframe.operators.windows import as_of_latest, rolling, suffix_product


@pytest.fixture
def no_coalesce(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, old)


def _tasks_of(df, key_col, hot):
    rows = df.filter(F.col(key_col) == hot).select(F.spark_partition_id().alias("p")).distinct().collect()
    return len(rows)


def test_hot_symbol_spreads_in_rolling(spark, no_coalesce):
    hot = spark.range(1, 20001).select(F.lit("hot").alias("sym"), F.col("id").cast("int").alias("t"),
                                       F.lit(1.001).alias("g"))
    cold = spark.range(1, 201).select(F.lit("cold").alias("sym"), F.col("id").cast("int").alias("t"),
                                      F.lit(1.001).alias("g"))
    out = rolling(hot.unionByName(cold), "g", {"r": 60}, ["sym"], "t", block=1000)
    assert _tasks_of(out, "sym", "hot") >= 4
    assert out.filter("sym = 'hot' AND r IS NULL").count() == 59  # only the first n-1 days


def test_hot_symbol_spreads_in_suffix_and_as_of(spark, no_coalesce):
    d0 = dt.date(1950, 1, 1)
    hot = spark.range(0, 20000).select(F.lit("hot").alias("k"), F.date_add(F.lit(d0), F.col("id").cast("int")).alias("d"),
                                       F.lit(1.0).alias("r"))
    out = suffix_product(hot, "r", ["k"], "d", "f", block_days=1000)
    assert _tasks_of(out, "k", "hot") >= 4
    versions = hot.filter(F.col("d").isin([F.date_add(F.lit(d0), i) for i in (0, 7000, 15000)])) \
                  .select("k", F.col("d").alias("v"))
    asof = as_of_latest(hot.select("k", "d"), versions, ["k"], "d", "v", "v", block_days=1000)
    assert _tasks_of(asof, "k", "hot") >= 4
    assert asof.filter("v IS NULL").count() == 0
