"""Co-located copies: no exchange in joins on num_key, and never stale rows."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from equiframe.plans.factors import factor_panel
from equiframe.plans.refresh import EquityStore
from equiframe.session import checkpoint_dir


@pytest.fixture()
def store(spark):
    s = EquityStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/by-key-{uuid.uuid4().hex}")
    daily = spark.range(1, 401).select(
        F.col("id").alias("num_key"), F.date_add(F.lit(dt.date(2019, 12, 1)), (F.col("id") / 4).cast("int")).alias("base_dt"),
        F.concat(F.lit("S"), F.col("id") % 4).alias("sym_cd"), F.lit(10.0).alias("close"))
    s.upsert("stock_daily", daily)
    s.upsert("factor_daily", daily.select("num_key", F.col("num_key").cast("double").alias("inv_per")))
    return s


def _panel(store, start=None):
    return factor_panel(store.by_key("stock_daily", start), store.by_key("factor_daily", start), start=start)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_of_copies_has_no_exchange(spark, store):
    before = sorted(map(tuple, _panel(store).select("num_key", "base_dt", "sym_cd", "inv_per").collect()))
    made = store.co_locate(buckets=4)
    assert made == {"stock_daily": ["2019", "2020"], "factor_daily": ["2019", "2020"]}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        whole, late = _panel(store), _panel(store, "2020-01-01")
        assert "Exchange" not in _plan(whole) and "SelectedBucketsCount: 4 out of 4" in _plan(whole)
        assert "Exchange" not in _plan(late) and "year#" in _plan(late) and ">= 2020" in _plan(late)
        assert sorted(map(tuple, whole.select("num_key", "base_dt", "sym_cd", "inv_per").collect())) == before
        assert late.count() == sum(1 for r in before if r[1] >= dt.date(2020, 1, 1))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_changed_table_is_not_read_from_its_copy(spark, store):
    store.co_locate(buckets=2)
    assert store.co_locate() == {"stock_daily": [], "factor_daily": []}
    change = spark.createDataFrame([(400, -5.0)], "num_key long, inv_per double")
    store.upsert("factor_daily", change)
    assert "by_key_" not in _plan(store.by_key("factor_daily"))
    assert store.by_key("factor_daily").filter("inv_per = -5").count() == 1
    assert store.co_locate() == {"stock_daily": [], "factor_daily": ["2020"]}
    assert "by_key_" in _plan(store.by_key("factor_daily"))
    again = EquityStore(spark, store.root)
    assert again.by_key("factor_daily").filter("inv_per = -5").count() == 1
    assert again.by_key("factor_daily").count() == 400
    again.delete("factor_daily", F.col("num_key") <= 400)
    assert again.by_key("stock_daily").count() == 400


def test_copies_need_a_year_partition_and_a_stored_table(spark, store):
    with pytest.raises(ValueError):
        store.co_locate(["stock_cons"])
    with pytest.raises(ValueError):
        store.co_locate(buckets=0)
    with pytest.raises(ValueError):
        store.by_key("stock_cons")
