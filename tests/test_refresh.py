"""The reference's refresh actions end to end on a scratch store."""

import tempfile

from pyspark.sql import functions as F

from equiframe import fixtures as fx
from equiframe.plans import calendar as cal
from equiframe.plans.refresh import EquityStore
from equiframe.sources.tables import read_parquet
from equiframe.sources.vendor import cross_section, fiscal_basis, item_metadata

SF = "/root/testdata/sf0.001"


def test_refresh_actions_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="equiframe-store-", dir="/tmp")
    store = EquityStore(spark, f"{root}/db", staging_root=f"{root}/staging")
    load = lambda n: fx.load(spark, SF, n)

    years = read_parquet(spark, SF, "lineitem").select(F.year("l_shipdate").alias("year")).distinct()
    store.refresh_workdays(years, cal.fixed_holidays(years))
    n_days = store.table("workdays").count()
    store.refresh_workdays(years.filter("year = 1998"), cal.fixed_holidays(years))
    assert store.table("workdays").count() == n_days

    store.refresh_index_list(load("fx_index_raw"))
    assert store.table("index_list").count() == 25

    listing = load("fx_listing")
    days = ["1998-01-05", "1998-01-12"]  # Mondays: vendor and membership weeks
    prices = listing.withColumn("base_dt", F.lit(days[0]).cast("date")).unionByName(
        listing.withColumn("base_dt", F.lit(days[1]).cast("date")))
    vendor = load("fx_vendor")
    landed = dict(base=load("fx_base_price"), excluded=load("fx_excluded"), sectors=load("fx_sectors"),
                  vendor=vendor, members=load("fx_members"), levels=load("fx_index_levels"),
                  index_base=load("fx_index_base"))
    store.load_daily(prices, **landed)
    sd = store.table("stock_daily")
    n = sd.count()
    assert n > 0 and n % 2 == 0
    assert sorted(r.num_key for r in sd.select("num_key").collect()) == list(range(1, n + 1))
    # the same attributes on the second day are not a new version
    assert store.table("stock_info").count() == n // 2
    # re-landing the same days writes nothing new
    store.load_daily(prices, **landed)
    assert store.table("stock_daily").count() == n

    meta = item_metadata(spark)
    normalised = cross_section(load("fx_cs_raw"), meta, "fs", F.col("period"))
    store.load_statements(normalised, meta, normalised.select("fs_q").distinct())
    assert store.table("company_fs_pl_prep").count() > 0

    # num_key-keyed tables land in the year of their trading day (they may be
    # empty: listing codes and vendor codes overlap only by chance)
    for name in ("stock_cons", "stock_managed", "stocks_in_index"):
        if store.exists(name):
            assert {r.year for r in store.scan(name).select("year").distinct().collect()} == {1998}

    # new symbols: fiscal-basis export, known quarters only, all quarters prepped
    fb = fiscal_basis(load("fx_fb_raw"), meta)
    before = store.table("company_fs_pl_prep").count()
    store.load_new_symbol_statements(fb, meta, fb.select("sym_cd").distinct())
    assert store.table("company_fs_pl_prep").count() >= before

    store.refresh_factors()
    fd = store.table("factor_daily")
    assert fd.count() == n
    assert set(fd.columns) >= {"num_key", "inv_per", "inv_pbr_12mf", "ret_3m", "ret_12m"}
    # a ranged refresh rewrites the same rows with the same values
    before = sorted(tuple(r) for r in fd.collect())
    store.refresh_factors(days[0], days[1])
    after = sorted(tuple(r) for r in store.table("factor_daily").collect())
    assert after == before


def test_store_upsert_of_num_key_table_without_key_days(spark):
    import datetime as dt
    root = tempfile.mkdtemp(prefix="equiframe-store-", dir="/tmp")
    store = EquityStore(spark, f"{root}/db", staging_root=f"{root}/staging")
    daily = spark.createDataFrame([(1, dt.date(2020, 1, 2), "s"), (2, dt.date(2021, 1, 4), "s")],
                                  "num_key bigint, base_dt date, sym_cd string")
    store.upsert("stock_daily", daily)
    store.upsert("stock_managed", spark.createDataFrame([(1, 1), (2, 3), (9, 2)], "num_key bigint, type int"))
    got = sorted((r.num_key, r.type, r.year) for r in store.scan("stock_managed").collect())
    assert got == [(1, 1, 2020), (2, 3, 2021)]


def test_missing_prerequisite_is_a_clear_error(spark):
    import pytest
    root = tempfile.mkdtemp(prefix="equiframe-store-", dir="/tmp")
    store = EquityStore(spark, f"{root}/db")
    with pytest.raises(ValueError, match="load_daily"):
        store.refresh_factors()


def test_reload_keeps_keys_takes_corrections_and_counts_duplicates_once(spark):
    root = tempfile.mkdtemp(prefix="equiframe-store-", dir="/tmp")
    store = EquityStore(spark, f"{root}/db", staging_root=f"{root}/staging")
    load = lambda n: fx.load(spark, SF, n)
    store.refresh_index_list(load("fx_index_raw"))
    listing = load("fx_listing")
    prices = listing.withColumn("base_dt", F.lit("1998-01-05").cast("date"))
    landed = dict(base=load("fx_base_price"), excluded=load("fx_excluded"), sectors=load("fx_sectors"),
                  vendor=load("fx_vendor"), members=load("fx_members"), levels=load("fx_index_levels"),
                  index_base=load("fx_index_base"))
    names = ("stock_daily", "stock_info", "stock_cons", "stock_managed", "stocks_in_index", "index_daily")

    def all_rows():
        return {n: sorted(map(str, store.table(n).collect())) for n in names if store.exists(n)}

    store.load_daily(prices, **landed)
    first = all_rows()
    assert first["stock_daily"] and first["index_daily"]
    assert store.table("index_daily").filter("idx_code is null").count() == 0
    store.load_daily(prices.unionByName(prices), **landed)  # again, every listing twice
    assert all_rows() == first
    keys = {r.sym_cd: r.num_key for r in store.table("stock_daily").collect()}
    store.load_daily(prices.withColumn("TDD_CLSPRC", F.lit("999,999")), **landed)
    got = store.table("stock_daily").collect()
    assert {r.sym_cd: r.num_key for r in got} == keys and {r.close for r in got} == {999999.0}
    # levels are stored without prices, too
    store.load_daily(prices.limit(0), **landed)
    assert all_rows()["index_daily"] == first["index_daily"]
    import os
    assert not os.path.exists(f"{root}/staging") or os.listdir(f"{root}/staging") == []


def test_ranged_momentum_reads_as_far_back_as_its_windows(spark):
    root = tempfile.mkdtemp(prefix="equiframe-store-", dir="/tmp")
    store = EquityStore(spark, f"{root}/db", staging_root=f"{root}/staging")
    daily = fx.load(spark, SF, "fx_daily")  # weekly bars: 252 of them are five years
    store.upsert("stock_daily", daily.withColumn("info_update", F.col("base_dt")))
    store.refresh_workdays(daily.select(F.year("base_dt").alias("year")).distinct(),
                           cal.fixed_holidays(daily.select(F.year("base_dt").alias("year")).distinct()))
    from equiframe.plans import factors as fac
    for name, cols in (("company_fs_bs", "fx_bs"), ("company_fs_pl_prep", "fx_prep")):
        if cols in fx._FIXTURES:
            store.upsert(name, fx.load(spark, SF, cols))
    if not store.exists("company_fs_pl_prep"):
        from equiframe.plans import statements as st
        store.upsert("company_fs_pl_prep", st.trailing_pl_range(fx.load(spark, SF, "fx_bs"), fx.load(spark, SF, "fx_pl"),
                                                                fx.load(spark, SF, "fx_bs").select("fs_q").distinct()))
    store.refresh_factors(start="1998-01-01")
    want = {r.num_key: r for r in fac.momentum(daily).join(daily.select("num_key", "base_dt"), "num_key")
            .filter("base_dt >= '1998-01-01'").collect()}
    got = store.table("factor_daily").collect()
    assert {r.num_key for r in got} == set(want)
    for r in got:
        for c in ("ret_3m", "ret_6m", "ret_12m"):
            a, b = r[c], want[r.num_key][c]
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9)


def test_unfinished_swap_is_finished_by_the_next_open(spark, monkeypatch):
    from equiframe.sources import sinks

    root = tempfile.mkdtemp(prefix="equiframe-store-", dir="/tmp")
    path, staging = f"{root}/t", f"{root}/staging"
    make = lambda rows: spark.createDataFrame(rows, "k int, v string, year int")
    sinks.upsert_table(spark, path, make([(1, "a", 2000), (2, "b", 2001)]), ["k"], ["year"], staging)

    def lost(spark, path):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(sinks, "finish_swap", lambda s, p: None if not hasattr(lost, "armed") else lost(s, p))
    real_swap = sinks._swap

    def broken(spark, path, stage, parts):
        lost.armed = True
        real_swap(spark, path, stage, parts)

    monkeypatch.setattr(sinks, "_swap", broken)
    try:
        sinks.upsert_table(spark, path, make([(2, "B", 2001), (3, "c", 2001)]), ["k"], ["year"], staging)
        raise AssertionError("the swap should have broken off")
    except RuntimeError:
        pass
    monkeypatch.undo()
    import shutil
    shutil.rmtree(f"{path}/year=2001")  # the overwrite had begun
    sinks.finish_swap(spark, path)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a", 2000), (2, "B", 2001), (3, "c", 2001)]
    import os
    assert os.listdir(staging) == [] and not os.path.exists(f"{path}._swap")
