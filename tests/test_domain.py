import datetime as dt

from pyspark.sql import functions as F

from equiframe.plans.factors import value_factors
from equiframe.plans.ingest import stock_info_merge
from equiframe.plans.statements import trailing_pl
from equiframe.sources.sinks import delete_where, upsert_partial


def test_trailing_pl_golden(spark):
    rows = [("s", "2020 Q1", 10.0), ("s", "2020 Q2", 20.0), ("s", "2020 Q3", 30.0), ("s", "2020 Q4", 40.0),
            ("s", "2021 Q1", 12.0), ("s", "2021 Q2", None), ("s", "2021 Q3", 36.0), ("s", "2021 Q4", None)]
    grid = spark.createDataFrame(rows, "sym_cd string, fs_q string, x double")
    got = {r.fs_q: (r.x_a4q, r.x_n) for r in trailing_pl(grid).collect()}
    assert "2021 Q4" not in got  # all-NULL row dropped
    assert got["2021 Q1"] == (42.0, 12.0)
    assert got["2021 Q2"] == (40.0, None)
    assert got["2021 Q3"] == (46.0, None)
    assert [got[f"2020 Q{q}"][0] for q in (1, 2, 3, 4)] == [None, None, None, 40.0]
    assert [got[f"2020 Q{q}"][1] for q in (1, 2, 3, 4)] == [10.0, 10.0, 10.0, 10.0]


def test_trailing_pl_earn_prefers_controlling(spark):
    rows = [("s", "2020 Q4", 5.0, 4.0), ("s", "2021 Q1", 2.0, None)]
    grid = spark.createDataFrame(rows, "sym_cd string, fs_q string, earn double, earn_dom double")
    got = {r.fs_q: r.asDict() for r in trailing_pl(grid).collect()}
    assert "earn_dom_a4q" not in got["2020 Q4"]
    assert got["2020 Q4"]["earn_a4q"] == 4.0
    assert got["2021 Q1"]["earn_a4q"] == 4.0  # earn_dom fallback to last year's Q4
    assert got["2021 Q1"]["earn_n"] == 2.0    # earn_dom_n NULL -> earn_n


def test_partial_upsert_golden(spark):
    target = spark.createDataFrame([(1, "a1", "b1"), (2, "a2", "b2")], "k int, a string, b string")
    source = spark.createDataFrame([(2, None), (3, "b3")], "k int, b string")
    got = sorted(tuple(r) for r in upsert_partial(target, source, ["k"]).collect())
    assert got == [(1, "a1", "b1"), (2, "a2", None), (3, None, "b3")]
    twice = upsert_partial(upsert_partial(target, source, ["k"]), source, ["k"])
    assert sorted(tuple(r) for r in twice.collect()) == got


def test_delete_keeps_null_predicate(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 50.0)], "k int, v double")
    assert sorted(r.k for r in delete_where(df, F.col("v") > 10).collect()) == [1, 2]


def test_stock_info_merge_first_seen(spark):
    d = [dt.date(2023, 1, 1), dt.date(2023, 1, 2), dt.date(2023, 1, 3)]
    existing = spark.createDataFrame([("s", d[0], "A")], "sym_cd string, info_update date, sym_nm string")
    batch = spark.createDataFrame([("s", d[1], "B"), ("s", d[2], "A")],
                                  "sym_cd string, info_update date, sym_nm string")
    got = [(r.info_update, r.sym_nm) for r in stock_info_merge(existing, batch).collect()]
    assert got == [(d[1], "B")]


def test_zero_shares_every_factor_null(spark):
    daily = spark.createDataFrame([(1, dt.date(2023, 1, 2), "s", 100.0, 0.0, 10.0)],
                                  "num_key long, base_dt date, sym_cd string, mkt_cap double, "
                                  "num_stock_o double, num_stock_t double")
    cons = spark.createDataFrame([(1, 1.0, 1.0, 1.0, 1.0, 1.0)],
                                 "num_key long, sales_12mf double, opr_prof_12mf double, earn_12mf double, "
                                 "earn_dom_12mf double, bps_12mf double")
    wd = spark.createDataFrame([(dt.date(2023, 1, 2), "2022 Q3", 2021)], "base_dt date, fs_q string, fs_y int")
    bs = spark.createDataFrame([("s", "2022 Q3", 1.0, 1.0, 1.0)],
                               "sym_cd string, fs_q string, grs_asset double, cap double, net_asset double")
    prep = spark.createDataFrame([("s", "2022 Q3", 1.0, 1.0, 1.0, 1.0, 1.0)],
                                 "sym_cd string, fs_q string, sales_a4q double, opr_prof_a4q double, "
                                 "earn_a4q double, op_cash_flow_a4q double, cash_flow_a4q double")
    row = value_factors(daily, cons, wd, bs, prep).collect()[0].asDict()
    assert row.pop("num_key") == 1
    assert all(v is None for v in row.values())


def test_stock_info_changes_keeps_returns(spark):
    d = [dt.date(2023, 1, 1), dt.date(2023, 1, 2), dt.date(2023, 1, 3), dt.date(2023, 1, 4)]
    existing = spark.createDataFrame([("s", d[0], "A")], "sym_cd string, info_update date, sym_nm string")
    batch = spark.createDataFrame([("s", d[1], "B"), ("s", d[2], "A"), ("s", d[3], "A")],
                                  "sym_cd string, info_update date, sym_nm string")
    from equiframe.plans.ingest import stock_info_changes
    got = sorted((r.info_update, r.sym_nm) for r in stock_info_changes(existing, batch).collect())
    assert got == [(d[1], "B"), (d[2], "A")]


def test_update_plan_golden(spark):
    from equiframe.plans.calendar import update_plan, with_report_lag
    days = [dt.date(2023, 5, 29) + dt.timedelta(days=i) for i in range(10)]
    wd = with_report_lag(spark.createDataFrame([(d,) for d in days if d.weekday() < 5], "base_dt date"))
    daily = spark.createDataFrame([(dt.date(2023, 5, 31), "s")], "base_dt date, sym_cd string")
    bs = spark.createDataFrame([("s", "2022 Q4")], "sym_cd string, fs_q string")
    info = spark.createDataFrame([("s",), ("t",)], "sym_cd string")
    plan = update_plan(wd, daily, bs, info, info.filter("sym_cd = 's'"), dt.datetime(2023, 6, 6, 8, 0))
    # before 09:00 the cut-off is two days back: 2023-06-04 (a Sunday)
    assert [r.base_dt for r in plan["days"].orderBy("base_dt").collect()] == \
        [dt.date(2023, 6, 1), dt.date(2023, 6, 2)]
    assert sorted(r.year for r in plan["years"].collect()) == [2023]
    assert sorted(r.fs_q for r in plan["quarters"].collect()) == ["2022 Q4", "2023 Q1"]
    assert [r.sym_cd for r in plan["new_symbols"].collect()] == ["t"]


def test_listed_universe_pairs_landed_frames_by_day(spark):
    from pyspark.sql import functions as F
    from equiframe.plans.ingest import listed_universe
    d1, d2 = dt.date(2023, 1, 2), dt.date(2023, 1, 3)
    px = spark.createDataFrame([(d, "000010", "1", "1", "9", "9", "9", "9", "ACME", "STK") for d in (d1, d2)],
                               "base_dt date, ISU_SRT_CD string, ACC_TRDVOL string, ACC_TRDVAL string, "
                               "TDD_OPNPRC string, TDD_HGPRC string, TDD_LWPRC string, TDD_CLSPRC string, "
                               "ISU_ABBRV string, MKT_ID string")
    base = spark.createDataFrame([(d1, "000010", "8"), (d2, "000010", "9")],
                                 "base_dt date, ISU_SRT_CD string, BAS_PRC string")
    excluded = spark.createDataFrame([(d2, "000010")], "base_dt date, ISU_SRT_CD string")
    sectors = spark.createDataFrame([(d1, "000010", "반도체"), (d2, "000010", "제약")],
                                    "base_dt date, ISU_SRT_CD string, IDX_IND_NM string")
    got = [(r.base_dt, r.base_p, r.sec_krx) for r in
           listed_universe(px, base, excluded, sectors, F.col("base_dt")).collect()]
    assert got == [(d1, 8.0, "전기전자")]  # day 2 is excluded that day only


def test_stock_cons_right_join_keeps_vendor_only_rows(spark):
    from equiframe.plans.ingest import stock_cons, stock_managed
    d1 = dt.date(2023, 1, 2)
    daily = spark.createDataFrame([(7, d1, "a")], "num_key bigint, base_dt date, sym_cd string")
    vendor = spark.createDataFrame(
        [(d1, "a", 1.0, None, None, None, None, None, "정상", "정지", None),
         (d1, "b", None, 2.0, None, None, None, None, "관리", "정상", "정상"),   # no stock_daily row
         (d1, "c", None, None, None, None, None, None, "정상", "정상", "정상")],  # no consensus item
        "base_dt date, sym_cd string, sales_12mf double, opr_prof_12mf double, earn_12mf double, "
        "earn_dom_12mf double, bps_12mf double, eps_down_fy2 double, sym_mng string, sym_stop string, "
        "sym_reg string")
    cons = sorted((r.num_key or -1, r.sales_12mf, r.opr_prof_12mf) for r in stock_cons(daily, vendor).collect())
    assert cons == [(-1, None, 2.0), (7, 1.0, None)]
    managed = sorted((r.num_key or -1, r.type) for r in stock_managed(daily, vendor).collect())
    assert managed == [(-1, 1), (7, 2)]
