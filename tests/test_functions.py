import datetime as dt

from pyspark.sql import functions as F

from equiframe.functions import (cutoff_date, market_letters, parse_number, quarter_label,
                                 report_quarter, report_year, round_half_even, safe_div,
                                 sector_recode, unite)


def test_parse_number_golden(spark):
    df = spark.createDataFrame([("1,234",), ("-",), ("-1,234.5",), ("12%",), ("$3,000",), ("",),
                                ("NA",), ("N/A",), (None,)], "x string")
    got = [r[0] for r in df.select(parse_number("x")).collect()]
    assert got == [1234.0, None, -1234.5, 12.0, 3000.0, None, None, None, None]


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "x double")
    assert [r[0] for r in df.select(round_half_even("x")).collect()] == [0.0, 2.0, 2.0, -0.0]


def test_report_lag_golden(spark):
    days = ["2023-01-02", "2023-03-31", "2023-04-03", "2023-05-31", "2023-06-01", "2023-07-31",
            "2023-09-01", "2023-12-01"]
    want = ["2022 Q3", "2022 Q3", "2022 Q4", "2022 Q4", "2023 Q1", "2023 Q1", "2023 Q2", "2023 Q3"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("d"))
    got = df.select(report_quarter("d").alias("q"), report_year("d").alias("y")).collect()
    assert [r.q for r in got] == want
    # fs_y = year(day - 15 months): January-March 2023 -> 2021, later -> 2022
    assert [r.y for r in got] == [2021] * 2 + [2022] * 6


def test_report_lag_clamps_like_fill_forward(spark):
    # 2023-07-31 - 5 months has no day 31 in February: clamps to 02-28 (Q1),
    # the same quarter the prior day gives.
    df = spark.createDataFrame([("2023-07-31",), ("2023-07-28",)], "d string")
    got = [r[0] for r in df.select(report_quarter(F.to_date("d"))).collect()]
    assert got == ["2023 Q1", "2023 Q1"]


def test_cutoff_date():
    assert cutoff_date(dt.datetime(2023, 5, 10, 8, 59)) == dt.date(2023, 5, 8)
    assert cutoff_date(dt.datetime(2023, 5, 10, 9, 0)) == dt.date(2023, 5, 9)


def test_recoders(spark):
    df = spark.createDataFrame([("반도체", "KOSPI", "1st-Quarter"), ("없는업종", "KRX 테마", "Semi-Quarter"),
                                (None, "KOSDAQ", "Annual")], "s string, m string, q string")
    got = df.select(sector_recode("s"), market_letters("m"), quarter_label("q")).collect()
    assert [tuple(r) for r in got] == [("전기전자", "P", "Q1"), ("없는업종", "X T", "Q2"), (None, "Q", "Q4")]


def test_unite_and_safe_div(spark):
    df = spark.createDataFrame([("P", "001", 1.0, 0.0), (None, "002", 4.0, 2.0)],
                               "a string, b string, x double, y double")
    got = df.select(unite(["a", "b"]).alias("u"), safe_div("x", "y").alias("r")).collect()
    assert [(r.u, r.r) for r in got] == [("P001", None), ("NA002", 2.0)]


def test_parse_yyyymmdd_and_daily_cross_section(spark):
    import datetime as dt

    from equiframe.functions import parse_yyyymmdd
    from equiframe.sources.vendor import cross_section, item_metadata
    df = spark.createDataFrame([("20230102",), ("2023-01-02",), ("bad",), (None,)], "x string")
    assert [r[0] for r in df.select(parse_yyyymmdd("x")).collect()] == [dt.date(2023, 1, 2), None, None, None]
    meta = item_metadata(spark, [("daily", "mkt_cap", 1, 0, 0, 0), ("daily", "sec_fn_1", 0, 0, 0, 0)])
    raw = spark.createDataFrame([("A005930", "1,234", "IT")], "sym_cd string, mkt_cap string, sec_fn_1 string")
    row = cross_section(raw, meta, "daily", "20230102").first()
    assert tuple(row) == (dt.date(2023, 1, 2), "005930", 1234.0, "IT")


def test_small_helpers(spark):
    import datetime as dt

    from equiframe.functions import first_non_null, is_q4
    df = spark.createDataFrame([("005930", None, 2.0, dt.date(2023, 1, 2), "2022 Q4"),
                                ("000660", 1.0, 3.0, dt.date(2023, 3, 31), "2023 Q1")],
                               "s string, a double, b double, d date, q string")
    got = df.orderBy("d").select(first_non_null("a", "b"), is_q4("q")).collect()
    assert [tuple(r) for r in got] == [(2.0, True), (1.0, False)]
