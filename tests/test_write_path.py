import datetime as dt
import random
import tempfile

from pyspark.sql import functions as F

from equiframe.plans.prices import adjust_prices
from equiframe.plans.statements import trailing_pl
from equiframe.sources.sinks import replace_partitions, upsert_table


def _root():
    return tempfile.mkdtemp(prefix="equiframe-write-", dir="/tmp")


def test_upsert_table_rewrites_only_touched_partitions(spark):
    root = _root()
    path = f"{root}/factor_daily"
    t = spark.createDataFrame([(1, 2020, 1.0, 10.0), (2, 2020, 2.0, 20.0), (3, 2021, 3.0, 30.0)],
                              "num_key long, year int, a double, b double")
    upsert_table(spark, path, t, ["num_key"], partition_by=["year"], staging_root=root)
    src = spark.createDataFrame([(2, 2020, None), (4, 2020, 40.0)], "num_key long, year int, b double")
    upsert_table(spark, path, src, ["num_key"], partition_by=["year"], staging_root=root)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("num_key", "year", "a", "b").collect())
    assert got == [(1, 2020, 1.0, 10.0), (2, 2020, 2.0, None), (3, 2021, 3.0, 30.0), (4, 2020, None, 40.0)]
    # applying the same upsert again changes nothing
    upsert_table(spark, path, src, ["num_key"], partition_by=["year"], staging_root=root)
    again = sorted(tuple(r) for r in spark.read.parquet(path).select("num_key", "year", "a", "b").collect())
    assert again == got


def test_replace_partitions_keeps_other_years(spark):
    root = _root()
    path = f"{root}/workdays"
    days = spark.createDataFrame([(dt.date(2020, 1, 2), 2020), (dt.date(2021, 1, 4), 2021)],
                                 "base_dt date, year int")
    days.write.partitionBy("year").parquet(path)
    fresh = spark.createDataFrame([(dt.date(2021, 1, 5), 2021), (dt.date(2021, 1, 6), 2021)],
                                  "base_dt date, year int")
    replace_partitions(spark, path, fresh, ["year"], staging_root=root)
    got = sorted(r.base_dt for r in spark.read.parquet(path).collect())
    assert got == [dt.date(2020, 1, 2), dt.date(2021, 1, 5), dt.date(2021, 1, 6)]


def test_single_quarter_values_sum_to_ytd_and_q4_is_ytd(spark):
    rnd = random.Random(5)
    rows = []
    for s in ("a", "b"):
        ytd = 0.0
        for y in (2019, 2020, 2021):
            ytd = 0.0
            for q in (1, 2, 3, 4):
                ytd += float(rnd.randrange(1, 100))
                rows.append((s, f"{y} Q{q}", ytd))
    grid = spark.createDataFrame(rows, "sym_cd string, fs_q string, x double")
    out = trailing_pl(grid).collect()
    by = {(r.sym_cd, r.fs_q): r for r in out}
    for s in ("a", "b"):
        for y in (2019, 2020, 2021):
            assert sum(by[(s, f"{y} Q{q}")].x_n for q in (1, 2, 3, 4)) == by[(s, f"{y} Q4")].x_a4q
            assert by[(s, f"{y} Q4")].x_a4q == [x for (ss, fq, x) in rows if ss == s and fq == f"{y} Q4"][0]


def test_adjusted_last_close_equals_raw_last_close(spark):
    rnd = random.Random(9)
    rows, d0 = [], dt.date(2015, 1, 1)
    for s in ("a", "b", "c"):
        close = 100.0
        for i in range(0, 3000, 3):
            base = close * (0.5 if rnd.random() < 0.01 else 1.0)
            close = base * (1 + rnd.uniform(-0.03, 0.03))
            rows.append((s, d0 + dt.timedelta(days=i), close, close, close, close, base))
    df = spark.createDataFrame(rows, "sym_cd string, base_dt date, open double, high double, low double, "
                                     "close double, base_p double")
    adj = adjust_prices(df, close_only=True, block_days=365)
    last = adj.groupBy("sym_cd").agg(F.max_by("close", "base_dt").alias("c")).collect()
    raw = {s: [r for r in rows if r[0] == s][-1][5] for s in ("a", "b", "c")}
    assert {r.sym_cd: r.c for r in last} == raw


def test_upsert_table_unpartitioned_swaps_whole_table(spark):
    root = _root()
    path = f"{root}/index_list"
    t = spark.createDataFrame([("X001", "a"), ("P002", "b")], "idx_code string, codeName string")
    upsert_table(spark, path, t, ["idx_code"], staging_root=root)
    upsert_table(spark, path, spark.createDataFrame([("P002", "B"), ("Q003", "c")], "idx_code string, codeName string"),
                 ["idx_code"], staging_root=root)
    got = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert got == [("P002", "B"), ("Q003", "c"), ("X001", "a")]


def test_replace_partition_by_predicate(spark):
    from equiframe.sources.sinks import replace_partition
    t = spark.createDataFrame([(dt.date(2020, 1, 2),), (dt.date(2021, 1, 4),)], "base_dt date")
    new = spark.createDataFrame([(dt.date(2021, 1, 5),)], "base_dt date")
    got = sorted(r.base_dt for r in replace_partition(t, new, F.year("base_dt") == 2021).collect())
    assert got == [dt.date(2020, 1, 2), dt.date(2021, 1, 5)]
