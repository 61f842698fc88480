import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from equiframe.operators.keys import assign_keys
from equiframe.operators.windows import fill_forward, latest_per_key, rolling, suffix_product
from equiframe.plans.prices import adjust_prices


def test_rolling_gap_makes_every_value_null(spark):
    # n = 3 over calendar days 1..5; the symbol misses day 3
    rows = [("a", t, 1.1) for t in (1, 2, 4, 5)]
    df = spark.createDataFrame(rows, "sym string, t int, g double")
    got = rolling(df, "g", {"r": 3}, ["sym"], "t").collect()
    assert all(r.r is None for r in got)


def _dense_product(vals, t, n):
    window = [vals.get(k) for k in range(t - n + 1, t + 1)]
    if any(v is None for v in window):
        return None
    return math.prod(window)


def test_rolling_blocks_equal_dense_grid(spark):
    rnd = random.Random(7)
    rows = []
    for s in ("a", "b", "c"):
        for t in range(1, 400):
            if rnd.random() < 0.03:
                continue
            rows.append((s, t, None if rnd.random() < 0.01 else 1 + rnd.uniform(-0.05, 0.05)))
    df = spark.createDataFrame(rows, "sym string, t int, g double")
    wins = {"w5": 5, "w60": 60}
    for block in (61, 100, 4096):
        got = {(r.sym, r.t): (r.w5, r.w60) for r in rolling(df, "g", wins, ["sym"], "t", block=block).collect()}
        assert len(got) == len(rows)
        for s in ("a", "b", "c"):
            vals = {t: g for (ss, t, g) in rows if ss == s}
            for t in vals:
                for i, n in enumerate((5, 60)):
                    want = _dense_product(vals, t, n)
                    have = got[(s, t)][i]
                    assert (want is None) == (have is None)
                    if want is not None:
                        assert math.isclose(want, have, rel_tol=1e-12)


def test_adjust_split_golden(spark):
    # day 1 close 100 base 100; day 2 close 50 base 50 (a 2:1 split)
    df = spark.createDataFrame([("a", dt.date(2023, 1, 2), 100.0, 100.0, 100.0, 100.0, 100.0),
                                ("a", dt.date(2023, 1, 3), 50.0, 50.0, 50.0, 50.0, 50.0)],
                               "sym_cd string, base_dt date, open double, high double, low double, "
                               "close double, base_p double")
    close = [r.close for r in adjust_prices(df, close_only=True).orderBy("base_dt").collect()]
    assert close == [50.0, 50.0]


def test_suffix_product_blocks_and_nulls(spark):
    rnd = random.Random(3)
    start = dt.date(2020, 1, 1)
    rows = [("k", start + dt.timedelta(days=i), None if i == 40 else 1 + rnd.uniform(-0.1, 0.1), float(i))
            for i in range(300)]
    df = spark.createDataFrame(rows, "k string, d date, r double, c double")
    out = {r.d: (r.f, r.last) for r in
           suffix_product(df, "r", ["k"], "d", "f", {"last": "c"}, block_days=17).collect()}
    vals = [r for (_, _, r, _) in rows]
    for i, (_, d, _, _) in enumerate(rows):
        later = vals[i + 1:]
        want = None if any(v is None for v in later) else math.prod(later)
        f, last = out[d]
        assert last == 299.0
        assert (want is None) == (f is None)
        if want is not None:
            assert math.isclose(want, f, rel_tol=1e-12)


def test_first_seen_a_b_a(spark):
    from equiframe.plans.ingest import stock_info_merge
    df = spark.createDataFrame([("s", "A", dt.date(2023, 1, 1)), ("s", "B", dt.date(2023, 1, 2)),
                                ("s", "A", dt.date(2023, 1, 3))], "sym_cd string, nm string, info_update date")
    seen = stock_info_merge(df.limit(0), df)
    assert sorted((r.nm, r.info_update) for r in seen.collect()) == [("A", dt.date(2023, 1, 1)), ("B", dt.date(2023, 1, 2))]
    latest = latest_per_key(seen, ["sym_cd"], "info_update").collect()
    assert [(r.nm, r.info_update) for r in latest] == [("B", dt.date(2023, 1, 2))]


def test_keys_contiguous_unique_and_ordered(spark):
    rnd = random.Random(1)
    rows = [(dt.date(2023, 1, 1) + dt.timedelta(days=rnd.randrange(30)), f"{rnd.randrange(10**6):06d}")
            for _ in range(3000)]
    rows = list(dict.fromkeys(rows))
    # one hot day holding a third of the rows
    rows += [(dt.date(2023, 3, 1), f"{i:06d}") for i in range(len(rows) // 2)]
    df = spark.createDataFrame(rows, "base_dt date, sym_cd string")
    for parts in (7, None):  # explicit ranges, or AQE-coalesced ones
        out = assign_keys(df, ["base_dt", "sym_cd"], start=F.lit(100).cast("long"), partitions=parts).collect()
        keys = sorted(r.num_key for r in out)
        assert keys == list(range(101, 101 + len(rows)))
        by_key = [(r.base_dt, r.sym_cd) for r in sorted(out, key=lambda r: r.num_key)]
        assert by_key == sorted(rows)


def test_as_of_latest_matches_brute_force(spark):
    from equiframe.operators.windows import as_of_latest
    rnd = random.Random(11)
    d0 = dt.date(2020, 1, 1)
    left = [(k, d0 + dt.timedelta(days=rnd.randrange(400))) for k in "abc" for _ in range(150)]
    right = [(k, d0 + dt.timedelta(days=rnd.randrange(-30, 400))) for k in "ab" for _ in range(12)]
    ldf = spark.createDataFrame(left, "k string, d date")
    rdf = spark.createDataFrame(right, "k string, v date")
    for block in (7, 50, 4096):
        got = sorted((r.k, r.d, r.v) for r in as_of_latest(ldf, rdf, ["k"], "d", "v", "v", block).collect())
        want = sorted((k, d, max((v for kk, v in right if kk == k and v <= d), default=None)) for k, d in left)
        assert got == want


def test_momentum_range_equals_full_history_restricted(spark):
    from equiframe import fixtures as fx
    from equiframe.plans.factors import momentum
    daily = fx.load(spark, "/root/testdata/sf0.01", "fx_daily")
    windows = {"r5": 5, "r60": 60}
    full = {r.num_key: (r.r5, r.r60) for r in momentum(daily, windows).collect()}
    keys = {r.num_key for r in daily.filter("base_dt BETWEEN '1998-03-01' AND '1999-06-30'").collect()}
    part = {r.num_key: (r.r5, r.r60) for r in momentum(daily, windows, start="1998-03-01", end="1999-06-30").collect()}
    assert set(part) == keys
    assert all(part[k] == full[k] for k in keys)


def test_suffix_product_shuffles_raw_rows_once(spark):
    import re

    from equiframe.operators.windows import suffix_product

    df = spark.range(100).selectExpr("cast(id % 3 as string) AS k", "date_add(date'2020-01-01', cast(id as int)) AS d",
                                     "1.0D + id AS v", "'payload' AS wide")
    plan = suffix_product(df, "v", ["k"], "d", "out")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("REPARTITION_BY_COL", plan)) == 1
    # the other branch shuffles only what was aggregated before
    assert re.search(r"Exchange hashpartitioning\([^\n]*ENSURE[^\n]*\n[^\n]*(Hash|Sort|ObjectHash)Aggregate\([^\n]*partial", plan)


def test_full_windows_of_every_length_and_aggregate(spark):
    import random

    from equiframe.operators.windows import AGGREGATES

    rnd = random.Random(4)
    rows = [(k, t, None if rnd.random() < 0.02 else rnd.randrange(1, 9)) for k in "ab" for t in range(1, 400) if rnd.random() < 0.995]
    df = spark.createDataFrame(rows, "k string, t long, v int")
    windows = {f"w{n}": n for n in (1, 2, 3, 4, 5, 15, 16, 17, 60, 63, 64, 65, 120)}
    at = {(k, t): v for k, t, v in rows}
    brute = {"product": lambda x: math.prod(map(float, x)), "sum": sum, "mean": lambda x: sum(x) / len(x), "min": min, "max": max}
    assert brute.keys() == AGGREGATES.keys()
    for agg, fn in brute.items():
        for r in rolling(df, "v", windows, ["k"], "t", agg=agg, block=50).collect():
            for name, n in windows.items():
                cells = [at.get((r.k, t)) for t in range(r.t - n + 1, r.t + 1)]
                if None in cells:
                    assert r[name] is None
                else:
                    assert r[name] == pytest.approx(fn(cells), rel=1e-12)


def test_full_windows_sort_once(spark):
    df = spark.createDataFrame([("a", 1, 1.0)], "k string, t long, v double")
    plan = rolling(df, "v", {"a": 60, "b": 252}, ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Exchange hashpartitioning") == 1 and "rangeBetween" not in plan.lower()


def test_fill_forward_blocks_equal_row_by_row(spark):
    rnd = random.Random(5)
    rows, want = [], {}
    for sym in ("a", "b", None):
        last = [None, None]
        for o in [None] + sorted(rnd.sample(range(-40, 300), 150)):
            vals = [float(rnd.randrange(100)) if rnd.random() < 0.1 else None, f"t{o}" if rnd.random() < 0.02 else None]
            rows.append((sym, o, *vals))
            last = [v if v is not None else k for v, k in zip(vals, last)]
            want[sym, o] = tuple(last)
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "sym string, o int, x double, t string")
    for block in (1, 7, 64, 10_000):
        out = fill_forward(df, ["x", "t"], ["sym"], "o", block=block)
        assert out.columns == df.columns
        got = {(r.sym, r.o): (r.x, r.t) for r in out.collect()}
        assert got == want and out.count() == len(rows)
    assert fill_forward(df.limit(0), ["x"], ["sym"], "o").count() == 0
    with pytest.raises(ValueError):
        fill_forward(df, ["x"], ["sym"], "o", block=0)


def test_fill_forward_spreads_a_hot_key(spark):
    df = spark.range(0, 20_000).select(F.lit("hot").alias("sym"), F.col("id").alias("o"),
                                       F.when(F.col("id") % 5_000 == 0, F.col("id")).alias("x"))
    out = fill_forward(df, ["x"], ["sym"], "o", block=100)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan
    assert out.filter("x <> o - o % 5000").count() == 0 and out.filter("x is not null").count() == 20_000
