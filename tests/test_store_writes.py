"""Stored writes: unique keys, deletes, readers beside writers, leases."""

import json
import os
import shutil
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from equiframe.plans.refresh import EquityStore
from equiframe.sources import files, lease, sinks


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="equiframe-store-", dir="/tmp")


def make(spark, rows):
    return spark.createDataFrame(rows, "k int, v string, year int")


def rows_of(df):
    return sorted(map(tuple, df.collect())) if df is not None else []


FIRST = [(1, "a", 2000), (2, "b", 2001), (3, "c", 2001), (4, "d", 2002)]


def written(spark, root):
    path = f"{root}/t"
    sinks.upsert_table(spark, path, make(spark, FIRST), ["k"], ["year"], f"{root}/staging")
    return path


def test_equal_rows_count_once_however_often_they_land(spark, root):
    store = EquityStore(spark, f"{root}/db", staging_root=f"{root}/staging")
    members = spark.createDataFrame([(1, "X1", 2020)] * 3 + [(2, "X1", 2020)], "num_key long, idx_code string, year int")
    key_days = spark.sql("SELECT explode(array(1L, 2L)) num_key, DATE '2020-01-02' base_dt")
    raw = spark.createDataFrame([("f1", "KRX", "001", "one", "a", "b"), ("f2", "KOSPI", "002", "two", "a", "b")] * 2,
                                "full_code string, marketName string, short_code string, codeName string, marketCode string, x string")
    for _ in range(3):
        store.upsert("stocks_in_index", members.drop("year"), key_days)
        store.refresh_index_list(raw)
        assert store.table("stocks_in_index").count() == 2 and store.table("index_list").count() == 2


@pytest.mark.parametrize("parts", [[], ["year"]])
def test_rows_that_share_a_key_and_differ_are_an_error(spark, root, parts):
    path = f"{root}/t"
    good = make(spark, [(1, "a", 2000), (1, "a", 2000), (2, None, 2000), (2, None, 2000)])
    for _ in range(2):
        sinks.upsert_table(spark, path, good, ["k"], parts, f"{root}/staging")
        with pytest.raises(sinks.ConflictingRows, match='"k":7'):
            sinks.upsert_table(spark, path, make(spark, [(7, "x", 2000), (7, "y", 2000)]), ["k"], parts, f"{root}/staging")
        assert rows_of(spark.read.parquet(path)) == [(1, "a", 2000), (2, None, 2000)]
        assert os.listdir(f"{root}/staging") == []


def test_delete_empties_a_partition_and_rewrites_another(spark, root):
    path = written(spark, root)
    before = {f: os.stat(f"{path}/{f}").st_mtime_ns for f in os.listdir(path)}
    sinks.delete_rows(spark, path, (F.col("year") == 2000) | (F.col("v") == "b"), ["year"], f"{root}/staging")
    assert rows_of(spark.read.parquet(path)) == [(3, "c", 2001), (4, "d", 2002)]
    assert not os.path.exists(f"{path}/year=2000")
    assert os.stat(f"{path}/year=2002").st_mtime_ns == before["year=2002"]
    sinks.delete_rows(spark, path, F.col("v") == "nothing", ["year"], f"{root}/staging")
    sinks.delete_rows(spark, path, F.lit(None).cast("boolean"), ["year"], f"{root}/staging")
    assert rows_of(spark.read.parquet(path)) == [(3, "c", 2001), (4, "d", 2002)]
    sinks.delete_rows(spark, path, F.lit(True), ["year"], f"{root}/staging")
    assert sinks.read_table(spark, path) is None and os.listdir(f"{root}/staging") == []
    sinks.upsert_table(spark, path, make(spark, FIRST), ["k"], ["year"], f"{root}/staging")
    assert rows_of(spark.read.parquet(path)) == FIRST


def test_delete_reads_only_partitions_its_predicate_can_hit(spark, root, monkeypatch):
    path = written(spark, root)
    with open(next(os.path.join(f"{path}/year=2002", f) for f in os.listdir(f"{path}/year=2002") if f.endswith(".parquet")), "wb") as f:
        f.write(b"not parquet")
    for crc in [f for f in os.listdir(f"{path}/year=2002") if f.endswith(".crc")]:
        os.remove(f"{path}/year=2002/{crc}")
    # schema inference may look at any file, so it is given
    monkeypatch.setattr(sinks, "read_if_present", lambda s, p: s.read.schema("k int, v string, year int").parquet(p))
    sinks.delete_rows(spark, path, (F.col("year") == 2001) & (F.col("k") == 2), ["year"], f"{root}/staging")
    assert rows_of(spark.read.parquet(f"{path}/year=2001")) == [(3, "c")]


def test_delete_from_a_table_without_partitions(spark, root):
    path = f"{root}/t"
    sinks.upsert_table(spark, path, make(spark, FIRST), ["k"], [], f"{root}/staging")
    sinks.delete_rows(spark, path, F.col("k") < 3, [], f"{root}/staging")
    assert rows_of(spark.read.parquet(path)) == FIRST[2:]
    sinks.delete_rows(spark, path, F.lit(True), [], f"{root}/staging")
    assert rows_of(spark.read.parquet(path)) == []
    sinks.delete_rows(spark, f"{root}/absent", F.lit(True), [], f"{root}/staging")


def test_store_delete_between_days(spark, root):
    store = EquityStore(spark, f"{root}/db", staging_root=f"{root}/staging")
    rows = spark.sql("SELECT id + 1 AS num_key, DATE '2020-12-28' + CAST(id AS int) AS base_dt, 's' AS sym_cd FROM range(10)")
    store.upsert("stock_daily", rows)
    store.delete("stock_daily", F.col("num_key") > 2, start="2020-12-29", end="2021-01-02")
    assert sorted(r.num_key for r in store.table("stock_daily").collect()) == [1, 2, 7, 8, 9, 10]


NEW = [(2, "B", 2001), (5, "e", 2003)]
AFTER = [(1, "a", 2000), (2, "B", 2001), (3, "c", 2001), (4, "d", 2002), (5, "e", 2003)]


def snapshot(root):
    return sorted((d, n, os.stat(os.path.join(d, n)).st_mtime_ns) for d, _, ns in os.walk(root) for n in ns)


def test_a_reader_between_marker_and_overwrite_sees_the_new_rows_and_writes_nothing(spark, root, monkeypatch):
    path = written(spark, root)
    moved, real = [], files.move

    def move(spark, source, target):
        if target.startswith(f"{path}/"):
            if moved:
                raise RuntimeError("driver lost")
            moved.append(target)
        return real(spark, source, target)

    with monkeypatch.context() as m:
        m.setattr(files, "move", move)
        with pytest.raises(RuntimeError, match="driver lost"):
            sinks.upsert_table(spark, path, make(spark, NEW), ["k"], ["year"], f"{root}/staging")
    assert len(moved) == 1 and files.exists(spark, f"{path}._swap")  # one of two folders is in place
    before = snapshot(root)
    reader = EquityStore(spark, root)
    assert rows_of(reader.spark.createDataFrame(sinks.read_table(spark, path).collect())) == AFTER
    assert reader.exists("t") and snapshot(root) == before
    sinks.upsert_table(spark, path, make(spark, NEW[:1]), ["k"], ["year"], f"{root}/staging")  # the next writer finishes it
    assert rows_of(spark.read.parquet(path)) == AFTER
    assert os.listdir(f"{root}/staging") == [] and not [f for f in os.listdir(root) if f.startswith("t.")]


def test_a_driver_lost_between_stage_and_swap_of_a_delete(spark, root, monkeypatch):
    path = written(spark, root)
    with monkeypatch.context() as m:
        m.setattr(sinks, "finish_swap", lambda s, p: None)  # the marker is written, nothing moves
        sinks.delete_rows(spark, path, (F.col("year") == 2000) | (F.col("k") == 2), ["year"], f"{root}/staging")
    assert os.path.exists(f"{path}/year=2000")
    want = [(3, "c", 2001), (4, "d", 2002)]
    assert rows_of(sinks.read_table(spark, path)) == want
    sinks.finish_swap(spark, path)
    sinks.finish_swap(spark, path)
    assert rows_of(spark.read.parquet(path)) == want and not os.path.exists(f"{path}/year=2000")


def test_a_live_writer_keeps_others_out(spark, root):
    path = written(spark, root)
    other = lease.Lease(spark, path)
    other.acquire()
    with pytest.raises(lease.TableBusy):
        sinks.upsert_table(spark, path, make(spark, NEW), ["k"], ["year"], f"{root}/staging")
    files.write_text(spark, f"{path}._swap", json.dumps({"staging": f"{root}/s", "stage": f"{root}/s/rows", "partition_by": ["year"],
                                                       "moves": [], "drops": ["year=2002"]}), True)
    with pytest.raises(lease.TableBusy):  # nor may a recovery finish its swap
        sinks.finish_swap(spark, path)
    assert rows_of(sinks.read_table(spark, path)) == FIRST[:3]
    other.release()
    sinks.finish_swap(spark, path)
    assert rows_of(spark.read.parquet(path)) == FIRST[:3]


def test_a_lost_writers_lease_runs_out_and_it_may_not_go_on(spark, root):
    path = written(spark, root)
    lost = lease.Lease(spark, path, seconds=0.2)
    lost._renew = lambda: None  # its driver is cut off
    lost.acquire()
    time.sleep(0.4)
    sinks.upsert_table(spark, path, make(spark, NEW), ["k"], ["year"], f"{root}/staging")
    assert rows_of(spark.read.parquet(path)) == AFTER
    with pytest.raises(lease.LeaseLost):
        lost.check()
    lost.release()


def test_a_lease_is_renewed_while_its_writer_lives(spark, root):
    mine = lease.Lease(spark, f"{root}/t", seconds=0.8)
    mine.acquire()
    time.sleep(2)
    mine.check()
    with pytest.raises(lease.TableBusy):
        lease.Lease(spark, f"{root}/t").acquire()
    mine.release()
    assert not os.path.exists(lease.lease_file(f"{root}/t"))
    shutil.rmtree(root)


# ---- D13 by change set ------------------------------------------------------

def statements(rnd, symbols, quarters):
    return [(s, q, *(None if rnd.random() < 0.25 else float(rnd.randrange(1, 99)) for _ in range(2)),
             None if rnd.random() < 0.2 else 1.0) for s in symbols for q in quarters if rnd.random() < 0.85]


@pytest.mark.parametrize("seed", range(3))
def test_reached_keys_give_what_the_whole_table_gives(spark, seed):
    import random

    from equiframe.plans import statements as st

    rnd = random.Random(seed)
    quarters = [f"{y} Q{q}" for y in range(2018, 2023) for q in (1, 2, 3, 4) if rnd.random() < 0.9]
    old = {(r[0], r[1]): r for r in statements(rnd, "abcdefg", quarters[:-2])}
    landed = statements(rnd, "bfz", rnd.sample(quarters, 3)) + statements(rnd, "c", quarters[-2:])
    now = {**old, **{(r[0], r[1]): r for r in landed}}

    def frames(rows):
        df = spark.createDataFrame(list(rows.values()), "sym_cd string, fs_q string, sales double, earn double, net_asset double")
        return df.filter("net_asset IS NOT NULL").select("sym_cd", "fs_q", "net_asset"), df.select("sym_cd", "fs_q", "sales", "earn")

    (bs0, pl0), (bs1, pl1) = frames(old), frames(now)
    whole = lambda bs, pl: {(r.sym_cd, r.fs_q): r for r in st.trailing_pl(st.complete_grid(bs, "sym_cd", "fs_q", pl)).collect()}
    keys = spark.createDataFrame([r[:2] for r in landed], "sym_cd string, fs_q string").distinct()
    new = bs1.select("fs_q").distinct().join(bs0.select("fs_q").distinct(), "fs_q", "left_anti")
    reached = st.reached_keys(bs1, keys, new)
    got = {(r.sym_cd, r.fs_q): r for r in st.trailing_pl_reached(bs1, pl1, reached).collect()}
    before, after = whole(bs0, pl0), whole(bs1, pl1)
    at = {tuple(r) for r in reached.collect()}
    assert {k: r for k, r in after.items() if k in at} == got
    assert all(k in at for k in before.keys() | after.keys() if before.get(k) != after.get(k))
    if not new.count():
        assert {s for s, _ in at} <= {"b", "c", "f", "z"}


def test_a_correction_recomputes_its_symbol_alone(spark, root, monkeypatch):
    from equiframe.plans import statements as st

    store = EquityStore(spark, f"{root}/db", staging_root=f"{root}/staging")
    symbols, quarters = [f"s{i:03d}" for i in range(40)], [f"{y} Q{q}" for y in (2020, 2021, 2022) for q in (1, 2, 3, 4)]
    store.upsert("company_fs_bs", spark.createDataFrame([(s, q, 1.0) for s in symbols for q in quarters], "sym_cd string, fs_q string, net_asset double"))
    store.upsert("company_fs_pl", spark.createDataFrame([(s, q, 5.0 * int(q[-1])) for s in symbols for q in quarters], "sym_cd string, fs_q string, sales double"))
    bs, pl = store.table("company_fs_bs"), store.table("company_fs_pl")
    nothing = bs.select("fs_q").limit(0)
    reached = st.reached_keys(bs, spark.createDataFrame([("s007", "2021 Q2")], "sym_cd string, fs_q string"), nothing)
    assert sorted(map(tuple, reached.collect())) == [("s007", q) for q in ("2021 Q2", "2021 Q3", "2021 Q4", "2022 Q1", "2022 Q2")]
    out = st.trailing_pl_reached(bs, pl, reached)
    assert len(out.collect()) == 5
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "sym_cd" in plan.split("PushedFilters: [", 1)[1].split("]", 1)[0] or "DataFilters" in plan


# ---- marks from footers -------------------------------------------------------

def test_marks_read_no_data_column(spark, root):
    import datetime as dt

    from equiframe.sources import marks

    store = EquityStore(spark, f"{root}/db", staging_root=f"{root}/staging")
    assert store.marks("stock_daily", ["num_key"]) == {"num_key": None, "rows": 0}
    store.upsert("stock_daily", spark.sql("SELECT id AS num_key, DATE '2019-06-01' + CAST(id AS int) AS base_dt, 's' AS sym_cd FROM range(700)"))
    assert store.marks("stock_daily", ["num_key", "base_dt"]) == {"num_key": 699, "base_dt": dt.date(2021, 4, 30), "rows": 700}
    plan = marks.marks_frame(spark, store.path("stock_daily"), ["num_key", "base_dt"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(num_key), MAX(base_dt), COUNT(*)]" in plan
    assert marks.stored_marks(spark, store.path("stock_daily"), ["num_key"], least=True)["num_key"] == 0
    store.delete("stock_daily", F.col("num_key") >= 500)
    assert store.marks("stock_daily", ["num_key"]) == {"num_key": 499, "rows": 500}


def test_the_plan_of_a_store(spark, root):
    import datetime as dt

    from equiframe.plans import calendar as cal

    store = EquityStore(spark, f"{root}/db", staging_root=f"{root}/staging")
    years = spark.createDataFrame([(2021,), (2022,)], "year int")
    store.refresh_workdays(years, cal.fixed_holidays(years))
    as_of = dt.datetime(2022, 3, 10, 12)
    everything = store.update_plan(as_of)
    assert everything["days"].count() == store.table("workdays").filter("base_dt <= '2022-03-09'").count()
    store.upsert("stock_daily", spark.sql("SELECT 1L AS num_key, DATE '2022-03-04' AS base_dt, 's' AS sym_cd"))
    store.upsert("company_fs_bs", spark.sql("SELECT 's' AS sym_cd, '2021 Q3' AS fs_q, 1.0D AS net_asset"))
    store.upsert("stock_info", spark.sql("SELECT 's' AS sym_cd, DATE '2022-03-04' AS info_update UNION ALL SELECT 'n', DATE '2022-03-04'"))
    plan = store.update_plan(as_of, snapshot=spark.sql("SELECT 's' AS sym_cd"))
    assert sorted(str(r[0]) for r in plan["days"].collect()) == ["2022-03-07", "2022-03-08", "2022-03-09"]
    assert [r[0] for r in plan["years"].collect()] == [2022] and [r[0] for r in plan["quarters"].collect()] == ["2021 Q3"]
    assert [r[0] for r in plan["new_symbols"].collect()] == ["n"]
