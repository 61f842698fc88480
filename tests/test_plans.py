"""Plan-shape guards for the scale properties (over stored parquet inputs)."""

import contextlib
import io
import re
import tempfile

import pytest

from equiframe import fixtures as fx
from equiframe.operators.filters import lookback_window
from equiframe.operators.joins import expand_grid
from equiframe.plans.factors import momentum, value_factors
from equiframe.plans.statements import complete_grid, trailing_pl

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def stored(spark):
    root = tempfile.mkdtemp(prefix="equiframe-plans-", dir="/tmp")
    for n in ("fx_daily", "fx_cons", "fx_workdays", "fx_bs", "fx_pl"):
        fx.load(spark, SF, n).write.parquet(f"{root}/{n}")
    return lambda n: spark.read.parquet(f"{root}/{n}")


def test_momentum_one_panel_shuffle_and_broadcast_calendar(stored):
    p = plan(momentum(stored("fx_daily")))
    panel_exchanges = re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", p)
    assert any("sym_cd" in e and "_blk" in e for e in panel_exchanges)
    assert not any(e.startswith("sym_cd") and "_blk" not in e for e in panel_exchanges)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_value_factor_date_filter_reaches_the_scan(spark, stored):
    bs, pl = stored("fx_bs"), stored("fx_pl")
    prep = trailing_pl(complete_grid(bs, "sym_cd", "fs_q", pl.drop("dpr", "prop_div")))
    vf = value_factors(stored("fx_daily"), stored("fx_cons"), stored("fx_workdays"), bs, prep,
                       start="1996-01-01", end="1996-12-31")
    pushed = re.findall(r"PushedFilters: \[(.*)\]", plan(vf))
    assert any("GreaterThanOrEqual(base_dt" in f and "LessThanOrEqual(base_dt" in f for f in pushed)


def test_grid_and_lookback_have_no_nested_loop_or_cartesian(stored):
    for df in (expand_grid(stored("fx_bs"), "sym_cd", "fs_q"),
               lookback_window(stored("fx_daily"), "1y", keys=[]),
               lookback_window(stored("fx_daily"), "6m")):
        p = plan(df)
        assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_scan_prunes_columns(stored):
    p = plan(momentum(stored("fx_daily")))
    schemas = re.findall(r"ReadSchema: struct<(.*)>", p)
    assert schemas and all("trd_val" not in s and "mkt_cap" not in s for s in schemas)


def test_trailing_pl_three_windows_share_one_sort(stored):
    grid = complete_grid(stored("fx_bs"), "sym_cd", "fs_q", stored("fx_pl").drop("dpr", "prop_div"))
    lines = plan(trailing_pl(grid)).split("\n\n")[0].splitlines()
    windows = [i for i, line in enumerate(lines) if "Window (" in line]
    assert len(windows) == 3
    between = lines[windows[0]:windows[-1] + 1]
    assert not any("Sort (" in line or "Exchange (" in line for line in between)
    assert "Sort (" in lines[windows[-1] + 1]


def test_a_broadcast_is_bounded_in_bytes(spark):
    from pyspark.sql import functions as F

    from equiframe.operators.joins import broadcast_if_small
    wide = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("text"))

    def hinted(df):
        return "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(broadcast_if_small(wide))
    assert not hinted(broadcast_if_small(wide, max_bytes=10_000))
    assert hinted(broadcast_if_small(wide.limit(0), max_bytes=0))
