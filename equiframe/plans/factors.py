"""Value factors, momentum, factor table updates and reads.

The reference computes value factors one working day at a time and
momentum one symbol at a time; here each is one job over the whole range.

Scale: value factors shuffle the panel once (the consensus join on num_key;
calendar and statements are bounded broadcasts); momentum shuffles it once
on (sym_cd, block); the factor table is an upsert on num_key touching only
the supplied columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equiframe.functions.numeric import first_non_null, safe_div
from equiframe.operators.columns import first_columns, select_range
from equiframe.operators.filters import DateLike, sym_dt_pick
from equiframe.operators.joins import bounded_broadcast, broadcast_if_small
from equiframe.operators.windows import market_calendar, rolling
from equiframe.plans.statements import filled_balance_sheet
from equiframe.schemas import VALUE_FACTORS
from equiframe.sources.sinks import upsert_partial

# Momentum look-backs in trading days (3, 6 and 12 months).
MOMENTUM_WINDOWS = {"ret_3m": 60, "ret_6m": 120, "ret_12m": 252}




def value_factors(daily: DataFrame, cons: DataFrame, workdays: DataFrame, bs: DataFrame,
                  pl_prep: DataFrame, syms=None, start: DateLike = None,
                  end: DateLike = None) -> DataFrame:
    """Value factors per num_key.

    stock_daily (num_key..sym_cd, mkt_cap..num_stock_t) left-join consensus
    on num_key; each day's published quarter from the calendar (the
    point-in-time bridge: a statement is used only once published); the
    filled balance sheet's net assets and the trailing P&L on (sym_cd,
    fs_q).  Ratios are items over share-adjusted market cap
    ``mkt_cap / num_stock_o * num_stock_t``; a zero or NULL denominator
    gives NULL.  The symbol/date filter reaches the stock_daily scan.

    Join order and sides: the calendar (one row per trading day) is
    broadcast; the statement sides (symbols x quarters, independent of the
    daily volume) are materialised once and broadcast when under a byte
    bound (checked), else joined by shuffle; consensus joins last, on
    num_key, so the result comes out partitioned by num_key for the
    factor-table upsert.
    """
    d = sym_dt_pick(select_range(daily, ("num_key", "sym_cd"), ("mkt_cap", "num_stock_t")),
                    syms, start, end)
    c = select_range(cons, ("num_key", "bps_12mf"))
    fbs = filled_balance_sheet(bs).select("sym_cd", "fs_q", "net_asset")
    prep = select_range(pl_prep, ("sym_cd", "cash_flow_a4q"))
    # one statement side keyed (sym_cd, fs_q): materialised once, size-checked
    stmts = broadcast_if_small(fbs.join(prep, on=["sym_cd", "fs_q"], how="full_outer"))
    j = (d.join(bounded_broadcast(workdays.select("base_dt", "fs_q")), on="base_dt", how="left")
          .join(stmts, on=["sym_cd", "fs_q"], how="left")
          .join(c, on="num_key", how="left")
          .withColumn("earn_12mf", first_non_null("earn_dom_12mf", "earn_12mf")))
    per_share = safe_div(F.col("mkt_cap"), F.col("num_stock_o"))
    adj = per_share * F.col("num_stock_t")
    ratios = {
        "inv_per": safe_div(F.col("earn_a4q"), adj),
        "inv_por": safe_div(F.col("opr_prof_a4q"), adj),
        "inv_psr": safe_div(F.col("sales_a4q"), adj),
        "inv_pocr": safe_div(F.col("op_cash_flow_a4q"), adj),
        "inv_pcr": safe_div(F.col("cash_flow_a4q"), adj),
        "inv_pbr": safe_div(F.col("net_asset"), adj),
        "inv_per_12mf": safe_div(F.col("earn_12mf"), adj),
        "inv_por_12mf": safe_div(F.col("opr_prof_12mf"), adj),
        "inv_psr_12mf": safe_div(F.col("sales_12mf"), adj),
        "inv_pbr_12mf": safe_div(F.col("bps_12mf"), per_share),
    }
    return j.select("num_key", *[ratios[k].alias(k) for k in VALUE_FACTORS])


def momentum(daily: DataFrame, windows: dict[str, int] | None = None, syms=None,
             block: int | None = None, start: DateLike = None, end: DateLike = None) -> DataFrame:
    """Trailing gross returns over the market calendar.

    ``gret = close / base_p`` (base price = previous close adjusted for
    corporate actions); ``ret = product of the last n trading days' gret -
    1``, NULL unless the symbol traded with a value on all n days of the
    market calendar (the distinct base_dt of stock_daily).  One row per
    stock_daily row of the (optional) symbol set.

    With ``start``/``end`` only those rows are returned, and only the rows
    from ``longest window - 1`` trading days before ``start`` are read into
    the windows (the bound is found on the calendar by scalar subqueries),
    so a refresh does not re-window the whole history.

    The calendar (one row per trading day) is broadcast; the panel is
    shuffled once, on (sym_cd, block) -- see ``rolling``.
    """
    windows = windows or MOMENTUM_WINDOWS
    cal = market_calendar(daily, "base_dt", "t")
    panel = sym_dt_pick(daily, syms, end=end)
    if start is not None:
        first_t = cal.filter(F.col("base_dt") >= F.lit(start).cast("date")).agg(F.min("t")).scalar()
        lower = cal.filter(F.col("t") >= first_t - (max(windows.values()) - 1)).agg(F.min("base_dt")).scalar()
        panel = panel.filter(F.col("base_dt") >= lower)
    panel = panel.select("num_key", "sym_cd", "base_dt",
                         safe_div(F.col("close"), F.col("base_p")).alias("gret"))
    panel = panel.join(bounded_broadcast(cal), on="base_dt", how="inner")
    kw = {"block": block} if block else {}
    rolled = rolling(panel, "gret", windows, ["sym_cd"], "t", agg="product", **kw)
    if start is not None:
        rolled = rolled.filter(F.col("base_dt") >= F.lit(start).cast("date"))
    return rolled.select("num_key", *[(F.col(k) - 1).alias(k) for k in windows])


def update_factors(value: DataFrame, mom: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """D16 + D17 writes: the factor table after upserting the value factors
    and then the momentum columns, each on num_key, each touching only its
    own columns."""
    mom_cols = [c for c in mom.columns if c != "num_key"]
    if existing is None:
        # upserting into an empty table is an insert
        step1 = value.select("num_key", *VALUE_FACTORS, *[F.lit(None).cast("double").alias(c) for c in mom_cols])
    else:
        step1 = upsert_partial(existing, value, ["num_key"])
    return upsert_partial(step1, mom, ["num_key"])


def factor_panel(daily: DataFrame, factors: DataFrame, syms=None, start: DateLike = None,
                 end: DateLike = None) -> DataFrame:
    """(num_key, base_dt, sym_cd) of stock_daily, filtered, with the
    factor columns."""
    keys = sym_dt_pick(first_columns(daily, 3), syms, start, end)
    return keys.join(factors, on="num_key", how="left")


def factor_coverage(panel: DataFrame, col: str, out: str = "count") -> DataFrame:
    """Per symbol, the number of rows with a non-NULL ``col``."""
    return panel.groupBy("sym_cd").agg(F.count(F.col(col)).alias(out))
