"""Symbol lookup, raw OHLC, corporate-action adjusted prices.

Scale: the latest-name lookup is a ``max_by`` aggregate (partial, map-side);
the looked-up codes reach the price table as a semi join; the adjustment is
the blocked ``suffix_product`` (no symbol history in one task).  The date
range is applied before the adjustment, as the adjusted prices are anchored
at its last day.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equiframe.functions.numeric import round_half_even, safe_div
from equiframe.operators.filters import DateLike, between_dates, in_set, lookback_window
from equiframe.operators.windows import latest_per_key, suffix_product


def symbol_lookup(info: DataFrame, names: Iterable[str] | DataFrame) -> DataFrame:
    """Codes whose *latest* name is one of ``names`` (an old name does
    not match).  Latest row per symbol is a ``max_by`` aggregate."""
    latest = latest_per_key(info.select("sym_cd", "info_update", "sym_nm"), ["sym_cd"], "info_update")
    return in_set(latest, "sym_nm", names).select("sym_cd")


def ohlc(info: DataFrame, daily: DataFrame, names: Iterable[str] | DataFrame) -> DataFrame:
    """Raw open..base_p of the looked-up symbols, sorted."""
    codes = symbol_lookup(info, names)
    px = daily.select("sym_cd", "base_dt", "open", "high", "low", "close", "base_p")
    return px.join(codes, on="sym_cd", how="left_semi").orderBy("sym_cd", "base_dt")


def adjust_prices(px: DataFrame, close_only: bool = False, block_days: int | None = None,
                  materialize: bool = False) -> DataFrame:
    """Back-adjust prices for corporate actions.

    Per symbol by date, ``close_adj_i = last close x product over later days
    j of base_p_j / close_j`` (1 on the last day; NULL when any later ratio
    is NULL).  ``close_only`` returns the unrounded adjusted close; otherwise
    open/high/low/close are ``x / close x close_adj`` rounded half-to-even.
    Prices are anchored at the last date of ``px``: filter dates first.
    """
    ratio = px.withColumn("_r", safe_div(F.col("base_p"), F.col("close")))
    kw = {"block_days": block_days} if block_days else {}
    adj = suffix_product(ratio, "_r", ["sym_cd"], "base_dt", "_f", {"_last": "close"},
                         materialize=materialize, **kw)
    adj = adj.withColumn("close_adj", F.col("_last") * F.col("_f"))
    if close_only:
        return adj.select("sym_cd", "base_dt", F.col("close_adj").alias("close"))
    scaled = {c: round_half_even(safe_div(F.col(c), F.col("close")) * F.col("close_adj"))
              for c in ("open", "high", "low", "close")}
    return adj.select("sym_cd", "base_dt", *[scaled[c].alias(c) for c in ("open", "high", "low", "close")])


VIEW_KINDS = ("table", "line", "candle")


def price_view(info: DataFrame, daily: DataFrame, names, start: DateLike, end: DateLike,
               kind: str = "table") -> DataFrame:
    """Adjusted prices of named stocks over ``[start, end]``.

    ``line`` gives the adjusted close; ``table`` and ``candle`` give
    adjusted open, high, low, close (correctly labelled).
    """
    if kind not in VIEW_KINDS:
        raise ValueError(f"kind must be one of {VIEW_KINDS}")
    px = between_dates(ohlc(info, daily, names), start, end)
    # the looked-up, filtered prices are stored once rather than recomputed
    # by both branches of the adjustment
    out = adjust_prices(px, close_only=(kind == "line"), materialize=True)
    return out.orderBy("sym_cd", "base_dt")


def recent_prices(daily: DataFrame, span: str) -> DataFrame:
    """F9 on the price table: each symbol's rows in the look-back window
    ending at its last date."""
    return lookback_window(daily, span, ["sym_cd"], "base_dt")
