"""Row filters (F1, F2, F5, F7-F10).  All are plain ``filter`` predicates so
Catalyst pushes them into the parquet scan where the columns allow.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equiframe.functions.text import SPAC_WORD

DateLike = str | _dt.date | None

# Above this many literals an IN list becomes a semi join (the list is then
# a DataFrame, shuffled or broadcast by the planner like any other side).
MAX_IN_LIST = 1000


def _lit_date(d: DateLike) -> Column:
    return F.lit(d).cast("date") if isinstance(d, str) else F.lit(d)


def in_set(df: DataFrame, col: str, values: Iterable | DataFrame, value_col: str | None = None) -> DataFrame:
    """keep rows whose ``col`` is in ``values``.

    ``values`` may be a Python collection (short lists become ``isin``) or a
    one-column DataFrame (a left-semi join, for lists of any length).
    """
    if isinstance(values, DataFrame):
        vc = value_col or values.columns[0]
        keys = values.select(F.col(vc).alias(col)).distinct()
        return df.join(keys, on=col, how="left_semi")
    vals = list(values)
    if len(vals) > MAX_IN_LIST:
        spark = df.sparkSession
        return in_set(df, col, spark.createDataFrame([(v,) for v in vals], [col]))
    return df.filter(F.col(col).isin(vals))


def sym_dt_pick(df: DataFrame, syms: Iterable | DataFrame | None = None, start: DateLike = None,
                end: DateLike = None, sym_col: str = "sym_cd", date_col: str = "base_dt") -> DataFrame:
    """optional symbol-set and inclusive date-range filter.

    Each part applies only when given; with no part the frame is unchanged.
    """
    out = df
    if syms is not None:
        out = in_set(out, sym_col, syms)
    if start is not None:
        out = out.filter(F.col(date_col) >= _lit_date(start))
    if end is not None:
        out = out.filter(F.col(date_col) <= _lit_date(end))
    return out


def between_dates(df: DataFrame, start: DateLike, end: DateLike, date_col: str = "base_dt") -> DataFrame:
    """inclusive time range."""
    return df.filter(F.col(date_col).between(_lit_date(start), _lit_date(end)))


def quarter_between(df: DataFrame, first: str | Column | None, last: str | Column | None,
                    col: str = "fs_q") -> DataFrame:
    """F8: ``"YYYY Qn"`` range by text comparison (lexical = time order)."""
    out = df
    if first is not None:
        out = out.filter(F.col(col) >= (F.lit(first) if isinstance(first, str) else first))
    if last is not None:
        out = out.filter(F.col(col) <= (F.lit(last) if isinstance(last, str) else last))
    return out


def listed_common_shares(df: DataFrame) -> DataFrame:
    """the listed common-share universe.

    Market is not KONEX, the code ends in 0 (common share), does not start
    with 9 (foreign issuer), the name is not a SPAC, a base price exists.
    """
    return df.filter(
        (F.col("mkt_cd") != F.lit("KNX"))
        & F.col("sym_cd").endswith("0")
        & ~F.col("sym_cd").startswith("9")
        & ~F.col("sym_nm").contains(SPAC_WORD)
        & F.col("base_p").isNotNull())


LOOKBACKS = ("1m", "6m", "1y", "3y", "5y", "10y", "mtd", "ytd", "all")


def lookback_start(last: Column, span: str) -> Column:
    """Start date of a look-back window ending at ``last``."""
    months = {"1m": 1, "6m": 6, "1y": 12, "3y": 36, "5y": 60, "10y": 120}
    if span in months:
        return F.add_months(last, -months[span])
    if span == "mtd":
        return F.trunc(last, "month")
    if span == "ytd":
        return F.trunc(last, "year")
    if span == "all":
        return F.lit(None).cast("date")
    raise ValueError(f"unknown look-back {span!r}; one of {LOOKBACKS}")


def lookback_window(df: DataFrame, span: str, keys: list[str] | None = None,
                    date_col: str = "base_dt") -> DataFrame:
    """rows inside a look-back window relative to the last date shown.

    The last date is taken per ``keys`` group (per symbol by default) with a
    grouped ``max`` joined back -- a partial aggregate, so a hot symbol never
    lands in one task whole.  Bounds are inclusive; ``all`` keeps every row.
    """
    keys = keys if keys is not None else ["sym_cd"]
    if span == "all":
        return df
    if not keys:
        last_all = df.agg(F.max(date_col)).scalar()
        return df.filter(F.col(date_col) >= lookback_start(last_all, span))
    last = df.groupBy(*keys).agg(F.max(date_col).alias("_last"))
    joined = df.join(last, on=keys, how="inner")
    return joined.filter(F.col(date_col) >= lookback_start(F.col("_last"), span)).drop("_last")


def on_date(df: DataFrame, day: DateLike, col: str = "info_update") -> DataFrame:
    """rows stamped with one day."""
    return df.filter(F.col(col) == _lit_date(day))
