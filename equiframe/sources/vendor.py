"""Vendor exports -> typed tables, driven by the item metadata.

The vendor's spreadsheet export is landed as text files (one column per
item).  Which items belong to which table, which are numeric, which are
balance-sheet or P&L items, and which are "new" is metadata (the
``fn_tables`` table).  Metadata is a few hundred rows; its item lists are
read on the driver once and drive plain ``select`` lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equiframe.functions.dates import parse_yyyymmdd
from equiframe.functions.text import parse_number, quarter_label, strip_prefix
from equiframe.operators.columns import require_columns
from equiframe.schemas import FN_TABLES

META_SCHEMA = FN_TABLES

# Item metadata for the statement and daily exports used by the fixtures:
# (table, item, numeric, new, bs, pl).
DEFAULT_ITEMS = [
    ("fs", "sales", 1, 0, 0, 1),
    ("fs", "opr_prof", 1, 0, 0, 1),
    ("fs", "earn", 1, 0, 0, 1),
    ("fs", "earn_dom", 1, 1, 0, 1),
    ("fs", "grs_asset", 1, 0, 1, 0),
    ("fs", "net_asset", 1, 0, 1, 0),
    ("fs", "op_cash_flow", 1, 0, 0, 1),
    ("fs", "cash_flow", 1, 1, 0, 1),
    ("fs", "memo", 0, 0, 0, 0),
    ("daily", "sym_mng", 0, 0, 0, 0),
    ("daily", "sym_stop", 0, 0, 0, 0),
    ("daily", "sym_reg", 0, 1, 0, 0),
    ("daily", "net_buy_fi", 1, 0, 0, 0),
    ("daily", "mkt_cap", 1, 0, 0, 0),
    ("daily", "bps_12mf", 1, 0, 0, 0),
    ("daily", "eps_down_fy2", 1, 1, 0, 0),
]


def item_metadata(spark: SparkSession, items: list[tuple] | None = None) -> DataFrame:
    rows = [(t, i, "kind", f"C{n:03d}", i.upper(), "Q" if t == "fs" else "D", num, new, bs, pl)
            for n, (t, i, num, new, bs, pl) in enumerate(items or DEFAULT_ITEMS)]
    return spark.createDataFrame(rows, META_SCHEMA)


def item_rows(meta: DataFrame, table: str) -> list:
    """The metadata rows of ``table`` in metadata order.

    Metadata is small by nature (one row per vendor item); it is the only
    thing the library collects to the driver, once per call.
    """
    return meta.filter(F.col("table") == table).collect()


def item_list(meta: DataFrame | list, table: str, flag: str | None = None, new_only: bool = False) -> list[str]:
    """Items of ``table`` (optionally with a flag set), in metadata order;
    ``meta`` is the metadata frame or rows already taken by ``item_rows``."""
    rows = meta if isinstance(meta, list) else item_rows(meta, table)
    return [r["item"] for r in rows
            if r["table"] == table and (not new_only or r["new"]) and (not flag or r[flag])]


def _period(period: str | Column, parse) -> Column:
    if isinstance(period, Column):
        return period
    return parse(F.lit(period))


def cross_section(raw: DataFrame, meta: DataFrame, kind: str, period: str | Column,
                  new_only: bool = False) -> DataFrame:
    """One cross-section export -> typed rows.

    ``kind`` is ``"fs"`` (statements; ``period`` is the quarter
    ``"YYYY Qn"``) or ``"daily"`` (``period`` is the day, ``YYYYMMDD`` text or
    a date column).  All values are taken as text, numeric items are parsed
    with ``parse_number`` (NA tokens -> NULL) and the one-character vendor
    prefix is dropped from ``sym_cd``.  Every item of the metadata (with
    ``new_only`` every new one) must be in the export.
    """
    rows = item_rows(meta, kind)
    items = require_columns(raw, item_list(rows, kind, new_only=new_only), f"{kind} export")
    numeric = set(item_list(rows, kind, "numeric", new_only=new_only))
    if kind == "fs":
        head = [_period(period, lambda c: c).alias("fs_q")]
        lead = ["sym_cd", "fs_q"]
    else:
        head = [_period(period, parse_yyyymmdd).alias("base_dt")]
        lead = ["base_dt", "sym_cd"]
    body = [(parse_number(F.col(i)) if i in numeric else F.col(i).cast("string")).alias(i) for i in items]
    out = raw.select(strip_prefix(F.col("sym_cd").cast("string")).alias("sym_cd"), *head, *body)
    return out.select(*lead, *items)


def fiscal_basis(raw: DataFrame, meta: DataFrame, new_only: bool = False) -> DataFrame:
    """Fiscal-basis export -> typed rows keyed (sym_cd, fs_q).

    ``fs_q = year + ' ' + quarter label`` (1st-Quarter -> Q1, Semi-Annual or
    Semi-Quarter -> Q2, 3rd-Quarter -> Q3, Annual -> Q4); month, year and
    quarter columns are dropped.  Every item of the metadata must be there.
    """
    rows = item_rows(meta, "fs")
    items = require_columns(raw, item_list(rows, "fs", new_only=new_only), "fiscal-basis export")
    numeric = set(item_list(rows, "fs", "numeric", new_only=new_only))
    fs_q = F.concat_ws(" ", F.col("year").cast("string"), quarter_label(F.col("quarter").cast("string")))
    body = [(parse_number(F.col(i)) if i in numeric else F.col(i).cast("string")).alias(i) for i in items]
    return raw.select(strip_prefix(F.col("sym_cd").cast("string")).alias("sym_cd"),
                      fs_q.alias("fs_q"), *body)
