"""The reference's refresh actions over stored tables.

``EquityStore`` keeps each table as a Parquet directory under one root
(dated tables partitioned by ``year``) and offers the app's actions, each
one Spark job over all pending days / quarters instead of a loop:

* ``refresh_workdays`` -- business calendar for some years (S5: the years'
  partitions are replaced),
* ``refresh_index_list`` -- index list upsert on idx_code,
* ``load_daily`` -- the six daily tables from landed frames holding any
  number of days, upserted in the reference's order with its keys,
* ``load_statements`` / ``load_new_symbol_statements`` -- statement tables
  and the trailing P&L for the quarters to update,
* ``refresh_factors`` -- value factors over a date range and momentum,
  upserted into ``factor_daily`` column-wise.

Dated reads add a ``year`` predicate so Spark prunes partitions.  An action
never keeps a lazy read of a table it rewrites: what it needs from that
table is materialised first (keys are checkpointed, small sets too).
"""

from __future__ import annotations

import datetime as _dt
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equiframe.operators.filters import DateLike
from equiframe.operators.keys import one_per_key
from equiframe.plans import calendar as cal
from equiframe.plans import factors as fac
from equiframe.plans import ingest as ing
from equiframe.plans import statements as st
from equiframe import schemas
from equiframe.sources import files
from equiframe.sources.bucketed import layout, read_copy, write_copy
from equiframe.sources.marks import stored_marks
from equiframe.sources.sinks import delete_rows, read_table, replace_partitions, upsert_table
from equiframe.session import checkpoint_dir
from equiframe.sources.tables import TableStore

# table -> (upsert keys, partition columns)
# Dated tables are partitioned by ``year``: of base_dt, of info_update, or --
# for tables keyed by num_key -- of the trading day the key stands for, so an
# upsert rewrites only the years it touches.  Statement tables and the index
# list are small (symbols x quarters) and kept whole.
TABLES: dict[str, tuple[list[str], list[str]]] = {
    "workdays": (["base_dt"], ["year"]),
    "index_list": (["idx_code"], []),
    "stock_info": (["sym_cd", "info_update"], ["year"]),
    "stock_daily": (["base_dt", "sym_cd"], ["year"]),
    "stock_cons": (["num_key"], ["year"]),
    "stock_managed": (["num_key", "type"], ["year"]),
    "stocks_in_index": (["num_key", "idx_code"], ["year"]),
    "index_daily": (["base_dt", "idx_code"], ["year"]),
    "company_fs_bs": (["sym_cd", "fs_q"], []),
    "company_fs_pl": (["sym_cd", "fs_q"], []),
    "company_fs_pl_prep": (["sym_cd", "fs_q"], []),
    "factor_daily": (["num_key"], ["year"]),
}
# tables joined on num_key, and the bytes a bucket of their co-located copies holds
BY_KEY = ["stock_daily", "stock_cons", "factor_daily"]
BUCKET_BYTES = 256 << 20
# the action that fills each table (for error messages)
BUILT_BY = {
    "workdays": "refresh_workdays", "index_list": "refresh_index_list", "stock_daily": "load_daily",
    "stock_info": "load_daily", "company_fs_bs": "load_statements", "company_fs_pl": "load_statements",
    "company_fs_pl_prep": "load_statements",
}
# within-partition sort of the stored files (lookup key first)
SORT_WITHIN = {
    "stock_daily": ["sym_cd", "base_dt"],
    "index_daily": ["idx_code", "base_dt"],
    "stock_info": ["sym_cd", "info_update"],
    "company_fs_bs": ["sym_cd", "fs_q"],
    "company_fs_pl": ["sym_cd", "fs_q"],
    "company_fs_pl_prep": ["sym_cd", "fs_q"],
}
# where the partition year comes from when the rows carry no base_dt
YEAR_SOURCE = {"stock_info": "info_update"}


# tables written column-wise by several actions: their full column set
FULL_COLUMNS = {"factor_daily": schemas.FACTOR_DAILY}


def _year(start: DateLike) -> int | None:
    if start is None:
        return None
    return (start if isinstance(start, _dt.date) else _dt.date.fromisoformat(str(start))).year


def _years(df: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """The partitions that days from ``start`` to ``end`` can lie in, without
    the partition column."""
    lo, hi = _year(start), _year(end)
    if lo is not None:
        df = df.filter(F.col("year") >= lo)
    if hi is not None:
        df = df.filter(F.col("year") <= hi)
    return df.drop("year")


class EquityStore(TableStore):
    """Stored equity tables plus the refresh actions."""

    def __init__(self, spark: SparkSession, root: str, staging_root: str | None = None):
        super().__init__(spark, root)
        self.staging_root = staging_root

    # -- reads ---------------------------------------------------------------
    def exists(self, name: str) -> bool:
        return read_table(self.spark, self.path(name)) is not None

    def table(self, name: str, start: DateLike = None, end: DateLike = None) -> DataFrame | None:
        """The stored table (``None`` if never written).  With a date range a
        ``year`` predicate is added so only the touched partitions are read;
        the partition column itself is dropped.  Reading never writes, also
        where a writer was lost in its swap."""
        df = read_table(self.spark, self.path(name))
        if df is None:
            return None
        if "year" in df.columns and "year" in TABLES.get(name, ([], []))[1]:
            df = _years(df, start, end)
        return df

    def require(self, name: str, start: DateLike = None, end: DateLike = None) -> DataFrame:
        """Like ``table`` but a missing table is an error naming the action
        that builds it."""
        df = self.table(name, start, end)
        if df is None:
            raise ValueError(f"table {name!r} has no data yet; build it first ({BUILT_BY.get(name, 'load')})")
        return df

    def _copy(self, name: str) -> str:
        return f"{self.root}/_by_key/{name}{self.suffix}"

    def by_key(self, name: str, start: DateLike = None, end: DateLike = None) -> DataFrame:
        """Like ``require``, from the copy bucketed by num_key if ``co_locate``
        made one and the table is unchanged since: joins of such copies on
        num_key need no exchange.  Else the stored table, with the same rows."""
        df = read_copy(self.spark, self.path(name), self._copy(name))
        return self.require(name, start, end) if df is None else _years(df, start, end)

    def co_locate(self, names: list[str] | None = None, buckets: int | None = None) -> dict[str, list[str]]:
        """Copies of the tables ``names`` (default those of ``BY_KEY`` that are
        stored) bucketed by num_key, all into the same number of buckets: as many as the
        copies have, or as the largest table needs at ``BUCKET_BYTES`` each if
        that is more than four times as many.  Rewrites the years that changed
        since the last call; they are returned by table."""
        names = names if names is not None else [n for n in BY_KEY if self.exists(n)]
        if buckets is None:
            need = max([1, *(-(-files.size(self.spark, self.path(n)) // BUCKET_BYTES) for n in names)])
            need = 1 << (need - 1).bit_length()
            have = max([made["buckets"] for n in BY_KEY if (made := layout(self.spark, self._copy(n)))], default=0)
            buckets = have if have and need <= 4 * have else need
        return {n: write_copy(self.spark, self.path(n), self._copy(n), "num_key", buckets) for n in names}

    def marks(self, name: str, columns: list[str]) -> dict[str, Any]:
        """Largest values of date or number columns and the number of rows,
        from file footers."""
        return stored_marks(self.spark, self.path(name), columns)

    def update_plan(self, as_of: _dt.datetime, snapshot: DataFrame | None = None) -> dict[str, DataFrame]:
        """D2 over the stored tables: the trading days, years and quarters to
        load as of ``as_of`` and -- given the symbols (sym_cd) from before the
        daily load -- the new symbols.  What is loaded already is told by
        footers; the daily table itself is not read."""
        workdays = self.require("workdays")
        last_day = self.marks("stock_daily", ["base_dt"])["base_dt"]
        days = cal.days_after(workdays, last_day, as_of)
        years = self.spark.createDataFrame([(y,) for y in sorted({(last_day or as_of).year, as_of.year})], "year int")
        bs, info = self.table("company_fs_bs"), self.table("stock_info")
        published = workdays.filter(F.col("base_dt") <= days.agg(F.max("base_dt")).scalar())
        if bs is not None:
            published = published.filter(F.col("fs_q") >= F.coalesce(bs.agg(F.max("fs_q")).scalar(), F.lit("")))
        plan = {"days": days, "years": years, "quarters": published.select("fs_q").distinct()}
        if snapshot is not None and info is not None:
            plan["new_symbols"] = cal.new_symbols(info, snapshot)
        return plan

    # -- writes --------------------------------------------------------------
    def upsert(self, name: str, rows: DataFrame, key_days: DataFrame | None = None, unique: bool = False) -> None:
        """Upsert ``rows`` with the table's keys.  Rows keyed by num_key get
        their partition year from ``key_days`` (num_key, base_dt) -- the
        stock_daily rows of the same load -- or, when not given, from the
        stored stock_daily; rows whose key is unknown there are not stored.
        Neither are rows with a NULL in their key: a keyed table has none.
        Rows that share a key and are equal count once, others are an error
        that names the key (``ConflictingRows``); ``unique``: the caller knows
        that no two rows share one."""
        keys, parts = TABLES[name]
        rows = rows.dropna(subset=keys)
        if name in FULL_COLUMNS and not self.exists(name):
            # first write creates the whole table, so later column-wise
            # upserts have their columns to fill
            have = set(rows.columns)
            rows = rows.select(*[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
                                 for f in FULL_COLUMNS[name].fields])
        if "year" in parts:
            if "base_dt" in rows.columns:
                rows = rows.withColumn("year", F.year("base_dt"))
            elif name in YEAR_SOURCE:
                rows = rows.withColumn("year", F.year(YEAR_SOURCE[name]))
            else:
                if key_days is None:  # look the keys' trading days up in the store
                    key_days = self.require("stock_daily").select("num_key", "base_dt")
                years = key_days.select("num_key", F.year("base_dt").alias("year"))
                rows = rows.join(years, on="num_key", how="inner")
        upsert_table(self.spark, self.path(name), rows, keys, partition_by=parts,
                     staging_root=self.staging_root, sort_within=SORT_WITHIN.get(name, keys), unique=unique)

    def delete(self, name: str, predicate: Column, start: DateLike = None, end: DateLike = None) -> None:
        """Remove the rows where ``predicate`` is TRUE -- of ``[start,
        end]``, which for a table partitioned by year bounds the partitions
        that are read at all.  A partition that keeps no row is removed; a
        table that keeps none reads as never written."""
        keys, parts = TABLES[name]
        for bound, col in ((start, F.col("year") >= F.lit(_year(start))), (end, F.col("year") <= F.lit(_year(end)))):
            if bound is not None and "year" in parts:
                predicate = predicate & col
        day = "base_dt" if name not in YEAR_SOURCE else YEAR_SOURCE[name]
        table = read_table(self.spark, self.path(name))
        if table is not None and day in table.columns:
            if start is not None:
                predicate = predicate & (F.col(day) >= F.lit(start).cast("date"))
            if end is not None:
                predicate = predicate & (F.col(day) <= F.lit(end).cast("date"))
        delete_rows(self.spark, self.path(name), predicate, parts, self.staging_root, SORT_WITHIN.get(name, keys))

    # -- actions -------------------------------------------------------------
    def refresh_workdays(self, years: DataFrame, holidays: DataFrame) -> None:
        """D1 + S5: the calendar partitions of ``years`` are rebuilt."""
        days = cal.business_calendar(years, holidays).withColumn("year", F.year("base_dt"))
        replace_partitions(self.spark, self.path("workdays"), days, ["year"], self.staging_root)

    def refresh_index_list(self, raw: DataFrame) -> None:
        """D3: index list upsert on idx_code."""
        self.upsert("index_list", ing.index_list(raw))

    def load_daily(self, prices: DataFrame, base: DataFrame, excluded: DataFrame, sectors: DataFrame,
                   vendor: DataFrame, members: DataFrame, levels: DataFrame, index_base: DataFrame,
                   info_batch: DataFrame | None = None) -> None:
        """D4-D10 for every landed day at once.

        ``prices`` carry a ``base_dt`` column (any number of days); the other
        landed frames are keyed by (base_dt, ...) as well.  A listing that is
        stored already keeps its num_key and takes the landed values, so a
        re-run -- also after a partially applied one -- changes nothing and a
        correction replaces what it corrects.  A listing landed twice counts
        once (``one_per_key``).  Without landed prices the index levels are
        stored all the same.
        """
        idx = self.table("index_list")
        if idx is not None:
            daily_index = ing.index_daily(levels, index_base, idx, ordered=False)
            self.upsert("index_daily", one_per_key(daily_index.dropna(subset=["idx_code"]), ["base_dt", "idx_code"]))
        # the landed span (two scalars) bounds the partitions read back below
        span = prices.agg(F.min("base_dt").alias("a"), F.max("base_dt").alias("b")).first()
        if span["a"] is None:
            return
        checkpoint_dir(self.spark)
        # no global sorts on the way to storage: files are sorted per partition;
        # the universe is used by several tables and computed once
        universe = one_per_key(ing.listed_universe(prices, base, excluded, sectors, F.col("base_dt"), ordered=False),
                               ["base_dt", "sym_cd"]).checkpoint(eager=True)
        vendor = one_per_key(vendor.filter(F.col("base_dt").between(F.lit(span["a"]), F.lit(span["b"]))),
                             ["base_dt", "sym_cd"]).checkpoint(eager=True)  # four tables are made of it
        stored_daily = self.table("stock_daily")

        batch = info_batch if info_batch is not None else universe.join(
            vendor.select("base_dt", "sym_cd", "sec_fn_1", "sec_fn_2", "sec_fn_3"),
            on=["base_dt", "sym_cd"], how="left").select(
            "sym_cd", F.col("base_dt").alias("info_update"), "sym_nm", "mkt_cd", "sec_krx",
            "sec_fn_1", "sec_fn_2", "sec_fn_3")
        stored_info = self.table("stock_info")
        if stored_info is None:
            stored_info = batch.limit(0)
        new_versions = ing.stock_info_merge(stored_info, batch.select(*stored_info.columns))
        self.upsert("stock_info", new_versions)

        info = self.table("stock_info")
        last_key = self.marks("stock_daily", ["num_key"])["num_key"] or 0
        daily = ing.stock_daily(universe, vendor, info, stored_daily, last_key)
        self.upsert("stock_daily", daily)
        daily = self.table("stock_daily", span["a"], span["b"]).filter(
            F.col("base_dt").between(F.lit(span["a"]), F.lit(span["b"])))
        key_days = daily.select("num_key", "base_dt")
        # rows without a stock_daily key (vendor-only) have no place in a
        # num_key-keyed table and drop out in the year lookup
        self.upsert("stock_cons", ing.stock_cons(daily, vendor), key_days)
        self.upsert("stock_managed", ing.stock_managed(daily, vendor), key_days)
        self.upsert("stocks_in_index", ing.stocks_in_index(daily, members, ordered=False), key_days)

    def load_statements(self, normalised: DataFrame, meta: DataFrame, quarters: DataFrame) -> None:
        """D11 + D13 for existing symbols: bs/pl upserts, then the trailing
        P&L of the quarters to update, recomputed for the keys that the landed
        rows reach (``statements.reached_keys``); others stay as stored."""
        checkpoint_dir(self.spark)
        bs, pl = st.split_statements(normalised, meta)
        landed = bs.select(*st.KEYS).unionByName(pl.select(*st.KEYS)).dropna().distinct().checkpoint(eager=True)
        # quarters the grid lacks so far: of a trailing table never built, all
        grid = self.table("company_fs_bs") if self.exists("company_fs_pl_prep") else None
        known = None if grid is None else grid.select("fs_q").distinct().checkpoint(eager=True)
        self.upsert("company_fs_bs", bs)
        self.upsert("company_fs_pl", pl)
        bs, pl = self.table("company_fs_bs"), self.table("company_fs_pl")
        if bs is None or pl is None:
            return
        new = bs.select("fs_q").distinct() if known is None else bs.select("fs_q").distinct().join(known, "fs_q", "left_anti")
        reached = st.reached_keys(bs, landed, new).filter(F.col("fs_q").between(
            quarters.agg(F.min("fs_q")).scalar(), quarters.agg(F.max("fs_q")).scalar())).checkpoint(eager=True)
        self.upsert("company_fs_pl_prep", st.trailing_pl_reached(bs, pl, reached), unique=True)

    def load_new_symbol_statements(self, normalised: DataFrame, meta: DataFrame, symbols: DataFrame) -> None:
        """D11 (known quarters only) + D13 for new symbols, all quarters."""
        # the known quarters are read before company_fs_bs is rewritten below
        # (a lazy read would point at replaced files); a small set, stored once
        checkpoint_dir(self.spark)
        known = self.table("company_fs_bs").select("fs_q").distinct().checkpoint(eager=True)
        bs, pl = st.split_statements(normalised, meta, known_quarters=known)
        self.upsert("company_fs_bs", bs)
        self.upsert("company_fs_pl", pl)
        prep = st.trailing_pl_new(self.table("company_fs_bs"), self.table("company_fs_pl"), symbols)
        self.upsert("company_fs_pl_prep", prep)

    def refresh_factors(self, start: DateLike = None, end: DateLike = None) -> None:
        """D15 + D16 over ``[start, end]`` and D17 over the whole market
        calendar (momentum needs the history before ``start``); both upserted
        into factor_daily touching only their own columns."""
        in_range = self.require("stock_daily", start, end).filter(
            F.col("base_dt").between(F.lit(start or "0001-01-01").cast("date"),
                                     F.lit(end or "9999-12-31").cast("date")))
        key_days = in_range.select("num_key", "base_dt")
        cons = self.table("stock_cons", start, end)
        if cons is None:  # no consensus landed yet: every *_12mf factor is NULL
            cons = self.spark.createDataFrame([], schemas.STOCK_CONS)
        value = fac.value_factors(in_range, cons, self.require("workdays"),
                                  self.require("company_fs_bs"), self.require("company_fs_pl_prep"))
        self.upsert("factor_daily", value, key_days)
        # the windows reach back as many trading days as the longest has: the
        # stored calendar says since when, and only those years are read
        history = self.table("stock_daily", end=end)
        if start is not None:
            earlier = (history.select("base_dt").distinct().filter(F.col("base_dt") < F.lit(start).cast("date"))
                              .orderBy(F.desc("base_dt")).limit(max(fac.MOMENTUM_WINDOWS.values()) - 1))
            since = earlier.agg(F.min("base_dt")).first()[0]
            history = self.table("stock_daily", since or start, end)
        self.upsert("factor_daily", fac.momentum(history, start=start, end=end), key_days)
