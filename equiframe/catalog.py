"""Registered queries: each runs one library operator (or domain function)
over the stand-in tables of ``fixtures`` and has an equivalent DuckDB SQL
oracle over the same source tables.

Only the values whose last bits depend on how an engine associates a
window product (momentum, rolling products, adjusted closes) are rounded,
at the very end and identically in both engines; every other value is
computed by the same IEEE operations in both and compared as is.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equiframe import fixtures as fx
from equiframe.functions.dates import parse_yyyymmdd
from equiframe.functions.text import parse_number, remove_dashes, sector_recode
from equiframe.operators.columns import across, drop_range, select_range
from equiframe.operators.filters import on_date, sym_dt_pick
from equiframe.operators.joins import bounded_broadcast, value_set
from equiframe.operators.windows import latest_per_key, market_calendar, rolling
from equiframe.plans import calendar as cal
from equiframe.plans import factors as fac
from equiframe.plans import ingest as ing
from equiframe.plans import prices as prc
from equiframe.plans import statements as st
from equiframe.plans.refresh import EquityStore
from equiframe.session import checkpoint_dir
from equiframe.sources import sinks
from equiframe.sources.landed import read_export
from equiframe.sources.payload import explode_payload, explode_variant
from equiframe.sources.tables import TableStore, read_parquet
from equiframe.sources.vendor import cross_section, fiscal_basis, item_metadata

Query = Callable[[SparkSession, str], DataFrame]

# Query parameters (the operators' own inputs: dates, spans, clocks).
SPLIT_DAY = "1999-01-01"          # stored history before, landed batch from here
LISTING_DAY = "20230102"           # the day stamped on a landed listing
VIEW_START, VIEW_END = "1996-01-01", "2000-06-30"
PANEL_START = "1998-01-01"
AS_OF = _dt.datetime(2000, 9, 1, 8, 30)
LOADED_UNTIL = "2000-06-01"        # stock_daily loaded before this day
BS_LOADED_UNTIL = "2000 Q1"        # statements loaded up to this quarter
SNAPSHOT_DAY = "1995-01-09"        # symbol list snapshot taken before this day
NAMES_UNTIL = "1995-01-05"         # names looked up: those in use in the first days
GONE_YEAR, PART_GONE_YEAR = 1995, 1997  # years deleted from a stored table, whole and in part
LAND_DAYS = ("1998-01-05", "1998-01-12", "1998-01-19")  # days landed in the stored load


def finish(df: DataFrame, cols: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Comparison form: round ``cols`` (the values whose last bits depend on
    how an engine associates a product) to ``digits`` places."""
    if not cols:
        return df
    return across(df, cols, lambda c: F.round(c, digits))


def _fx(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return fx.load(spark, sf, name)


def _rnd(cols: list[str], digits: int) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


def _sql(fixtures: list[str], body: str, doubles: list[str] | None = None, digits: int = 6) -> str:
    """Oracle text; ``body`` may continue the fixtures' WITH list (leading
    comma) and must end with a SELECT.  ``doubles`` are rounded."""
    text = "\n" + fx.oracle(fixtures, body)
    if not doubles:
        return text.strip()
    head, _, last = text.rpartition("\nSELECT ")
    return f"{head}\nSELECT * REPLACE ({_rnd(doubles, digits)}) FROM (SELECT {last}) _o".strip()


Q: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco



# --------------------------------------------------------------------------
# Step 1: scans, filters, column ranges
# --------------------------------------------------------------------------


def _latest_market_syms(spark: SparkSession, sf: str, market: str) -> DataFrame:
    info = _fx(spark, sf, "fx_history")
    latest = latest_per_key(info.select("sym_cd", "info_update", "mkt_cd"), ["sym_cd"], "info_update")
    return latest.filter(F.col("mkt_cd") == market).select("sym_cd")


_LATEST_O = """
, latest_o AS (
  SELECT sym_cd FROM (
    SELECT sym_cd, mkt_cd, row_number() OVER (PARTITION BY sym_cd ORDER BY info_update DESC) AS rn
    FROM fx_history) z WHERE rn = 1 AND mkt_cd = 'O')
"""


@register("scan_filter", _sql(["fx_daily", "fx_history"], _LATEST_O + """
SELECT d.* FROM fx_daily d
WHERE d.sym_cd IN (SELECT sym_cd FROM latest_o)
  AND d.base_dt >= DATE '1997-01-01' AND d.base_dt <= DATE '1999-12-31'
"""))
def q_scan_filter(spark: SparkSession, sf: str) -> DataFrame:
    """F1 sym_dt_pick: symbols (as a semi join on a derived list) and an
    inclusive date range over stock_daily."""
    daily = _fx(spark, sf, "fx_daily")
    syms = _latest_market_syms(spark, sf, "O")
    return sym_dt_pick(daily, syms, "1997-01-01", "1999-12-31")


_CONS = ["sales_12mf", "opr_prof_12mf", "earn_12mf", "earn_dom_12mf", "bps_12mf", "eps_down_fy2"]


@register("drop_all_null", _sql(["fx_vendor"], f"""
SELECT base_dt, sym_cd, {", ".join(_CONS)} FROM fx_vendor
WHERE {" OR ".join(c + " IS NOT NULL" for c in _CONS)}
"""))
def q_drop_all_null(spark: SparkSession, sf: str) -> DataFrame:
    """vendor consensus rows with at least one item present."""
    v = _fx(spark, sf, "fx_vendor").select("base_dt", "sym_cd", *_CONS)
    return st.drop_all_null(v, ["base_dt", "sym_cd"])


@register("col_range", _sql(["fx_daily"], """
SELECT num_key, base_dt, sym_cd, open, high, low, close, mkt_cap FROM fx_daily
"""))
def q_col_range(spark: SparkSession, sf: str) -> DataFrame:
    """Drop the range trd_vol:trd_val, keep num_key:close plus mkt_cap
    (ranges resolved on the schema's column order)."""
    daily = _fx(spark, sf, "fx_daily")
    return select_range(drop_range(daily, "trd_vol", "trd_val"), ("num_key", "close"), "mkt_cap")


# --------------------------------------------------------------------------
# Step 2: momentum
# --------------------------------------------------------------------------

_CAL = """
, cal AS (SELECT base_dt, row_number() OVER (ORDER BY base_dt) AS t
          FROM (SELECT DISTINCT base_dt FROM fx_daily) d)
, gp AS (SELECT d.num_key, d.sym_cd, c.t, d.close / nullif(d.base_p, 0) AS g
         FROM fx_daily d JOIN cal c ON c.base_dt = d.base_dt)
"""


def _roll_sql(name: str, n: int, minus_one: bool) -> str:
    w = f"(PARTITION BY sym_cd ORDER BY t RANGE BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    tail = " - 1" if minus_one else ""
    return f"CASE WHEN count(g) OVER {w} = {n} THEN product(g) OVER {w} END{tail} AS {name}"


MOM = fac.MOMENTUM_WINDOWS


@register("momentum_returns", _sql(["fx_daily"], _CAL + "SELECT num_key, " +
                                   ", ".join(_roll_sql(k, n, True) for k, n in MOM.items()) +
                                   " FROM gp", list(MOM)))
def q_momentum(spark: SparkSession, sf: str) -> DataFrame:
    """60/120/252-trading-day momentum for every stock_daily row."""
    return finish(fac.momentum(_fx(spark, sf, "fx_daily")), list(MOM))


ROLL = {"p5": 5, "p20": 20}


@register("rolling_product", _sql(["fx_daily"], _CAL + "SELECT num_key, " +
                                  ", ".join(_roll_sql(k, n, False) for k, n in ROLL.items()) +
                                  " FROM gp", list(ROLL)))
def q_rolling(spark: SparkSession, sf: str) -> DataFrame:
    """Full-window rolling product of close/base_p over 5 and 20
    trading days of the market calendar (small blocks force the halo path)."""
    daily = _fx(spark, sf, "fx_daily")
    c = market_calendar(daily)
    p = daily.select("num_key", "sym_cd", "base_dt",
                     F.try_divide(F.col("close"), F.col("base_p")).alias("g")).join(bounded_broadcast(c), "base_dt")
    return finish(rolling(p, "g", ROLL, ["sym_cd"], "t", "product", block=64).select("num_key", *ROLL), list(ROLL))


# --------------------------------------------------------------------------
# Step 3: calendar
# --------------------------------------------------------------------------

_HOL = ", ".join(f"({m}, {d})" for m, d in cal.FIXED_HOLIDAYS)
_YEARS_SQL = f"""
, yrs AS (SELECT DISTINCT CAST(year(l_shipdate) AS INT) AS y FROM lineitem)
, days AS (SELECT CAST(gs.d AS DATE) AS base_dt
           FROM yrs, LATERAL (SELECT unnest(generate_series(CAST(make_date(y, 1, 1) AS TIMESTAMP),
                                                            CAST(make_date(y, 12, 31) AS TIMESTAMP),
                                                            INTERVAL 1 DAY)) AS d) gs)
, hol AS (SELECT make_date(y, m, d) AS base_dt FROM yrs, (VALUES {_HOL}) h(m, d))
, bdays AS (SELECT base_dt FROM days WHERE isodow(base_dt) <= 5
            AND base_dt NOT IN (SELECT base_dt FROM hol))
"""


def _lag_cols(col: str = "base_dt") -> str:
    lagged = f"(CASE WHEN month({col}) = 3 THEN {col} - INTERVAL 6 MONTH ELSE {col} - INTERVAL 5 MONTH END)"
    return (f"CAST(year({lagged}) AS VARCHAR) || ' Q' || CAST(quarter({lagged}) AS VARCHAR) AS fs_q, "
            f"CAST(year({col} - INTERVAL 15 MONTH) AS INTEGER) AS fs_y")


def _ship_years(spark: SparkSession, sf: str) -> DataFrame:
    return read_parquet(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year")).distinct()


def _workdays(spark: SparkSession, sf: str) -> DataFrame:
    years = _ship_years(spark, sf)
    return cal.business_calendar(years, cal.fixed_holidays(years))


@register("business_calendar", _sql([], _YEARS_SQL + f"SELECT base_dt, {_lag_cols()} FROM bdays"))
def q_business_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Trading days of every year present in lineitem, weekends and
    fixed holidays removed, with the published quarter and report year."""
    return _workdays(spark, sf)


@register("report_lag_quarters", _sql([], f"""
SELECT base_dt, {_lag_cols()} FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS base_dt FROM lineitem) d
"""))
def q_report_lag(spark: SparkSession, sf: str) -> DataFrame:
    """D1 rule on every ship date: quarter of (day - 6 months) in March,
    else (day - 5 months); report year of (day - 15 months)."""
    days = read_parquet(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("base_dt")).distinct()
    return cal.with_report_lag(days)


@register("day_codes", _sql([], _YEARS_SQL + """
SELECT base_dt, replace(CAST(base_dt AS VARCHAR), '-', '') AS code, base_dt AS parsed FROM bdays
"""))
def q_day_codes(spark: SparkSession, sf: str) -> DataFrame:
    """X7 + X8: trading days as request codes (dashes removed) and parsed
    back from ``YYYYMMDD`` text."""
    days = _workdays(spark, sf).select("base_dt")
    coded = days.select("base_dt", remove_dashes(F.col("base_dt").cast("string")).alias("code"))
    return coded.select("base_dt", "code", parse_yyyymmdd("code").alias("parsed"))


# --------------------------------------------------------------------------
# Step 4: scalar functions and ingest normalisers
# --------------------------------------------------------------------------

def _pn(x: str) -> str:
    """The first number of a text, stated apart from the library's rule."""
    return f"TRY_CAST(regexp_extract(replace({x}, ',', ''), '-?([0-9]+([.][0-9]+)?|[.][0-9]+)', 0) AS DOUBLE)"


_LISTING_NUM = ["ACC_TRDVOL", "ACC_TRDVAL", "TDD_OPNPRC", "TDD_HGPRC", "TDD_LWPRC", "TDD_CLSPRC", "ISU_ABBRV"]


@register("parse_number", _sql(["fx_listing"], "SELECT ISU_SRT_CD, " +
                               ", ".join(f"{_pn(c)} AS {c}" for c in _LISTING_NUM) +
                               " FROM fx_listing"))
def q_parse_number(spark: SparkSession, sf: str) -> DataFrame:
    """X1 on every text field of the landed listing (names included, which
    mostly have no number)."""
    raw = _fx(spark, sf, "fx_listing")
    return raw.select("ISU_SRT_CD", *[parse_number(c).alias(c) for c in _LISTING_NUM])


@register("json_explode", _sql([], """
SELECT event_type, event_id, user_id, value, props FROM events
"""))
def q_json_explode(spark: SparkSession, sf: str) -> DataFrame:
    """Landed payload documents -> one row per record of the array
    under each document's first key; fields typed after the explode."""
    payload = _fx(spark, sf, "fx_payload")
    rows = explode_payload(payload, "payload", ["event_id", "user_id", "value", "props"],
                           keep=["event_type"])
    return rows.select("event_type", F.col("event_id").try_cast("long").alias("event_id"),
                       F.col("user_id").try_cast("long").alias("user_id"),
                       F.col("value").try_cast("double").alias("value"), "props")


_CS_NUM = ["sales", "opr_prof", "earn", "earn_dom", "grs_asset", "net_asset", "op_cash_flow", "cash_flow"]


@register("vendor_cross_section", _sql(["fx_cs_raw"], "SELECT substr(sym_cd, 2) AS sym_cd, period AS fs_q, " +
                                       ", ".join(f"{_pn(c)} AS {c}" for c in _CS_NUM) +
                                       ", memo FROM fx_cs_raw"))
def q_vendor_cs(spark: SparkSession, sf: str) -> DataFrame:
    """Statement export text -> typed items chosen by metadata."""
    raw = _fx(spark, sf, "fx_cs_raw")
    meta = item_metadata(spark)
    return cross_section(raw, meta, "fs", F.col("period"))


_DAILY_TEXT = ["sym_mng", "sym_stop", "sym_reg"]
_DAILY_NUM = ["net_buy_fi", "mkt_cap", "bps_12mf", "eps_down_fy2"]


@register("vendor_cross_section_daily", _sql(["fx_vendor_raw"], "SELECT base_dt, substr(sym_cd, 2) AS sym_cd, " +
                                             ", ".join([*_DAILY_TEXT, *(f"{_pn(c)} AS {c}" for c in _DAILY_NUM)]) +
                                             " FROM fx_vendor_raw"))
def q_vendor_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Daily export text -> typed items keyed (base_dt, sym_cd)."""
    return cross_section(_fx(spark, sf, "fx_vendor_raw"), item_metadata(spark), "daily", F.col("base_dt"))


@register("vendor_cross_section_new", _sql(["fx_vendor_raw"], f"""
SELECT base_dt, substr(sym_cd, 2) AS sym_cd, sym_reg, {_pn("eps_down_fy2")} AS eps_down_fy2 FROM fx_vendor_raw
"""))
def q_vendor_new(spark: SparkSession, sf: str) -> DataFrame:
    """Only the items the metadata flags as new."""
    return cross_section(_fx(spark, sf, "fx_vendor_raw"), item_metadata(spark), "daily", F.col("base_dt"),
                         new_only=True)


_SQL_TEXT = """
SELECT n.n_name, count(*) AS orders, sum(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) AS filled
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
GROUP BY n.n_name
"""


@register("sql_tables", """
SELECT n_name, count(*) AS orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS filled
FROM orders, customer, nation WHERE c_custkey = o_custkey AND n_nationkey = c_nationkey GROUP BY n_name
""")
def q_sql_tables(spark: SparkSession, sf: str) -> DataFrame:
    """SQL text over stored tables."""
    return TableStore(spark, str(sf), ".parquet").sql(_SQL_TEXT, ["orders", "customer", "nation"])


@register("info_on_date", _sql(["fx_history"], f"""
SELECT * FROM fx_history WHERE info_update = DATE '{SPLIT_DAY}'
"""))
def q_on_date(spark: SparkSession, sf: str) -> DataFrame:
    """the attribute rows stamped with one day."""
    return on_date(_fx(spark, sf, "fx_history"), SPLIT_DAY)


_QMAP = "CASE quarter WHEN '1st-Quarter' THEN 'Q1' WHEN 'Semi-Annual' THEN 'Q2' WHEN 'Semi-Quarter' THEN 'Q2' " \
        "WHEN '3rd-Quarter' THEN 'Q3' WHEN 'Annual' THEN 'Q4' ELSE quarter END"


@register("vendor_fiscal_basis", _sql(["fx_fb_raw"], f"SELECT substr(sym_cd, 2) AS sym_cd, year || ' ' || {_QMAP} AS fs_q, " +
                                      ", ".join(f"{_pn(c)} AS {c}" for c in _CS_NUM) +
                                      ", memo FROM fx_fb_raw"))
def q_vendor_fb(spark: SparkSession, sf: str) -> DataFrame:
    """Fiscal-basis export -> typed rows; quarter labels recoded."""
    return fiscal_basis(_fx(spark, sf, "fx_fb_raw"), item_metadata(spark))


# The industries' sectors, stated apart from the library's table
# so that a wrong entry there shows.
_SECTORS = """VALUES
  ('음식료·담배', '음식료품'), ('섬유·의류', '섬유의복'), ('종이·목재', '종이목재'), ('출판·매체복제', '종이목재'),
  ('제약', '의약품'), ('비금속', '비금속광물'), ('금속', '철강금속'), ('기계·장비', '기계'), ('일반전기전자', '전기전자'),
  ('의료·정밀기기', '의료정밀'), ('운송장비·부품', '운수장비'), ('기타제조', '기타제조업'), ('전기·가스·수도', '전기가스업'),
  ('건설', '건설업'), ('유통', '유통업'), ('숙박·음식', '서비스업'), ('운송', '운수창고업'), ('금융', '기타금융'),
  ('기타서비스', '서비스업'), ('오락·문화', '서비스업'), ('통신서비스', '통신업'), ('방송서비스', '서비스업'),
  ('인터넷', '서비스업'), ('디지털컨텐츠', '서비스업'), ('소프트웨어', '서비스업'), ('컴퓨터서비스', '서비스업'),
  ('통신장비', '전기전자'), ('정보기기', '전기전자'), ('반도체', '전기전자'), ('IT부품', '전기전자')"""


def _sector_case(col: str) -> str:
    return f"coalesce((SELECT sector FROM ({_SECTORS}) m(industry, sector) WHERE industry = {col}), {col})"



@register("listed_universe", _sql(["fx_listing", "fx_base_price", "fx_excluded", "fx_sectors"], f"""
, typed AS (
  SELECT DATE '2023-01-02' AS base_dt, p.ISU_SRT_CD AS sym_cd,
         {_pn('p.ACC_TRDVOL')} AS trd_vol, {_pn('p.ACC_TRDVAL')} AS trd_val,
         {_pn('p.TDD_OPNPRC')} AS open, {_pn('p.TDD_HGPRC')} AS high,
         {_pn('p.TDD_LWPRC')} AS low, {_pn('p.TDD_CLSPRC')} AS close,
         nullif({_pn('b.BAS_PRC')}, 1) AS base_p, p.ISU_ABBRV AS sym_nm, p.MKT_ID AS mkt_cd
  FROM fx_listing p LEFT JOIN fx_base_price b ON b.ISU_SRT_CD = p.ISU_SRT_CD
  WHERE p.ISU_SRT_CD IS NOT NULL)
SELECT t.*, {_sector_case('s.IDX_IND_NM')} AS sec_krx
FROM typed t LEFT JOIN fx_sectors s ON s.ISU_SRT_CD = t.sym_cd
WHERE t.mkt_cd <> 'KNX' AND t.sym_cd LIKE '%0' AND t.sym_cd NOT LIKE '9%'
  AND t.sym_nm NOT LIKE '%스팩%' AND t.base_p IS NOT NULL
  AND t.sym_cd NOT IN (SELECT ISU_SRT_CD FROM fx_excluded)
"""))
def q_listed_universe(spark: SparkSession, sf: str) -> DataFrame:
    """Landed listing -> the day's common-share universe with sector."""
    out = ing.listed_universe(_fx(spark, sf, "fx_listing"), _fx(spark, sf, "fx_base_price"),
                              _fx(spark, sf, "fx_excluded"), _fx(spark, sf, "fx_sectors"), LISTING_DAY)
    return out


_MKT_SQL = "replace(replace(replace(replace(marketName, 'KRX', 'X'), 'KOSPI', 'P'), 'KOSDAQ', 'Q'), '테마', 'T')"


@register("index_list", _sql(["fx_index_raw"], f"""
SELECT full_code, coalesce({_MKT_SQL}, 'NA') || coalesce(short_code, 'NA') AS idx_code,
       {_MKT_SQL} AS mkt_nm, short_code, codeName FROM fx_index_raw
"""))
def q_index_list(spark: SparkSession, sf: str) -> DataFrame:
    """D3: raw index list -> idx_code = market letter + short code."""
    return ing.index_list(_fx(spark, sf, "fx_index_raw"))


@register("sector_recode", _sql(["fx_sectors"], f"""
SELECT ISU_SRT_CD, {_sector_case('IDX_IND_NM')} AS sec_krx FROM fx_sectors
"""))
def q_sector_recode(spark: SparkSession, sf: str) -> DataFrame:
    """KRX industry name -> sector (exact match; unmatched kept)."""
    s = _fx(spark, sf, "fx_sectors")
    return s.select("ISU_SRT_CD", sector_recode("IDX_IND_NM").alias("sec_krx"))


# --------------------------------------------------------------------------
# Step 5: daily tables
# --------------------------------------------------------------------------

@register("stock_info_merge", _sql(["fx_history"], f"""
SELECT sym_cd, min(info_update) AS info_update, sym_nm, mkt_cd, sec_krx
FROM fx_history GROUP BY sym_cd, sym_nm, mkt_cd, sec_krx
HAVING min(info_update) >= DATE '{SPLIT_DAY}'
"""))
def q_stock_info_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Stored first-seen history (days before the split) merged with
    every landed day after it; returns the new versions to save."""
    h = _fx(spark, sf, "fx_history")
    before = h.filter(F.col("info_update") < F.lit(SPLIT_DAY).cast("date"))
    after = h.filter(F.col("info_update") >= F.lit(SPLIT_DAY).cast("date"))
    stored = ing.stock_info_merge(before.limit(0), before)
    return ing.stock_info_merge(stored, after)


@register("stock_info_history", _sql(["fx_history"], """
SELECT sym_cd, min(info_update) AS info_update, sym_nm, mkt_cd, sec_krx
FROM fx_history GROUP BY sym_cd, sym_nm, mkt_cd, sec_krx
"""))
def q_stock_info_history(spark: SparkSession, sf: str) -> DataFrame:
    """D5 whole history: every landed day merged into an empty store; one
    row per attribute version at its first-seen day (A -> B -> A keeps two)."""
    h = _fx(spark, sf, "fx_history")
    return ing.stock_info_merge(h.limit(0), h, new_only=False)


@register("stock_info_changes", _sql(["fx_history"], """
SELECT sym_cd, info_update, sym_nm, mkt_cd, sec_krx FROM (
  SELECT *, lag(sym_nm) OVER w AS p_nm, lag(mkt_cd) OVER w AS p_mkt, lag(sec_krx) OVER w AS p_sec,
         row_number() OVER w AS rn
  FROM fx_history WINDOW w AS (PARTITION BY sym_cd ORDER BY info_update)) z
WHERE rn = 1 OR sym_nm IS DISTINCT FROM p_nm OR mkt_cd IS DISTINCT FROM p_mkt
   OR sec_krx IS DISTINCT FROM p_sec
"""))
def q_stock_info_changes(spark: SparkSession, sf: str) -> DataFrame:
    """D5 true-history option: every change of a symbol's attributes is a
    version (A -> B -> A keeps three), over the whole history."""
    h = _fx(spark, sf, "fx_history")
    return ing.stock_info_changes(h.limit(0), h, new_only=False)


@register("latest_stock_info", _sql(["fx_history"], """
SELECT sym_cd, info_update, sym_nm, mkt_cd, sec_krx FROM (
  SELECT *, row_number() OVER (PARTITION BY sym_cd ORDER BY info_update DESC) AS rn FROM fx_history) z
WHERE rn = 1
"""))
def q_latest_stock_info(spark: SparkSession, sf: str) -> DataFrame:
    """Each symbol's latest attribute row (a max_by aggregate)."""
    return latest_per_key(_fx(spark, sf, "fx_history"), ["sym_cd"], "info_update")



@register("stock_daily", _sql(["fx_daily", "fx_vendor", "fx_history"], f"""
, px AS (SELECT base_dt, sym_cd, trd_vol, trd_val, open, high, low, close, base_p
         FROM fx_daily WHERE base_dt >= DATE '{SPLIT_DAY}')
, mk AS (SELECT coalesce(max(num_key), 0) AS m FROM fx_daily WHERE base_dt < DATE '{SPLIT_DAY}')
SELECT (SELECT m FROM mk) + row_number() OVER (ORDER BY p.base_dt, p.sym_cd) AS num_key,
       p.base_dt, p.sym_cd, p.trd_vol, p.trd_val, p.open, p.high, p.low, p.close, p.base_p,
       v.net_buy_fi, v.mkt_cap, v.num_stock_o, v.num_stock_t,
       (SELECT max(h.info_update) FROM fx_history h
        WHERE h.sym_cd = p.sym_cd AND h.info_update <= p.base_dt) AS info_update
FROM px p LEFT JOIN fx_vendor v ON v.base_dt = p.base_dt AND v.sym_cd = p.sym_cd
"""))
def q_stock_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Landed prices from the split day on + vendor items + attribute
    version as of each day + contiguous num_key after the stored maximum."""
    d = _fx(spark, sf, "fx_daily")
    split = F.lit(SPLIT_DAY).cast("date")
    stored = d.filter(F.col("base_dt") < split)
    universe = d.filter(F.col("base_dt") >= split)
    return ing.stock_daily(universe, _fx(spark, sf, "fx_vendor"), _fx(spark, sf, "fx_history"),
                                  stored)


@register("stock_cons", _sql(["fx_daily", "fx_vendor"], f"""
SELECT CAST(d.num_key AS VARCHAR) AS num_key, {", ".join("v." + c for c in _CONS)}
FROM fx_vendor v LEFT JOIN fx_daily d ON d.base_dt = v.base_dt AND d.sym_cd = v.sym_cd
WHERE {" OR ".join("v." + c + " IS NOT NULL" for c in _CONS)}
"""))
def q_stock_cons(spark: SparkSession, sf: str) -> DataFrame:
    """Consensus rows keyed by num_key (as text: a vendor row without a
    stock_daily row keeps a NULL key)."""
    cons = ing.stock_cons(_fx(spark, sf, "fx_daily"), _fx(spark, sf, "fx_vendor"))
    return cons.withColumn("num_key", F.col("num_key").cast("string"))


@register("stock_managed", _sql(["fx_daily", "fx_vendor"], """
, k AS (SELECT CAST(d.num_key AS VARCHAR) AS num_key, v.sym_mng, v.sym_stop, v.sym_reg
        FROM fx_vendor v LEFT JOIN fx_daily d ON d.base_dt = v.base_dt AND d.sym_cd = v.sym_cd)
SELECT num_key, CAST(1 AS INTEGER) AS type FROM k WHERE sym_mng <> '정상'
UNION ALL SELECT num_key, CAST(2 AS INTEGER) FROM k WHERE sym_stop <> '정상'
UNION ALL SELECT num_key, CAST(3 AS INTEGER) FROM k WHERE sym_reg <> '정상'
"""))
def q_stock_managed(spark: SparkSession, sf: str) -> DataFrame:
    """Unpivot the three status columns; keep non-normal ones as type
    1/2/3 (keys as text: a vendor row may have none)."""
    managed = ing.stock_managed(_fx(spark, sf, "fx_daily"), _fx(spark, sf, "fx_vendor"))
    return managed.withColumn("num_key", F.col("num_key").cast("string"))


@register("stocks_in_index", _sql(["fx_daily", "fx_members"], """
SELECT d.num_key, m.idx_code FROM fx_daily d JOIN fx_members m ON m.base_dt = d.base_dt AND m.sym_cd = d.sym_cd
"""))
def q_stocks_in_index(spark: SparkSession, sf: str) -> DataFrame:
    """Index membership keyed by num_key."""
    return ing.stocks_in_index(_fx(spark, sf, "fx_daily"), _fx(spark, sf, "fx_members"))



_INDEX_CTE = f"""
, il AS (SELECT coalesce({_MKT_SQL}, 'NA') || coalesce(short_code, 'NA') AS idx_code,
                {_MKT_SQL} AS mkt_nm, codeName FROM fx_index_raw)
, j AS (SELECT l.base_dt, l.mkt, l.IDX_NM AS sym_nm, l.ACC_TRDVOL, l.ACC_TRDVAL, l.OPNPRC_IDX, l.HGPRC_IDX,
               l.LWPRC_IDX, l.CLSPRC_IDX, b.OPN_DD_INDX
        FROM fx_index_levels l LEFT JOIN fx_index_base b
          ON b.base_dt = l.base_dt AND b.mkt = l.mkt AND b.IDX_IND_NM = l.IDX_NM
        WHERE l.ACC_TRDVOL <> '-' AND l.ACC_TRDVAL <> '-' AND l.OPNPRC_IDX <> '-' AND l.HGPRC_IDX <> '-'
          AND l.LWPRC_IDX <> '-' AND l.CLSPRC_IDX <> '-' AND b.OPN_DD_INDX <> '-')
, ix AS (SELECT j.base_dt, il.idx_code, {_pn('ACC_TRDVOL')} AS trd_vol, {_pn('ACC_TRDVAL')} AS trd_val,
       {_pn('OPNPRC_IDX')} AS open, {_pn('HGPRC_IDX')} AS high, {_pn('LWPRC_IDX')} AS low,
       {_pn('CLSPRC_IDX')} AS close, {_pn('OPN_DD_INDX')} AS base_p
FROM j LEFT JOIN il ON il.codeName = j.sym_nm
  AND il.mkt_nm = CASE j.mkt WHEN '01' THEN 'X' WHEN '02' THEN 'P' WHEN '03' THEN 'Q' WHEN '04' THEN 'T' ELSE j.mkt END)
"""


@register("index_daily", _sql(["fx_index_levels", "fx_index_base", "fx_index_raw"], _INDEX_CTE + "SELECT * FROM ix"))
def q_index_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Index levels joined to base values and index codes."""
    il = ing.index_list(_fx(spark, sf, "fx_index_raw"))
    return ing.index_daily(_fx(spark, sf, "fx_index_levels"), _fx(spark, sf, "fx_index_base"), il)


# --------------------------------------------------------------------------
# Step 6: statements
# --------------------------------------------------------------------------

_PL_ITEMS = ["sales", "opr_prof", "earn", "earn_dom", "op_cash_flow", "cash_flow"]
_PL_OUT = ["sales", "opr_prof", "earn", "op_cash_flow", "cash_flow"]
_TP_COLS = [f"{x}_a4q" for x in _PL_OUT] + [f"{x}_n" for x in _PL_OUT]


def _tp_sql(grid_cte: str) -> str:
    """Trailing P&L over a grid CTE with columns sym_cd, fs_q, items
    (y1 via a self join on last year's Q4, l4 via lag)."""
    a = []
    n = []
    for x in _PL_ITEMS:
        a.append(f"CASE WHEN g.q = 4 THEN g.{x} ELSE coalesce(g.{x} + p.{x} - g.l4_{x}, p.{x}) END AS {x}_a4q")
        n.append(f"g.{x} - g.l1_{x} AS {x}_n")
    lags = ", ".join(f"lag({x}, 4) OVER (PARTITION BY sym_cd ORDER BY fs_q) AS l4_{x}, "
                     f"lag({x}, 1, 0) OVER (PARTITION BY sym_cd, y ORDER BY fs_q) AS l1_{x}" for x in _PL_ITEMS)
    outs = [f"coalesce(earn_dom_a4q, earn_a4q) AS earn_a4q" if c == "earn_a4q" else
            f"coalesce(earn_dom_n, earn_n) AS earn_n" if c == "earn_n" else c for c in _TP_COLS]
    return f"""
, gy AS (SELECT *, CAST(substr(fs_q, 1, 4) AS INTEGER) AS y, CAST(substr(fs_q, 7, 1) AS INTEGER) AS q FROM {grid_cte})
, gl AS (SELECT *, {lags} FROM gy)
, tp0 AS (SELECT g.sym_cd, g.fs_q, {", ".join(a)}, {", ".join(n)}
          FROM gl g LEFT JOIN gy p ON p.sym_cd = g.sym_cd AND p.y = g.y - 1 AND p.q = 4)
, tp AS (SELECT sym_cd, fs_q, {", ".join(outs)} FROM tp0)
, tpf AS (SELECT * FROM tp WHERE {" OR ".join(c + " IS NOT NULL" for c in _TP_COLS)})
"""


_GRID = f"""
, grid AS (SELECT s.sym_cd, q.fs_q, {", ".join("p." + x for x in _PL_ITEMS)}
           FROM (SELECT DISTINCT sym_cd FROM fx_bs) s CROSS JOIN (SELECT DISTINCT fs_q FROM fx_bs) q
           LEFT JOIN fx_pl p ON p.sym_cd = s.sym_cd AND p.fs_q = q.fs_q)
"""


def _stmt_inputs(spark: SparkSession, sf: str):
    return _fx(spark, sf, "fx_bs"), _fx(spark, sf, "fx_pl")


_BS_ITEMS = ["grs_asset", "net_asset"]
_PL_META = ["sales", "opr_prof", "earn", "earn_dom", "op_cash_flow", "cash_flow"]


def _cs_typed_sql() -> str:
    return ("\n, cs AS (SELECT substr(sym_cd, 2) AS sym_cd, period AS fs_q, " +
            ", ".join(f"{_pn(c)} AS {c}" for c in _CS_NUM) + " FROM fx_cs_raw)\n")


@register("split_statements", _sql(["fx_cs_raw"], _cs_typed_sql() + f"""
SELECT sym_cd, fs_q, {", ".join(_PL_META)} FROM cs WHERE {" OR ".join(c + " IS NOT NULL" for c in _PL_META)}
"""))
def q_split_pl(spark: SparkSession, sf: str) -> DataFrame:
    """Normalised statement export -> P&L part (metadata pl flag),
    all-NULL rows dropped."""
    meta = item_metadata(spark)
    _, pl = st.split_statements(cross_section(_fx(spark, sf, "fx_cs_raw"), meta, "fs", F.col("period")), meta)
    return pl


@register("split_statements_bs", _sql(["fx_cs_raw"], _cs_typed_sql() + f"""
SELECT sym_cd, fs_q, {", ".join(_BS_ITEMS)} FROM cs WHERE {" OR ".join(c + " IS NOT NULL" for c in _BS_ITEMS)}
"""))
def q_split_bs(spark: SparkSession, sf: str) -> DataFrame:
    """Balance-sheet part (metadata bs flag), all-NULL rows dropped."""
    meta = item_metadata(spark)
    bs, _ = st.split_statements(cross_section(_fx(spark, sf, "fx_cs_raw"), meta, "fs", F.col("period")), meta)
    return bs


@register("split_statements_new", _sql(["fx_fb_raw", "fx_bs"],
                                       f"\n, fb AS (SELECT substr(sym_cd, 2) AS sym_cd, year || ' ' || {_QMAP} AS fs_q, " +
                                       ", ".join(f"{_pn(c)} AS {c}" for c in _CS_NUM) + " FROM fx_fb_raw)\n" + f"""
SELECT sym_cd, fs_q, {", ".join(_PL_META)} FROM fb
WHERE ({" OR ".join(c + " IS NOT NULL" for c in _PL_META)}) AND fs_q IN (SELECT fs_q FROM fx_bs WHERE fs_q <= '{BS_LOADED_UNTIL}')
"""))
def q_split_new(spark: SparkSession, sf: str) -> DataFrame:
    """D11 new-symbol variant: fiscal-basis export, P&L part, only quarters
    already in the stored balance sheet (semi join; later ones drop out)."""
    meta = item_metadata(spark)
    df = fiscal_basis(_fx(spark, sf, "fx_fb_raw"), meta)
    _, pl = st.split_statements(df, meta, known_quarters=_fx(spark, sf, "fx_bs").filter(F.col("fs_q") <= BS_LOADED_UNTIL))
    return pl


@register("trailing_pl", _sql(["fx_bs", "fx_pl"], _GRID + _tp_sql("grid") + "SELECT * FROM tpf"))
def q_trailing_pl(spark: SparkSession, sf: str) -> DataFrame:
    """D12 on the full (symbol x quarter) grid of the stored statements."""
    bs, pl = _stmt_inputs(spark, sf)
    grid = st.complete_grid(bs, "sym_cd", "fs_q", pl.drop("dpr", "prop_div"))
    return st.trailing_pl(grid, quarters=value_set(bs, "fs_q"))


_WQ = """
, wq AS (SELECT min(fs_q) AS a, max(fs_q) AS b FROM fx_workdays)
"""


@register("trailing_pl_existing", _sql(["fx_bs", "fx_pl", "fx_workdays"], _WQ + """
, grid0 AS (SELECT s.sym_cd, q.fs_q FROM (SELECT DISTINCT sym_cd FROM fx_bs) s CROSS JOIN (SELECT DISTINCT fs_q FROM fx_bs) q)
, grid AS (SELECT g.sym_cd, g.fs_q, p.sales, p.opr_prof, p.earn, p.earn_dom, p.op_cash_flow, p.cash_flow
           FROM grid0 g LEFT JOIN fx_pl p ON p.sym_cd = g.sym_cd AND p.fs_q = g.fs_q
           WHERE g.fs_q >= (SELECT CAST(CAST(substr(a, 1, 4) AS INTEGER) - 1 AS VARCHAR) || ' Q1' FROM wq)
             AND g.fs_q <= (SELECT b FROM wq))
""" + _tp_sql("grid") + """
SELECT * FROM tpf WHERE fs_q >= (SELECT a FROM wq) AND fs_q <= (SELECT b FROM wq)
"""))
def q_trailing_existing(spark: SparkSession, sf: str) -> DataFrame:
    """D13 existing symbols: the quarters published over the trading
    calendar (first..last), grid from Q1 of the year before."""
    bs, pl = _stmt_inputs(spark, sf)
    return st.trailing_pl_range(bs, pl, _fx(spark, sf, "fx_workdays").select("fs_q"))


@register("trailing_pl_new", _sql(["fx_bs", "fx_pl"], _GRID.replace(
    "LEFT JOIN fx_pl p ON p.sym_cd = s.sym_cd AND p.fs_q = q.fs_q",
    "LEFT JOIN fx_pl p ON p.sym_cd = s.sym_cd AND p.fs_q = q.fs_q "
    "WHERE s.sym_cd IN (SELECT sym_cd FROM fx_pl)") + _tp_sql("grid") + "SELECT * FROM tpf"))
def q_trailing_new(spark: SparkSession, sf: str) -> DataFrame:
    """D13 new-symbol variant: every quarter for the given symbols (here
    every symbol with a P&L row: a full rebuild)."""
    bs, pl = _stmt_inputs(spark, sf)
    return st.trailing_pl_new(bs, pl, pl.select("sym_cd"))


_FBS = """
, bgrid AS (SELECT s.sym_cd, q.fs_q, b.grs_asset, b.cap, b.net_asset
            FROM (SELECT DISTINCT sym_cd FROM fx_bs) s CROSS JOIN (SELECT DISTINCT fs_q FROM fx_bs) q
            LEFT JOIN fx_bs b ON b.sym_cd = s.sym_cd AND b.fs_q = q.fs_q)
, fbs AS (SELECT sym_cd, fs_q,
     last_value(grs_asset IGNORE NULLS) OVER w AS grs_asset,
     last_value(cap IGNORE NULLS) OVER w AS cap,
     last_value(net_asset IGNORE NULLS) OVER w AS net_asset
   FROM bgrid WINDOW w AS (PARTITION BY sym_cd ORDER BY fs_q ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""


@register("filled_balance_sheet", _sql(["fx_bs"], _FBS + "SELECT * FROM fbs"))
def q_filled_bs(spark: SparkSession, sf: str) -> DataFrame:
    """Complete grid, balance-sheet items carried forward per symbol."""
    return st.filled_balance_sheet(_fx(spark, sf, "fx_bs"))


# --------------------------------------------------------------------------
# Step 7: value factors, panel, coverage
# --------------------------------------------------------------------------

_VF = fac.VALUE_FACTORS
_VF_SQL = _GRID + _tp_sql("grid") + _FBS + """
, vj AS (SELECT d.num_key, d.mkt_cap, d.num_stock_o, d.num_stock_t,
                c.sales_12mf, c.opr_prof_12mf, coalesce(c.earn_dom_12mf, c.earn_12mf) AS earn_12mf, c.bps_12mf,
                f.net_asset, t.sales_a4q, t.opr_prof_a4q, t.earn_a4q, t.op_cash_flow_a4q, t.cash_flow_a4q
         FROM fx_daily d LEFT JOIN fx_cons c ON c.num_key = d.num_key
         LEFT JOIN fx_workdays w ON w.base_dt = d.base_dt
         LEFT JOIN fbs f ON f.sym_cd = d.sym_cd AND f.fs_q = w.fs_q
         LEFT JOIN tpf t ON t.sym_cd = d.sym_cd AND t.fs_q = w.fs_q)
, va AS (SELECT *, mkt_cap / nullif(num_stock_o, 0) * num_stock_t AS adj,
                mkt_cap / nullif(num_stock_o, 0) AS per_share FROM vj)
, vf AS (SELECT num_key,
   earn_a4q / nullif(adj, 0) AS inv_per, opr_prof_a4q / nullif(adj, 0) AS inv_por,
   sales_a4q / nullif(adj, 0) AS inv_psr, op_cash_flow_a4q / nullif(adj, 0) AS inv_pocr,
   cash_flow_a4q / nullif(adj, 0) AS inv_pcr, net_asset / nullif(adj, 0) AS inv_pbr,
   earn_12mf / nullif(adj, 0) AS inv_per_12mf, opr_prof_12mf / nullif(adj, 0) AS inv_por_12mf,
   sales_12mf / nullif(adj, 0) AS inv_psr_12mf, bps_12mf / nullif(per_share, 0) AS inv_pbr_12mf
   FROM va)
"""
_VF_FIX = ["fx_daily", "fx_cons", "fx_workdays", "fx_bs", "fx_pl"]


def _value_factors(spark: SparkSession, sf: str):
    bs, pl = _stmt_inputs(spark, sf)
    prep = st.trailing_pl(st.complete_grid(bs, "sym_cd", "fs_q", pl.drop("dpr", "prop_div")), quarters=value_set(bs, "fs_q"))
    return fac.value_factors(_fx(spark, sf, "fx_daily"), _fx(spark, sf, "fx_cons"),
                             _fx(spark, sf, "fx_workdays"), bs, prep)


@register("value_factors", _sql(_VF_FIX, _VF_SQL + "SELECT * FROM vf"))
def q_value_factors(spark: SparkSession, sf: str) -> DataFrame:
    """Ten value factors for every stock_daily row (point-in-time
    statements through the calendar's published quarter)."""
    return _value_factors(spark, sf)


_MOM_CTE = _CAL + ", mom AS (SELECT num_key, " + ", ".join(_roll_sql(k, n, True) for k, n in MOM.items()) + " FROM gp)\n"
_FACTOR_TABLE = _VF_SQL + _MOM_CTE + f"""
, ft AS (SELECT coalesce(v.num_key, m.num_key) AS num_key, {", ".join("v." + c for c in _VF)},
                {", ".join("m." + c for c in MOM)}
         FROM vf v FULL OUTER JOIN mom m ON m.num_key = v.num_key)
"""


def _factor_table(spark: SparkSession, sf: str):
    return fac.update_factors(_value_factors(spark, sf), fac.momentum(_fx(spark, sf, "fx_daily")))


@register("update_factors", _sql(_VF_FIX, _FACTOR_TABLE + "SELECT * FROM ft", list(MOM)))
def q_update_factors(spark: SparkSession, sf: str) -> DataFrame:
    """D16 + D17 writes: factor table after upserting value factors, then
    momentum, each on num_key touching only its own columns."""
    return finish(_factor_table(spark, sf), list(MOM))


@register("factor_panel", _sql(_VF_FIX, _FACTOR_TABLE + f"""
SELECT d.num_key, d.base_dt, d.sym_cd, {", ".join("ft." + c for c in _VF + list(MOM))}
FROM fx_daily d LEFT JOIN ft ON ft.num_key = d.num_key WHERE d.base_dt >= DATE '{PANEL_START}'
""", list(MOM)))
def q_factor_panel(spark: SparkSession, sf: str) -> DataFrame:
    """First three stock_daily columns from the panel start on, with
    every factor."""
    return finish(fac.factor_panel(_fx(spark, sf, "fx_daily"), _factor_table(spark, sf), start=PANEL_START),
                  list(MOM))


@register("factor_coverage", _sql(["fx_daily"], _MOM_CTE + """
SELECT d.sym_cd, count(m.ret_12m) AS count FROM fx_daily d LEFT JOIN mom m ON m.num_key = d.num_key
GROUP BY d.sym_cd
"""))
def q_factor_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Per symbol, how many rows have a 12-month momentum."""
    d = _fx(spark, sf, "fx_daily")
    return fac.factor_coverage(fac.factor_panel(d, fac.momentum(d)), "ret_12m")


# --------------------------------------------------------------------------
# Step 8: prices
# --------------------------------------------------------------------------

_NAMES = f"""
, names AS (SELECT DISTINCT sym_nm FROM fx_history WHERE info_update <= DATE '{NAMES_UNTIL}')
, latest AS (SELECT sym_cd, sym_nm FROM (
    SELECT sym_cd, sym_nm, row_number() OVER (PARTITION BY sym_cd ORDER BY info_update DESC) AS rn
    FROM fx_history) z WHERE rn = 1)
, codes AS (SELECT sym_cd FROM latest WHERE sym_nm IN (SELECT sym_nm FROM names))
"""


def _names(spark: SparkSession, sf: str) -> DataFrame:
    h = _fx(spark, sf, "fx_history")
    return h.filter(F.col("info_update") <= F.lit(NAMES_UNTIL).cast("date")).select("sym_nm").distinct()


@register("symbol_lookup", _sql(["fx_history"], _NAMES + "SELECT sym_cd FROM codes"))
def q_symbol_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Codes whose latest name is among the names used in the first
    days (a symbol renamed since does not match)."""
    return prc.symbol_lookup(_fx(spark, sf, "fx_history"), _names(spark, sf))


@register("ohlc", _sql(["fx_history", "fx_daily"], _NAMES + """
SELECT sym_cd, base_dt, open, high, low, close, base_p FROM fx_daily WHERE sym_cd IN (SELECT sym_cd FROM codes)
"""))
def q_ohlc(spark: SparkSession, sf: str) -> DataFrame:
    """Raw prices of the looked-up symbols."""
    return prc.ohlc(_fx(spark, sf, "fx_history"), _fx(spark, sf, "fx_daily"), _names(spark, sf))


def _adj_sql(src: str) -> str:
    return f"""
, ar AS (SELECT sym_cd, base_dt, open, high, low, close, base_p / nullif(close, 0) AS r FROM {src})
, aa AS (SELECT *,
   last_value(close) OVER (PARTITION BY sym_cd ORDER BY base_dt ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_close,
   count(*) OVER wf - count(r) OVER wf AS nulls_after, product(r) OVER wf AS p_after
   FROM ar WINDOW wf AS (PARTITION BY sym_cd ORDER BY base_dt ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
, adj AS (SELECT *, last_close * CASE WHEN coalesce(nulls_after, 0) = 0 THEN coalesce(p_after, 1) END AS close_adj FROM aa)
"""


_OHLC_ADJ = ", ".join(f"round_even({c} / nullif(close, 0) * close_adj, 0) AS {c}" for c in ("open", "high", "low", "close"))


@register("adjusted_close", _sql(["fx_daily"], _adj_sql("fx_daily") + "SELECT sym_cd, base_dt, close_adj AS close FROM adj",
                                 ["close"], 4))
def q_adjusted_close(spark: SparkSession, sf: str) -> DataFrame:
    """D22 close-only: back-adjusted close for every symbol over its whole
    history (unrounded)."""
    d = _fx(spark, sf, "fx_daily").select("sym_cd", "base_dt", "open", "high", "low", "close", "base_p")
    return finish(prc.adjust_prices(d, close_only=True), ["close"], 4)


@register("adjusted_ohlc", _sql(["fx_daily"], _adj_sql("fx_daily") + f"SELECT sym_cd, base_dt, {_OHLC_ADJ} FROM adj"))
def q_adjusted_ohlc(spark: SparkSession, sf: str) -> DataFrame:
    """Adjusted open/high/low/close, half-even rounded; small date
    blocks so that the cross-block suffix path runs."""
    d = _fx(spark, sf, "fx_daily").select("sym_cd", "base_dt", "open", "high", "low", "close", "base_p")
    return prc.adjust_prices(d, close_only=False, block_days=90)


@register("price_view", _sql(["fx_history", "fx_daily"], _NAMES + f"""
, pv AS (SELECT * FROM fx_daily WHERE sym_cd IN (SELECT sym_cd FROM codes)
         AND base_dt BETWEEN DATE '{VIEW_START}' AND DATE '{VIEW_END}')
""" + _adj_sql("pv") + f"SELECT sym_cd, base_dt, {_OHLC_ADJ} FROM adj"))
def q_price_view(spark: SparkSession, sf: str) -> DataFrame:
    """Named stocks, date range first, then adjustment anchored at
    the range end (candle form)."""
    return prc.price_view(_fx(spark, sf, "fx_history"), _fx(spark, sf, "fx_daily"),
                                 _names(spark, sf), VIEW_START, VIEW_END, "candle")


@register("lookback_window", _sql(["fx_daily"], """
SELECT d.* FROM fx_daily d JOIN (SELECT sym_cd, max(base_dt) AS last FROM fx_daily GROUP BY sym_cd) m
  ON m.sym_cd = d.sym_cd WHERE d.base_dt >= m.last - INTERVAL 12 MONTH
"""))
def q_lookback(spark: SparkSession, sf: str) -> DataFrame:
    """each symbol's last year of rows (the 1y range button)."""
    return prc.recent_prices(_fx(spark, sf, "fx_daily"), "1y")


@register("lookback_mtd", _sql(["fx_daily"], """
SELECT d.* FROM fx_daily d JOIN (SELECT sym_cd, max(base_dt) AS last FROM fx_daily GROUP BY sym_cd) m
  ON m.sym_cd = d.sym_cd WHERE d.base_dt >= date_trunc('month', m.last)
"""))
def q_lookback_mtd(spark: SparkSession, sf: str) -> DataFrame:
    """each symbol's rows from the first of its last month (MTD)."""
    return prc.recent_prices(_fx(spark, sf, "fx_daily"), "mtd")


@register("lookback_ytd", _sql(["fx_daily"], """
SELECT d.* FROM fx_daily d JOIN (SELECT sym_cd, max(base_dt) AS last FROM fx_daily GROUP BY sym_cd) m
  ON m.sym_cd = d.sym_cd WHERE d.base_dt >= date_trunc('year', m.last)
"""))
def q_lookback_ytd(spark: SparkSession, sf: str) -> DataFrame:
    """each symbol's rows from January 1st of its last year (YTD)."""
    return prc.recent_prices(_fx(spark, sf, "fx_daily"), "ytd")


def _register_lookback(span: str, months: int | None) -> None:
    bound = f"WHERE d.base_dt >= m.last - INTERVAL {months} MONTH" if months else ""

    @register(f"lookback_{span}", _sql(["fx_daily"], f"""
SELECT d.* FROM fx_daily d JOIN (SELECT sym_cd, max(base_dt) AS last FROM fx_daily GROUP BY sym_cd) m
  ON m.sym_cd = d.sym_cd {bound}
"""))
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return prc.recent_prices(_fx(spark, sf, "fx_daily"), span)

    q.__doc__ = f"F9: each symbol's rows of the {span} range button."


for _span, _months in {"1m": 1, "6m": 6, "3y": 36, "5y": 60, "10y": 120, "all": None}.items():
    _register_lookback(_span, _months)


@register("price_view_line", _sql(["fx_history", "fx_daily"], _NAMES + f"""
, pv AS (SELECT * FROM fx_daily WHERE sym_cd IN (SELECT sym_cd FROM codes)
         AND base_dt BETWEEN DATE '{VIEW_START}' AND DATE '{VIEW_END}')
""" + _adj_sql("pv") + "SELECT sym_cd, base_dt, close_adj AS close FROM adj", ["close"], 4))
def q_price_view_line(spark: SparkSession, sf: str) -> DataFrame:
    """D23 line form: unrounded adjusted close of the named stocks over the
    range, anchored at the range end."""
    return finish(prc.price_view(_fx(spark, sf, "fx_history"), _fx(spark, sf, "fx_daily"),
                                 _names(spark, sf), VIEW_START, VIEW_END, "line"), ["close"], 4)


# --------------------------------------------------------------------------
# Step 9: write path
# --------------------------------------------------------------------------

@register("upsert_partial", _sql(["fx_daily", "fx_cons"], """
, src AS (SELECT num_key, CASE WHEN num_key % 5 = 0 THEN NULL ELSE close * CAST(0.95 AS DOUBLE) END AS bps_12mf,
                 close * CAST(0.02 AS DOUBLE) AS eps_down_fy2 FROM fx_daily)
SELECT coalesce(t.num_key, s.num_key) AS num_key, t.sales_12mf, t.opr_prof_12mf, t.earn_12mf, t.earn_dom_12mf,
       CASE WHEN s.num_key IS NOT NULL THEN s.bps_12mf ELSE t.bps_12mf END AS bps_12mf,
       CASE WHEN s.num_key IS NOT NULL THEN s.eps_down_fy2 ELSE t.eps_down_fy2 END AS eps_down_fy2
FROM fx_cons t FULL OUTER JOIN src s ON s.num_key = t.num_key
"""))
def q_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """S3: consensus table upserted with two supplied columns for every
    stock_daily key (matched: those columns replaced, NULL included;
    unmatched: inserted with the other items NULL)."""
    d = _fx(spark, sf, "fx_daily")
    src = d.select("num_key",
                   F.when(F.col("num_key") % 5 == 0, F.lit(None).cast("double"))
                    .otherwise(F.col("close") * F.lit(0.95)).alias("bps_12mf"),
                   (F.col("close") * F.lit(0.02)).alias("eps_down_fy2"))
    return sinks.upsert_partial(_fx(spark, sf, "fx_cons"), src, ["num_key"])


@register("delete_where", _sql(["fx_daily", "fx_cons"], """
SELECT * FROM fx_cons WHERE NOT coalesce(earn_dom_12mf > 1000, false)
"""))
def q_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Delete consensus rows with earn_dom_12mf > 1000 (a NULL
    predicate keeps the row)."""
    c = _fx(spark, sf, "fx_cons")
    return sinks.delete_where(c, F.col("earn_dom_12mf") > 1000)


_LOADED = f"fx_daily WHERE base_dt < DATE '{LOADED_UNTIL}'"


@register("replace_year", _sql(["fx_daily", "fx_workdays"], _YEARS_SQL + f"""
, ry AS (SELECT DISTINCT y FROM (SELECT CAST(year(max(base_dt)) AS INTEGER) AS y FROM {_LOADED}
                                 UNION ALL SELECT {AS_OF.year}) u WHERE y IS NOT NULL)
, newdays AS (SELECT base_dt FROM bdays WHERE CAST(year(base_dt) AS INTEGER) IN (SELECT y FROM ry))
SELECT base_dt, fs_q, fs_y FROM fx_workdays WHERE CAST(year(base_dt) AS INTEGER) NOT IN (SELECT y FROM ry)
UNION ALL SELECT base_dt, {_lag_cols()} FROM newdays
"""))
def q_replace_year(spark: SparkSession, sf: str) -> DataFrame:
    """S5 + D2 + D1: the years to update (last loaded year and the current
    one) are replaced in the workdays table by a fresh business calendar."""
    wd = _fx(spark, sf, "fx_workdays")
    loaded = _fx(spark, sf, "fx_daily").filter(F.col("base_dt") < F.lit(LOADED_UNTIL).cast("date"))
    years = cal.years_to_update(loaded, AS_OF)
    return sinks.replace_partition_values(wd, _workdays(spark, sf), F.year("base_dt"), years)


# --------------------------------------------------------------------------
# Step 10: update planner
# --------------------------------------------------------------------------

_CUTOFF = (AS_OF.date() - _dt.timedelta(days=2 if AS_OF.hour < 9 else 1)).isoformat()


@register("days_to_update", _sql(["fx_daily"], _YEARS_SQL + f"""
SELECT base_dt FROM bdays WHERE base_dt > (SELECT max(base_dt) FROM {_LOADED}) AND base_dt <= DATE '{_CUTOFF}'
"""))
def q_days_to_update(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar days after the last loaded day up to the cut-off."""
    loaded = _fx(spark, sf, "fx_daily").filter(F.col("base_dt") < F.lit(LOADED_UNTIL).cast("date"))
    return cal.days_to_update(_workdays(spark, sf), loaded, AS_OF)


@register("years_to_update", _sql(["fx_daily"], f"""
SELECT DISTINCT y AS year FROM (SELECT CAST(year(max(base_dt)) AS INTEGER) AS y FROM {_LOADED}
                               UNION ALL SELECT {AS_OF.year}) u WHERE y IS NOT NULL
"""))
def q_years_to_update(spark: SparkSession, sf: str) -> DataFrame:
    """Last loaded year and the current year."""
    loaded = _fx(spark, sf, "fx_daily").filter(F.col("base_dt") < F.lit(LOADED_UNTIL).cast("date"))
    return cal.years_to_update(loaded, AS_OF)


@register("quarters_to_update", _sql(["fx_daily", "fx_bs"], _YEARS_SQL + f"""
, wd AS (SELECT base_dt, {_lag_cols()} FROM bdays)
, lastday AS (SELECT max(base_dt) AS d FROM bdays
              WHERE base_dt > (SELECT max(base_dt) FROM {_LOADED}) AND base_dt <= DATE '{_CUTOFF}')
SELECT DISTINCT fs_q FROM wd
WHERE fs_q >= (SELECT max(fs_q) FROM fx_bs WHERE fs_q <= '{BS_LOADED_UNTIL}')
  AND base_dt <= (SELECT d FROM lastday)
"""))
def q_quarters_to_update(spark: SparkSession, sf: str) -> DataFrame:
    """Published quarters from the last stored statement quarter on, as
    of the last planned day."""
    loaded = _fx(spark, sf, "fx_daily").filter(F.col("base_dt") < F.lit(LOADED_UNTIL).cast("date"))
    bs = _fx(spark, sf, "fx_bs").filter(F.col("fs_q") <= F.lit(BS_LOADED_UNTIL))
    return cal.quarters_to_update(_workdays(spark, sf), bs, loaded, AS_OF)


@register("new_symbols", _sql(["fx_history"], f"""
SELECT DISTINCT sym_cd FROM fx_history
WHERE sym_cd NOT IN (SELECT sym_cd FROM fx_history WHERE info_update < DATE '{SNAPSHOT_DAY}')
"""))
def q_new_symbols(spark: SparkSession, sf: str) -> DataFrame:
    """Symbols in stock_info not in the snapshot taken before the load."""
    h = _fx(spark, sf, "fx_history")
    return cal.new_symbols(h, h.filter(F.col("info_update") < F.lit(SNAPSHOT_DAY).cast("date")))


# --------------------------------------------------------------------------
# Step 11: the growing panel (weekly bars per supplier)
# --------------------------------------------------------------------------

WEEKS = {"ret_5w": 5, "ret_13w": 13, "ret_26w": 26}
_SUPP_CAL = _CAL.replace("fx_daily", "fx_supp_daily")


@register("supp_momentum", _sql(["fx_supp_daily"], _SUPP_CAL + "SELECT num_key, " +
                                ", ".join(_roll_sql(k, n, True) for k, n in WEEKS.items()) + " FROM gp", list(WEEKS)))
def q_supp_momentum(spark: SparkSession, sf: str) -> DataFrame:
    """D17 with windows of 5, 13 and 26 weeks over the supplier panel."""
    return finish(fac.momentum(_fx(spark, sf, "fx_supp_daily"), WEEKS), list(WEEKS))


@register("supp_rolling_product", _sql(["fx_supp_daily"], _SUPP_CAL + "SELECT num_key, " +
                                       _roll_sql("p5", 5, False) + " FROM gp", ["p5"]))
def q_supp_rolling(spark: SparkSession, sf: str) -> DataFrame:
    """W4 over the supplier panel, blocks of 64 weeks."""
    daily = _fx(spark, sf, "fx_supp_daily")
    p = daily.select("num_key", "sym_cd", "base_dt", F.try_divide(F.col("close"), F.col("base_p")).alias("g"))
    p = p.join(bounded_broadcast(market_calendar(daily)), "base_dt")
    return finish(rolling(p, "g", {"p5": 5}, ["sym_cd"], "t", "product", block=64).select("num_key", "p5"), ["p5"])


@register("supp_adjusted_close", _sql(["fx_supp_daily"], _adj_sql("fx_supp_daily") +
                                      "SELECT sym_cd, base_dt, close_adj AS close FROM adj", ["close"], 4))
def q_supp_adjusted(spark: SparkSession, sf: str) -> DataFrame:
    """D22 over the supplier panel."""
    d = _fx(spark, sf, "fx_supp_daily").select("sym_cd", "base_dt", "open", "high", "low", "close", "base_p")
    return finish(prc.adjust_prices(d, close_only=True), ["close"], 4)


@register("supp_lookback", _sql(["fx_supp_daily"], """
SELECT d.* FROM fx_supp_daily d JOIN (SELECT sym_cd, max(base_dt) AS last FROM fx_supp_daily GROUP BY sym_cd) m
  ON m.sym_cd = d.sym_cd WHERE d.base_dt >= m.last - INTERVAL 6 MONTH
"""))
def q_supp_lookback(spark: SparkSession, sf: str) -> DataFrame:
    """F9 over the supplier panel."""
    return prc.recent_prices(_fx(spark, sf, "fx_supp_daily"), "6m")


@register("supp_upsert", _sql(["fx_supp_daily"], f"""
, t AS (SELECT num_key, close, mkt_cap FROM fx_supp_daily WHERE base_dt < DATE '{SPLIT_DAY}')
, s AS (SELECT num_key, mkt_cap * 2 AS mkt_cap FROM fx_supp_daily WHERE base_dt >= DATE '{PANEL_START}')
SELECT coalesce(t.num_key, s.num_key) AS num_key, t.close,
       CASE WHEN s.num_key IS NULL THEN t.mkt_cap ELSE s.mkt_cap END AS mkt_cap
FROM t FULL OUTER JOIN s ON s.num_key = t.num_key
"""))
def q_supp_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """S3 over the supplier panel: kept, updated and inserted rows."""
    d = _fx(spark, sf, "fx_supp_daily")
    target = d.filter(F.col("base_dt") < F.lit(SPLIT_DAY).cast("date")).select("num_key", "close", "mkt_cap")
    source = d.filter(F.col("base_dt") >= F.lit(PANEL_START).cast("date")).select(
        "num_key", (F.col("mkt_cap") * 2).alias("mkt_cap"))
    return sinks.upsert_partial(target, source, ["num_key"])


# --------------------------------------------------------------------------
# Step 12: stored loads, read back
# --------------------------------------------------------------------------

def _store(spark: SparkSession) -> EquityStore:
    """An empty store in the shared folder."""
    return EquityStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/store-{uuid.uuid4().hex}")


def _landed(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return dict(base=_fx(spark, sf, "fx_base_price"), excluded=_fx(spark, sf, "fx_excluded"),
                sectors=_fx(spark, sf, "fx_sectors"), vendor=_fx(spark, sf, "fx_vendor"),
                members=_fx(spark, sf, "fx_members"), index_base=_fx(spark, sf, "fx_index_base"))


def _listed_on(listing: DataFrame, *days: str) -> DataFrame:
    """The listing as landed on each of ``days``."""
    return listing.withColumn("base_dt", F.explode(F.array(*[F.lit(d).cast("date") for d in days])))


_STORED = f"""
, typed AS (
  SELECT p.ISU_SRT_CD AS sym_cd, {_pn('p.ACC_TRDVOL')} AS trd_vol, {_pn('p.ACC_TRDVAL')} AS trd_val,
         {_pn('p.TDD_OPNPRC')} AS open, {_pn('p.TDD_HGPRC')} AS high,
         {_pn('p.TDD_LWPRC')} AS low, {_pn('p.TDD_CLSPRC')} AS close,
         nullif({_pn('b.BAS_PRC')}, 1) AS base_p, p.ISU_ABBRV AS sym_nm, p.MKT_ID AS mkt_cd
  FROM fx_listing p LEFT JOIN fx_base_price b ON b.ISU_SRT_CD = p.ISU_SRT_CD
  WHERE p.ISU_SRT_CD IS NOT NULL)
, landed AS (
  SELECT d.base_dt, d.corrected, t.*, {_sector_case('s.IDX_IND_NM')} AS sec_krx,
         v.net_buy_fi, v.mkt_cap, v.num_stock_o, v.num_stock_t, v.sec_fn_1, v.sec_fn_2, v.sec_fn_3
  FROM typed t
  CROSS JOIN (VALUES (DATE '{LAND_DAYS[0]}', 0), (DATE '{LAND_DAYS[1]}', 1), (DATE '{LAND_DAYS[2]}', 1)) d(base_dt, corrected)
  LEFT JOIN fx_sectors s ON s.ISU_SRT_CD = t.sym_cd
  LEFT JOIN fx_vendor v ON v.sym_cd = t.sym_cd AND v.base_dt = d.base_dt
  WHERE t.mkt_cd <> 'KNX' AND t.sym_cd LIKE '%0' AND t.sym_cd NOT LIKE '9%'
    AND t.sym_nm NOT LIKE '%스팩%' AND t.base_p IS NOT NULL
    AND t.sym_cd NOT IN (SELECT ISU_SRT_CD FROM fx_excluded))
, versions AS (
  SELECT sym_cd, min(base_dt) AS info_update FROM landed
  GROUP BY sym_cd, sym_nm, mkt_cd, sec_krx, sec_fn_1, sec_fn_2, sec_fn_3)
SELECT row_number() OVER (ORDER BY l.base_dt, l.sym_cd) AS num_key, l.base_dt, l.sym_cd, trd_vol, trd_val, open, high,
       low, CASE WHEN corrected = 1 THEN high ELSE close END AS close, base_p, net_buy_fi, mkt_cap, num_stock_o,
       num_stock_t, (SELECT max(v.info_update) FROM versions v
                     WHERE v.sym_cd = l.sym_cd AND v.info_update <= l.base_dt) AS info_update
FROM landed l
"""


@register("store_reload", _sql(["fx_listing", "fx_base_price", "fx_excluded", "fx_sectors", "fx_vendor"], _STORED))
def q_store_reload(spark: SparkSession, sf: str) -> DataFrame:
    """D6 stored: two days landed, then the second again with corrected
    closes beside a third, every listing twice; read back."""
    store = _store(spark)
    listing, landed = _fx(spark, sf, "fx_listing"), _landed(spark, sf)
    levels = _fx(spark, sf, "fx_index_levels")
    store.load_daily(_listed_on(listing, *LAND_DAYS[:2]), levels=levels, **landed)
    corrected = _listed_on(listing.withColumn("TDD_CLSPRC", F.col("TDD_HGPRC")), *LAND_DAYS[1:])
    store.load_daily(corrected.unionByName(corrected), levels=levels, **landed)
    return store.require("stock_daily")


@register("store_index_daily", _sql(["fx_index_levels", "fx_index_base", "fx_index_raw"], _INDEX_CTE + """
SELECT base_dt, idx_code, trd_vol, trd_val, open, high, low, close, base_p FROM (
  SELECT *, row_number() OVER (PARTITION BY base_dt, idx_code
    ORDER BY trd_vol DESC, trd_val DESC, open DESC, high DESC, low DESC, close DESC, base_p DESC) AS rn
  FROM ix WHERE idx_code IS NOT NULL) k WHERE rn = 1
"""))
def q_store_index(spark: SparkSession, sf: str) -> DataFrame:
    """D10 stored, without landed prices: levels up to a day, then all of
    them twice; one row per key, none without an index code."""
    store = _store(spark)
    store.refresh_index_list(_fx(spark, sf, "fx_index_raw"))
    none = _listed_on(_fx(spark, sf, "fx_listing"), LAND_DAYS[0]).filter(F.lit(False))
    levels, landed = _fx(spark, sf, "fx_index_levels"), _landed(spark, sf)
    store.load_daily(none, levels=levels.filter(F.col("base_dt") < F.lit(SPLIT_DAY).cast("date")), **landed)
    store.load_daily(none, levels=levels.unionByName(levels), **landed)
    return store.require("index_daily")


@register("store_factors", _sql(_VF_FIX, _FACTOR_TABLE + "SELECT * FROM ft", list(MOM)))
def q_store_factors(spark: SparkSession, sf: str) -> DataFrame:
    """D15-D17 stored: factors up to a day, then from it on, into the
    existing table; ranged momentum equals that of the whole history."""
    store = _store(spark)
    daily = _fx(spark, sf, "fx_daily")
    bs, pl = _stmt_inputs(spark, sf)
    store.upsert("stock_daily", daily.withColumn("info_update", F.col("base_dt")))
    store.upsert("stock_cons", _fx(spark, sf, "fx_cons"))
    store.upsert("workdays", _fx(spark, sf, "fx_workdays"))
    store.upsert("company_fs_bs", bs)
    store.upsert("company_fs_pl_prep", st.trailing_pl(st.complete_grid(bs, "sym_cd", "fs_q", pl.drop("dpr", "prop_div"))))
    before = _dt.date.fromisoformat(SPLIT_DAY) - _dt.timedelta(days=1)
    store.refresh_factors(end=before.isoformat())
    store.refresh_factors(start=SPLIT_DAY)
    return finish(store.require("factor_daily"), list(MOM))


@register("store_delete", _sql(["fx_supp_daily"], f"""
SELECT * FROM fx_supp_daily
WHERE NOT (year(base_dt) = {GONE_YEAR} OR (base_dt >= DATE '{VIEW_START}' AND year(base_dt) = {PART_GONE_YEAR}
                                           AND coalesce(close < open, FALSE)))
"""))
def q_store_delete(spark: SparkSession, sf: str) -> DataFrame:
    """S4 stored: the supplier panel written, a whole year and part of another
    deleted, a third delete that hits nothing; read back."""
    store = _store(spark)
    store.upsert("stock_daily", _fx(spark, sf, "fx_supp_daily"))
    store.delete("stock_daily", F.lit(True), start=f"{GONE_YEAR}-01-01", end=f"{GONE_YEAR}-12-31")
    store.delete("stock_daily", (F.col("close") < F.col("open")) & (F.col("base_dt") >= F.lit(VIEW_START).cast("date")),
                 start=f"{PART_GONE_YEAR}-01-01", end=f"{PART_GONE_YEAR}-12-31")
    store.delete("stock_daily", F.col("sym_cd").isNull())
    return store.require("stock_daily")


@register("store_members", _sql(["fx_daily", "fx_members"], """
SELECT DISTINCT d.num_key, m.idx_code FROM fx_daily d JOIN fx_members m ON m.base_dt = d.base_dt AND m.sym_cd = d.sym_cd
"""))
def q_store_members(spark: SparkSession, sf: str) -> DataFrame:
    """D9 stored: index membership landed three times, each row twice."""
    store = _store(spark)
    daily, members = _fx(spark, sf, "fx_daily"), _fx(spark, sf, "fx_members")
    rows = ing.stocks_in_index(daily, members.unionByName(members), ordered=False)
    for _ in range(3):
        store.upsert("stocks_in_index", rows, daily.select("num_key", "base_dt"))
    return store.require("stocks_in_index")


_STATEMENTS = _cs_typed_sql() + f"""
, sbs AS (SELECT sym_cd, fs_q FROM cs WHERE {" OR ".join(c + " IS NOT NULL" for c in _BS_ITEMS)})
, spl AS (SELECT sym_cd, fs_q, {", ".join(_PL_META)} FROM cs WHERE {" OR ".join(c + " IS NOT NULL" for c in _PL_META)})
, sgrid AS (SELECT s.sym_cd, q.fs_q, {", ".join("p." + x for x in _PL_ITEMS)}
            FROM (SELECT DISTINCT sym_cd FROM sbs) s CROSS JOIN (SELECT DISTINCT fs_q FROM sbs) q
            LEFT JOIN spl p ON p.sym_cd = s.sym_cd AND p.fs_q = q.fs_q)
"""


@register("store_statements", _sql(["fx_cs_raw"], _STATEMENTS + _tp_sql("sgrid") + "SELECT * FROM tpf"))
def q_store_statements(spark: SparkSession, sf: str) -> DataFrame:
    """D11 + D13 stored: statements up to a quarter, one symbol's wrong; that
    symbol corrected; the later quarters; each export twice.  Read back the
    trailing P&L, which only ever recomputed what a load reached."""
    store, meta = _store(spark), item_metadata(spark)
    export = cross_section(_fx(spark, sf, "fx_cs_raw"), meta, "fs", F.col("period"))
    quarters = export.select("fs_q").distinct()
    first, later = export.filter(F.col("fs_q") <= BS_LOADED_UNTIL), export.filter(F.col("fs_q") > BS_LOADED_UNTIL)
    one = F.col("sym_cd") == export.agg(F.min("sym_cd")).scalar()
    wrong = across(first, _PL_ITEMS, lambda c: F.when(one, c * 3).otherwise(c))
    for landed in (wrong, first.filter(one), later):
        store.load_statements(landed.unionByName(landed), meta, quarters)
    return store.require("company_fs_pl_prep")


@register("store_workdays", SQL["business_calendar"])
def q_store_workdays(spark: SparkSession, sf: str) -> DataFrame:
    """D1 + S5 stored: all years, then the later ones replaced; read back."""
    store = _store(spark)
    years = read_parquet(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year")).distinct()
    for some in (years, years.filter(F.col("year") >= PART_GONE_YEAR)):
        store.refresh_workdays(some, cal.fixed_holidays(some))
    return store.require("workdays")


@register("store_panel", _sql(_VF_FIX, _FACTOR_TABLE + f"""
SELECT d.num_key, d.base_dt, d.sym_cd, {", ".join("ft." + c for c in _VF + list(MOM))}
FROM fx_daily d LEFT JOIN ft ON ft.num_key = d.num_key WHERE d.base_dt >= DATE '{PANEL_START}'
""", list(MOM)))
def q_store_panel(spark: SparkSession, sf: str) -> DataFrame:
    """D18 stored: the panel over a stored daily and a stored factor table,
    only the years of the panel read from either."""
    store = _store(spark)
    daily = _fx(spark, sf, "fx_daily")
    store.upsert("stock_daily", daily)
    store.upsert("factor_daily", _factor_table(spark, sf), daily.select("num_key", "base_dt"), unique=True)
    return finish(fac.factor_panel(store.require("stock_daily", PANEL_START), store.require("factor_daily", PANEL_START),
                                   start=PANEL_START), list(MOM))


@register("store_by_key", SQL["store_panel"])
def q_store_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """D18 stored: the panel from copies bucketed by num_key.  The factors
    change after the first copies, so that some years are copied again."""
    store = _store(spark)
    daily, factors = _fx(spark, sf, "fx_daily"), _factor_table(spark, sf)
    days = daily.select("num_key", "base_dt")
    late = days.filter(F.col("base_dt") >= F.lit(PANEL_START).cast("date"))
    store.upsert("stock_daily", daily)
    store.upsert("factor_daily", factors.withColumn(_VF[0], F.lit(-1.0)), late, unique=True)
    store.upsert("factor_daily", factors, days.join(late, "num_key", "left_anti"), unique=True)
    store.co_locate()
    store.upsert("factor_daily", factors, late, unique=True)
    store.co_locate()
    return finish(fac.factor_panel(store.by_key("stock_daily", PANEL_START), store.by_key("factor_daily", PANEL_START),
                                   start=PANEL_START), list(MOM))


@register("store_plan", SQL["days_to_update"])
def q_store_plan(spark: SparkSession, sf: str) -> DataFrame:
    """D2 stored: trading days after the last stored one, which the daily
    table's footers tell."""
    store = _store(spark)
    store.upsert("stock_daily", _fx(spark, sf, "fx_daily").filter(F.col("base_dt") < F.lit(LOADED_UNTIL).cast("date")))
    store.upsert("workdays", _workdays(spark, sf))
    return store.update_plan(AS_OF)["days"]


# --------------------------------------------------------------------------
# Step 13: landed text and typed payloads
# --------------------------------------------------------------------------

_EXPORT_COLS = ["sym_cd", "period", *_CS_NUM, "memo"]


def _text_export(spark: SparkSession, sf: str):
    """The vendor cross section as text files with a header each, every
    second quarter's lines also broken: cut short, too long, without a key."""
    raw = _fx(spark, sf, "fx_cs_raw")
    whole = raw.select(F.to_csv(F.struct(*_EXPORT_COLS)).alias("value"))
    odd = raw.filter(F.col("period").endswith("1") | F.col("period").endswith("3"))
    broken = odd.select(F.explode(F.array(
        F.concat_ws(",", "sym_cd", "period"),
        F.concat_ws(",", "sym_cd", "period", F.lit(",".join("x" * len(_EXPORT_COLS)))),
        F.concat(F.lit(","), F.col("period"), F.lit("," * (len(_EXPORT_COLS) - 2))))).alias("value"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/export-{uuid.uuid4().hex}"
    headers = spark.range(4).select(F.lit(",".join(_EXPORT_COLS)).alias("value"))
    whole.unionByName(broken).unionByName(headers).write.text(path)
    return read_export(spark, path, _EXPORT_COLS, ["sym_cd", "period"])


@register("vendor_text", SQL["vendor_cross_section"])
def q_vendor_text(spark: SparkSession, sf: str) -> DataFrame:
    """S7 from landed text with broken lines in it: the rows that fit."""
    return cross_section(_text_export(spark, sf).rows, item_metadata(spark), "fs", F.col("period"))


@register("vendor_quarantine", _sql(["fx_cs_raw"], f"""
, odd AS (SELECT sym_cd, period FROM fx_cs_raw WHERE period LIKE '%1' OR period LIKE '%3')
SELECT sym_cd || ',' || period AS line, 'fields' AS reason FROM odd
UNION ALL SELECT sym_cd || ',' || period || ',{",".join("x" * len(_EXPORT_COLS))}', 'fields' FROM odd
UNION ALL SELECT ',' || period || '{"," * (len(_EXPORT_COLS) - 2)}', 'key' FROM odd
"""))
def q_vendor_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """The lines that do not fit, each with its reason."""
    return _text_export(spark, sf).quarantine.select("line", "reason")


@register("json_variant", _sql(["fx_daily"], """
SELECT sym_cd, CAST(year(base_dt) AS INTEGER) AS y, num_key, base_dt, close, trd_vol, CASE WHEN close > open THEN 'up' END AS mark,
       CAST(num_key * 2 AS BIGINT) AS second
FROM fx_daily
"""))
def q_json_variant(spark: SparkSession, sf: str) -> DataFrame:
    """S6 on nested, numeric and missing fields: one payload per symbol and
    year, its records under the first key and other keys beside it."""
    d = _fx(spark, sf, "fx_daily")
    record = F.struct("num_key", F.struct(F.col("base_dt").cast("string").alias("day"), "close").alias("px"), "trd_vol",
                      F.when(F.col("close") > F.col("open"), "up").alias("mark"),
                      F.array(F.col("num_key"), F.col("num_key") * 2).alias("lots"))
    payload = d.groupBy("sym_cd", F.year("base_dt").alias("y")).agg(F.collect_list(record).alias("r")).select(
        "sym_cd", "y", F.to_json(F.struct(F.col("r").alias("output"), F.lit("2024").alias("asOf"),
                                          F.array(F.lit(1)).alias("aside"))).alias("payload"))
    return explode_variant(payload, {"num_key": ("$.num_key", "bigint"), "base_dt": ("$.px.day", "date"),
                                     "close": ("$.px.close", "double"), "trd_vol": ("$.trd_vol", d.schema["trd_vol"].dataType.simpleString()),
                                     "mark": ("$.mark", "string"), "second": ("$.lots[1]", "bigint")}, keep=["sym_cd", "y"])


# --------------------------------------------------------------------------

def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Momentum with a one-week window added (so the smallest scale has
    non-NULL values) for every stock_daily row."""
    windows = {"ret_1w": 5, **MOM}
    return finish(fac.momentum(_fx(spark, sf, "fx_daily"), windows), list(windows))
