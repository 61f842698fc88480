"""Stand-in inputs built from the driver's TPC-H-like tables (FIXTURES.md B).

Each fixture is one dialect-neutral SELECT.  Spark runs it with
``spark.sql`` directly over the parquet files; the DuckDB oracle inlines the
same text as a CTE over its pre-registered views, so both engines see the
same rows.  Fixtures only *shape* rows into the reference's table schemas
(stock_daily, company_fs_pl, ...); every operator under test runs in the
library on top of them.

Only two things differ per dialect: how a source table is named, and how an
integer is printed with thousands separators (``{commas:expr}``).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from equiframe.functions.text import SECTOR_RECODE

SOURCE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

# Text the fixtures draw from: the vendor's quarter labels, the KRX industry
# names of the library's fixed recode table (plus one name it does not map),
# and index market names.
QUARTER_LABELS = ["1st-Quarter", "Semi-Annual", "3rd-Quarter", "Annual"]
KRX_INDUSTRIES = [*SECTOR_RECODE, "기타업종"]
INDEX_MARKETS = ["KRX", "KOSPI", "KOSDAQ", "테마", "KRX 테마"]


def _case_list(expr: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


# name -> (sql template, fixture dependencies)
_FIXTURES: dict[str, tuple[str, list[str]]] = {}


def _fx(name: str, deps: list[str], sql: str) -> None:
    _FIXTURES[name] = (sql, deps)


# --- stock_daily: weekly bars per nation (sym_cd = nation key) -------------
_BARS = """
SELECT sym_cd, nation, base_dt,
       sum(qty) AS trd_vol, round(sum(ext), 2) AS trd_val,
       min_by(lo, ts) AS open, max(hi) AS high, min(lo) AS low, max_by(hi, ts) AS close
FROM (
  SELECT sym_cd, nation, base_dt, ts, sum(qty) AS qty, sum(ext) AS ext, min(px) AS lo, max(px) AS hi
  FROM (
    SELECT {sym} AS sym_cd, {nation} AS nation,
           CAST(date_trunc('{unit}', l.l_shipdate) AS DATE) AS base_dt, l.l_shipdate AS ts,
           l.l_extendedprice / l.l_quantity + CAST(0.01370003 AS DOUBLE) AS px,
           l.l_quantity AS qty, l.l_extendedprice AS ext
    FROM {lineitem} l {join}
  ) x
  GROUP BY sym_cd, nation, base_dt, ts
) y
GROUP BY sym_cd, nation, base_dt
"""

_DAILY = """
SELECT num_key, base_dt, sym_cd, trd_vol, trd_val, open, high, low, close,
       CASE WHEN (rn + nation) % 97 = 0 THEN prev_close * CAST(0.7391 AS DOUBLE)
            ELSE prev_close END AS base_p,
       net_buy_fi, close * num_stock_o AS mkt_cap, num_stock_o, num_stock_t
FROM (
  SELECT b.*,
         CAST(year(base_dt) * 10000 + month(base_dt) * 100 + day(base_dt) AS BIGINT) * {keymul}
           + nation AS num_key,
         row_number() OVER (PARTITION BY sym_cd ORDER BY base_dt) AS rn,
         coalesce(lag(close) OVER (PARTITION BY sym_cd ORDER BY base_dt), close) AS prev_close,
         CAST(1000 + 10 * (nation % 100) AS DOUBLE) AS num_stock_o,
         CAST(1000 + 10 * (nation % 100) + 100 * (nation % 3) AS DOUBLE) AS num_stock_t,
         trd_vol * CAST((nation % 5) - 2 AS DOUBLE) AS net_buy_fi
  FROM ({bars}) b
) c
"""

_fx("fx_daily", [], _DAILY.replace("{keymul}", "100").replace("{bars}", _BARS.format(
    sym="CAST(s.s_nationkey AS STRING)", nation="s.s_nationkey", unit="week",
    lineitem="{lineitem}", join="JOIN {supplier} s ON l.l_suppkey = s.s_suppkey")))

# Larger panel for the statement-free operators in the bench: daily bars per
# part (sym_cd = part key).
_fx("fx_part_daily", [], _DAILY.replace("{keymul}", "10000000").replace("{bars}", _BARS.format(
    sym="CAST(l.l_partkey AS STRING)", nation="l.l_partkey", unit="day",
    lineitem="{lineitem}", join="")))

# Supplier panel: weekly bars per supplier (sym_cd = supplier key); its rows
# grow with the scale factor.
_fx("fx_supp_daily", [], _DAILY.replace("{keymul}", "10000000").replace("{bars}", _BARS.format(
    sym="CAST(l.l_suppkey AS STRING)", nation="l.l_suppkey", unit="week",
    lineitem="{lineitem}", join="")))

# --- stock_cons: consensus items keyed by num_key ---------------------------
_fx("fx_cons", ["fx_daily"], """
SELECT num_key,
       CASE WHEN num_key % 7 = 0 THEN NULL ELSE close * CAST(4.0 AS DOUBLE) END AS sales_12mf,
       close * CAST(0.6 AS DOUBLE) AS opr_prof_12mf,
       close * CAST(0.45 AS DOUBLE) AS earn_12mf,
       CASE WHEN num_key % 3 = 0 THEN NULL ELSE close * CAST(0.4 AS DOUBLE) END AS earn_dom_12mf,
       close * CAST(0.9 AS DOUBLE) AS bps_12mf,
       close * CAST(0.05 AS DOUBLE) AS eps_down_fy2
FROM fx_daily
""")

# --- workdays: the trading calendar of fx_daily with the report lag ---------
_fx("fx_workdays", ["fx_daily"], """
SELECT base_dt,
       CAST(year(lagged) AS STRING) || ' Q' || CAST(quarter(lagged) AS STRING) AS fs_q,
       CAST(year(base_dt - INTERVAL 15 MONTH) AS INT) AS fs_y
FROM (
  SELECT base_dt,
         CASE WHEN month(base_dt) = 3 THEN base_dt - INTERVAL 6 MONTH
              ELSE base_dt - INTERVAL 5 MONTH END AS lagged
  FROM (SELECT DISTINCT base_dt FROM fx_daily) d
) w
""")

# --- quarterly order sums per customer nation (statement source) ------------
_fx("fx_orders_q", [], """
SELECT nation, y, q, all_c, f_c,
       sum(all_c) OVER (PARTITION BY nation, y ORDER BY q
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ytd_all,
       sum(f_c) OVER (PARTITION BY nation, y ORDER BY q
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ytd_f
FROM (
  SELECT c.c_nationkey AS nation, CAST(year(o.o_orderdate) AS INT) AS y,
         CAST(quarter(o.o_orderdate) AS INT) AS q,
         CAST(round(sum(o.o_totalprice) * 100, 0) AS BIGINT) AS all_c,
         CAST(round(sum(CASE WHEN o.o_orderstatus = 'F' THEN o.o_totalprice
                             ELSE CAST(0 AS DOUBLE) END) * 100, 0) AS BIGINT) AS f_c
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
  GROUP BY c.c_nationkey, year(o.o_orderdate), quarter(o.o_orderdate)
) g
""")

# --- company_fs_pl: year-to-date P&L items ----------------------------------
_fx("fx_pl", ["fx_orders_q"], """
SELECT CAST(nation AS STRING) AS sym_cd,
       CAST(y AS STRING) || ' Q' || CAST(q AS STRING) AS fs_q,
       CAST(ytd_all AS DOUBLE) / 100 AS sales,
       CASE WHEN ytd_f = 0 THEN NULL ELSE CAST(ytd_f AS DOUBLE) / 100 END AS opr_prof,
       CAST(ytd_all AS DOUBLE) / 100 * CAST(0.25 AS DOUBLE) AS earn,
       CASE WHEN nation % 3 = 0 THEN NULL
            ELSE CAST(ytd_all AS DOUBLE) / 100 * CAST(0.2 AS DOUBLE) END AS earn_dom,
       CASE WHEN (nation + y + q) % 7 = 0 THEN NULL
            ELSE CAST(ytd_all AS DOUBLE) / 100 * CAST(0.35 AS DOUBLE) END AS op_cash_flow,
       CAST(ytd_all AS DOUBLE) / 100 * CAST(0.15 AS DOUBLE) AS cash_flow,
       CAST(ytd_all AS DOUBLE) / 100 * CAST(0.05 AS DOUBLE) AS dpr,
       CAST(ytd_all AS DOUBLE) / 100 * CAST(0.02 AS DOUBLE) AS prop_div
FROM fx_orders_q
""")

# --- company_fs_bs: balance-sheet items on the same grid --------------------
_fx("fx_bs", ["fx_orders_q"], """
SELECT CAST(nation AS STRING) AS sym_cd,
       CAST(y AS STRING) || ' Q' || CAST(q AS STRING) AS fs_q,
       CAST(all_c AS DOUBLE) / 100 * CAST(2.5 AS DOUBLE) AS grs_asset,
       CASE WHEN (nation + q) % 5 = 0 THEN NULL
            ELSE CAST(all_c AS DOUBLE) / 100 * CAST(0.5 AS DOUBLE) END AS cap,
       CASE WHEN (nation + q) % 5 = 0 THEN NULL
            ELSE CAST(all_c AS DOUBLE) / 100 * CAST(1.2 AS DOUBLE) END AS net_asset
FROM fx_orders_q
""")

# --- vendor daily items per (customer nation, order week) -------------------
_VENDOR_ITEMS = """
SELECT base_dt, sym_cd,
       CASE WHEN n % 5 = 0 THEN '관리' ELSE '정상' END AS sym_mng,
       CASE WHEN n % 7 = 0 THEN '정지' WHEN n % 11 = 0 THEN NULL ELSE '정상' END AS sym_stop,
       CASE WHEN n % 3 = 0 AND lowp > 0 THEN '환기' ELSE '정상' END AS sym_reg,
       seg_hi AS sec_fn_1, seg_lo AS sec_fn_2,
       CASE WHEN n % 2 = 0 THEN NULL ELSE seg_hi END AS sec_fn_3,
       fin - CAST(tot_c AS DOUBLE) / 100 AS net_buy_fi,
       CAST(tot_c AS DOUBLE) / 100 * CAST(0.01 AS DOUBLE) AS mkt_cap,
       CAST(1000 + 10 * nation AS DOUBLE) AS num_stock_o,
       CAST(1000 + 10 * nation + 100 * (nation % 3) AS DOUBLE) AS num_stock_t,
       CASE WHEN n % 4 = 0 THEN NULL ELSE CAST(tot_c AS DOUBLE) / 100 * CAST(1.1 AS DOUBLE) END AS sales_12mf,
       CASE WHEN n % 4 = 0 THEN NULL ELSE CAST(tot_c AS DOUBLE) / 100 * CAST(0.2 AS DOUBLE) END AS opr_prof_12mf,
       CASE WHEN n % 4 = 0 THEN NULL ELSE CAST(tot_c AS DOUBLE) / 100 * CAST(0.1 AS DOUBLE) END AS earn_12mf,
       CASE WHEN n % 4 = 0 OR n % 3 = 0 THEN NULL
            ELSE CAST(tot_c AS DOUBLE) / 100 * CAST(0.09 AS DOUBLE) END AS earn_dom_12mf,
       CASE WHEN n % 4 = 0 THEN NULL ELSE CAST(tot_c AS DOUBLE) / 100 * CAST(0.5 AS DOUBLE) END AS bps_12mf,
       CASE WHEN n % 4 = 0 OR n % 2 = 0 THEN NULL ELSE CAST(n AS DOUBLE) END AS eps_down_fy2
FROM ({inner}) v
"""

# vendor items per (customer nation, order week): its grid differs from
# fx_daily's, so some vendor rows have no stock_daily row
_fx("fx_vendor", [], _VENDOR_ITEMS.replace("{inner}", """
  SELECT CAST(date_trunc('week', o.o_orderdate) AS DATE) AS base_dt,
         CAST(c.c_nationkey AS STRING) AS sym_cd, c.c_nationkey AS nation,
         count(*) AS n,
         CAST(round(sum(o.o_totalprice) * 100, 0) AS BIGINT) AS tot_c,
         round(sum(CASE WHEN o.o_orderstatus = 'F' THEN o.o_totalprice
                        ELSE CAST(0 AS DOUBLE) END), 2) AS fin,
         sum(CASE WHEN o.o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) AS lowp,
         max(c.c_mktsegment) AS seg_hi, min(c.c_mktsegment) AS seg_lo
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
  GROUP BY CAST(date_trunc('week', o.o_orderdate) AS DATE), c.c_nationkey
"""))

# vendor daily export (all text, 'A'-prefixed codes)
_fx("fx_vendor_raw", ["fx_vendor"], """
SELECT 'A' || sym_cd AS sym_cd, base_dt, sym_mng, sym_stop, sym_reg,
       {commas:CAST(round(net_buy_fi * 100, 0) AS BIGINT)} AS net_buy_fi,
       {commas:CAST(round(mkt_cap * 100, 0) AS BIGINT)} AS mkt_cap,
       CASE WHEN bps_12mf IS NULL THEN 'N/A' ELSE {commas:CAST(round(bps_12mf, 0) AS BIGINT)} END AS bps_12mf,
       CASE WHEN eps_down_fy2 IS NULL THEN '' ELSE {commas:CAST(eps_down_fy2 AS BIGINT)} END AS eps_down_fy2
FROM fx_vendor
""")

# --- stock_info history: attributes per (nation, ship date) -----------------
_fx("fx_history", [], """
SELECT CAST(s.s_nationkey AS STRING) AS sym_cd, CAST(l.l_shipdate AS DATE) AS info_update,
       'N' || CAST(s.s_nationkey AS STRING) || '-' || max(l.l_returnflag) AS sym_nm,
       max(l.l_linestatus) AS mkt_cd,
       CASE WHEN max(l.l_returnflag) = 'R' THEN NULL
            ELSE 'SEC-' || substr(CAST(year(l.l_shipdate) AS STRING), 1, 3) || min(l.l_returnflag) END AS sec_krx
FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
GROUP BY s.s_nationkey, CAST(l.l_shipdate AS DATE), year(l.l_shipdate)
""")

# --- raw exchange listing (all text) ----------------------------------------
_fx("fx_listing", [], """
SELECT CASE WHEN p_partkey % 53 = 0 THEN NULL ELSE CAST(p_partkey AS STRING) END AS ISU_SRT_CD,
       {commas:CAST(p_size * 1013 + p_partkey % 7 AS BIGINT)} AS ACC_TRDVOL,
       {commas:CAST(round(p_retailprice * 100, 0) AS BIGINT) * p_size} AS ACC_TRDVAL,
       {commas:CAST(round(p_retailprice * 100, 0) AS BIGINT) - p_size} AS TDD_OPNPRC,
       {commas:CAST(round(p_retailprice * 100, 0) AS BIGINT) + 3 * p_size} AS TDD_HGPRC,
       {commas:CAST(round(p_retailprice * 100, 0) AS BIGINT) - 2 * p_size} AS TDD_LWPRC,
       CASE WHEN p_partkey % 29 = 0 THEN '-'
            ELSE {commas:CAST(round(p_retailprice * 100, 0) AS BIGINT)} END AS TDD_CLSPRC,
       CASE WHEN p_size % 13 = 0 THEN p_name || ' 스팩' ELSE p_name END AS ISU_ABBRV,
       CASE p_size % 4 WHEN 0 THEN 'KNX' WHEN 1 THEN 'STK' ELSE 'KSQ' END AS MKT_ID
FROM {part}
""")

_fx("fx_base_price", [], """
SELECT CAST(p_partkey AS STRING) AS ISU_SRT_CD,
       CASE WHEN p_size = 1 THEN '1'
            ELSE {commas:CAST(round(p_retailprice * 100, 0) AS BIGINT) - 7} END AS BAS_PRC
FROM {part}
""")

_fx("fx_excluded", [], """
SELECT CAST(p_partkey AS STRING) AS ISU_SRT_CD FROM {part} WHERE p_brand = 'Brand#13'
""")

_fx("fx_sectors", [], f"""
SELECT CAST(p_partkey AS STRING) AS ISU_SRT_CD,
       {_case_list('p_partkey % 31', KRX_INDUSTRIES)} AS IDX_IND_NM
FROM {{part}}
""")

# --- raw index list: one index per nation, market family by region ---------
_fx("fx_index_raw", [], f"""
SELECT '1' || lpad(CAST(n.n_nationkey AS STRING), 3, '0') AS full_code,
       CASE WHEN n.n_nationkey % 7 = 6 THEN NULL
            ELSE lpad(CAST(n.n_nationkey AS STRING), 3, '0') END AS short_code,
       n.n_name AS codeName,
       lpad(CAST(r.r_regionkey AS STRING), 2, '0') AS marketCode,
       {_case_list('r.r_regionkey % 5', INDEX_MARKETS)} AS marketName
FROM {{nation}} n JOIN {{region}} r ON n.n_regionkey = r.r_regionkey
""")

# index membership per (order week, customer nation): the nation's own index
# and, for every third nation, the index of the next nation as well.
_fx("fx_members", [], """
SELECT DISTINCT base_dt, sym_cd, 'M' || lpad(CAST(member_of AS STRING), 3, '0') AS idx_code
FROM (
  SELECT CAST(date_trunc('week', o.o_orderdate) AS DATE) AS base_dt,
         CAST(c.c_nationkey AS STRING) AS sym_cd, c.c_nationkey AS member_of
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
  UNION ALL
  SELECT CAST(date_trunc('week', o.o_orderdate) AS DATE) AS base_dt,
         CAST(c.c_nationkey AS STRING) AS sym_cd, c.c_nationkey + 1 AS member_of
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
  WHERE c.c_nationkey % 3 = 0
) m
""")

# raw index levels per (ship week, nation) and the index base values
_fx("fx_index_levels", [], """
SELECT base_dt, mkt, IDX_NM,
       {commas:CAST(round(vol, 0) AS BIGINT)} AS ACC_TRDVOL,
       {commas:CAST(val AS BIGINT)} AS ACC_TRDVAL,
       {commas:CAST(pxo AS BIGINT)} AS OPNPRC_IDX,
       {commas:CAST(pxh AS BIGINT)} AS HGPRC_IDX,
       {commas:CAST(pxl AS BIGINT)} AS LWPRC_IDX,
       CASE WHEN n % 9 = 0 THEN '-' ELSE {commas:CAST(pxc AS BIGINT)} END AS CLSPRC_IDX
FROM (
  SELECT CAST(date_trunc('week', l.l_shipdate) AS DATE) AS base_dt,
         '0' || CAST(r.r_regionkey % 4 + 1 AS STRING) AS mkt, k.n_name AS IDX_NM,
         count(*) AS n, sum(l.l_quantity) AS vol, round(sum(l.l_extendedprice), 0) AS val,
         round(min(l.l_extendedprice), 0) AS pxl, round(max(l.l_extendedprice), 0) AS pxh,
         round(avg(l.l_extendedprice), 0) AS pxo, round(sum(l.l_extendedprice) / count(*) + 1, 0) AS pxc
  FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
  JOIN {nation} k ON s.s_nationkey = k.n_nationkey JOIN {region} r ON k.n_regionkey = r.r_regionkey
  GROUP BY CAST(date_trunc('week', l.l_shipdate) AS DATE), r.r_regionkey, k.n_name
) g
""")

_fx("fx_index_base", [], """
SELECT DISTINCT CAST(date_trunc('week', l.l_shipdate) AS DATE) AS base_dt,
       '0' || CAST(r.r_regionkey % 4 + 1 AS STRING) AS mkt, k.n_name AS IDX_IND_NM,
       {commas:CAST(1000 + 10 * k.n_nationkey AS BIGINT)} AS OPN_DD_INDX
FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
JOIN {nation} k ON s.s_nationkey = k.n_nationkey JOIN {region} r ON k.n_regionkey = r.r_regionkey
""")

# --- vendor statement exports (all text, 'A'-prefixed codes) ----------------
# A symbol that reports neither part (no P&L item, no balance-sheet item) has
# only NA tokens there.
_STMT_TEXT = """
       CASE WHEN no_pl OR (all_c % 13) = 0 THEN 'N/A' ELSE {commas:CAST(ytd_all AS BIGINT)} END AS sales,
       CASE WHEN no_pl OR (f_c % 17) = 0 THEN '' ELSE {commas:CAST(ytd_f AS BIGINT)} END AS opr_prof,
       CASE WHEN no_pl THEN 'NA' ELSE {commas:CAST(floor(ytd_all / 4) AS BIGINT)} END AS earn,
       CASE WHEN no_pl OR nation % 3 = 0 THEN 'NULL' ELSE {commas:CAST(floor(ytd_all / 5) AS BIGINT)} END AS earn_dom,
       CASE WHEN no_bs THEN 'NA' ELSE {commas:CAST(all_c * 2 AS BIGINT)} END AS grs_asset,
       CASE WHEN no_bs OR (nation + q) % 5 = 0 THEN 'NaN' ELSE {commas:CAST(all_c AS BIGINT)} END AS net_asset,
       CASE WHEN no_pl OR (nation + y + q) % 7 = 0 THEN 'NA' ELSE {commas:CAST(floor(ytd_f / 2) AS BIGINT)} END AS op_cash_flow,
       CASE WHEN no_pl OR (nation + q + y) % 4 = 0 THEN 'NA' ELSE {commas:CAST(floor(ytd_all / 3) AS BIGINT)} END AS cash_flow,
       'unit-' || CAST(q AS STRING) AS memo
FROM (SELECT *, (nation + y * 4 + q) % 11 = 0 AS no_pl, (nation + y + q) % 9 = 0 AS no_bs FROM fx_orders_q) o
"""
_fx("fx_cs_raw", ["fx_orders_q"], """
SELECT 'A' || CAST(nation AS STRING) AS sym_cd,
       CAST(y AS STRING) || ' Q' || CAST(q AS STRING) AS period,
""" + _STMT_TEXT)

_fx("fx_fb_raw", ["fx_orders_q"], f"""
SELECT 'A' || CAST(nation AS STRING) AS sym_cd, 'x' AS fs_q,
       CAST(q * 3 AS STRING) AS month, CAST(y AS STRING) AS year,
       CASE WHEN q = 2 AND nation % 2 = 1 THEN 'Semi-Quarter'
            ELSE {_case_list('q - 1', QUARTER_LABELS)} END AS quarter,
""" + _STMT_TEXT)

# --- landed web payloads ----------------------------------------------------
# One JSON document per (event type, block of 100 event ids): an object whose
# first key holds an array of flat records, as the exchange's web service
# answers.  Spark-only (the oracle reads the records straight from events);
# every document holds at most 100 records.
_fx("fx_payload", [], """
SELECT event_type, CAST(floor(event_id / 100) AS BIGINT) AS payload_id,
       to_json(named_struct(
         'OutBlock_1', collect_list(named_struct('event_id', event_id, 'user_id', user_id,
                                                 'value', value, 'props', props)),
         'CURRENT_DATETIME', CAST(max(ts) AS STRING))) AS payload
FROM {events}
GROUP BY event_type, CAST(floor(event_id / 100) AS BIGINT)
""")


def _deps(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in _FIXTURES[n][1]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


_COMMAS = re.compile(r"\{commas:([^{}]*)\}")


def _render(sql: str, dialect: str, sf_dir: str | None) -> str:
    if dialect == "spark":
        sql = _COMMAS.sub(lambda m: f"format_number({m.group(1)}, 0)", sql)
        for t in SOURCE_TABLES:
            sql = sql.replace("{" + t + "}", f"parquet.`{sf_dir}/{t}.parquet`")
    else:
        sql = _COMMAS.sub(lambda m: f"format('{{:,}}', {m.group(1)})", sql)
        for t in SOURCE_TABLES:
            sql = sql.replace("{" + t + "}", t)
    return sql


def with_clause(names: list[str], dialect: str = "duckdb", sf_dir: str | None = None) -> str:
    parts = [f"{n} AS ({_render(_FIXTURES[n][0], dialect, sf_dir)})" for n in _deps(names)]
    return "WITH " + ",\n".join(parts)


def oracle(fixtures: list[str], body: str) -> str:
    """DuckDB text: the fixtures as CTEs followed by ``body``.

    ``body`` may continue the WITH list by starting with a comma.
    """
    body = body.strip()
    if not fixtures:
        return "WITH " + body[1:].lstrip() if body.startswith(",") else body
    return with_clause(fixtures, "duckdb") + "\n" + body


# sf_dir -> folder holding materialised fixtures (see ``stage``)
_STAGED: dict[str, str] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture ``name`` as a Spark DataFrame over ``sf_dir`` (read from
    the staged copy when ``stage`` materialised one)."""
    sf_dir = str(sf_dir).rstrip("/")
    staged = _STAGED.get(sf_dir)
    if staged:
        return spark.read.parquet(f"{staged}/{name}")
    return spark.sql(with_clause([name], "spark", sf_dir) + f"\nSELECT * FROM {name}")


def stage(spark: SparkSession, sf_dir: str, out_dir: str, only: list[str] | None = None) -> None:
    """Materialise every fixture of ``sf_dir`` as Parquet under ``out_dir``
    so that later loads read stored tables, as production queries do."""
    for n in only or names():
        load(spark, sf_dir, n).write.mode("overwrite").parquet(f"{out_dir}/{n}")
    _STAGED[str(sf_dir).rstrip("/")] = out_dir



def names() -> list[str]:
    return list(_FIXTURES)
