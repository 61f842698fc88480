"""Explicit schemas of the stored tables.

The reference keeps them only in its database (no DDL); column order
matters because several steps take positional ranges (``a:b``).  Vendor
items beyond those named here come from the item metadata and are appended
by the normalisers.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _DT, _L, _I = T.StringType(), T.DoubleType(), T.DateType(), T.LongType(), T.IntegerType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


WORKDAYS = _schema(("base_dt", _DT), ("fs_q", _S), ("fs_y", _I))

INDEX_LIST = _schema(("full_code", _S), ("idx_code", _S), ("mkt_nm", _S), ("short_code", _S),
                     ("codeName", _S))

STOCK_INFO = _schema(("sym_cd", _S), ("info_update", _DT), ("sym_nm", _S), ("mkt_cd", _S),
                     ("sec_krx", _S), ("sec_fn_1", _S), ("sec_fn_2", _S), ("sec_fn_3", _S))

STOCK_DAILY = _schema(("num_key", _L), ("base_dt", _DT), ("sym_cd", _S), ("trd_vol", _D), ("trd_val", _D),
                      ("open", _D), ("high", _D), ("low", _D), ("close", _D), ("base_p", _D),
                      ("net_buy_fi", _D), ("mkt_cap", _D), ("num_stock_o", _D), ("num_stock_t", _D),
                      ("info_update", _DT))

STOCK_CONS = _schema(("num_key", _L), ("sales_12mf", _D), ("opr_prof_12mf", _D), ("earn_12mf", _D),
                     ("earn_dom_12mf", _D), ("bps_12mf", _D), ("eps_down_fy2", _D))

STOCK_MANAGED = _schema(("num_key", _L), ("type", _I))

STOCKS_IN_INDEX = _schema(("num_key", _L), ("idx_code", _S))

INDEX_DAILY = _schema(("base_dt", _DT), ("idx_code", _S), ("trd_vol", _D), ("trd_val", _D), ("open", _D),
                      ("high", _D), ("low", _D), ("close", _D), ("base_p", _D))

COMPANY_FS_BS = _schema(("sym_cd", _S), ("fs_q", _S), ("grs_asset", _D), ("cap", _D), ("net_asset", _D))

COMPANY_FS_PL = _schema(("sym_cd", _S), ("fs_q", _S), ("sales", _D), ("opr_prof", _D), ("earn", _D),
                        ("earn_dom", _D), ("op_cash_flow", _D), ("cash_flow", _D), ("dpr", _D),
                        ("prop_div", _D))

_PREP_ITEMS = ["sales", "opr_prof", "earn", "op_cash_flow", "cash_flow"]
COMPANY_FS_PL_PREP = _schema(("sym_cd", _S), ("fs_q", _S), *[(f"{x}_a4q", _D) for x in _PREP_ITEMS],
                             *[(f"{x}_n", _D) for x in _PREP_ITEMS])

VALUE_FACTORS = ["inv_per", "inv_por", "inv_psr", "inv_pocr", "inv_pcr", "inv_pbr",
                 "inv_per_12mf", "inv_por_12mf", "inv_psr_12mf", "inv_pbr_12mf"]
MOMENTUM = ["ret_3m", "ret_6m", "ret_12m"]
FACTOR_DAILY = _schema(("num_key", _L), *[(c, _D) for c in VALUE_FACTORS], *[(c, _D) for c in MOMENTUM])

FN_TABLES = _schema(("table", _S), ("item", _S), ("item_kind", _S), ("item_code", _S), ("item_nm", _S),
                    ("item_freq", _S), ("numeric", _I), ("new", _I), ("bs", _I), ("pl", _I))

TABLES: dict[str, T.StructType] = {
    "workdays": WORKDAYS, "index_list": INDEX_LIST, "stock_info": STOCK_INFO, "stock_daily": STOCK_DAILY,
    "stock_cons": STOCK_CONS, "stock_managed": STOCK_MANAGED, "stocks_in_index": STOCKS_IN_INDEX,
    "index_daily": INDEX_DAILY, "company_fs_bs": COMPANY_FS_BS, "company_fs_pl": COMPANY_FS_PL,
    "company_fs_pl_prep": COMPANY_FS_PL_PREP, "factor_daily": FACTOR_DAILY, "fn_tables": FN_TABLES,
}
