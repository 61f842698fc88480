"""Landed exchange and vendor data -> the daily tables.

The reference loads one day per call; every function here takes frames
that may hold any number of days (``base_dt`` is a column), so a backfill is
one job.  Joins are on (base_dt, sym_cd) and shuffle both sides on that
key; the small sides (excluded lists, index lists, partition offsets) are
bounded and broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equiframe.functions.numeric import all_differ_from, any_not_null
from equiframe.functions.text import (MANAGED_NORMAL, MANAGED_TYPE_CODE, MARKET_CODE_LETTER,
                                      market_letters, null_if_equal, parse_number, recode_exact,
                                      sector_recode, unite)
from equiframe.operators.filters import listed_common_shares
from equiframe.operators.keys import assign_keys
from equiframe.operators.reshape import tag, union_by_name, unpivot_columns
from equiframe.operators.windows import as_of_latest

# ---------------------------------------------------------------------------
# Exchange field names -> table columns (same order).
PRICE_FIELDS = ["ISU_SRT_CD", "ACC_TRDVOL", "ACC_TRDVAL", "TDD_OPNPRC", "TDD_HGPRC", "TDD_LWPRC",
                "TDD_CLSPRC", "BAS_PRC", "ISU_ABBRV", "MKT_ID"]
PRICE_COLUMNS = ["sym_cd", "trd_vol", "trd_val", "open", "high", "low", "close", "base_p",
                 "sym_nm", "mkt_cd"]
INDEX_FIELDS = ["IDX_NM", "ACC_TRDVOL", "ACC_TRDVAL", "OPNPRC_IDX", "HGPRC_IDX", "LWPRC_IDX",
                "CLSPRC_IDX"]
INDEX_COLUMNS = ["sym_nm", "trd_vol", "trd_val", "open", "high", "low", "close"]
VENDOR_DAILY = ["net_buy_fi", "mkt_cap", "num_stock_o", "num_stock_t"]
CONSENSUS = ["sales_12mf", "opr_prof_12mf", "earn_12mf", "earn_dom_12mf", "bps_12mf", "eps_down_fy2"]
MANAGED = ["sym_mng", "sym_stop", "sym_reg"]
# ---------------------------------------------------------------------------


def index_list(raw: DataFrame) -> DataFrame:
    """D3: raw index list -> (full_code, idx_code, mkt_nm, short_code, codeName).

    ``mkt_nm`` is the market name with KRX/KOSPI/KOSDAQ/theme replaced by
    X/P/Q/T; ``idx_code`` = mkt_nm + short_code (a NULL part prints NA).
    """
    mkt = market_letters(F.col("marketName"))
    return raw.select(
        "full_code",
        unite([mkt, F.col("short_code")]).alias("idx_code"),
        mkt.alias("mkt_nm"),
        "short_code", "codeName")


def listed_universe(prices: DataFrame, base: DataFrame, excluded: DataFrame, sectors: DataFrame,
                    day: str | Column, ordered: bool = True) -> DataFrame:
    """The day's common-share universe with sector.

    prices (text) left-join base prices on code; every field but code,
    name and market parsed as a number; base price 1 means "none"; the
    listed-universe filter; special vehicles (excluded codes) removed; KRX
    sector recoded; sorted by code (``ordered``; a global sort, so writers
    that keep their own file order turn it off).  ``day`` is ``YYYYMMDD`` text or a date
    column already on ``prices``; when ``prices`` and another landed frame
    both carry ``base_dt`` (several days landed at once) they pair by day.
    """
    def day_key(other: DataFrame) -> list[str]:
        # several landed days at once: every landed frame pairs by day too
        return ["base_dt"] if "base_dt" in prices.columns and "base_dt" in other.columns else []

    bkey = day_key(base)
    joined = prices.join(base.select("ISU_SRT_CD", *bkey, "BAS_PRC"), on=["ISU_SRT_CD", *bkey], how="left")
    base_dt = F.to_date(F.lit(day), "yyyyMMdd") if isinstance(day, str) else day
    typed = joined.select(base_dt.alias("base_dt"), *[
        (F.col(f) if c in ("sym_cd", "sym_nm", "mkt_cd") else parse_number(F.col(f))).alias(c)
        for f, c in zip(PRICE_FIELDS, PRICE_COLUMNS)])
    typed = (typed.filter(F.col("sym_cd").isNotNull())
                  .withColumn("base_p", null_if_equal("base_p", 1.0)))
    universe = listed_common_shares(typed)
    ekey = day_key(excluded)
    universe = universe.join(excluded.select(F.col("ISU_SRT_CD").alias("sym_cd"), *ekey).distinct(),
                             on=["sym_cd", *ekey], how="left_anti")
    skey = day_key(sectors)
    sec = sectors.select(F.col("ISU_SRT_CD").alias("sym_cd"), *skey,
                         sector_recode(F.col("IDX_IND_NM")).alias("sec_krx"))
    out = universe.join(sec, on=["sym_cd", *skey], how="left").select(
        "base_dt", "sym_cd", "trd_vol", "trd_val", "open", "high", "low", "close", "base_p",
        "sym_nm", "mkt_cd", "sec_krx")
    return out.orderBy("sym_cd") if ordered else out


def stock_info_changes(existing: DataFrame, batch: DataFrame, new_only: bool = True) -> DataFrame:
    """D5, true-history variant: a row is a new version whenever its
    attributes differ (NULL-safe) from the symbol's previous row by
    ``info_update`` -- A -> B -> A keeps three versions.

    A lag per symbol over the attribute rows (at most one per symbol and
    day).  With ``new_only`` only versions from ``batch`` are returned.
    """
    attrs = [c for c in existing.columns if c not in ("sym_cd", "info_update")]
    tagged = union_by_name(tag(existing, _src=0), tag(batch.select(*existing.columns), _src=1))
    w = Window.partitionBy("sym_cd").orderBy("info_update", "_src")
    changed = F.lag(F.lit(1)).over(w).isNull()
    for a in attrs:
        changed = changed | ~F.col(a).eqNullSafe(F.lag(F.col(a)).over(w))
    out = tagged.withColumn("_new", changed).filter(F.col("_new"))
    if new_only:
        out = out.filter(F.col("_src") == 1)
    return out.select(*existing.columns)


def stock_info_merge(existing: DataFrame, batch: DataFrame, new_only: bool = True) -> DataFrame:
    """Attribute history, first-seen wins.

    ``existing`` (sym_cd, info_update, attributes...) and the landed batch
    rows (same columns, any number of days) are reduced to one row per
    distinct attribute set with its earliest ``info_update`` (existing rows
    win ties); a return to an earlier set (A -> B -> A) is not a new
    version.  NULL attributes group together, as in the reference.  With
    ``new_only`` only the versions first seen in the batch are returned
    (the rows to save).  One grouped ``min`` with partial aggregation.
    """
    attrs = [c for c in existing.columns if c != "info_update"]
    tagged = union_by_name(tag(existing, _src=0), tag(batch.select(*existing.columns), _src=1))
    first = tagged.groupBy(*attrs).agg(F.min(F.struct("info_update", "_src")).alias("_first"))
    out = first.select(*attrs, F.col("_first.info_update").alias("info_update"),
                       F.col("_first._src").alias("_src"))
    if new_only:
        out = out.filter(F.col("_src") == 1)
    return out.select(*existing.columns)


def info_as_of(daily: DataFrame, info: DataFrame) -> DataFrame:
    """The latest ``info_update`` on or before each (sym_cd, base_dt): the
    attribute version valid on that day (blocked as-of lookup, no range
    join, no pairs)."""
    return as_of_latest(daily.select("sym_cd", "base_dt"), info.select("sym_cd", "info_update"),
                        ["sym_cd"], "base_dt", "info_update", "info_update")


def stock_daily(universe: DataFrame, vendor: DataFrame, info: DataFrame,
                existing: DataFrame | None = None, last_key: int | None = None) -> DataFrame:
    """The stock_daily rows for the landed days.

    prices (base_dt..base_p) + vendor daily items + the symbol's current
    attribute version (as of the day) + a surrogate ``num_key``: a listing
    that ``existing`` holds keeps its key, the others are numbered after the
    largest key stored (0 when empty; ``last_key`` if the caller knows it) in
    (base_dt, sym_cd) order, without a single-partition sort.  Only the keys
    are numbered, before the joins.
    """
    px = universe.select("base_dt", "sym_cd", "trd_vol", "trd_val", "open", "high", "low",
                         "close", "base_p")
    v = vendor.select("base_dt", "sym_cd", *VENDOR_DAILY)
    rows = px.join(v, on=["base_dt", "sym_cd"], how="left")
    rows = rows.join(info_as_of(px.select("sym_cd", "base_dt"), info), on=["sym_cd", "base_dt"],
                     how="left")
    listed = px.select("base_dt", "sym_cd")
    if existing is None:
        keys = assign_keys(listed, ["base_dt", "sym_cd"], "num_key", 0)
    else:
        start = last_key if last_key is not None else F.coalesce(
            existing.agg(F.max("num_key")).scalar(), F.lit(0)).cast("long")
        held = existing.select("num_key", "base_dt", "sym_cd").filter(F.col("base_dt").between(
            listed.agg(F.min("base_dt")).scalar(), listed.agg(F.max("base_dt")).scalar()))
        unseen = listed.join(held, on=["base_dt", "sym_cd"], how="left_anti")
        keys = assign_keys(unseen, ["base_dt", "sym_cd"], "num_key", start).unionByName(
            held.join(listed, on=["base_dt", "sym_cd"], how="left_semi"))
    return rows.join(keys, on=["base_dt", "sym_cd"], how="inner").select(
        "num_key", "base_dt", "sym_cd", "trd_vol", "trd_val", "open", "high", "low", "close", "base_p",
        *VENDOR_DAILY, "info_update")


def stock_cons(daily: DataFrame, vendor: DataFrame) -> DataFrame:
    """Consensus rows with any item present, keyed by num_key (right
    join: a vendor row with no stock_daily row keeps a NULL num_key)."""
    cons = vendor.select("base_dt", "sym_cd", *CONSENSUS).filter(any_not_null(CONSENSUS))
    keys = daily.select("num_key", "base_dt", "sym_cd")
    return keys.join(cons, on=["base_dt", "sym_cd"], how="right").select("num_key", *CONSENSUS)


def stock_managed(daily: DataFrame, vendor: DataFrame) -> DataFrame:
    """One row per (num_key, managed type) whose status is not normal.

    Types: sym_mng -> 1, sym_stop -> 2, sym_reg -> 3.  A NULL status is
    dropped like a normal one.  The key is (num_key, type).
    """
    flags = vendor.select("base_dt", "sym_cd", *MANAGED)
    keyed = daily.select("num_key", "base_dt", "sym_cd").join(flags, on=["base_dt", "sym_cd"],
                                                              how="right")
    long = unpivot_columns(keyed, ["num_key"], MANAGED, "managed", "value")
    code = recode_exact(F.col("managed"), {k: str(v) for k, v in MANAGED_TYPE_CODE.items()})
    return (long.filter(F.col("value") != F.lit(MANAGED_NORMAL))
                .select("num_key", code.cast("int").alias("type")))


def stocks_in_index(daily: DataFrame, members: DataFrame, ordered: bool = True) -> DataFrame:
    """Index membership keyed by num_key (inner join on (base_dt,
    sym_cd)), sorted by (num_key, idx_code) unless ``ordered`` is off."""
    keys = daily.select("num_key", "base_dt", "sym_cd")
    out = (keys.join(members.select("base_dt", "sym_cd", "idx_code"), on=["base_dt", "sym_cd"])
               .select("num_key", "idx_code"))
    return out.orderBy("num_key", "idx_code") if ordered else out


def index_daily(levels: DataFrame, base: DataFrame, idx_list: DataFrame, ordered: bool = True) -> DataFrame:
    """Index levels per (base_dt, idx_code).

    Per market code (01-04 -> X, P, Q, T): levels left-join the base
    values on index name; rows with a "-" or NULL in any field are dropped
    (so a level without a base value vanishes); numbers parsed; the index
    code is looked up by name within the market (a repeated name fans out).
    ``levels``/``base`` carry ``base_dt`` and the market code ``mkt``.
    """
    lv = levels.select("base_dt", "mkt", *[F.col(f).alias(c) for f, c in zip(INDEX_FIELDS, INDEX_COLUMNS)])
    bs = base.select("base_dt", "mkt", F.col("IDX_IND_NM").alias("sym_nm"),
                     F.col("OPN_DD_INDX").alias("base_p"))
    j = lv.join(bs, on=["base_dt", "mkt", "sym_nm"], how="left")
    fields = INDEX_COLUMNS[1:] + ["base_p"]
    j = j.filter(all_differ_from(fields, "-"))
    j = j.select("base_dt", "mkt", "sym_nm", *[parse_number(F.col(c)).alias(c) for c in fields])
    letter = recode_exact(F.col("mkt"), MARKET_CODE_LETTER)
    lookup = idx_list.select(F.col("mkt_nm").alias("_letter"), F.col("codeName").alias("sym_nm"),
                             "idx_code")
    out = j.withColumn("_letter", letter).join(lookup, on=["_letter", "sym_nm"], how="left")
    out = out.select("base_dt", "idx_code", *fields)
    return out.orderBy("idx_code") if ordered else out
