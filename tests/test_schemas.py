"""Domain functions produce the stored tables' declared columns and types."""

from pyspark.sql import functions as F

from equiframe import fixtures as fx
from equiframe import schemas
from equiframe.plans import calendar as cal
from equiframe.plans import factors as fac
from equiframe.plans import ingest as ing
from equiframe.plans import statements as st
from equiframe.sources.tables import read_parquet

SF = "/root/testdata/sf0.001"


def _shape(df):
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def _want(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def test_domain_outputs_match_declared_schemas(spark):
    load = lambda n: fx.load(spark, SF, n)
    daily, vendor, info = load("fx_daily"), load("fx_vendor"), load("fx_history")
    years = read_parquet(spark, SF, "lineitem").select(F.year("l_shipdate").alias("year")).distinct()
    assert _shape(cal.business_calendar(years, cal.fixed_holidays(years))) == _want(schemas.WORKDAYS)
    assert _shape(ing.index_list(load("fx_index_raw"))) == _want(schemas.INDEX_LIST)
    sd = ing.stock_daily(daily, vendor, info)
    assert _shape(sd) == _want(schemas.STOCK_DAILY)
    assert _shape(ing.stock_cons(sd, vendor)) == _want(schemas.STOCK_CONS)
    assert _shape(ing.stock_managed(sd, vendor)) == _want(schemas.STOCK_MANAGED)
    assert _shape(ing.stocks_in_index(sd, load("fx_members"))) == _want(schemas.STOCKS_IN_INDEX)
    il = ing.index_list(load("fx_index_raw"))
    assert _shape(ing.index_daily(load("fx_index_levels"), load("fx_index_base"), il)) == _want(schemas.INDEX_DAILY)
    bs, pl = load("fx_bs"), load("fx_pl")
    assert _shape(bs) == _want(schemas.COMPANY_FS_BS) and _shape(pl) == _want(schemas.COMPANY_FS_PL)
    prep = st.trailing_pl(st.complete_grid(bs, "sym_cd", "fs_q", pl.drop("dpr", "prop_div")))
    assert _shape(prep) == _want(schemas.COMPANY_FS_PL_PREP)
    assert _shape(st.filled_balance_sheet(bs)) == _want(schemas.COMPANY_FS_BS)
    value = fac.value_factors(daily, load("fx_cons"), load("fx_workdays"), bs, prep)
    assert _shape(fac.update_factors(value, fac.momentum(daily))) == _want(schemas.FACTOR_DAILY)
    empty_info = spark.createDataFrame([], schemas.STOCK_INFO)
    assert _shape(ing.stock_info_merge(empty_info, empty_info)) == _want(schemas.STOCK_INFO)
