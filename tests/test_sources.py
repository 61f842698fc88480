import datetime as dt
import tempfile

from pyspark.sql import functions as F

from equiframe.functions import remove_dashes
from equiframe.operators.columns import across, col_range, first_columns, relocate
from equiframe.operators.filters import in_set, on_date, sym_dt_pick
from equiframe.operators.reshape import tag, union_by_name, unpivot_columns
from equiframe.sources.tables import TableStore


def test_table_store_scan_and_sql(spark):
    root = tempfile.mkdtemp(prefix="equiframe-store-", dir="/tmp")
    spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string").write.parquet(f"{root}/t1")
    store = TableStore(spark, root)
    assert store.scan("t1").count() == 2
    got = store.sql("SELECT max(k) AS m FROM t1", ["t1"]).first().m
    assert got == 2


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, "2023-01-02", 3.0, 4.0, "x")], "k int, d string, a double, b double, s string")
    assert col_range(df, "d", "b") == ["d", "a", "b"]
    assert first_columns(df, 2).columns == ["k", "d"]
    assert relocate(df, ["s"], before="a").columns == ["k", "d", "s", "a", "b"]
    r = across(df, ["a", "b"], lambda c: c * 2).select("a", "b").first()
    assert (r.a, r.b) == (6.0, 8.0)
    assert df.select(remove_dashes("d")).first()[0] == "20230102"


def test_filters_and_reshape(spark):
    df = spark.createDataFrame([("a", dt.date(2023, 1, 2)), ("b", dt.date(2023, 1, 3)),
                                ("c", dt.date(2023, 1, 4))], "sym_cd string, base_dt date")
    assert df.transform(lambda d: sym_dt_pick(d)).count() == 3
    assert sym_dt_pick(df, ["a", "c"], end="2023-01-03").count() == 1
    assert in_set(df, "sym_cd", spark.createDataFrame([("b",)], "x string")).count() == 1
    assert on_date(df, "2023-01-03", "base_dt").first().sym_cd == "b"
    u = union_by_name(df, tag(df.limit(1), market="STK"))
    assert u.filter(F.col("market") == "STK").count() == 1 and u.count() == 4
    w = spark.createDataFrame([(1, "정상", "정지", None)], "num_key int, sym_mng string, sym_stop string, sym_reg string")
    long = unpivot_columns(w, ["num_key"], ["sym_mng", "sym_stop", "sym_reg"], "managed", "value").collect()
    assert [(r.managed, r.value) for r in long] == [("sym_mng", "정상"), ("sym_stop", "정지"), ("sym_reg", None)]


def test_payload_explode_tolerates_empty_and_bad_documents(spark):
    from equiframe.sources.payload import explode_payload
    df = spark.createDataFrame([(1, '{"OutBlock_1":[{"a":"1","b":"x"},{"a":"2"}],"CURRENT_DATETIME":"t"}'),
                                (2, '{}'), (3, 'not json'), (4, None), (5, '{"out":[]}')],
                               "id int, payload string")
    got = sorted((r.id, r.a, r.b) for r in explode_payload(df, "payload", ["a", "b"]).collect())
    assert got == [(1, "1", "x"), (1, "2", None)]


def test_more_operator_paths(spark):
    from equiframe.operators.filters import lookback_window
    from equiframe.operators.windows import rolling
    from equiframe.sources.vendor import cross_section, item_metadata
    df = spark.createDataFrame([("a", t, float(t)) for t in range(1, 8)], "k string, t int, v double")
    partial = {r.t: r.s for r in rolling(df, "v", {"s": 3}, ["k"], "t", agg="sum", full_only=False).collect()}
    assert partial == {1: 1.0, 2: 3.0, 3: 6.0, 4: 9.0, 5: 12.0, 6: 15.0, 7: 18.0}
    many = list(range(1500))
    ids = spark.range(0, 3000).withColumnRenamed("id", "x")
    assert in_set(ids, "x", many).count() == 1500
    days = spark.createDataFrame([("a", dt.date(2022, 12, 1)), ("a", dt.date(2023, 2, 10)), ("a", dt.date(2023, 3, 1))],
                                 "sym_cd string, base_dt date")
    assert lookback_window(days, "all").count() == 3
    assert lookback_window(days, "1m").count() == 2
    assert lookback_window(days, "3y").count() == 3
    meta = item_metadata(spark, [("fs", "sales", 1, 0, 0, 1), ("fs", "earn_dom", 1, 1, 0, 1)])
    raw = spark.createDataFrame([("A1", "10", "2")], "sym_cd string, sales string, earn_dom string")
    assert cross_section(raw, meta, "fs", "2023 Q1", new_only=True).columns == ["sym_cd", "fs_q", "earn_dom"]


def test_argument_errors_are_clear(spark):
    import pytest

    from equiframe.operators.windows import rolling
    from equiframe.sources.sinks import upsert_partial
    df = spark.createDataFrame([("a", 1, 1.0)], "k string, t int, v double")
    with pytest.raises(ValueError, match="agg must be one of"):
        rolling(df, "v", {"r": 2}, ["k"], "t", agg="median")
    with pytest.raises(ValueError, match="lengths >= 1"):
        rolling(df, "v", {"r": 0}, ["k"], "t")
    with pytest.raises(ValueError, match="upsert keys"):
        upsert_partial(df, df.select("t", "v"), ["k"])


def test_block_sizes_must_be_positive(spark):
    import pytest

    from equiframe.operators.windows import as_of_latest, rolling, suffix_product
    df = spark.createDataFrame([("a", 1, dt.date(2023, 1, 2), 1.0)], "k string, t int, d date, v double")
    with pytest.raises(ValueError, match="block"):
        rolling(df, "v", {"r": 2}, ["k"], "t", block=0)
    with pytest.raises(ValueError, match="block_days"):
        suffix_product(df, "v", ["k"], "d", "f", block_days=0)
    with pytest.raises(ValueError, match="block_days"):
        as_of_latest(df, df.select("k", F.col("d").alias("w")), ["k"], "d", "w", "w", block_days=0)


def test_a_missing_vendor_item_is_an_error_that_names_it(spark):
    import pytest

    from equiframe.plans.ingest import stock_cons
    from equiframe.plans.statements import split_statements
    from equiframe.sources.vendor import cross_section, fiscal_basis, item_metadata
    meta = item_metadata(spark)
    raw = spark.createDataFrame([("A1", "1")], "sym_cd string, sales string")
    for broken in (lambda: cross_section(raw, meta, "fs", "2020 Q1"), lambda: fiscal_basis(raw, meta),
                   lambda: split_statements(raw.withColumn("fs_q", raw.sales), meta)):
        with pytest.raises(ValueError, match="net_asset"):
            broken()
    with pytest.raises(Exception, match="sales_12mf"):
        stock_cons(raw, raw.withColumn("base_dt", raw.sales))
