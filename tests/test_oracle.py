"""The driver's gate in miniature: every registered query against its
DuckDB oracle on the smallest scale."""

import pytest

import __spark_entry__ as E
from equiframe import catalog
from tools.compare import compare, duck, type_mismatches

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(catalog.Q) == set(catalog.SQL) <= set(SQL) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    rel = con.sql(SQL[name])
    ok, msg = compare(sdf.toPandas(), rel.df())
    assert ok, msg
    assert not type_mismatches(sdf.schema, rel)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["num_key", "ret_1w", "ret_3m", "ret_6m", "ret_12m"]
    assert df.count() > 0


def test_contract_shapes(spark):
    first, second = E.entry(spark).schema, E.entry(spark).schema
    assert first == second
    for name, fn in catalog.Q.items():
        cols = fn(spark, SF).columns
        assert len(cols) == len(set(cols)), name
        assert all(c == c.strip() and c for c in cols), name
