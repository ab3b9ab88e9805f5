"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as contract
from compare import compare, connect
from pairloom.plans import catalog

SF = "/root/testdata/sf0.001"
QUERIES = catalog.QUERIES
SQL = catalog.ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    assert rows and all(r["accuracy"] > 0.5 for r in rows)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["stage", "n_rows", "mean_tokens", "truncated_share"]
    assert sum(r["n_rows"] for r in df.collect()) == 31


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries()) and set(QUERIES) <= set(contract.queries())
