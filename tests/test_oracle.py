"""Every registered query against its DuckDB oracle on the smallest test
tables (the driver repeats this at sf0.01)."""

import os

import pytest

import __spark_entry__ as E
from ledgerlens.plans import catalog, oracle
from scripts.check_oracle import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

# The text operators have their own tests.
_QUERIES = catalog.queries()
_SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(_QUERIES) == set(_SQL)


@pytest.mark.parametrize("name", sorted(_QUERIES))
def test_query_matches_oracle(spark, con, name):
    status, msg = compare(spark, con, SF, name, _QUERIES[name], _SQL.get(name))
    assert status != "FAIL", msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["ym", "revenue", "rolling_3m_avg", "rolling_3m_total"]
    assert df.count() > 0
