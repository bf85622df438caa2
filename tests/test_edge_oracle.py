"""Every registered query against its oracle on the edge-case tables
(NULL and unknown statuses, dangling and NULL keys, duplicates), which the
clean driver tables never exercise."""

import tempfile

import pytest

from ledgerlens.plans import catalog, oracle
from scripts.check_oracle import compare, duck
from tests.edge_data import write_edge_tables

_QUERIES = catalog.queries()
_SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def edge_dir():
    d = tempfile.mkdtemp(prefix="ll-edge-", dir="/tmp")
    write_edge_tables(d)
    return d


@pytest.fixture(scope="module")
def con(edge_dir):
    return duck(edge_dir)


@pytest.mark.parametrize("name", sorted(_QUERIES))
def test_edge_query_matches_oracle(spark, con, edge_dir, name):
    status, msg = compare(spark, con, edge_dir, name, _QUERIES[name], _SQL.get(name))
    assert status != "FAIL", msg


def test_edge_affinity_low_threshold(spark, con, edge_dir):
    from ledgerlens.operators.sql_patterns import category_affinity
    from ledgerlens.params import TEST as P
    from ledgerlens.sources.adapter import load_tables
    sql = _SQL["category_affinity"].replace(f">= {P['affinity_min']}", ">= 1")
    assert sql != _SQL["category_affinity"]
    status, msg = compare(spark, con, edge_dir, "category_affinity_min1",
                          lambda s, d: category_affinity(load_tables(s, d), min_count=1), sql)
    assert status == "OK", msg
    assert int(msg.split()[0]) > 0
