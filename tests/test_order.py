"""Sorted queries give their rows in the oracle's order, on clean and odd tables."""

import pytest

from ledgerlens.plans import catalog, oracle
from scripts.check_oracle import duck, norm
from tests.edge_data import write_edge_tables

_QUERIES, _SQL = catalog.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module", params=["clean", "odd"])
def tables(request, tmp_path_factory):
    folder = "/root/testdata/sf0.001"
    if request.param == "odd":
        folder = str(tmp_path_factory.mktemp("odd"))
        write_edge_tables(folder)
    return folder, duck(folder)


@pytest.mark.parametrize("name", sorted(oracle.ORDER_BY))
def test_rows_come_in_order(spark, tables, name):
    folder, con = tables
    got = _QUERIES[name](spark, folder)
    want = con.execute(oracle.ordered(name, _SQL[name]))
    columns = [d[0] for d in want.description]
    assert [tuple(norm(r[c]) for c in columns) for r in got.collect()] == [tuple(map(norm, r)) for r in want.fetchall()]
