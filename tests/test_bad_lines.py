"""Malformed CSV lines are neither silent NULLs nor lost: they are left out,
listed and counted, whatever columns a query reads."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import quality as D
from ledgerlens.sources.adapter import csv_gate, csv_rejects, load_csv_tables, read_csv
from ledgerlens.sources.schema import TABLE_SCHEMAS

GOOD = {
    "customers": ["C1,Ann,Lee,a@x.com,1,Rome,RM,IT,2022-01-05,Web,18-25,F", 'C2,"B, ""b""",Lee,b@x.com,,,,,,,,'],
    "products": ["P1,Pen,Books,B,10.50,5.25,7,4.5,1"],
    "orders": ["O1,C1,2022-03-01,2022-03-04,Delivered,Card,Web,IT,100.00,5.00,1", "O2,C2,2022-03-02,,Shipped,Card,Web,IT,50.00,0,0"],
    "order_items": ["I1,O1,P1,2,10.50,0.0500,19.950000", "I2,O2,P1,1,10.50,,"],
    "returns": ["R1,O1,C1,2022-03-09,Damaged,19.95,Approved"],
}
BAD = {
    "orders": ["O3,C1,2022-03-05", "O4,C1,2022-03-06,,Shipped,Card,Web,IT,1,0,0,extra", "O5,C1,06/03/2022,,Shipped,Card,Web,IT,1,0,0"],
    "order_items": ["I3,O1,P1,two,10.50,0.05,9.975", "I4,O1,P1,1,abc,0.05,9.975"],
    "products": ["P2,Ink,Books,B,9.99,1.00,3,4.5,yes"],
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("csv")
    for name, schema in TABLE_SCHEMAS.items():
        lines = [",".join(schema.fieldNames()), *GOOD[name]]
        for i, line in enumerate(BAD.get(name, ())):
            lines.insert(1 + i, line)
        (path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    return str(path)


def test_rows_are_the_sound_lines(spark, folder):
    t = load_csv_tables(spark, folder)
    for name in TABLE_SCHEMAS:
        df = getattr(t, name)
        assert df.schema == TABLE_SCHEMAS[name]
        assert df.count() == len(df.collect()) == len(GOOD[name]), name
        key = df.columns[0]
        # One column alone, or all: the same rows.
        assert df.select(key).collect() == [(line.split(",")[0],) for line in GOOD[name]]
    assert [r.first_name for r in t.customers.collect()] == ["Ann", 'B, "b"']
    assert t.orders.filter(F.col("order_date").isNull()).count() == 0
    counts = {r.table_name: r.row_count for r in D.row_counts(t).collect()}
    assert counts == {name: len(lines) for name, lines in GOOD.items()}


def test_rejects_hold_the_lines_whole(spark, folder):
    got = {}
    for r in csv_rejects(spark, folder).collect():
        assert os.path.basename(r.file) == f"{r.table_name}.csv"
        got.setdefault(r.table_name, []).append(r.line)
    assert got == BAD
    assert csv_rejects(spark, folder).count() == sum(map(len, BAD.values()))


def test_gate_counts_them(spark, folder):
    got = {r.table_name: (r.lines, r.rejected, r.passed) for r in csv_gate(spark, folder).collect()}
    assert got == {name: (len(GOOD[name]) + len(BAD.get(name, ())), len(BAD.get(name, ())), name not in BAD) for name in GOOD}
    assert all(r.passed for r in csv_gate(spark, folder, max_share=0.7).collect())


def test_other_headers_are_an_error(spark, tmp_path):
    for name, schema in TABLE_SCHEMAS.items():
        names = schema.fieldNames()
        (tmp_path / f"{name}.csv").write_text(",".join(["wrong", *names[1:]]) + "\n" + GOOD[name][0] + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_csv_tables(spark, str(tmp_path)).orders.collect()


def test_labelled_file(spark, tmp_path):
    path = str(tmp_path / "cohort.csv")
    with open(path, "w") as f:
        f.write(",0,1\n2023-01,1.0,0.5\n2023-02,1.0\n2023-03,x,0.5\n")
    df = read_csv(spark, path, "c string, m0 double, m1 double", label_col="cohort_month")
    assert df.columns == ["cohort_month", "m0", "m1"] and [tuple(r) for r in df.collect()] == [("2023-01", 1.0, 0.5)]
    bad = read_csv(spark, path, "c string, m0 double, m1 double", label_col="cohort_month", rejects=True)
    assert [r.line for r in bad.collect()] == ["2023-02,1.0", "2023-03,x,0.5"]
