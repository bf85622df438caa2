"""Many lines are dealt to as many tasks as their bytes ask for, with the same results."""

import re

import pytest

from ledgerlens.operators import predictive as M
from ledgerlens.params import TEST as P
from ledgerlens.session import input_bytes
from ledgerlens.sources.adapter import load_tables

BANDS = dict(edges=P["band_edges"], labels=P["band_labels"])
FAMILY = {
    "discount_recommendation": lambda t: M.discount_recommendation(t, **BANDS, min_margin=P["min_margin"]),
    "discount_effect": lambda t: M.discount_effect(t, **BANDS),
    "discount_band_impact": lambda t: M.discount_band_impact(t, **BANDS),
    "price_elasticity": lambda t: M.price_elasticity_bands(t, **BANDS),
    "elasticity_summary": lambda t: M.elasticity_summary(t, **BANDS, base=P["base_band"], target=P["target_band"],
                                                         price_change=P["price_change"]),
    "market_basket": lambda t: M.market_basket(t, min_support=P["basket_support"]),
}


@pytest.fixture()
def tables(spark, tmp_dir):
    """Orders and lines with null and repeated order ids, repeated lines and
    unknown products, in a folder whose name has to be escaped."""
    d = f"{tmp_dir}/a b%20c"
    spark.sql("SELECT if(id % 11 = 0, NULL, cast(id / 2 AS bigint)) AS o_orderkey, id % 9 AS o_custkey, DATE'2024-01-05' AS o_orderdate, "
              "element_at(array('F', 'O', 'P', NULL), cast(id % 4 AS int) + 1) AS o_orderstatus, '1-URGENT' AS o_orderpriority, "
              "cast(id AS double) AS o_totalprice FROM range(400)").write.parquet(f"{d}/orders.parquet")
    spark.sql("SELECT if(id % 13 = 0, NULL, cast(id % 230 AS bigint)) AS l_orderkey, id % 21 AS l_partkey, cast(id % 5 AS int) AS l_linenumber, "
              "cast(id % 7 + 1 AS double) AS l_quantity, 10.0D + id % 90 AS l_extendedprice, (id % 11) / 100D AS l_discount, 'N' AS l_returnflag, "
              "'O' AS l_linestatus, DATE'2024-02-01' AS l_shipdate FROM range(1500) LATERAL VIEW explode(sequence(0, cast(id % 2 AS int))) AS k"
              ).write.parquet(f"{d}/lineitem.parquet")
    spark.sql("SELECT id AS p_partkey, concat('p', id) AS p_name, concat('c', id % 4) AS p_type, 'b' AS p_brand, 5.0D + id AS p_retailprice, "
              "cast(id AS int) AS p_size FROM range(20)").write.parquet(f"{d}/part.parquet")
    for name in ("customer", "nation", "region"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{d}/{name}.parquet")
    return load_tables(spark, d)


def test_bytes_of_files(spark, tables):
    assert input_bytes(tables.order_items) > 1000
    assert input_bytes(spark.createDataFrame([(1,)], "a int")) == 0


@pytest.mark.parametrize("large_products", [0, 1 << 40])
def test_tasks_grow_with_the_lines(spark, tables, monkeypatch, large_products):
    few = {name: sorted(map(str, f(tables).collect())) for name, f in FAMILY.items()}
    assert few["discount_effect"] and few["price_elasticity"]
    monkeypatch.setattr(M, "LARGE_PRODUCTS", large_products)
    for tasks in (9, 37):  # the session has 8
        monkeypatch.setattr(M, "TASK_BYTES", input_bytes(tables.order_items) // tasks + 1)
        for name, f in FAMILY.items():
            df = f(tables)
            dealt = set(re.findall(r"hashpartitioning\((order_id|product_id)#\d+L?, (\d+)\)",
                                   df._jdf.queryExecution().executedPlan().toString()))
            assert ("order_id", str(tasks)) in dealt, (name, dealt)
            assert (("product_id", str(tasks)) in dealt) == (not large_products), (name, dealt)
            assert sorted(map(str, df.collect())) == few[name], name


def test_few_lines_are_left_to_the_session(spark, tables):
    plan = FAMILY["discount_effect"](tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan
