"""Expected shapes on the sf0.01 test tables:
each query exercises its rule on the real data."""

import pytest

from ledgerlens.operators import predictive as M
from ledgerlens.operators import reports as R
from ledgerlens.operators import sql_patterns as Q
from ledgerlens.params import TEST as P
from ledgerlens.sources.adapter import load_tables


@pytest.fixture(scope="module")
def t(spark):
    return load_tables(spark, "/root/testdata/sf0.01")


def _counts(df, col):
    return {r[0]: r[1] for r in df.groupBy(col).count().collect()}


def test_abc_classes(t):
    got = {r.abc_class: r.products for r in Q.abc_classification(t).collect()}
    assert got == {"A": 1428, "B": 394, "C": 178}


def test_cohort_retention_shape(t):
    rows = Q.cohort_retention(t).collect()
    assert len(rows) == 484 and len({r.cohort_month for r in rows}) == 66
    assert all(r.retention_pct == 100.0 for r in rows if r.month_offset == 0)


def test_weekly_anomalies(t):
    assert _counts(Q.weekly_anomaly(t, k=2), "status") == {Q.ANOMALY_LABEL: 14, Q.NORMAL_LABEL: 335}


def test_affinity_pairs(t):
    assert Q.category_affinity(t, min_count=50).count() == 30
    assert Q.category_affinity(t, min_count=P["affinity_min"]).count() < 30


def test_rfm_segments(t):
    got = _counts(R.rfm_scores(t, snapshot=P["snapshot"]), "segment")
    assert got == {"Champions": 305, "Loyal": 324, "New/Recent": 169, "At Risk": 268,
                   "Lost": 332, "High Spender": 4, "Potential Loyal": 95}


def test_inactive_customer_tiers(t):
    s, g, p = P["nba_tiers"]
    nba = Q.next_best_action(t, snapshot=P["snapshot"], silver=s, gold=g, platinum=p,
                             limit=None)
    assert _counts(nba, "value_tier") == {"Bronze": 135, "Silver": 434, "Gold": 389,
                                          "Platinum": 214}


def test_clv_tiers(t):
    got = _counts(M.clv_stats(t, P["snapshot"], P["clv_tiers"]), "clv_tier")
    assert got == {"Bronze": 550, "Silver": 584, "Gold": 262, "Platinum": 101}


def test_decile_shares_sum_to_100(t):
    rows = Q.customer_deciles(t).collect()
    assert len(rows) == 10 and abs(sum(r.pct_total_revenue for r in rows) - 100) < 0.06
    assert sum(r.customers for r in rows) == 1497


def test_orphans_against_reduced_dimensions(t):
    import dataclasses

    from pyspark.sql import functions as F

    from ledgerlens.operators import quality as Dq
    reduced = dataclasses.replace(
        t, customers=t.customers.filter(F.col("customer_id") % 2 == 0),
        products=t.products.filter(F.col("product_id") % 3 != 0))
    got = {r.check_name: r.violations for r in Dq.referential_checks(reduced).collect()}
    exp_orders = t.orders.filter(F.col("customer_id") % 2 != 0).count()
    exp_items = t.order_items.filter(F.col("product_id") % 3 == 0).count()
    assert got["orders → customers (orphan orders)"] == exp_orders > 0
    assert got["order_items → products (missing products)"] == exp_items > 0
    assert got["order_items → orders (orphan items)"] == 0
