"""FIXTURES.md §4 micro-fixtures: boundary values and NULL rules."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.functions.core import bin_right
from ledgerlens.operators import dashboard as K
from ledgerlens.operators import predictive as M
from ledgerlens.operators import quality as Dq
from ledgerlens.operators import sql_patterns as Q
from ledgerlens.operators.predictive import CLV_LABELS
from tests.fixtures import customer, item, make_tables, order, product


def test_tie_orders_broken_by_order_id(spark):
    t = make_tables(spark, orders=[order(2, 1, "2023-01-05"), order(1, 1, "2023-01-05"),
                                   order(3, 1, "2023-02-01")], customers=[customer(1)])
    rows = Q.customer_journey(t).orderBy("order_rank").collect()
    assert [(r.order_id, r.order_rank) for r in rows] == [(1, 1), (2, 2), (3, 3)]
    assert rows[1].days_since_last == 0 and rows[1].days_to_next == 27
    assert rows[0].days_since_last is None and rows[2].days_to_next is None


def test_value_tier_edges_are_inclusive(spark):
    orders = [order(i, i, "2024-01-01", total=v)
              for i, v in enumerate(["4999.99", "5000.00", "20000.00", "50000.00"], start=1)]
    t = make_tables(spark, orders=orders, customers=[customer(i) for i in range(1, 5)])
    rows = Q.next_best_action(t, snapshot="2025-01-01").collect()
    assert {r.customer_id: r.value_tier for r in rows} == {
        1: "Bronze", 2: "Silver", 3: "Gold", 4: "Platinum"}


def test_clv_tier_edges_are_exclusive(spark):
    edges = (-1.0, 5000.0, 20000.0, 50000.0, float("inf"))
    df = spark.createDataFrame([(5000.0,), (50000.0,), (50000.01,)], "v double")
    got = [r.b for r in df.select(bin_right(F.col("v"), edges, CLV_LABELS).alias("b"))
           .orderBy("v").collect()]
    assert got == ["Bronze", "Gold", "Platinum"]


def test_recency_edges(spark):
    snap = dt.date(2025, 1, 1)
    days = [90, 91, 180, 181, 365, 366]
    orders = [order(i, i, (snap - dt.timedelta(days=d)).isoformat()) for i, d in enumerate(days, 1)]
    t = make_tables(spark, orders=orders, customers=[customer(i) for i in range(1, 7)])
    got = {r.days_inactive: r.recommended_action for r in Q.next_best_action(t).collect()}
    assert got == {91: Q.ACTION_WIN_BACK, 180: Q.ACTION_WIN_BACK, 181: Q.ACTION_URGENT,
                   365: Q.ACTION_URGENT, 366: Q.ACTION_REENGAGE}


def test_gap_month_zero_filled_in_k2_skipped_in_q3(spark):
    orders = [order(1, 1, "2023-01-10"), order(2, 1, "2023-03-10")]
    t = make_tables(spark, orders=orders, customers=[customer(1)])
    k2 = K.monthly_revenue(t).orderBy("month").collect()
    assert [(r.month, r.revenue) for r in k2] == [
        (dt.date(2023, 1, 31), 100.0), (dt.date(2023, 2, 28), 0.0), (dt.date(2023, 3, 31), 100.0)]
    assert k2[0].month_label == "Jan 2023"
    q3 = Q.rolling_revenue(t).orderBy("ym").collect()
    assert [r.ym for r in q3] == ["2023-01", "2023-03"]
    assert q3[1].rolling_3m_avg == 100.0 and q3[1].rolling_3m_total == 200.0


def test_orphans_and_null_keys(spark):
    orders = [order(1, 1, "2023-01-01"), order(2, 99, "2023-01-01"), order(3, None, "2023-01-01")]
    items = [item(1, 10), item(7, 10), item(1, 11)]
    t = make_tables(spark, orders=orders, items=items, products=[product(10)],
                    customers=[customer(1)])
    got = {r.check_name: r.violations for r in Dq.referential_checks(t).collect()}
    assert got["orders → customers (orphan orders)"] == 2
    assert got["order_items → orders (orphan items)"] == 1
    assert got["order_items → products (missing products)"] == 1
    gate = {r.check_name: r.observed for r in Dq.quality_gate(t, min_customers=1, min_orders=1)
            .collect()}
    assert gate["orders: orders with missing customer_id"] == 2


def test_duplicate_null_emails_sql_vs_pandas(spark):
    custs = [customer(1, email=""), customer(2, email="a"), customer(3, email="a")]
    custs = [(c[0], c[1], c[2], None if c[0] == 1 else c[3]) + c[4:] for c in custs]
    custs.append((4, "f", "l", None, "c", "c", "X", "0", "web", "0"))
    t = make_tables(spark, customers=custs, orders=[order(1, 1, "2023-01-01")])
    d3 = {r.check_name: r.violations for r in Dq.uniqueness_checks(t).collect()}
    assert d3["customers - duplicate email"] == 3   # two NULLs + one repeat
    gate = {r.check_name: r.observed for r in Dq.quality_gate(t, min_customers=1, min_orders=1)
            .collect()}
    assert gate["customers: duplicate emails"] == 2  # first NULL is not a duplicate


def test_bad_lines_tolerance(spark):
    items = [item(1, 10, qty=1, price=100.0, total="-100"),   # negative: signed ratio never trips
             item(1, 11, qty=1, price=100.0, total="0"),      # zero: NULLIF -> no violation
             item(1, 12, qty=1, price=100.0, total="102"),    # off by 2 %
             item(1, 13, qty=2, price=50.0, total="100.5")]   # within 1 %
    t = make_tables(spark, orders=[order(1, 1, "2023-01-01")], items=items,
                    products=[product(i) for i in (10, 11, 12, 13)], customers=[customer(1)])
    got = {r.check_name: r.violations for r in Dq.business_rule_checks(t).collect()}
    assert got["order_items - line_total mismatch (>1% tolerance)"] == 1


def test_no_sales_products_land_in_c(spark):
    orders = [order(1, 1, "2023-01-01"), order(2, 1, "2023-01-02", status="Cancelled")]
    items = [item(1, 10, price=700.0), item(1, 11, price=200.0), item(1, 14, price=60.0),
             item(1, 15, price=40.0), item(2, 12, price=500.0)]
    t = make_tables(spark, orders=orders, items=items,
                    products=[product(i) for i in (10, 11, 12, 13, 14, 15)],
                    customers=[customer(1)])
    # cumulative shares 0.70 (A), 0.90 (B), 0.96 (C, crosses .95), 1.0, 1.0, 1.0
    got = {r.abc_class: r.products for r in Q.abc_classification(t).collect()}
    assert got == {"A": 1, "B": 1, "C": 4}
    pr = {r.product_id: float(r.revenue) for r in Q.product_revenue(t).collect()}
    assert pr[12] == 0.0 and pr[13] == 0.0
    pr_all = {r.product_id: float(r.revenue) for r in Q.product_revenue(t, False).collect()}
    assert pr_all[12] == 500.0   # cancelled sales kept, as the reference SQL does


def test_missing_band_category_dropped(spark):
    items = [item(1, 10, qty=2, disc="0"), item(1, 10, qty=4, disc="0.18"),
             item(1, 20, qty=3, disc="0")]
    t = make_tables(spark, orders=[order(1, 1, "2023-01-01")], items=items,
                    products=[product(10, cat="A"), product(20, cat="B")],
                    customers=[customer(1)])
    rows = M.elasticity_summary(t).collect()
    assert [r.category for r in rows] == ["A"]
    assert rows[0].price_elasticity == round((4 - 2) / 2 / -0.18, 3)
    assert rows[0].elastic == "Yes"


def test_basket_rule_strength(spark):
    # 10 orders: A and B always together in orders 1-5; C in orders 5-10
    orders = [order(i, 1, "2023-01-01") for i in range(1, 11)]
    items = []
    for o in range(1, 6):
        items += [item(o, 1), item(o, 2)]
    for o in range(5, 11):
        items.append(item(o, 3))
    prods = [product(1, cat="A"), product(2, cat="B"), product(3, cat="C")]
    t = make_tables(spark, orders=orders, items=items, products=prods, customers=[customer(1)])
    rows = {(r.category_A, r.category_B): r for r in M.market_basket(t).collect()}
    ab = rows[("A", "B")]
    assert ab.lift == 2.0 and ab.rule_strength == "Strong" and ab.support == 0.5
    ac = rows[("A", "C")]
    assert ac.rule_strength == "Weak"      # lift = 0.1 / (0.5 * 0.6)
    for r in rows.values():
        exp = "Strong" if r.lift > 1.2 else "Moderate" if r.lift > 1.0 else "Weak"
        assert r.rule_strength == exp


def test_one_order_customer_tenure_clamps_to_one(spark):
    t = make_tables(spark, orders=[order(1, 1, "2024-12-01", total="1000.00")],
                    customers=[customer(1)])
    r = M.clv_prediction(t).collect()[0]
    assert r.tenure_days == 1 and r.recency_days == 31
    assert r.purchase_rate == 30.0


def test_null_status_sql_drops_pandas_keeps(spark):
    orders = [order(1, 1, "2023-01-10", total="100.00"),
              order(2, 1, "2023-01-11", status=None, total="50.00")]
    t = make_tables(spark, orders=orders, customers=[customer(1)])
    # SQL patterns drop a NULL status ...
    assert Q.rolling_revenue(t).collect()[0].revenue == 100.0
    # ... the dashboard and the Python analytics keep it
    k = K.executive_kpis(t).collect()[0]
    assert k.revenue == 150.0 and k.orders == 2
    assert K.monthly_revenue(t).collect()[0].revenue == 150.0
    fc = M.revenue_forecast(t, months=1, base_year=2023).filter("type = 'actual'").collect()
    assert fc[0].revenue == 150.0


def test_published_months_golden_forecast(spark):
    # 36 published monthly revenues (millions), Jan 2022 .. Dec 2024, and the
    # published six-month forecast; inputs are rounded, so +-0.01 M.
    published = [0.79, 0.96, 1.34, 2.13, 4.62, 3.49, 2.68, 5.48, 5.48, 8.82, 8.5, 9.2,
                 11.45, 9.93, 11.22, 15.53, 15.13, 14.92, 15.77, 18.97, 19.86, 22.72, 23.35,
                 23.26, 23.04, 22.65, 32.69, 32.43, 34.22, 37.52, 43.68, 54.35, 46.25, 62.13,
                 70.74, 82.36]
    expected = [29.13, 28.59, 39.77, 45.37, 50.31, 53.63]
    orders = []
    for i, v in enumerate(published):
        y, m = 2022 + i // 12, i % 12 + 1
        orders.append(order(i + 1, 1, f"{y}-{m:02d}-15", total=f"{v * 1e6:.2f}"))
    t = make_tables(spark, orders=orders, customers=[customer(1)])
    fc = (M.revenue_forecast(t, months=6, base_year=2022).filter("type = 'forecast'")
          .orderBy("ym").collect())
    assert [r.ym for r in fc] == [f"2025-{m:02d}" for m in range(1, 7)]
    for r, e in zip(fc, expected):
        assert abs(r.forecast_revenue / 1e6 - e) <= 0.011, (r.ym, r.forecast_revenue, e)
    fit = M.forecast_fit(t, base_year=2022).collect()[0]
    assert abs(fit.slope / 1e5 - 17.7) < 0.05 and abs(fit.r2 - 0.83) < 0.005


def test_quality_gate_failing_volume_bound(spark):
    t = make_tables(spark, orders=[order(1, 1, "2023-01-01")], customers=[customer(1)],
                    items=[item(1, 10)], products=[product(10)])
    rows = {r.check_name: (r.observed, r.passed) for r in
            Dq.quality_gate(t, min_customers=1000, min_orders=1).collect()}
    assert rows["customers: expected ≥1000"] == (1, False)
    assert rows["orders: expected ≥1"] == (1, True)
    assert rows["quality gate (all checks)"] == (2, False)  # volume + delivered without date


def test_chart_series_order_and_scale(spark):
    df = spark.createDataFrame([("a", 1_500_000.0), ("b", 2_000_000.0), ("c", 1_500_000.0)],
                               "name string, revenue double")
    r = K.chart_series(df, "name", "revenue",
                       F.struct(-F.col("revenue"), F.col("name"))).collect()[0]
    assert r.labels == '["b","a","c"]' and r.values == "[2.00,1.50,1.50]"


def test_filters_empty_selection_is_empty(spark):
    t = make_tables(spark, orders=[order(1, 1, "2023-01-01")], customers=[customer(1)])
    k = K.executive_kpis(t, years=[]).collect()[0]
    assert k.orders == 0 and k.revenue == 0.0 and k.aov == 0.0 and k.cancel_rate_pct == 0.0
