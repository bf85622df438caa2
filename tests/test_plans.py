"""Plan-shape checks: fused scans, no cross joins, bounded broadcasts."""

import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(plan):
    return re.findall(r"/(\w+)\.parquet\]", plan)


def test_null_checks_scan_each_table_once(spark):
    scans = _scans(_plan(spark, "null_checks"))
    assert scans.count("orders") == 1 and scans.count("lineitem") == 1
    assert scans.count("part") == 1 and scans.count("customer") == 1


def test_range_checks_one_scan_per_logical_table(spark):
    scans = _scans(_plan(spark, "range_checks"))
    # orders, products, order lines, returns (returns are lineitem rows too)
    assert scans.count("orders") == 1 and scans.count("part") == 1
    assert scans.count("lineitem") == 2


def test_no_cartesian_or_nested_loop_joins(spark):
    for name in ("category_affinity", "market_basket", "weekly_anomaly", "order_value_outliers",
                 "executive_kpis", "churn_features"):
        plan = _plan(spark, name)
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_tiles_and_shares_give_no_row_a_position(spark):
    # Boundaries come from counting rounds over the totals (one checkpoint); what
    # is left is a comparison with literals, so no row is sorted or dealt by range.
    for name in ("customer_deciles", "rfm_scores", "abc_classification"):
        plan = _plan(spark, name)
        assert plan.count("ExistingRDD") == 1 and "ntile(" not in plan.lower(), name
        below = plan[plan.find("HashAggregate"):] if "HashAggregate" in plan else plan  # the result's few rows are sorted
        assert "rangepartitioning" not in below and "Sort" not in below, name
    assert "Exchange" not in _plan(spark, "rfm_scores")


def test_two_distinct_counts_in_one_pass(spark):
    for name, scans in (("executive_kpis", 2), ("monthly_summary", 1)):  # the units' semi join reads orders too
        plan = _plan(spark, name)
        assert "Expand" not in plan, name
        assert _scans(plan).count("orders") == scans, name


def _line_shuffles(spark, name):
    """Exchanges above lineitem before anything is aggregated, broadcast off."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(spark, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if "lineitem.parquet" in x)
    depth = re.search(r"[A-Z]", lines[at]).start()
    count = 0
    for x in reversed(lines[:at]):
        d = re.search(r"[+:*]- |[A-Z(*]", x).start()
        if d < depth:
            depth = d
            if re.search(r"functions=\[(?!\])", x):
                break
            count += "Exchange hash" in x
    return count


def test_discount_family_and_affinity_shuffle_lines_twice(spark):
    for name in ("discount_effect", "price_elasticity", "category_affinity"):
        assert _line_shuffles(spark, name) <= 2, name


def test_forecast_reads_orders_once(spark):
    assert _scans(_executed(spark, "revenue_forecast")).count("orders") == 1


def _executed(spark, name):
    df = E.queries()[name](spark, SF)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_gate_reads_orders_and_lines_twice_at_most(spark):
    scans = _scans(_executed(spark, "quality_gate"))
    assert 1 <= scans.count("orders") <= 2 and scans.count("lineitem") == 2
