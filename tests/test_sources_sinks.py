import os

from pyspark.sql import functions as F

from ledgerlens.operators import predictive as M
from ledgerlens.operators import quality as Dq
from ledgerlens.operators import sql_patterns as Q
from ledgerlens.sources.adapter import load_csv_tables, load_tables, read_metrics_json
from ledgerlens.sources.schema import TABLE_SCHEMAS
from ledgerlens.sources.sinks import summary, write_metrics_json, write_orders_by_month, write_table

SF = "/root/testdata/sf0.001"


def _logical(t, name):
    """Adapter frame widened to the documented column set, keys as text."""
    df = {"customers": t.customers, "products": t.products, "order_items": t.order_items,
          "returns": t.returns}.get(name)
    if name == "orders":
        df = t.orders_geo().join(t.orders_delivery().select("order_id", "delivery_date"),
                                 "order_id")
    schema = TABLE_SCHEMAS[name]
    cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    return df.select(*cols)


def test_csv_round_trip(spark, tmp_dir):
    t = load_tables(spark, SF)
    for name in TABLE_SCHEMAS:
        write_table(_logical(t, name), f"{tmp_dir}/{name}.csv", fmt="csv")
    c = load_csv_tables(spark, tmp_dir)
    assert c.orders.schema == TABLE_SCHEMAS["orders"]
    a = {r.ym: r.revenue for r in Q.rolling_revenue(t).collect()}
    b = {r.ym: r.revenue for r in Q.rolling_revenue(c).collect()}
    assert a == b
    ra = {r.table_name: r.row_count for r in Dq.row_counts(t).collect()}
    rb = {r.table_name: r.row_count for r in Dq.row_counts(c).collect()}
    assert ra == rb


def test_metrics_json_round_trip(spark, tmp_dir):
    t = load_tables(spark, SF)
    m = M.churn_metrics(t, snapshot="2001-08-02")
    path = os.path.join(tmp_dir, "metrics")
    write_metrics_json(m, path)
    back = read_metrics_json(spark, path).collect()[0]
    orig = m.collect()[0]
    assert back.accuracy == orig.accuracy
    assert back.confusion_matrix.TP == orig.confusion_matrix.TP


def test_month_partitioned_layout_prunes(spark, tmp_dir):
    t = load_tables(spark, SF)
    write_orders_by_month(t, tmp_dir)
    o = spark.read.parquet(f"{tmp_dir}/orders")
    assert o.count() == t.orders.count()
    one = o.filter(F.col("order_month") == "1996-03")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "order_month" in plan
    assert one.count() == t.orders.filter(F.date_format("order_date", "yyyy-MM") == "1996-03").count()


def test_read_csv_with_row_label(spark, tmp_dir):
    from ledgerlens.sources.adapter import read_csv
    path = os.path.join(tmp_dir, "cohort.csv")
    with open(path, "w") as f:
        f.write(",0,1\n2023-01,1.0,0.5\n2023-02,1.0,0.25\n")
    df = read_csv(spark, path, "c string, m0 double, m1 double", label_col="cohort_month")
    assert df.columns == ["cohort_month", "m0", "m1"]
    assert {r.cohort_month: r.m1 for r in df.collect()} == {"2023-01": 0.5, "2023-02": 0.25}


def test_register_views_sql(spark):
    t = load_tables(spark, SF)
    t.register_views(prefix="ll_")
    n = spark.sql("SELECT COUNT(*) AS n FROM ll_orders WHERE status <> 'Cancelled'").collect()[0].n
    assert n == t.orders.filter("status <> 'Cancelled'").count()


def test_every_query_runs_on_the_documented_tables(spark, tmp_dir):
    """Written CSV tables: no error, and the same row counts as the adapter's."""
    from ledgerlens.plans import catalog
    t = load_tables(spark, SF)
    for name in TABLE_SCHEMAS:
        write_table(_logical(t, name), f"{tmp_dir}/{name}.csv", fmt="csv")
    c = load_csv_tables(spark, tmp_dir)
    kept = catalog.tables
    queries = catalog.queries()
    fitted = {"churn_predictions", "churn_metrics", "churn_risk_summary", "churn_risk_distribution", "confusion_matrix"}
    try:
        for name in sorted(set(queries) - fitted):
            catalog.tables = lambda s, d: c
            got = queries[name](spark, SF).count()
            catalog.tables = kept
            assert got == queries[name](spark, SF).count(), name
    finally:
        catalog.tables = kept


def test_month_layout_keeps_orphan_lines(spark, tmp_dir):
    import dataclasses
    t = load_tables(spark, SF)
    some = dataclasses.replace(t, orders=t.orders.filter("order_id % 3 <> 0"))
    write_orders_by_month(some, tmp_dir)
    lines = spark.read.parquet(f"{tmp_dir}/order_items")
    assert lines.count() == t.order_items.count()
    assert lines.filter("order_month IS NULL").count() == t.order_items.filter("order_id % 3 = 0").count()


def test_sorted_outputs(spark):
    from ledgerlens.operators import dashboard as K
    from ledgerlens.operators import reports as R
    t = load_tables(spark, SF)
    for df, col in ((K.revenue_by(t, "channel"), "revenue"), (K.revenue_by(t, "country"), "revenue"),
                    (R.category_performance(t), "revenue"), (R.rfm_segments(t, "2001-08-02"), "total_rev")):
        values = [r[col] for r in df.collect()]
        assert values == sorted(values, reverse=True)


def _files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def _summaries(spark, path):
    return [sorted(map(str, summary(spark, path, by, dims).collect()))
            for by in ("month", "quarter", "year", "all") for dims in ((), ("payment_method",))]


def test_adding_a_month_equals_a_rebuild(spark, tmp_dir):
    import dataclasses
    t = load_tables(spark, SF)
    before = dataclasses.replace(t, orders=t.orders.filter("order_date < '1996-05-01' OR order_date >= '1996-06-01'"))
    once, grown = f"{tmp_dir}/once", f"{tmp_dir}/grown"
    write_orders_by_month(t, once)
    write_orders_by_month(before, grown)
    had = {name: _files(f"{grown}/{name}") for name in ("orders", "order_items", "partials")}
    write_orders_by_month(t, grown, months=["1996-05"])
    for name, files in had.items():
        now = _files(f"{grown}/{name}")
        files = {f: at for f, at in files.items() if "__HIVE_DEFAULT_PARTITION__" not in f}  # lines whose order had not come
        assert files and all(now[f] == at for f, at in files.items())  # untouched, to the last file
        assert {f.split("/")[0] for f in now.keys() - files.keys()} == {"order_month=1996-05"}
    for name in ("orders", "order_items", "partials"):
        rows = lambda path: sorted(map(str, spark.read.parquet(f"{path}/{name}").collect()))
        assert rows(grown) == rows(once), name
    assert _summaries(spark, grown) == _summaries(spark, once)
    write_orders_by_month(t, grown, months=["1996-05"])  # once more: the same
    assert _summaries(spark, grown) == _summaries(spark, once)


def test_summaries_equal_the_reports(spark, tmp_dir):
    from ledgerlens.operators import reports as R
    t = load_tables(spark, SF)
    write_orders_by_month(t, tmp_dir)
    got = {r.period: (r.revenue, r.orders, r.customers, r.aov) for r in summary(spark, tmp_dir).collect()}
    assert got == {r.ym: (r.revenue, r.orders, r.customers, r.aov) for r in R.monthly_summary(t).collect()}
    live = t.orders.filter("status <> 'Cancelled'")
    want = {str(r.y): (r.n, r.c) for r in live.groupBy(F.year("order_date").alias("y")).agg(
        F.count_distinct("order_id").alias("n"), F.count_distinct("customer_id").alias("c")).collect()}
    assert {r.period: (r.orders, r.customers) for r in summary(spark, tmp_dir, "year").collect()} == want
    units = t.order_items.join(live, "order_id", "left_semi").agg(F.sum("quantity")).first()[0]
    assert summary(spark, tmp_dir, "all").first().units == units
    part = summary(spark, tmp_dir, "all", start="1996-02", end="1997-01").first()
    dated = live.filter("order_date >= '1996-02-01' AND order_date < '1997-02-01'")
    assert (part.orders, part.customers) == tuple(dated.agg(F.count_distinct("order_id"), F.count_distinct("customer_id")).first())


def test_summaries_of_text_ids(spark, tmp_dir):
    import dataclasses
    t = load_tables(spark, SF)
    text = dataclasses.replace(t, orders=t.orders.withColumns({c: F.col(c).cast("string") for c in ("order_id", "customer_id")}),
                               order_items=t.order_items.withColumn("order_id", F.col("order_id").cast("string")))
    write_orders_by_month(t, f"{tmp_dir}/a")
    write_orders_by_month(text, f"{tmp_dir}/b")
    assert _summaries(spark, f"{tmp_dir}/a") == _summaries(spark, f"{tmp_dir}/b")


def test_a_month_has_tasks_by_its_size(spark, tmp_dir):
    import dataclasses
    t = load_tables(spark, SF)
    hot = t.orders.withColumn("order_date", F.expr("CASE WHEN order_id % 3 > 0 THEN DATE'1997-07-15' ELSE order_date END"))
    kept = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        write_orders_by_month(dataclasses.replace(t, orders=hot.repartition(8)), tmp_dir)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", kept)
    per = {}
    for f in _files(f"{tmp_dir}/orders"):
        per[f.split("/")[0]] = per.get(f.split("/")[0], 0) + 1
    hot_files = per.pop("order_month=1997-07")
    assert hot_files > 2 and sorted(per.values())[len(per) // 2] <= 2  # some share a shuffle partition with the hot one
