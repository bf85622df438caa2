import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators.ranking import global_ntile, global_order


def _data(spark, n=1200, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # one hot key value holds a third of the rows
        k = 5 if i % 3 == 0 else rnd.randint(0, 40)
        rows.append((i, k, rnd.randint(1, 1000)))
    return spark.createDataFrame(rows, "id long, k int, v long")


@pytest.mark.parametrize("n,parts", [(10, 4), (3, 1), (7, 16), (5, 8), (10, None)])
def test_global_ntile_equals_window(spark, n, parts):
    df = _data(spark)
    order = [F.col("k").desc(), F.col("id").asc()]
    got = {r.id: r.t for r in global_ntile(df, n, order, "t", num_partitions=parts).collect()}
    w = Window.orderBy(F.col("k").desc(), F.col("id").asc())
    exp = {r.id: r.t for r in df.select("id", F.ntile(n).over(w).alias("t")).collect()}
    assert got == exp


def test_global_cumsum_equals_window(spark):
    df = _data(spark)
    order = [F.col("k").desc(), F.col("id").asc()]
    got = {r.id: (r._rank, r._cum, r._grand, r._total)
           for r in global_order(df, order, value_col="v", num_partitions=6).collect()}
    w = Window.orderBy(F.col("k").desc(), F.col("id").asc())
    exp = df.select("id", F.row_number().over(w).alias("r"),
                    F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("c"),
                    F.sum("v").over(Window.partitionBy()).alias("g"),
                    F.count("*").over(Window.partitionBy()).alias("n")).collect()
    assert got == {r.id: (r.r, r.c, r.g, r.n) for r in exp}


def test_hot_key_is_split_across_partitions(spark):
    df = _data(spark, n=3000)
    order = [F.col("k").desc(), F.col("id").asc()]
    ranked = global_order(df, order, num_partitions=8)
    # rows of the hot key must not all land in one range partition
    parts = (df.repartitionByRange(8, *order).filter(F.col("k") == 5)
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1
    assert ranked.count() == 3000


def test_fewer_rows_than_tiles(spark):
    df = spark.createDataFrame([(i, i) for i in range(4)], "id long, k long")
    got = sorted(r.t for r in global_ntile(df, 10, [F.col("k")], "t").collect())
    assert got == [1, 2, 3, 4]


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, k long")
    assert global_ntile(df, 10, [F.col("k")], "t").count() == 0


def _hot_orders(spark):
    """One customer holds half of the orders; ties, NULL customers and dates."""
    import dataclasses
    import datetime as dt

    from ledgerlens.sources.adapter import load_tables
    rnd = random.Random(5)
    day = dt.date(1996, 1, 1)
    rows = [(1 if i % 2 == 0 else (None if i % 41 == 0 else rnd.randint(2, 90)), i,
             None if i % 97 == 0 else day + dt.timedelta(days=rnd.randint(0, 300)), "Shipped", float(i % 50))
            for i in range(3000)]
    o = spark.createDataFrame(rows, "customer_id long, order_id long, order_date date, status string, _t double")
    o = o.withColumn("order_total", F.col("_t").cast("decimal(18,2)")).drop("_t")
    return dataclasses.replace(load_tables(spark, "/root/testdata/sf0.001"), orders=o), rows


def test_journey_and_gap_with_a_hot_customer(spark):
    import datetime as dt

    from ledgerlens.operators.reports import purchase_gap
    from ledgerlens.operators.sql_patterns import customer_journey
    t, rows = _hot_orders(spark)
    by = {}
    for c, i, d, _, _ in rows:
        by.setdefault(c, []).append((d or dt.date.min, i, d))
    want, gaps = set(), {}
    days = lambda a, b: (a - b).days if a and b else None
    for c, orders in by.items():
        orders.sort(key=lambda x: x[:2])
        n = len(orders)
        for k in {1, 2, n}:
            if k <= n:
                d = orders[k - 1][2]
                before = orders[k - 2][2] if k > 1 else None
                after = orders[k][2] if k < n else None
                want.add((c, orders[k - 1][1], k, n, days(d, before), days(after, d)))
        steps = [g for g in (days(b[2], a[2]) for a, b in zip(orders, orders[1:])) if g is not None]
        if n >= 2:
            gaps[c] = (n, round(sum(steps) / len(steps), 2) if steps else None, min(steps, default=None),
                       max(steps, default=None))
    got = {(r.customer_id, r.order_id, r.order_rank, r.total_orders, r.days_since_last, r.days_to_next)
           for r in customer_journey(t).collect()}
    assert got == want
    mine = {r.customer_id: (r.orders, r.avg_gap_days, r.min_gap_days, r.max_gap_days) for r in purchase_gap(t).collect()}
    assert mine.keys() == gaps.keys()
    for c in gaps:
        assert mine[c][0::2] == gaps[c][0::2] and mine[c][3] == gaps[c][3]
        assert mine[c][1] is None or abs(mine[c][1] - gaps[c][1]) < 0.011


def test_journey_plan_does_not_depend_on_partitions(spark):
    import re

    from ledgerlens.operators.sql_patterns import customer_journey
    t, _ = _hot_orders(spark)
    plans = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("8", "80000"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        plan = customer_journey(t)._jdf.queryExecution().executedPlan().toString()
        plans.append(re.findall(r"[+:]- *([A-Z]\w+)", plan))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert plans[0] == plans[1] and "WindowGroupLimit" in plans[0]
