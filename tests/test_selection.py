"""Boundaries by counting against plain windows over all rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators import selection as S
from ledgerlens.operators.ranking import global_order


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in rnd.sample(range(-10**12, 10**12), n):
        day = f"2001-0{rnd.randint(1, 9)}-1{rnd.randint(0, 9)}"
        # one hot value holds a third of the rows
        k = None if rnd.random() < 0.02 else 5 if rnd.random() < 0.33 else rnd.randint(-40, 40)
        v = None if rnd.random() < 0.02 else rnd.choice((0.0, 1e14, -3e13, 12.25)) if rnd.random() < 0.4 else rnd.uniform(-9e5, 9e9)
        rows.append((i, k, v, rnd.choice(("", "a", "a ", "ab", "abcdefg", "é", "zz")) * rnd.randint(0, 3) + str(rnd.randint(0, 99)), day))
    df = spark.createDataFrame(rows, "id long, k int, v double, s string, d string")
    return df.withColumns({"v": F.col("v").cast("decimal(28,2)"), "d": F.to_date("d")}).repartition(5).persist()


@pytest.fixture(scope="module")
def data(spark):
    return _data(spark)


def column(name, descending):
    return F.col(name).desc() if descending else F.col(name).asc()


KEYS = [[("k", False), ("id", False)], [("k", True), ("id", False)], [("v", False), ("id", True)],
        [("v", True), ("id", False)], [("s", False), ("id", False)], [("d", True), ("s", True), ("id", False)]]


@pytest.mark.parametrize("ranges,small", [(4096, 4096), (16, 20), (7, 1)])
def test_ntiles_equal_the_window(spark, data, monkeypatch, ranges, small):
    monkeypatch.setattr(S, "RANGES", ranges)
    monkeypatch.setattr(S, "SMALL", small)
    keys = KEYS if small > 1 else KEYS[1:4]
    tiles = {f"t{i}": (n, k) for i, (n, k) in enumerate(zip((10, 5, 7, 2, 10, 3), keys))}
    got = S.ntiles(data, tiles)
    want = data.withColumns({f"w{i}": F.ntile(n).over(Window.orderBy(*[column(*x) for x in k]))
                             for i, (n, k) in enumerate(tiles.values())})
    j = got.join(want.select("id", *[f"w{i}" for i in range(len(tiles))]), "id")
    assert j.count() == 3000
    assert j.where(" OR ".join(f"t{i} <> w{i}" for i in range(len(tiles)))).count() == 0


@pytest.mark.parametrize("n_rows", [0, 1, 4])
def test_fewer_rows_than_tiles(spark, n_rows):
    df = spark.createDataFrame([(i, i) for i in range(n_rows)], "id long, k long")
    assert sorted(r.t for r in S.ntiles(df, {"t": (10, [("k", False)])}).collect()) == list(range(1, n_rows + 1))


@pytest.mark.parametrize("small", [4096, 3])
def test_running_sums_cross_where_the_window_says(spark, data, monkeypatch, small):
    monkeypatch.setattr(S, "SMALL", small)
    monkeypatch.setattr(S, "RANGES", 64)
    rows = data.withColumn("v", F.coalesce("v", F.lit(0)).cast("decimal(28,2)"))
    cents = (F.col("v") * 100).cast("decimal(38,0)")
    total = int(rows.agg(F.sum(cents)).first()[0])
    limits = [total * 80 // 100, total * 95 // 100, -1, 10**30]
    order, first = S.crossings(rows, {"o": [("v", True), ("id", False)]}, {"o": limits}, cents)
    got = rows.select("id", *[S.beyond(order["o"], at).alias(f"b{i}") for i, at in enumerate(first["o"])])
    ranked = global_order(rows.withColumn("c", cents), [F.col("v").desc(), F.col("id").asc()], value_col="c")
    j = got.join(ranked.select("id", "_cum", "v"), "id")
    assert j.where(f"b0 <> (_cum > {limits[0]})").count() == 0
    assert j.where(f"b1 <> (_cum > {limits[1]})").count() == 0
    assert j.where("NOT b2").count() == 0 and j.where("b3").count() == 0 and first["o"][3] is None


def test_nothing_is_moved_or_written(spark, data):
    plan = S.ntiles(data, {"t": (10, KEYS[0])})._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("InMemoryRelation")[0] and "Window" not in plan


def test_unfit_types_are_refused(spark):
    with pytest.raises(TypeError, match="no exact selection"):
        S.ntiles(spark.createDataFrame([(1.5,)], "x double"), {"t": (2, [("x", False)])})
