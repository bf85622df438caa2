"""Distinct counts by bitmaps against count(distinct)."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import distinct as N


def _rows(n=4000, seed=2):
    rnd = random.Random(seed)
    far = [rnd.randrange(-2**62, 2**62) for _ in range(50)]
    return [(rnd.choice("abc"), None if rnd.random() < 0.05 else rnd.choice(far) if rnd.random() < 0.2 else rnd.randrange(90_000),
             5 if rnd.random() < 0.3 else rnd.randrange(-70_000, 10), rnd.choice(("x", "y", None)), rnd.randint(0, 9)) for _ in range(n)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(_rows(), "g string, a long, b int, s string, v int").repartition(6)


def _same(got, want):
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_counts_equal_count_distinct(df):
    live = F.col("v") > 2
    got = N.distinct_counts(df, {"na": F.when(live, F.col("a")), "nb": F.col("b")}, {"total": F.col("v")}, ["g"])
    want = df.groupBy("g").agg(F.count_distinct(F.when(live, F.col("a"))).alias("na"), F.count_distinct("b").alias("nb"),
                               F.sum("v").alias("total"))
    _same(got.select("g", "na", "nb", "total"), want)
    whole = N.distinct_counts(df, {"na": F.col("a"), "nb": F.col("b")})
    _same(whole, df.agg(F.count_distinct("a"), F.count_distinct("b")))


def test_other_types_count_too(df):
    got = N.distinct_counts(df, {"ns": F.col("s"), "ng": F.col("g")}, {"total": F.col("v")})
    _same(got, df.agg(F.count_distinct("s"), F.count_distinct("g"), F.sum("v")))
    with pytest.raises(TypeError, match="different types"):
        N.distinct_counts(df, {"na": F.col("a"), "ns": F.col("s")})


def test_partials_merge_over_any_groups(df):
    parts = N.partials(df, {"na": F.col("a"), "nb": F.col("b")}, {"total": F.col("v")}, ["g", "s"])
    got = N.counts(N.merged(parts, ["g"], ["total"]), ["na", "nb"], ["g"], ["total"])
    want = df.groupBy("g").agg(F.count_distinct("a"), F.count_distinct("b"), F.sum("v"))
    _same(got, want)


def test_no_rows(df):
    got = N.distinct_counts(df.limit(0), {"na": F.col("a"), "nb": F.col("b")}, {"total": F.col("v")})
    assert tuple(got.first()) == (0, 0, None)
    assert N.distinct_counts(df.limit(0), {"na": F.col("a")}, keys=["g"]).count() == 0


def test_one_pass_without_expand(df):
    plan = N.distinct_counts(df, {"na": F.col("a"), "nb": F.col("b")})._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Scan ExistingRDD") == 1
