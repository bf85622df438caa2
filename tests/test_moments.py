"""Means and deviations are the same to the last bit however rows are dealt."""

import dataclasses
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.moments import exact_avg, scalar_spread
from ledgerlens.operators import predictive as M
from ledgerlens.operators import quality as D
from ledgerlens.operators import reports as R
from ledgerlens.operators import sql_patterns as Q
from ledgerlens.params import TEST as P
from ledgerlens.sources.adapter import load_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def values(spark):
    rnd = random.Random(9)
    rows = [(i % 4, rnd.lognormvariate(5, 2) / 3) for i in range(5000)] + [(0, None), (1, float("nan"))]
    return rows, spark.createDataFrame(rows, "g int, v double")


def test_bits_do_not_depend_on_partitions(spark, values):
    rows, df = values
    seen = set()
    for n in (1, 7, 200):
        dealt = df.repartition(n)
        mean, std = scalar_spread(dealt, ["v"])[0]
        one = dealt.limit(1).select(mean, std).first()
        seen.add((*one, *(tuple(r) for r in dealt.groupBy("g").agg(exact_avg("v")).orderBy("g").collect())))
    assert len(seen) == 1
    mean, std, *groups = seen.pop()
    clean = [v for _, v in rows if v is not None and not math.isnan(v)]
    assert math.isclose(mean, statistics.fmean(clean), rel_tol=1e-9)
    assert math.isclose(std, statistics.pstdev(clean), rel_tol=1e-6)
    for g, a in groups:
        assert math.isclose(a, statistics.fmean([v for h, v in rows if h == g and v is not None and not math.isnan(v)]))


def test_empty_and_single(spark, values):
    _, df = values
    mean, std = scalar_spread(df.limit(0), ["v"])[0]
    assert tuple(spark.range(1).select(mean, std).first()) == (None, None)
    mean, std = scalar_spread(spark.range(1).select(F.lit(2.5).alias("v")), ["v"])[0]
    assert tuple(spark.range(1).select(mean, std).first()) == (2.5, 0.0)


def test_operators_give_equal_bits(spark):
    t = load_tables(spark, SF)
    bands = dict(edges=P["band_edges"], labels=P["band_labels"])
    seen = {}
    for n in (1, 7, 200):
        dealt = dataclasses.replace(t, orders=t.orders.repartition(n), order_items=t.order_items.repartition(n))
        for name, df in (
                ("effect", M._band_agg(M._margin_lines(dealt, **bands), ["category", "discount_band"])),
                ("impact", M._band_agg(M._margin_lines(dealt, **bands), ["discount_band"])),
                ("weekly", Q.weekly_anomaly(dealt)), ("outliers", D.order_value_outliers(dealt, k=1.5)),
                ("tiers", M.clv_tier_summary(dealt, snapshot=P["snapshot"], tiers=P["clv_tiers"])),
                ("segments", R.rfm_segments(dealt, snapshot=P["snapshot"]))):
            seen.setdefault(name, set()).add(tuple(sorted(map(str, df.collect()))))
    assert {name: len(v) for name, v in seen.items()} == dict.fromkeys(seen, 1)
