import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.functions.core import (
    bin_right, clamp, label_order, not_cancelled, rnd, week_w, year_week,
)
from ledgerlens.operators.predictive import BAND_EDGES, BAND_LABELS, RISK_EDGES, RISK_LABELS


def test_week_w_matches_strftime(spark):
    start = dt.date(2019, 12, 20)
    days = [start + dt.timedelta(days=i) for i in range(1500)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r.d: r.w for r in df.select("d", week_w(F.col("d")).alias("w")).collect()}
    for d in days:
        assert got[d] == d.strftime("%W"), d


def test_new_year_weeks(spark):
    df = spark.createDataFrame([(dt.date(2022, 12, 31),), (dt.date(2023, 1, 1),),
                                (dt.date(2023, 1, 2),)], "d date")
    got = [r.w for r in df.select(year_week(F.col("d")).alias("w")).orderBy("d").collect()]
    assert got == ["2022-W52", "2023-W00", "2023-W01"]


def test_bin_right_cut_edges(spark):
    vals = ["0", "0.001", "0.05", "0.0501", "0.20", "0.21", "-0.01"]
    df = spark.createDataFrame([(v,) for v in vals], "v string").select(
        F.col("v"), F.col("v").cast("decimal(5,4)").alias("x"))
    got = {r.v: r.b for r in df.select("v", bin_right(F.col("x"), BAND_EDGES, BAND_LABELS)
                                          .alias("b")).collect()}
    assert got == {"0": "0%", "0.001": "0%", "0.05": "1-5%", "0.0501": "6-10%",
                   "0.20": "16-20%", "0.21": None, "-0.01": None}


def test_prob_edges_zero_gets_no_band(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.6,), (0.8,), (1.0,)], "p double")
    got = [r.b for r in df.select(bin_right(F.col("p"), RISK_EDGES, RISK_LABELS).alias("b"))
           .orderBy("p").collect()]
    assert got == [None, "Low", "Medium", "High", "Critical"]


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (0.5,), (9.0,)], "x double")
    got = [r.c for r in df.select(clamp(F.col("x"), 0.0, 1.0).alias("c")).collect()]
    assert got == [None, 0.0, 0.5, 1.0]


def test_not_cancelled_null_rules(spark):
    df = spark.createDataFrame([("Delivered",), ("Cancelled",), (None,)], "status string")
    assert not_cancelled(df, "drop").count() == 1
    assert not_cancelled(df, "keep").count() == 2


def test_rnd_half_up(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (0.125,)], "x double")
    got = [r.r for r in df.select(rnd(F.col("x")).alias("r")).collect()]
    assert got == [1.01, 2.68, -1.01, 0.13]


def test_label_order(spark):
    df = spark.createDataFrame([("High",), ("Low",), ("zzz",)], "l string")
    got = [r.o for r in df.select(label_order(F.col("l"), RISK_LABELS).alias("o")).collect()]
    assert got == [3, 1, None]


def test_cluster_conf_sizes_partitions():
    from ledgerlens.session import cluster_conf
    c = cluster_conf(100 * (1 << 40), executors=1000, cores_per_executor=8)
    assert int(c["spark.sql.shuffle.partitions"]) == 80000
    small = cluster_conf(1 << 30, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 80
