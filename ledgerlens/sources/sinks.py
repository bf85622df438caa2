"""Sinks: per-analysis tables (SNK1), the metrics document (SNK2), chart
series (SNK3, see ``operators.dashboard.chart_series``), and the fact layout by
month with its summary tables (SNK4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.core import not_cancelled, rnd
from ledgerlens.functions.distinct import counts, merged, partials
from ledgerlens.sources.adapter import Tables

KINDS = ("orders", "customers")
SUMS = ("revenue", "units")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """SNK1: write one analysis output (parquet by default, or csv with a
    header row)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", True).option("escape", '"')  # quotes are doubled, as in most CSV files
    w.format(fmt).save(path)


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    """SNK2: the one-row metrics frame (with its nested struct) as JSON."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def order_month(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def _by_month(df: DataFrame, path: str) -> None:
    """Write ``df`` by ``order_month``, replacing the months that it holds and
    no others.  The rebalance hint deals a month to as many tasks as its bytes
    ask for (``spark.sql.adaptive.advisoryPartitionSizeInBytes``): a small month
    is one file, a large one many."""
    (df.hint("rebalance", F.col("order_month")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("order_month").parquet(path))


def _drop(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def month_partials(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """What the summaries of months are made of: per month and payment method
    of live orders the bitmaps of order and customer ids with the revenue, and
    the units sold.

    ``orders`` carries ``order_month``.  The partials of different months can be
    merged into exact counts of any range of months, without the orders.  Lines
    are reduced to one row per order before they meet it; a repeated order
    id has its units in its first month.
    """
    keys = ["order_month", "payment_method"]
    live = not_cancelled(orders).filter(F.col("order_month").isNotNull())
    parts = partials(live, {"orders": F.col("order_id"), "customers": F.col("customer_id")}, {"revenue": F.col("order_total")}, keys)
    first = live.groupBy("order_id").agg(F.min(F.struct(*keys)).alias("_first")).select("order_id", "_first.*")
    sold = lines.groupBy("order_id").agg(F.sum("quantity").alias("units"))
    units = sold.join(first, "order_id").groupBy(*keys).agg(F.sum("units").alias("units"))
    return parts.unionByName(units.withColumn("kind", F.lit("units")), allowMissingColumns=True)


def write_orders_by_month(t: Tables, path: str, months: Sequence[str] | None = None) -> None:
    """SNK4: orders and order lines laid out by order month, so date-range
    queries prune whole folders, with the summaries' partials beside them.

    ``months`` ('yyyy-MM') writes these months only, from ``t`` as it is now, and
    leaves every other folder alone; without it all months are written.  A
    month of which nothing is left in ``t`` keeps its folder.  Lines take the
    month of their order (the first, should an id repeat); lines without a known
    order keep a null month, whose folder is written anew each time, as
    their order may have come.
    """
    orders = t.orders.withColumn("order_month", order_month(F.col("order_date")))
    month = orders.groupBy("order_id").agg(F.min("order_month").alias("order_month"))
    lines = t.order_items.join(month, "order_id", "left")
    if months is not None:
        orders = orders.filter(F.col("order_month").isin(*months))
        lines = lines.filter(F.col("order_month").isin(*months) | F.col("order_month").isNull())
        _drop(t.spark, f"{path}/order_items/order_month=__HIVE_DEFAULT_PARTITION__")
    _by_month(orders, f"{path}/orders")
    _by_month(lines, f"{path}/order_items")
    # From what was just written, so that the tables are not read once more.
    spark = t.spark
    written = spark.read.schema(orders.schema).parquet(f"{path}/orders")
    items = spark.read.schema(lines.schema).parquet(f"{path}/order_items").drop("order_month")
    if months is not None:
        written = written.filter(F.col("order_month").isin(*months))
    _by_month(month_partials(written, items), f"{path}/partials")


def summary(spark: SparkSession, path: str, by: str = "month", dims: Sequence[str] = (), start: str | None = None,
            end: str | None = None) -> DataFrame:
    """SNK4: revenue, units, distinct orders and customers, and average order
    value by ``month``, ``quarter``, ``year`` or over ``all`` months from
    ``start`` to ``end`` ('yyyy-MM'), optionally by ``payment_method`` too.

    Read from the stored partials alone; distinct counts over several months
    are exact, as bitmaps are merged and not counts added.
    """
    parts = spark.read.parquet(f"{path}/partials").withColumn("order_month", F.col("order_month").cast("string"))
    if start is not None:
        parts = parts.filter(F.col("order_month") >= start)
    if end is not None:
        parts = parts.filter(F.col("order_month") <= end)
    year, number = F.substring("order_month", 1, 4), F.substring("order_month", 6, 2).cast("int")
    period = {"month": F.col("order_month"), "quarter": F.concat(year, F.lit("-Q"), F.ceil(number / 3).cast("string")),
              "year": year, "all": F.lit("all")}[by]
    keys = ["period", *dims]
    whole = merged(parts.withColumn("period", period), keys, SUMS)
    out = counts(whole, KINDS, keys, SUMS)
    return out.select(*keys, rnd("revenue").alias("revenue"), F.coalesce("units", F.lit(0)).cast("long").alias("units"),
                      F.col("orders").cast("long").alias("orders"), F.col("customers").cast("long").alias("customers"),
                      rnd(F.try_divide(F.col("revenue"), F.col("orders"))).alias("aov"))
