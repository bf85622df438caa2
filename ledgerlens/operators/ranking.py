"""GR1 / GR2: exact global ranks, NTILE and running sums without a
single-partition window.

``ROW_NUMBER() OVER (ORDER BY k)`` and ``SUM(x) OVER (ORDER BY k ROWS
UNBOUNDED PRECEDING)`` have no PARTITION BY, so Spark runs them in one task.
Here the rows are range-partitioned on the full sort order (key plus a unique
tie-break, so a hot key value is split across partitions too), sorted inside
each partition, and numbered by position.  The result is checkpointed to the
session's reliable checkpoint folder so that the sampled range bounds cannot
move between the jobs that read it.  Per-partition counts and sums (one row
per partition, a bound we set) are turned into offsets and broadcast back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import ensure_checkpoint_dir


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def global_order(df: DataFrame, order_cols: Sequence[Column], value_col: str | None = None,
                 rank_col: str = "_rank", cum_col: str = "_cum",
                 num_partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` (1-based position in ``order_cols`` order), ``_total``
    (row count) and, with ``value_col``, ``cum_col`` (running sum in that
    order) and ``_grand`` (sum over all rows).

    ``order_cols`` must define a total order (end with a unique key);
    otherwise positions among ties are arbitrary, as in SQL.
    """
    spark = df.sparkSession
    # Without an explicit count, AQE sizes the range partitioning from the
    # data; coalesced partitions are still contiguous ranges in order.
    ranged = (df.repartitionByRange(*order_cols) if num_partitions is None
              else df.repartitionByRange(int(num_partitions), *order_cols))
    ranged = (ranged.sortWithinPartitions(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    ensure_checkpoint_dir(spark)
    ranged = ranged.checkpoint(eager=True)

    aggs = [F.count(F.lit(1)).alias("_n")]
    if value_col is not None:
        aggs.append(F.sum(value_col).alias("_v"))
    per_part = ranged.groupBy("_pid").agg(*aggs)   # one row per range partition
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    cols = [F.col("_pid"),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_row_off"),
            F.sum("_n").over(whole).alias("_total")]
    if value_col is not None:
        zero = F.lit(0).cast(ranged.schema[value_col].dataType)
        cols += [F.coalesce(F.sum("_v").over(before), zero).alias("_val_off"),
                 F.sum("_v").over(whole).alias("_grand")]
    offsets = per_part.select(*cols)

    out = ranged.join(F.broadcast(offsets), "_pid")
    out = out.withColumn(rank_col, F.col("_row_off") + F.col("_pos") + F.lit(1))
    if value_col is not None:
        running = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        out = out.withColumn(cum_col, F.col("_val_off") + F.sum(value_col).over(running))
        out = out.drop("_val_off")
    return out.drop("_pid", "_pos", "_row_off")


def ntile_expr(rank: Column, total: Column, n: int) -> Column:
    """NTILE(n) from a 1-based rank and the row count: with q = N div n and
    r = N mod n, the first r tiles hold q + 1 rows, the rest q."""
    q = F.floor(total / F.lit(n)).cast("long")
    r = (total % F.lit(n)).cast("long")
    big = r * (q + 1)
    first = F.floor((rank - 1) / (q + 1)).cast("long") + 1
    rest = r + F.floor((rank - big - 1) / F.when(q > 0, q)).cast("long") + 1
    return F.when(rank <= big, first).otherwise(rest).cast("int")


def global_ntile(df: DataFrame, n: int, order_cols: Sequence[Column], out_col: str,
                 num_partitions: int | None = None) -> DataFrame:
    """``NTILE(n) OVER (ORDER BY order_cols)`` computed in parallel."""
    ranked = global_order(df, order_cols, num_partitions=num_partitions)
    return (ranked.withColumn(out_col, ntile_expr(F.col("_rank"), F.col("_total"), n))
            .drop("_rank", "_total"))


def month_spine(dates: DataFrame, date_col: str, out_col: str = "month") -> DataFrame:
    """First day of every month between the first and last date of
    ``date_col`` (AGG12).  Built from a one-row aggregate: size is the number
    of months, independent of the row count."""
    bounds = dates.agg(F.min(F.trunc(date_col, "MM")).alias("_lo"),
                       F.max(F.trunc(date_col, "MM")).alias("_hi"))
    return bounds.select(F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 month")))
                         .alias(out_col))


def day_spine(spark, start: str, end: str, out_col: str = "date") -> DataFrame:
    """SRC3: one row per calendar day in ``[start, end]``."""
    return spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)),
                             F.expr("interval 1 day"))).alias(out_col))
