"""Catalogued reports (A1-T4) and RFM segmentation.

The reference lists these queries by name only; the definitions are ours
and are documented per function.  Customer-attribute rollups aggregate
orders per customer before joining the customer dimension.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.core import (
    bin_right, not_cancelled, rnd, week_w, weekday_name, ym,
)
from ledgerlens.functions.distinct import distinct_counts
from ledgerlens.functions.moments import exact_avg
from ledgerlens.operators.dashboard import STOCK_EDGES, STOCK_LABELS, product_sales
from ledgerlens.operators.ranking import month_spine
from ledgerlens.operators.selection import ntiles
from ledgerlens.operators.sql_patterns import cohort_counts
from ledgerlens.session import ensure_checkpoint_dir
from ledgerlens.sources.adapter import Tables

# Fixed segment labels as rendered by the reference dashboard.
SEGMENTS = ("Champions", "Loyal", "New/Recent", "At Risk", "Lost", "High Spender",
            "Potential Loyal")


def monthly_summary(t: Tables) -> DataFrame:
    """A1: per month revenue, distinct orders, distinct customers, AOV."""
    o = not_cancelled(t.orders).withColumn("ym", ym(F.col("order_date")))
    return (distinct_counts(o, {"orders": F.col("order_id"), "customers": F.col("customer_id")},
                            {"_rev": F.col("order_total")}, ["ym"])
            .select("ym", rnd("_rev").alias("revenue"), "orders", "customers",
                    rnd(F.try_divide(F.col("_rev"), F.col("orders"))).alias("aov")))


def category_performance(t: Tables) -> DataFrame:
    """Per category revenue, COGS (qty x cost) and gross margin %,
    largest revenue first.  Items are aggregated per product first."""
    per_p = product_sales(t).join(t.products.select("product_id", "category", "cost_price"),
                                  "product_id")
    g = per_p.groupBy("category").agg(F.sum("_rev").alias("_rev"),
                                      F.sum(F.col("units_sold") * F.col("cost_price")).alias("_cogs"))
    g = g.orderBy(F.col("_rev").desc(), "category")
    return g.select("category", rnd("_rev").alias("revenue"), rnd("_cogs").alias("cogs"),
                    rnd(F.try_divide((F.col("_rev") - F.col("_cogs")) * 100, F.col("_rev")))
                    .alias("gp_margin"))


def _per_customer(t: Tables) -> DataFrame:
    return not_cancelled(t.orders).groupBy("customer_id").agg(
        F.sum("order_total").alias("_rev"), F.countDistinct("order_id").alias("_orders"))


def _share(df: DataFrame, col: str = "_rev") -> DataFrame:
    # df is a small aggregated frame (one row per dimension value)
    return df.withColumn("share_pct",
                         rnd(F.try_divide(F.col(col) * 100, F.sum(col).over(Window.partitionBy()))))


def channel_performance(t: Tables) -> DataFrame:
    """A4: per channel revenue, orders and share of revenue %."""
    if t.customer_geo is None:  # orders carry their channel
        g = (not_cancelled(t.orders).filter(F.col("channel").isNotNull()).groupBy("channel")
             .agg(F.sum("order_total").alias("_rev"), F.countDistinct("order_id").alias("orders")))
    else:
        g = (_per_customer(t).join(t.customer_geo, "customer_id", "left")
             .filter(F.col("channel").isNotNull())
             .groupBy("channel").agg(F.sum("_rev").alias("_rev"), F.sum("_orders").alias("orders")))
    return _share(g).select("channel", rnd("_rev").alias("revenue"),
                            F.col("orders").cast("long").alias("orders"), "share_pct")


def payment_method_mix(t: Tables) -> DataFrame:
    """A5: per payment method orders, revenue and share of revenue %."""
    g = (not_cancelled(t.orders).filter(F.col("payment_method").isNotNull())
         .groupBy("payment_method").agg(F.countDistinct("order_id").alias("orders"),
                                        F.sum("order_total").alias("_rev")))
    return _share(g).select("payment_method", "orders", rnd("_rev").alias("revenue"), "share_pct")


def customer_ltv_segments(t: Tables, silver: float = 5000, gold: float = 20000,
                          platinum: float = 50000) -> DataFrame:
    """B1: customers per lifetime-value tier (the value tiers of Q10)."""
    v = F.round(F.col("_rev"), 2)
    tier = (F.when(v >= platinum, "Platinum").when(v >= gold, "Gold")
            .when(v >= silver, "Silver").otherwise("Bronze"))
    return (_per_customer(t).withColumn("value_tier", tier).groupBy("value_tier")
            .agg(F.count(F.lit(1)).alias("customers"), F.sum(v).alias("_t"), F.avg(v).alias("_a"))
            .select("value_tier", "customers", rnd("_t").alias("total_ltv"), rnd("_a").alias("avg_ltv")))


def rfm_scores(t: Tables, snapshot: str = "2025-01-01") -> DataFrame:
    """B2: recency / frequency / monetary per customer, NTILE(5) scores (5
    best; ties by customer_id) and the segment by the rules, in order:
    R>=4 & F>=4 Champions; R>=3 & F>=3 Loyal; R>=4 & F<=2 New/Recent;
    R<=2 & F>=3 At Risk; R<=2 & F<=2 Lost; M>=4 High Spender; else
    Potential Loyal."""
    base = not_cancelled(t.orders).groupBy("customer_id").agg(
        F.datediff(F.lit(snapshot).cast("date"), F.max("order_date")).alias("recency"),
        F.countDistinct("order_id").alias("frequency"),
        F.sum("order_total").alias("monetary"))
    # Written once; the boundaries of all three scores come from the same counting rounds.
    ensure_checkpoint_dir(t.spark)
    cid = ("customer_id", False)
    s = ntiles(base.checkpoint(eager=True), {"r_score": (5, [("recency", True), cid]), "f_score": (5, [("frequency", False), cid]),
                                             "m_score": (5, [("monetary", False), cid])})
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    seg = (F.when((r >= 4) & (f >= 4), SEGMENTS[0]).when((r >= 3) & (f >= 3), SEGMENTS[1])
           .when((r >= 4) & (f <= 2), SEGMENTS[2]).when((r <= 2) & (f >= 3), SEGMENTS[3])
           .when((r <= 2) & (f <= 2), SEGMENTS[4]).when(m >= 4, SEGMENTS[5])
           .otherwise(SEGMENTS[6]))
    return s.select("customer_id", "recency", F.col("frequency").cast("long").alias("frequency"),
                    rnd("monetary").alias("monetary"), "r_score", "f_score", "m_score",
                    seg.alias("segment"))


def rfm_segments(t: Tables, snapshot: str = "2025-01-01") -> DataFrame:
    """Per segment customers, mean recency / frequency / monetary,
    total revenue and share of revenue %."""
    s = rfm_scores(t, snapshot)
    g = s.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"), F.avg("recency").alias("_r"),
        F.avg("frequency").alias("_f"), exact_avg("monetary", 2).alias("_m"),
        F.sum(F.col("monetary").cast("decimal(38,2)")).alias("_rev"))
    return _share(g).orderBy(F.col("_rev").desc(), "segment").select("segment", "customers", rnd("_r").alias("avg_recency"),
                            rnd("_f").alias("avg_freq"), rnd("_m").alias("avg_monetary"),
                            rnd("_rev").alias("total_rev"), F.col("share_pct").alias("pct_revenue"))


def new_vs_returning(t: Tables) -> DataFrame:
    """Per month customers in their first month vs returning ones."""
    act = not_cancelled(t.orders).select(
        "customer_id", F.trunc("order_date", "MM").alias("_m")).distinct()
    first = act.groupBy("customer_id").agg(F.min("_m").alias("_first"))
    j = act.join(first, "customer_id")
    return j.groupBy("_m").agg(
        F.count_if(F.col("_m") == F.col("_first")).alias("new_customers"),
        F.count_if(F.col("_m") > F.col("_first")).alias("returning_customers"),
    ).select(ym(F.col("_m")).alias("ym"), "new_customers", "returning_customers")


def cohort_matrix(t: Tables, max_offset: int = 12) -> DataFrame:
    """Wide retention matrix, one column m0..m{max_offset} with the
    fraction (0-1, 4 dp) of the cohort active at that offset.  The cohort
    size is FIRST_VALUE over the offsets of the cohort (WIN15; at most
    max_offset + 1 rows per cohort)."""
    by_cohort = Window.partitionBy("cohort_month").orderBy("month_offset")
    c = (cohort_counts(t, max_offset).drop("cohort_size")
         .withColumn("cohort_size", F.first("active_customers").over(by_cohort))
         .withColumn("_rate", F.col("active_customers") / F.col("cohort_size")))
    w = (c.groupBy("cohort_month", "cohort_size").pivot("month_offset", list(range(max_offset + 1)))
         .agg(F.first("_rate")))
    return w.select(ym(F.col("cohort_month")).alias("cohort_month"),
                    F.col("cohort_size").cast("long").alias("cohort_size"),
                    *[rnd(F.col(str(i)), 4).alias(f"m{i}") for i in range(max_offset + 1)])


def _by_customer_attr(t: Tables, keys: Sequence[str]) -> DataFrame:
    attrs = t.customers.select("customer_id", *keys)
    return (_per_customer(t).join(attrs, "customer_id", "left")
            .groupBy(*keys).agg(F.sum("_rev").alias("_rev"),
                                F.sum("_orders").cast("long").alias("orders"),
                                F.count(F.lit(1)).alias("customers")))


def revenue_by_country(t: Tables) -> DataFrame:
    """Per country revenue, orders and customers."""
    g = _by_customer_attr(t, ["country"]).filter(F.col("country").isNotNull())
    return g.select("country", rnd("_rev").alias("revenue"), "orders", "customers")


def top_cities(t: Tables, n: int = 20) -> DataFrame:
    """Top ``n`` customer cities by revenue (ties by city)."""
    g = _by_customer_attr(t, ["city"]).filter(F.col("city").isNotNull())
    return (g.orderBy(F.col("_rev").desc(), "city").limit(n)
            .select("city", rnd("_rev").alias("revenue"), "orders", "customers"))


def revenue_by_age_gender(t: Tables) -> DataFrame:
    """Revenue, orders and customers per age group x gender."""
    g = _by_customer_attr(t, ["age_group", "gender"])
    return g.select("age_group", "gender", rnd("_rev").alias("revenue"), "orders", "customers")


def status_share(t: Tables) -> DataFrame:
    """D1r: orders per status and share % (NULL status excluded)."""
    g = (t.orders.filter(F.col("status").isNotNull()).groupBy("status")
         .agg(F.count(F.lit(1)).alias("orders")))
    return _share(g, "orders").select("status", "orders", "share_pct")


def delivery_time_by_country(t: Tables) -> DataFrame:
    """D2r: mean days from order to delivery per country (Delivered orders
    with a delivery date)."""
    d = (t.orders_delivery().filter((F.col("status") == "Delivered")
                                    & F.col("delivery_date").isNotNull())
         .withColumn("_days", F.datediff("delivery_date", "order_date")))
    key = "country" if t.customer_geo is None else "customer_id"  # orders may carry their country
    g = d.groupBy(key).agg(F.sum("_days").alias("_s"), F.count(F.lit(1)).alias("_n"))
    if t.customer_geo is not None:
        g = g.join(t.customer_geo, "customer_id", "left")
    g = (g.filter(F.col("country").isNotNull()).groupBy("country").agg(F.sum("_s").alias("_s"), F.sum("_n").alias("orders")))
    return g.select("country", rnd(F.col("_s") / F.col("orders")).alias("avg_delivery_days"),
                    F.col("orders").cast("long").alias("orders"))


def return_rate_by_category(t: Tables) -> DataFrame:
    """D3r: per category, Delivered orders containing it, those with a
    return, and the rate %."""
    delivered = t.orders.filter(F.col("status") == "Delivered").select("order_id")
    oc = (t.order_items.join(delivered, "order_id", "left_semi").select("order_id", "product_id")
          .join(t.products.select("product_id", "category"), "product_id")
          .select("order_id", "category").distinct())
    returned = t.returns.select("order_id").distinct().withColumn("_r", F.lit(1))
    g = (oc.join(returned, "order_id", "left").groupBy("category")
         .agg(F.count(F.lit(1)).alias("delivered_orders"),
              F.count("_r").alias("returned_orders")))
    return g.select("category", "delivered_orders", "returned_orders",
                    rnd(F.col("returned_orders") * 100.0 / F.col("delivered_orders"))
                    .alias("return_rate_pct"))


def return_reason_breakdown(t: Tables) -> DataFrame:
    """D4r: per reason returns, share % and total refund."""
    g = (t.returns.filter(F.col("reason").isNotNull()).groupBy("reason")
         .agg(F.count(F.lit(1)).alias("returns"), F.sum("refund_amount").alias("_ref")))
    return _share(g, "returns").select("reason", "returns", "share_pct",
                                       rnd("_ref").alias("total_refund"))


def low_stock_alerts(t: Tables) -> DataFrame:
    """D5r: active products whose stock band is not Healthy."""
    band = bin_right(F.col("stock_quantity"), STOCK_EDGES, STOCK_LABELS)
    return (t.products.filter(F.col("is_active") == 1).withColumn("stock_status", band)
            .filter(F.col("stock_status").isNotNull() & (F.col("stock_status") != "Healthy"))
            .select("product_id", "product_name", "category", "stock_quantity", "stock_status"))


def ytd_and_mom(t: Tables) -> DataFrame:
    """Monthly revenue, running year-to-date total and % change from the
    previous month (one row per month: windows are calendar-bounded)."""
    m = (not_cancelled(t.orders).groupBy(F.trunc("order_date", "MM").alias("_m"))
         .agg(F.sum("order_total").alias("_rev")))
    ytd = Window.partitionBy(F.year("_m")).orderBy("_m").rowsBetween(Window.unboundedPreceding, 0)
    prev = F.lag("_rev").over(Window.orderBy("_m"))
    return m.select(ym(F.col("_m")).alias("ym"), F.year("_m").alias("year"),
                    rnd("_rev").alias("revenue"), rnd(F.sum("_rev").over(ytd)).alias("ytd_revenue"),
                    rnd((F.try_divide(F.col("_rev"), F.when(prev != 0, prev)) - 1) * 100)
                    .alias("mom_pct"))


def category_rank_monthly(t: Tables) -> DataFrame:
    """Per month the categories ranked by revenue (RANK, 1 = top)."""
    live = not_cancelled(t.orders).select("order_id", ym(F.col("order_date")).alias("ym"))
    per = (t.order_items.select("order_id", "product_id", "line_total").join(live, "order_id")
           .groupBy("ym", "product_id").agg(F.sum("line_total").alias("_rev"))
           .join(t.products.select("product_id", "category"), "product_id")
           .groupBy("ym", "category").agg(F.sum("_rev").alias("_rev")))
    w = Window.partitionBy("ym").orderBy(F.col("_rev").desc())
    return per.select("ym", "category", rnd("_rev").alias("revenue"),
                      F.rank().over(w).alias("rank"))


def purchase_gap(t: Tables) -> DataFrame:
    """Per customer with two or more orders the mean, min and max days
    between consecutive orders.

    Orders are first counted per customer and day: a day with several orders
    gives zero gaps, and the window sees at most one row per customer and
    calendar day, however many orders one customer holds.  An order without
    a date counts as an order but bounds no gap."""
    daily = not_cancelled(t.orders).groupBy("customer_id", "order_date").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("customer_id").orderBy("order_date")
    dated = F.col("order_date").isNotNull()
    gap = F.datediff("order_date", F.lag("order_date").over(w))
    g = daily.select("customer_id", "_n", gap.alias("_g"), F.when(dated, F.col("_n") - 1).otherwise(0).alias("_zero"))
    total = F.coalesce(F.sum("_g"), F.lit(0))
    n_gaps = F.count("_g") + F.sum("_zero")
    some = F.max("_zero") > 0
    return (g.groupBy("customer_id").agg(
        F.sum("_n").alias("orders"), F.try_divide(total, n_gaps).alias("_avg"),
        F.when(some, F.lit(0)).otherwise(F.min("_g")).alias("min_gap_days"),
        F.coalesce(F.max("_g"), F.when(some, F.lit(0))).alias("max_gap_days"))
        .filter(F.col("orders") >= 2)
        .select("customer_id", "orders", rnd("_avg").alias("avg_gap_days"), "min_gap_days",
                "max_gap_days"))


def _daily_revenue(t: Tables) -> DataFrame:
    nc = not_cancelled(t.orders)
    daily = nc.groupBy("order_date").agg(F.sum("order_total").alias("_rev"))
    bounds = nc.agg(F.min("order_date").alias("_lo"), F.max("order_date").alias("_hi"))
    spine = bounds.select(F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 day"))).alias("date"))
    return (spine.join(daily, F.col("date") == F.col("order_date"), "left")
            .select("date", F.coalesce(F.col("_rev"), F.lit(0).cast("decimal(38,2)")).alias("_rev")))


def time_intelligence(t: Tables) -> DataFrame:
    """Daily revenue over the order date range with month-to-date,
    year-to-date, same day last year and previous-month totals."""
    d = _daily_revenue(t)
    mtd = Window.partitionBy(F.trunc("date", "MM")).orderBy("date").rowsBetween(
        Window.unboundedPreceding, 0)
    ytd = Window.partitionBy(F.year("date")).orderBy("date").rowsBetween(
        Window.unboundedPreceding, 0)
    monthly = d.groupBy(F.trunc("date", "MM").alias("_pm")).agg(F.sum("_rev").alias("_prev_m"))
    last_year = d.select(F.col("date").alias("_ly"), F.col("_rev").alias("_ly_rev"))
    out = (d.withColumns({"_mtd": F.sum("_rev").over(mtd), "_ytd": F.sum("_rev").over(ytd),
                          "_ly": F.add_months("date", -12),
                          "_pm": F.add_months(F.trunc("date", "MM"), -1)})
           .join(last_year, "_ly", "left").join(monthly, "_pm", "left"))
    return out.select("date", rnd("_rev").alias("revenue"), rnd("_mtd").alias("mtd_revenue"),
                      rnd("_ytd").alias("ytd_revenue"), rnd("_ly_rev").alias("same_day_last_year"),
                      rnd("_prev_m").alias("prev_month_revenue"))


def date_dimension(t: Tables) -> DataFrame:
    """Calendar attributes for every day in the order date range."""
    b = t.orders.agg(F.min("order_date").alias("_lo"), F.max("order_date").alias("_hi"))
    d = F.col("date")
    return (b.select(F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 day"))).alias("date"))
            .select("date", F.year(d).alias("year"), F.quarter(d).alias("quarter"),
                    F.month(d).alias("month"), F.date_format(d, "MMMM").alias("month_name"),
                    week_w(d).alias("week"), weekday_name(d).alias("day_of_week")))


def return_rate_trend(t: Tables) -> DataFrame:
    """Per month returns (by return date) over Delivered orders (by
    order date), zero-filled over the span of both."""
    r = t.returns.groupBy(F.trunc("return_date", "MM").alias("_m")).agg(
        F.count(F.lit(1)).alias("returns"))
    dl = (t.orders.filter(F.col("status") == "Delivered")
          .groupBy(F.trunc("order_date", "MM").alias("_m"))
          .agg(F.count(F.lit(1)).alias("delivered_orders")))
    months = r.select("_m").unionByName(dl.select("_m"))
    spine = month_spine(months, "_m", "_m")
    j = spine.join(r, "_m", "left").join(dl, "_m", "left")
    rc = F.coalesce(F.col("returns"), F.lit(0))
    dc = F.coalesce(F.col("delivered_orders"), F.lit(0))
    return j.select(ym(F.col("_m")).alias("ym"), rc.cast("long").alias("returns"),
                    dc.cast("long").alias("delivered_orders"),
                    rnd(F.try_divide(rc * 100.0, F.when(dc != 0, dc))).alias("return_rate_pct"))


def rating_vs_sales(t: Tables) -> DataFrame:
    """T4: per product rating, units and revenue (0 when unsold)."""
    s = product_sales(t)
    return (t.products.select("product_id", "rating").join(s, "product_id", "left")
            .select("product_id", F.col("rating").cast("double").alias("rating"),
                    F.coalesce(F.col("units_sold"), F.lit(0)).cast("long").alias("units"),
                    rnd(F.coalesce(F.col("_rev"), F.lit(0))).alias("revenue")))

