"""KPI and dashboard aggregates (the numbers behind the HTML and
interactive dashboards), with optional year / country / channel filters.

Revenue by a customer attribute (channel, country) is aggregated per
customer first and joined to the customer dimension afterwards, so the join
carries one row per customer, not one per order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.core import bin_right, month_label, not_cancelled, rnd
from ledgerlens.functions.distinct import distinct_counts
from ledgerlens.operators.ranking import month_spine
from ledgerlens.sources.adapter import Tables

# Fixed values of the reference: stock bands and their labels; the outer bands are open.
STOCK_EDGES = (float("-inf"), 0, 10, 50, float("inf"))
STOCK_LABELS = ("Out of Stock", "Critical", "Low Stock", "Healthy")


def filtered_orders(t: Tables, years: Sequence[int] | None = None,
                    countries: Sequence[str] | None = None,
                    channels: Sequence[str] | None = None) -> DataFrame:
    """FLT9: year / country / channel selections ANDed; ``None`` means no
    filter, an empty list selects nothing; NULL never matches."""
    o = t.orders_geo() if (countries is not None or channels is not None) else t.orders
    cond = F.lit(True)
    if years is not None:
        cond = cond & (F.coalesce(F.year("order_date").isin(*years), F.lit(False))
                       if years else F.lit(False))
    if countries is not None:
        cond = cond & (F.coalesce(F.col("country").isin(*countries), F.lit(False))
                       if countries else F.lit(False))
    if channels is not None:
        cond = cond & (F.coalesce(F.col("channel").isin(*channels), F.lit(False))
                       if channels else F.lit(False))
    return o.filter(cond)


def executive_kpis(t: Tables, years=None, countries=None, channels=None) -> DataFrame:
    """K1: revenue, orders, customers, AOV, units, cancellation %, return %,
    active products and coupon % in one row.  Without filters the return
    rate is all returns over Delivered orders; with filters, returns of the
    selected Delivered orders over those orders.  Ratios are 0 on an empty
    selection.  Dashboard rule: a NULL status counts as not cancelled."""
    filtered = any(x is not None for x in (years, countries, channels))
    o = filtered_orders(t, years, countries, channels)
    live = (F.col("status") != "Cancelled") | F.col("status").isNull()
    flag = lambda cond: F.when(cond, 1).otherwise(0)
    # Both distinct counts and the sums in one pass over the orders.
    k = distinct_counts(o, {"orders": F.when(live, F.col("order_id")), "customers": F.when(live, F.col("customer_id"))}, {
        "_rev": F.when(live, F.col("order_total")), "_canc": flag(F.col("status") == "Cancelled"), "_all": F.lit(1),
        "_deliv": flag(F.col("status") == "Delivered"), "_coupons": F.when(live, F.col("coupon_used")),
        "_live": flag(live & F.col("coupon_used").isNotNull())})
    units = t.order_items.join(not_cancelled(o, "keep").select("order_id"), "order_id", "left_semi") \
        .agg(F.coalesce(F.sum("quantity"), F.lit(0)).cast("long")).scalar()
    if filtered:
        delivered = o.filter(F.col("status") == "Delivered").select("order_id")
        rets = t.returns.join(delivered, "order_id", "left_semi")
    else:
        rets = t.returns
    n_ret = rets.agg(F.count(F.lit(1))).scalar()
    active = t.products.agg(F.coalesce(F.sum("is_active"), F.lit(0)).cast("long")).scalar()
    one = k.select("*", units.alias("units"), n_ret.alias("_ret"), active.alias("active_products"))
    zero = F.lit(0.0)
    return one.select(
        rnd(F.coalesce(F.col("_rev"), F.lit(0))).alias("revenue"),
        F.col("orders").cast("long").alias("orders"),
        F.col("customers").cast("long").alias("customers"),
        rnd(F.coalesce(F.try_divide(F.col("_rev"), F.col("orders")), zero)).alias("aov"),
        "units",
        rnd(F.coalesce(F.try_divide(F.col("_canc") * 100.0, F.col("_all")), zero)).alias("cancel_rate_pct"),
        rnd(F.coalesce(F.try_divide(F.col("_ret") * 100.0, F.col("_deliv")), zero)).alias("return_rate_pct"),
        "active_products",
        rnd(F.coalesce(F.try_divide(F.col("_coupons") * 100.0, F.col("_live")), zero)).alias("coupon_rate_pct"))


def _zero_filled_monthly(events: DataFrame, date_col: str, value: Column, name: str) -> DataFrame:
    """AGG12: month-end resample with zero fill of empty months."""
    per = events.groupBy(F.trunc(date_col, "MM").alias("_m")).agg(value.alias("_v"))
    spine = month_spine(events, date_col, "_m")
    return (spine.join(per, "_m", "left")
            .select(F.last_day("_m").alias("month"),
                    F.coalesce(F.col("_v"), F.lit(0)).alias(name)))


def monthly_revenue(t: Tables, years=None, countries=None, channels=None) -> DataFrame:
    """K2: zero-filled month-end revenue series with a 'Mon YYYY' label
    (optionally over the filtered orders; NULL status kept, dashboard rule)."""
    o = filtered_orders(t, years, countries, channels)
    m = _zero_filled_monthly(not_cancelled(o, "keep"), "order_date", F.sum("order_total"), "_rev")
    return m.select("month", rnd("_rev").alias("revenue"), month_label(F.col("month")).alias("month_label"))


def mom_growth(t: Tables, years=None, countries=None, channels=None) -> DataFrame:
    """K3: K2 plus month-over-month growth % (NULL for the first month and
    after a zero month)."""
    m = monthly_revenue(t, years, countries, channels)
    w = Window.orderBy("month")  # one row per month
    prev = F.lag("revenue").over(w)
    return m.withColumn("mom_growth_pct",
                        rnd((F.try_divide(F.col("revenue"), F.when(prev != 0, prev)) - 1) * 100))


def revenue_by(t: Tables, dim: str, top: int | None = None, years=None, countries=None,
               channels=None) -> DataFrame:
    """K4: non-cancelled revenue by ``dim`` (channel, country or
    payment_method), largest first, optionally the top ``top`` and over the
    filtered orders (NULL status kept, dashboard rule)."""
    nc = not_cancelled(filtered_orders(t, years, countries, channels), "keep")
    if dim in nc.columns:
        g = nc.groupBy(dim).agg(F.sum("order_total").alias("_rev"))
    else:
        per_c = nc.groupBy("customer_id").agg(F.sum("order_total").alias("_c"))
        g = (per_c.join(t.customer_geo, "customer_id", "left")
             .groupBy(dim).agg(F.sum("_c").alias("_rev")))
    g = g.filter(F.col(dim).isNotNull())
    if top:
        g = g.orderBy(F.col("_rev").desc(), F.col(dim)).limit(top)
    return g.orderBy(F.col("_rev").desc(), F.col(dim)).select(dim, rnd("_rev").alias("revenue"))


def payment_mix(t: Tables) -> DataFrame:
    """K5: distinct non-cancelled orders per payment method (NULL status
    kept, dashboard rule)."""
    return (not_cancelled(t.orders, "keep").filter(F.col("payment_method").isNotNull())
            .groupBy("payment_method").agg(F.countDistinct("order_id").alias("orders"))
            .orderBy(F.col("orders").desc(), "payment_method"))


def status_distribution(t: Tables, years=None, countries=None, channels=None) -> DataFrame:
    """K6: orders per status (NULL excluded), optionally filtered."""
    o = filtered_orders(t, years, countries, channels)
    return (o.filter(F.col("status").isNotNull()).groupBy("status")
            .agg(F.count(F.lit(1)).alias("orders")))


def return_reasons(t: Tables) -> DataFrame:
    """K7: returns per reason."""
    return (t.returns.filter(F.col("reason").isNotNull()).groupBy("reason")
            .agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), "reason"))


def return_status_counts(t: Tables) -> DataFrame:
    """K7: returns per return status."""
    return (t.returns.filter(F.col("return_status").isNotNull()).groupBy("return_status")
            .agg(F.count(F.lit(1)).alias("count")))


def returns_kpis(t: Tables) -> DataFrame:
    """K8: count, total and mean refund, return rate (returns over Delivered
    orders; may exceed 100)."""
    r = t.returns.agg(F.count(F.lit(1)).alias("returns"), F.sum("refund_amount").alias("_tot"),
                      F.avg("refund_amount").alias("_avg"))
    d = t.orders.agg(F.count_if(F.col("status") == "Delivered")).scalar()
    return r.withColumn("_deliv", d).select(
        "returns", rnd(F.coalesce(F.col("_tot"), F.lit(0))).alias("total_refund"),
        rnd("_avg").alias("avg_refund"),
        rnd(F.try_divide(F.col("returns") * 100.0, F.col("_deliv"))).alias("return_rate_pct"))


def returns_over_time(t: Tables) -> DataFrame:
    """K9: zero-filled monthly count of returns."""
    m = _zero_filled_monthly(t.returns, "return_date", F.count("return_id"), "_n")
    return m.select("month", F.col("_n").cast("long").alias("returns"))


def inventory_health(t: Tables) -> DataFrame:
    """Products per stock band (every band listed, 0 when empty)."""
    band = bin_right(F.col("stock_quantity"), STOCK_EDGES, STOCK_LABELS)
    row = t.products.agg(*[F.count_if(band == lab).alias(f"_b{i}")
                           for i, lab in enumerate(STOCK_LABELS)])
    pairs = [F.struct(F.lit(lab).alias("stock_status"), F.col(f"_b{i}").cast("long").alias("products"),
                      F.lit(i + 1).alias("band_order")) for i, lab in enumerate(STOCK_LABELS)]
    return row.select(F.inline(F.array(*pairs)))


def product_sales(t: Tables) -> DataFrame:
    """Per product units and revenue over non-cancelled orders (items are
    aggregated per product before the product join)."""
    live = not_cancelled(t.orders).select("order_id")
    return (t.order_items.join(live, "order_id", "left_semi")
            .groupBy("product_id").agg(F.sum("quantity").alias("units_sold"),
                                       F.sum("line_total").alias("_rev")))


def top_products(t: Tables, n: int = 10) -> DataFrame:
    """Top ``n`` products by revenue (ties by product_id), with a
    1-based display position (SRT6; the window runs over the n-row result)."""
    s = product_sales(t).orderBy(F.col("_rev").desc(), "product_id").limit(n)
    pos = F.row_number().over(Window.orderBy(F.col("_rev").desc(), F.col("product_id")))
    return (s.join(t.products.select("product_id", "product_name", "category", "brand"), "product_id")
            .select(pos.alias("position"), "product_id", "product_name", "category", "brand",
                    F.col("units_sold").cast("long").alias("units_sold"), rnd("_rev").alias("revenue")))


def filter_domains(t: Tables) -> DataFrame:
    """The selectable years, countries and channels (long form).

    Orders are reduced to their distinct (customer, year) before anything is
    joined; the output is bounded by the three domains."""
    def pairs(*fields: tuple[str, Column]) -> Column:
        return F.array(*[F.struct(F.lit(d).alias("domain"), v.alias("value")) for d, v in fields])

    year = F.year("order_date").cast("string")
    if t.customer_geo is None:
        out = t.orders.select(F.inline(pairs(("year", year), ("country", F.col("country")),
                                             ("channel", F.col("channel")))))
    else:
        years = t.orders.select(year.alias("value")).distinct().select(F.lit("year").alias("domain"), "value")
        buyers = t.orders.select("customer_id").distinct().join(t.customer_geo, "customer_id")
        out = years.unionByName(buyers.select(F.inline(pairs(("country", F.col("country")),
                                                             ("channel", F.col("channel"))))))
    return out.na.drop(subset=["value"]).distinct()


def chart_series(df: DataFrame, label: str, value: str, sort_key: Column,
                 scale: float = 1e6, places: int = 2) -> DataFrame:
    """K18 / SNK3: ordered label and value series as JSON text (value /
    scale, rounded half-up to ``places``), from an already aggregated frame
    whose size is bounded by its dimension (channels, months, top-k).
    Values are DECIMAL in the JSON, so they print in plain notation."""
    s = df.select(F.struct(sort_key.alias("k"), F.col(label).alias("l"),
                           F.col(value).alias("v")).alias("s"))
    a = s.agg(F.array_sort(F.collect_list("s")).alias("a"))
    dec = f"decimal(38,{places})"
    return a.select(
        F.to_json(F.transform("a", lambda x: x["l"])).alias("labels"),
        F.to_json(F.transform("a", lambda x: F.round(
            (x["v"] / F.lit(scale)).try_cast("decimal(38,6)"), places).cast(dec))).alias("values"))


def chart_channel_revenue(t: Tables) -> DataFrame:
    """K18 applied to revenue by channel (largest first)."""
    r = revenue_by(t, "channel")
    return chart_series(r, "channel", "revenue", F.struct(-F.col("revenue"), F.col("channel")))


def chart_top_products(t: Tables, n: int = 5, name_chars: int = 30) -> DataFrame:
    """K18 applied to the top ``n`` products: names cut to ``name_chars``
    characters (FN16), revenue in millions."""
    top = top_products(t, n).withColumn("short_name", F.substring("product_name", 1, name_chars))
    return chart_series(top, "short_name", "revenue",
                        F.struct(-F.col("revenue"), F.col("product_id")))


def forecast_view(forecast: DataFrame, last: int = 12) -> DataFrame:
    """The last ``last`` actual months and all forecast months, in
    millions."""
    actual = forecast.filter(F.col("type") == "actual").orderBy(F.col("ym").desc()).limit(last)
    fc = forecast.filter(F.col("type") == "forecast")
    return actual.unionByName(fc).select(
        "ym", "type", rnd(F.col("revenue") / 1e6).alias("revenue_m"),
        rnd(F.col("forecast_revenue") / 1e6).alias("forecast_revenue_m")).orderBy("ym", "type")
