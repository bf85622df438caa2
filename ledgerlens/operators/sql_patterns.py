"""Q1-Q10: the ten analytical SQL patterns, as DataFrame plans.

Monthly / weekly / daily frames are bounded by the calendar, not by the data
size, so windows over them are cheap.  Everything that grows with the data
(customers, products, order pairs) is aggregated in parallel; the global
NTILE and running share use :mod:`ledgerlens.operators.ranking`.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.core import (
    days_between, month_offset, not_cancelled, rnd, week_w, weekday_name, year_week, ym,
)
from ledgerlens.functions.moments import scalar_spread
from ledgerlens.operators.ranking import day_spine
from ledgerlens.operators.selection import beyond, crossings, ntiles
from ledgerlens.session import ensure_checkpoint_dir
from ledgerlens.sources.adapter import Tables

# Fixed labels of the reference (must match its output text).
ANOMALY_LABEL = "⚠ ANOMALY"
NORMAL_LABEL = "Normal"
ACTION_ACTIVE = "✅ Active"
ACTION_WIN_BACK = "💛 Win-Back Offer"
ACTION_URGENT = "🔴 Urgent Reactivation"
ACTION_REENGAGE = "⚫ Re-engagement Campaign"


def date_spine_daily(t: Tables, start: str = "2022-01-01", end: str = "2024-12-31") -> DataFrame:
    """Q1: one row per calendar day with calendar fields, orders and revenue
    (0 on days without orders)."""
    o = not_cancelled(t.orders).filter(F.col("order_date").between(F.lit(start).cast("date"),
                                                                    F.lit(end).cast("date")))
    daily = o.groupBy("order_date").agg(
        F.countDistinct("order_id").alias("orders"),
        F.round(F.sum("order_total"), 2).alias("revenue"))
    spine = day_spine(t.spark, start, end, "date")
    d = F.col("date")
    return (spine.join(daily, d == F.col("order_date"), "left")
            .select(d,
                    F.date_format(d, "yyyy").alias("year"),
                    F.date_format(d, "MM").alias("month"),
                    week_w(d).alias("week"),
                    weekday_name(d).alias("day_of_week"),
                    F.coalesce(F.col("orders"), F.lit(0)).cast("long").alias("orders"),
                    rnd(F.coalesce(F.col("revenue"), F.lit(0))).alias("revenue"))
            .orderBy("date"))


def monthly_pivot(t: Tables, years: Sequence[int] = (2022, 2023, 2024)) -> DataFrame:
    """Q2: month x one revenue column per year, plus the all-years total.
    A month with no order in a year is NULL (not 0)."""
    o = not_cancelled(t.orders)
    yr = F.year("order_date")
    aggs = [rnd(F.sum(F.when(yr == y, F.col("order_total")))).alias(f"revenue_{y}")
            for y in years]
    aggs.append(rnd(F.sum("order_total")).alias("total_all_years"))
    return o.groupBy(F.date_format("order_date", "MM").alias("month")).agg(*aggs).orderBy("month")


def rolling_revenue(t: Tables, n: int = 3) -> DataFrame:
    """Q3: monthly revenue with an n-month rolling mean and total.  Months
    without orders are skipped (not zero-filled), as in the reference."""
    monthly = (not_cancelled(t.orders)
               .groupBy(ym(F.col("order_date")).alias("ym"))
               .agg(F.round(F.sum("order_total"), 2).alias("revenue")))
    # One row per month: the window is bounded by the calendar.
    w = Window.orderBy("ym").rowsBetween(-(n - 1), Window.currentRow)
    return monthly.select(
        "ym", rnd("revenue").alias("revenue"),
        rnd(F.avg("revenue").over(w)).alias(f"rolling_{n}m_avg"),
        rnd(F.sum("revenue").over(w)).alias(f"rolling_{n}m_total")).orderBy("ym")


def _kept(df: DataFrame) -> DataFrame:
    """A small frame of totals in the reliable checkpoint folder, for operators
    that read it several times."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def customer_lifetime_value(t: Tables) -> DataFrame:
    return (not_cancelled(t.orders).groupBy("customer_id")
            .agg(F.round(F.sum("order_total"), 2).alias("lifetime_value")))


def customer_deciles(t: Tables, n: int = 10) -> DataFrame:
    """Q4: NTILE(n) of customers by lifetime value (1 = top) with per-tile
    stats and share of revenue.  Ties broken by customer_id.  The tiles'
    boundaries are found by counting, so no customer is given a position."""
    # One row per customer, written once: the counting rounds and the result read it.
    ltv = _kept(customer_lifetime_value(t))
    tiles = ntiles(ltv, {"decile": (n, [("lifetime_value", True), ("customer_id", False)])})
    per = tiles.groupBy("decile").agg(
        F.count(F.lit(1)).alias("customers"),
        F.min("lifetime_value").alias("min_ltv"),
        F.max("lifetime_value").alias("max_ltv"),
        F.avg("lifetime_value").alias("avg_ltv"),
        F.sum("lifetime_value").alias("total_ltv"))
    # per has at most n rows; the grand total window is over those.
    grand = F.sum("total_ltv").over(Window.partitionBy())
    return per.select(
        "decile", "customers", rnd("min_ltv").alias("min_ltv"), rnd("max_ltv").alias("max_ltv"),
        rnd("avg_ltv").alias("avg_ltv"), rnd("total_ltv").alias("total_ltv"),
        rnd(F.try_divide(F.col("total_ltv") * 100, grand)).alias("pct_total_revenue")).orderBy("decile")


def customer_journey(t: Tables) -> DataFrame:
    """Q5: each customer's first, second and last order with the order
    count and the day gaps to the previous and next order.  Ties on the
    order date are broken by order_id.

    Only the first three and last two orders of a customer are ever ranked:
    Spark cuts a rank limit in each map task before the exchange, so a
    customer with any share of the orders sends a few rows per task.  The
    count is a partial aggregate."""
    base = not_cancelled(t.orders).select("customer_id", "order_id", "order_date", "order_total")
    up = Window.partitionBy("customer_id").orderBy("order_date", "order_id")
    down = Window.partitionBy("customer_id").orderBy(F.col("order_date").desc_nulls_last(),
                                                     F.col("order_id").desc_nulls_last())
    n = base.groupBy(F.col("customer_id").alias("_c")).agg(F.count(F.lit(1)).alias("total_orders"))
    first = (base.withColumn("order_rank", F.row_number().over(up)).filter(F.col("order_rank") <= 3)
             .withColumns({"prev_date": F.lag("order_date").over(up), "next_date": F.lead("order_date").over(up)})
             .filter(F.col("order_rank") <= 2))
    last = (base.withColumn("_back", F.row_number().over(down)).filter(F.col("_back") <= 2)
            .withColumn("prev_date", F.lead("order_date").over(down)).filter(F.col("_back") == 1)
            .select(*base.columns, F.lit(None).cast("int").alias("order_rank"), "prev_date",
                    F.lit(None).cast("date").alias("next_date")))
    # null-safe: NULL customers form one sequence, as in PARTITION BY
    j = first.unionByName(last).join(n, F.col("customer_id").eqNullSafe(F.col("_c")))
    return (j.filter(F.col("order_rank").isNotNull() | (F.col("total_orders") > 2))
            .select("customer_id", "order_id", "order_date", rnd("order_total").alias("order_total"),
                    F.coalesce(F.col("order_rank").cast("long"), F.col("total_orders")).alias("order_rank"),
                    "total_orders",
                    days_between(F.col("order_date"), F.col("prev_date")).alias("days_since_last"),
                    days_between(F.col("next_date"), F.col("order_date")).alias("days_to_next"))
            .orderBy("customer_id", "order_rank"))


def _items_in_live_orders(t: Tables, nulls: str = "drop") -> DataFrame:
    live = not_cancelled(t.orders, nulls).select("order_id")
    return t.order_items.join(live, "order_id", "left_semi")


def category_affinity(t: Tables, min_count: int = 50) -> DataFrame:
    """Q6: ordered category pairs (category of the lower product id first)
    that occur in the same non-cancelled order, counted in distinct orders.

    A pair (c1, c2) occurs in an order iff the lowest product id of c1 is
    below the highest product id of c2 there, so each order is first reduced
    to one row per category (min and max product id, partially aggregated),
    then to one row holding that short list (at most the number of
    categories, however large the order).  Pairs are formed inside that row,
    so the product self-join of the SQL (and its sort-merge) is not needed
    and a huge order cannot blow up.
    """
    # Products first: the order_id partitioning of the semi join then serves
    # both groupings.
    cat = t.products.select("product_id", "category")
    live = not_cancelled(t.orders).select("order_id")
    per_cat = (t.order_items.select("order_id", "product_id").join(cat, "product_id")
               .join(live, "order_id", "left_semi")
               .groupBy("order_id", "category")
               .agg(F.min("product_id").alias("lo"), F.max("product_id").alias("hi")))
    per_order = per_cat.groupBy("order_id").agg(
        F.collect_list(F.struct("category", "lo", "hi")).alias("cats"))
    pairs = (per_order.select(F.explode("cats").alias("a"), "cats")
             .select("a", F.explode("cats").alias("b"))
             .filter((F.col("a.category") != F.col("b.category")) & (F.col("a.lo") < F.col("b.hi")))
             .groupBy(F.col("a.category").alias("category_1"), F.col("b.category").alias("category_2"))
             .agg(F.count(F.lit(1)).alias("co_occurrences"))
             .filter(F.col("co_occurrences") >= min_count))
    n_orders = not_cancelled(t.orders).agg(F.countDistinct("order_id")).scalar()
    return pairs.select("category_1", "category_2", "co_occurrences",
                        rnd(F.col("co_occurrences") * 100.0 / n_orders, 4).alias("support_pct")
                        ).orderBy(F.col("co_occurrences").desc(), "category_1", "category_2")


def product_revenue(t: Tables, exclude_cancelled: bool = True) -> DataFrame:
    """Per product revenue (0 for products without sales)."""
    items = _items_in_live_orders(t) if exclude_cancelled else t.order_items
    sales = items.groupBy("product_id").agg(F.sum("line_total").alias("_rev"))
    return (t.products.select("product_id", "product_name", "category")
            .join(sales, "product_id", "left")
            .withColumn("revenue", F.coalesce(F.round("_rev", 2), F.lit(0).cast("decimal(38,2)")))
            .drop("_rev"))


def abc_classification(t: Tables, a: float = 0.80, b: float = 0.95,
                       exclude_cancelled: bool = True) -> DataFrame:
    """Q7: A/B/C classes by cumulative revenue share (products sorted by
    revenue desc, ties by product_id).  The product that crosses ``a`` lands
    in B; products without sales count 0 and land in C.

    ``exclude_cancelled=False`` reproduces the reference SQL, whose status
    test sits in the ON clause of an outer join and so keeps cancelled sales.
    Where all revenue adds up to nothing or less there are no shares: all is C.
    """
    pr = _kept(product_revenue(t, exclude_cancelled))
    cents = (F.col("revenue") * 100).cast("decimal(38,0)")
    total = int(pr.agg(F.sum(cents)).first()[0] or 0)
    # The products at which the share passes a and b; without revenue in all there is no share.
    limits = [int(Decimal(str(x)) * total) if total > 0 else -1 for x in (a, b)]
    order, first = crossings(pr, {"share": [("revenue", True), ("product_id", False)]}, {"share": limits}, cents)
    past = [beyond(order["share"], at) if total > 0 else F.lit(True) for at in first["share"]]
    cls = F.when(past[1], "C").when(past[0], "B").otherwise("A")
    per = (pr.withColumn("abc_class", cls)
           .groupBy("abc_class").agg(F.count(F.lit(1)).alias("products"),
                                     F.sum("revenue").alias("total_revenue"),
                                     F.avg("revenue").alias("avg_revenue")))
    grand = F.sum("total_revenue").over(Window.partitionBy())  # <= 3 rows
    return per.select("abc_class", "products", rnd("total_revenue").alias("total_revenue"),
                      rnd("avg_revenue").alias("avg_revenue"),
                      rnd(F.try_divide(F.col("total_revenue") * 100, grand)).alias("revenue_share_pct")
                      ).orderBy("abc_class")


def cohort_counts(t: Tables, max_offset: int = 12) -> DataFrame:
    """Distinct active customers per (cohort month, month offset)."""
    o = not_cancelled(t.orders)
    active = o.select("customer_id", F.trunc("order_date", "MM").alias("activity_month")).distinct()
    cohort = active.groupBy("customer_id").agg(F.min("activity_month").alias("cohort_month"))
    act = (active.join(cohort, "customer_id")
           .withColumn("month_offset", month_offset(F.col("activity_month"), F.col("cohort_month")))
           .filter(F.col("month_offset") <= max_offset))
    counts = act.groupBy("cohort_month", "month_offset").agg(
        F.count(F.lit(1)).alias("active_customers"))
    sizes = counts.filter(F.col("month_offset") == 0).select(
        "cohort_month", F.col("active_customers").alias("cohort_size"))
    return counts.join(sizes, "cohort_month")


def cohort_retention(t: Tables, max_offset: int = 12) -> DataFrame:
    """Q8: cohort (month of first order), size, month offset, active
    customers and retention %.  Built with real dates (the reference text
    parses 'YYYY-MM' as a date and returns nothing)."""
    c = cohort_counts(t, max_offset)
    return c.select(ym(F.col("cohort_month")).alias("cohort_month"),
                    F.col("cohort_size").cast("long").alias("cohort_size"),
                    "month_offset",
                    F.col("active_customers").cast("long").alias("active_customers"),
                    rnd(F.col("active_customers") * 100.0 / F.col("cohort_size"), 1)
                    .alias("retention_pct")).orderBy("cohort_month", "month_offset")


def weekly_anomaly(t: Tables, k: float = 2.0) -> DataFrame:
    """Q9: weekly revenue ('%Y-W%W' weeks) with z-score against all weeks;
    |z| > k is flagged (both directions, as the SQL does)."""
    weekly = (not_cancelled(t.orders)
              .groupBy(year_week(F.col("order_date")).alias("week"))
              .agg(F.round(F.sum("order_total"), 2).alias("revenue")))
    # Exact sums over the weekly frame, as scalar subqueries (Spark merges
    # them into one aggregate).
    (mean, std), = scalar_spread(weekly, ["revenue"], 2)
    z = F.try_divide(F.col("revenue").cast("double") - mean, F.when(std != 0, std))
    return weekly.select("week", rnd("revenue").alias("revenue"),
                         rnd(mean).alias("mean_revenue"), rnd(std).alias("std_deviation"),
                         rnd(z).alias("z_score"),
                         F.when(F.abs(z) > k, ANOMALY_LABEL).otherwise(NORMAL_LABEL).alias("status")
                         ).orderBy("week")


def next_best_action(t: Tables, snapshot: str = "2025-01-01", silver: float = 5000,
                     gold: float = 20000, platinum: float = 50000, limit: int | None = 50,
                     min_inactive: int = 90) -> DataFrame:
    """Q10: inactive (> min_inactive days) customers with totals, action and
    value tier; top ``limit`` by lifetime value (ties by customer_id), or
    all of them with ``limit=None``.

    Orders are aggregated per customer before the customer join."""
    per = (not_cancelled(t.orders).groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.round(F.sum("order_total"), 2).alias("ltv"),
        F.max("order_date").alias("last_order_date")))
    cust = t.customers.select(
        "customer_id", F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("name"),
        "email", "city", "country")
    inactive = F.datediff(F.lit(snapshot).cast("date"), F.col("last_order_date"))
    d = F.col("days_inactive")
    action = (F.when(d.between(91, 180), ACTION_WIN_BACK)
              .when(d.between(181, 365), ACTION_URGENT)
              .when(d > 365, ACTION_REENGAGE)
              .otherwise(ACTION_ACTIVE))
    v = F.col("ltv")
    tier = (F.when(v >= platinum, "Platinum").when(v >= gold, "Gold")
            .when(v >= silver, "Silver").otherwise("Bronze"))
    out = per.join(cust, "customer_id").withColumn("days_inactive", inactive).filter(d > min_inactive)
    if limit is not None:
        out = out.orderBy(F.col("ltv").desc(), F.col("customer_id").asc()).limit(limit)
    return (out
            .select("customer_id", "name", "email", "city", "country",
                    F.col("total_orders").cast("long").alias("total_orders"),
                    rnd("ltv").alias("lifetime_value"), "last_order_date", "days_inactive",
                    action.alias("recommended_action"), tier.alias("value_tier")))
