"""Forecasting, churn, price elasticity, market basket, CLV and
discount analytics.

Only the first aggregation of each analysis touches fact rows; the model
and ratio steps run on per-month, per-customer or per-category frames.
Small fixed-size frames (12 calendar months, a forecast horizon, one-row
statistics) are broadcast.  Double arithmetic is written in the same order
as the oracle so results agree to the last rounded digit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.core import (
    bin_right, label_order, month_number, not_cancelled, rnd, sigmoid, ym,
)
from ledgerlens.functions.moments import exact_avg, fixed, scalar_spread
from ledgerlens.operators import logistic
from ledgerlens.session import ensure_checkpoint_dir, input_bytes
from ledgerlens.sources.adapter import Tables

# Fixed values of the reference: risk, CLV-tier and discount-band bins and
# their labels.
RISK_EDGES = (0.0, 0.3, 0.6, 0.8, 1.0)
RISK_LABELS = ("Low", "Medium", "High", "Critical")
CLV_LABELS = ("Bronze", "Silver", "Gold", "Platinum")
BAND_EDGES = (-0.01, 0.001, 0.05, 0.10, 0.15, 0.20)
BAND_LABELS = ("0%", "1-5%", "6-10%", "11-15%", "16-20%")


# ── M1 revenue forecast ─────────────────────────────────────────────────────
def monthly_revenue_series(t: Tables, base_year: int = 2022) -> DataFrame:
    """Non-cancelled (NULL status kept) monthly revenue and distinct orders."""
    d = not_cancelled(t.orders, "keep")
    return d.groupBy(ym(F.col("order_date")).alias("ym"),
                     month_number(F.col("order_date"), base_year).alias("month_num")).agg(
        F.sum("order_total").alias("revenue_dec"),
        F.countDistinct("order_id").alias("orders"))


def revenue_forecast(t: Tables, months: int = 6, base_year: int = 2022) -> DataFrame:
    """M1: actual monthly rows plus ``months`` forecast rows.

    Trend: OLS of revenue on the running month number (``regr_slope`` /
    ``regr_intercept``); forecast = trend x seasonality index (a calendar
    month's revenue over all years by the mean of those sums; 1.0 for one
    never seen).  Orders are read once: everything after the monthly series
    is windows over its rows, one a month."""
    every, same = Window.partitionBy(), Window.partitionBy("cal_month")
    monthly = monthly_revenue_series(t, base_year).withColumns({
        "revenue": F.col("revenue_dec").cast("double"), "cal_month": F.substring("ym", 6, 2).cast("int")})
    # Orders without a date are a group too; a group without any total is none.
    month = F.when(F.col("revenue_dec").isNotNull(), F.coalesce("cal_month", F.lit(0)))
    n_months = F.size(F.collect_set(month).over(every))
    per_month = F.try_divide(F.sum("revenue_dec").over(every).cast("double"), n_months)
    m = monthly.withColumns({
        "slope": F.regr_slope("revenue", "month_num").over(every),
        "intercept": F.regr_intercept("revenue", "month_num").over(every),
        "last_num": F.max("month_num").over(every), "last_ym": F.max("ym").over(every),
        "season": F.try_divide(F.sum("revenue_dec").over(same).cast("double"), per_month)})
    seasons = F.collect_set(F.struct("cal_month", "season")).over(every)  # 12 at most
    m = m.withColumn("seasons", F.filter(seasons, lambda x: x["cal_month"].isNotNull() & x["season"].isNotNull()))

    def future(i: Column) -> Column:
        period = F.add_months(F.to_date(F.concat(F.col("last_ym"), F.lit("-01"))), i)
        trend = F.col("slope") * (F.col("last_num") + i) + F.col("intercept")
        index = F.get(F.filter("seasons", lambda x: x["cal_month"] == F.month(period)), F.lit(0))["season"]
        adjusted = rnd(trend * F.coalesce(index, F.lit(1.0)))
        return F.struct(ym(period).alias("ym"), adjusted.alias("revenue"), F.lit(None).cast("long").alias("orders"),
                        F.lit("forecast").alias("type"), adjusted.alias("forecast_revenue"), rnd(trend).alias("trend_revenue"))

    actual = F.struct("ym", rnd("revenue_dec").alias("revenue"), F.col("orders").cast("long").alias("orders"),
                      F.lit("actual").alias("type"), rnd("revenue_dec").alias("forecast_revenue"),
                      F.lit(None).cast("double").alias("trend_revenue"))
    ahead = F.transform(F.sequence(F.lit(1), F.lit(months)), future)
    return m.select(F.inline(F.when(F.col("ym") == F.col("last_ym"), F.concat(F.array(actual), ahead)).otherwise(F.array(actual))))


def forecast_fit(t: Tables, base_year: int = 2022) -> DataFrame:
    """Trend slope, intercept and R² of the monthly series (one row)."""
    monthly = monthly_revenue_series(t, base_year).withColumn(
        "revenue", F.col("revenue_dec").cast("double"))
    return monthly.agg(rnd(F.regr_slope("revenue", "month_num")).alias("slope"),
                       rnd(F.regr_intercept("revenue", "month_num")).alias("intercept"),
                       rnd(F.regr_r2("revenue", "month_num"), 4).alias("r2"),
                       F.count(F.lit(1)).alias("months"))


# ── M2-M5 churn ─────────────────────────────────────────────────────────────
def _customer_stats(t: Tables, snapshot: str) -> DataFrame:
    d = not_cancelled(t.orders, "keep")
    return d.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"),
        F.countDistinct("order_id").alias("frequency"),
        F.sum("order_total").alias("monetary_dec")).withColumns({
            "recency": F.datediff(F.lit(snapshot).cast("date"), F.col("last_order")),
            "monetary": F.col("monetary_dec").cast("double"),
        })


def churn_features(t: Tables, snapshot: str = "2025-01-01", threshold: int = 180) -> DataFrame:
    """M2: per customer recency, frequency, monetary, last order, average
    order and the churn label (recency > threshold)."""
    s = _customer_stats(t, snapshot)
    return s.select("customer_id", "recency", F.col("frequency").cast("long").alias("frequency"),
                    rnd("monetary_dec").alias("monetary"), "last_order",
                    rnd(F.try_divide(F.col("monetary"), F.col("frequency"))).alias("avg_order"),
                    (F.col("recency") > threshold).cast("int").alias("churned"))


FEATURES = ("recency", "frequency", "monetary", "avg_order")
Model = tuple[float, Sequence[float]]  # intercept, weights of the scaled features


def churn_scores(t: Tables, snapshot: str = "2025-01-01", threshold: int = 180,
                 train_pct: int = 80, seed: int = 42, reg_param: float = 0.01,
                 drop_recency: bool = False, model: Model | None = None) -> DataFrame:
    """M3: z-scaled features (population std + 1e-8), deterministic hash
    split, logistic regression; every customer scored.

    The reference runs 2,000 plain gradient-descent epochs; here the same
    model family is fitted by Newton steps over exact sums (a small L2 penalty,
    because the label is a step of the recency feature and the unpenalised
    optimum diverges).  ``drop_recency`` removes the leaking feature.  A given
    ``model`` is applied as it is, without a fit."""
    s = _customer_stats(t, snapshot).select(
        "customer_id", "last_order", "recency", F.col("frequency").cast("double").alias("frequency"),
        "monetary", F.try_divide(F.col("monetary"), F.col("frequency")).alias("avg_order"),
        (F.col("recency") > threshold).cast("int").alias("churned"))
    feats = [f for f in FEATURES if not (drop_recency and f == "recency")]
    s = s.na.fill(0, subset=feats)
    # Means and deviations from exact sums, as scalar subqueries (merged by
    # Spark into one aggregate over the customer frame).
    z = s.select("*", *[((F.col(f) - mean) / (std + F.lit(1e-8))).alias(f"z_{f}")
                        for f, (mean, std) in zip(feats, scalar_spread(s, feats))])
    digits = F.substring(F.md5(F.concat_ws(":", F.col("customer_id").cast("string"), F.lit(str(seed)))), 1, 8)
    z = z.withColumn("is_test", F.conv(digits, 16, 10).cast("long") % 100 >= train_pct)
    if model is None:
        # One row per customer feeds the fit's many passes and every output:
        # written once to the reliable checkpoint folder, so the order
        # aggregation runs once and all outputs score the same features.
        ensure_checkpoint_dir(t.spark)
        z = z.checkpoint(eager=True)
        model = logistic.fit(z.filter(~F.col("is_test")), "churned", [f"z_{f}" for f in feats], reg_param)
    raw = sigmoid(logistic.margin(*model, [f"z_{f}" for f in feats]))
    shown = F.round(raw, 4)  # the bands go by the rounded probability, the prediction by the raw one
    return z.select("customer_id", "recency", F.col("frequency").cast("long").alias("frequency"),
                    rnd("monetary").alias("monetary"), rnd("avg_order").alias("avg_order"), "last_order",
                    "churned", "is_test", shown.alias("churn_probability"),
                    (raw >= 0.5).cast("int").alias("predicted"),
                    bin_right(shown, RISK_EDGES, RISK_LABELS).alias("churn_risk"))


def churn_metrics(t: Tables, **kw) -> DataFrame:
    """M4: accuracy, precision, recall, F1 on the test split, overall churn
    rate, and the confusion matrix as a nested struct (one row)."""
    s = churn_scores(t, **kw)
    c, p = F.col("churned"), F.col("predicted")
    test = F.col("is_test")
    m = s.agg(F.count_if(test & (p == 1) & (c == 1)).alias("TP"),
              F.count_if(test & (p == 0) & (c == 0)).alias("TN"),
              F.count_if(test & (p == 1) & (c == 0)).alias("FP"),
              F.count_if(test & (p == 0) & (c == 1)).alias("FN"),
              F.avg("churned").alias("churn_rate"))
    tp, tn, fp, fn = (F.col(x) for x in ("TP", "TN", "FP", "FN"))
    prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
    return m.select(rnd(F.try_divide(tp + tn, tp + tn + fp + fn), 4).alias("accuracy"),
                    rnd(prec, 4).alias("precision"), rnd(rec, 4).alias("recall"),
                    rnd(f1, 4).alias("f1_score"), rnd("churn_rate", 4).alias("churn_rate"),
                    F.struct(tp.alias("TP"), tn.alias("TN"), fp.alias("FP"), fn.alias("FN"))
                    .alias("confusion_matrix"))


def churn_metrics_flat(t: Tables, **kw) -> DataFrame:
    """M4 with the confusion matrix as columns."""
    m = churn_metrics(t, **kw)
    return m.select(*m.columns[:-1], "confusion_matrix.*")


def churn_risk_summary(t: Tables, **kw) -> DataFrame:
    """M5: customers, mean and total monetary per risk band (a probability
    that rounds to 0 gets no band and is left out)."""
    s = churn_scores(t, **kw).filter(F.col("churn_risk").isNotNull())
    return s.groupBy("churn_risk").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.col("monetary").cast("decimal(38,2)")).alias("_sum"), F.count("monetary").alias("_n"),
    ).select("churn_risk", "customers", rnd(F.try_divide(F.col("_sum"), F.col("_n"))).alias("avg_monetary"),
             rnd("_sum").alias("total_revenue")
    ).withColumn("risk_order", label_order(F.col("churn_risk"), RISK_LABELS))


def churn_risk_distribution(t: Tables, **kw) -> DataFrame:
    """Customers per risk band, in band order."""
    return churn_risk_summary(t, **kw).select(
        F.col("churn_risk").alias("risk"), F.col("customers").alias("count"), "risk_order")


def confusion_matrix(t: Tables, **kw) -> DataFrame:
    """2x2 confusion frame on the test split, both classes always."""
    m = churn_metrics(t, **kw).select("confusion_matrix.*")
    row = lambda actual, no, yes: F.struct(F.lit(actual).alias("actual"), F.col(no).alias("predicted_0"),
                                           F.col(yes).alias("predicted_1"))
    return m.select(F.inline(F.array(row(0, "TN", "FP"), row(1, "FN", "TP"))))


# ── M6 / M10 / M11 / E4 discount bands ──────────────────────────────────────
#: Bytes of line files a task.  The distinct order counts keep nearly every line of
#: a task in memory, twice, and its sort once more: some 300 bytes a line.
TASK_BYTES = 8 << 20
MOST_TASKS = 50_000
#: Bytes of product files from which they are surely not broadcast.
LARGE_PRODUCTS = 32 << 20


def _sold_lines(t: Tables, product_cols: Sequence[str]) -> DataFrame:
    # Products first, orders last: the order_id partitioning then also serves
    # the distinct order counts.  Lines that the session's partitions would make
    # large tasks of are dealt to more, so that a task's memory does not grow with them.
    live = not_cancelled(t.orders, "keep").select("order_id")
    products, items = t.products.select("product_id", *product_cols), t.order_items
    tasks = min(MOST_TASKS, -(-input_bytes(items) // TASK_BYTES))
    many = tasks > int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    if many and input_bytes(products) > LARGE_PRODUCTS:
        items = items.repartition(tasks, "product_id")
    items = items.join(products, "product_id")
    if many:
        items = items.repartition(tasks, "order_id")
    return items.join(live, "order_id", "left_semi")


def price_elasticity(t: Tables, edges: Sequence[float] = BAND_EDGES,
                     labels: Sequence[str] = BAND_LABELS) -> DataFrame:
    """M6 (first output): per category x discount band the mean and total
    quantity, mean line revenue and distinct orders."""
    lines = _sold_lines(t, ["category"]).withColumn(
        "discount_band", bin_right(F.col("discount_pct"), edges, labels))
    return (lines.filter(F.col("discount_band").isNotNull())
            .groupBy("category", "discount_band")
            .agg(F.avg("quantity").alias("avg_qty"), F.sum("quantity").alias("total_units"),
                 F.avg("line_total").alias("avg_revenue"),
                 F.countDistinct("order_id").alias("orders")))


def price_elasticity_bands(t: Tables, edges=BAND_EDGES, labels=BAND_LABELS) -> DataFrame:
    e = price_elasticity(t, edges, labels)
    return e.select("category", "discount_band", rnd("avg_qty", 4).alias("avg_qty"),
                    F.col("total_units").cast("long").alias("total_units"),
                    rnd("avg_revenue").alias("avg_revenue"),
                    F.col("orders").cast("long").alias("orders"))


def elasticity_summary(t: Tables, edges=BAND_EDGES, labels=BAND_LABELS, base: str = "0%",
                       target: str = "16-20%", price_change: float = -0.18) -> DataFrame:
    """M6 (second output): elasticity = ((target - base) / base) / price
    change per category that has both bands; elastic when |e| > 1 (before
    rounding)."""
    e = price_elasticity(t, edges, labels)
    per = e.groupBy("category").agg(
        F.max(F.when(F.col("discount_band") == base, F.col("avg_qty"))).alias("b"),
        F.max(F.when(F.col("discount_band") == target, F.col("avg_qty"))).alias("h"))
    per = per.filter(F.col("b").isNotNull() & F.col("h").isNotNull())
    pct = F.when(F.col("b") > 0, (F.col("h") - F.col("b")) / F.col("b")).otherwise(F.lit(0.0))
    el = pct / F.lit(float(price_change))
    return per.select("category", rnd("b").alias("base_avg_qty"), rnd("h").alias("discounted_avg_qty"),
                      rnd(el, 3).alias("price_elasticity"),
                      F.when(F.abs(el) > 1, "Yes").otherwise("No").alias("elastic"))


def _margin_lines(t: Tables, edges, labels) -> DataFrame:
    lines = _sold_lines(t, ["category", "cost_price"])
    lt = F.col("line_total").cast("double")
    margin = (lt - F.col("quantity") * F.col("cost_price").cast("double")) / F.greatest(lt, F.lit(0.01))
    return (lines.withColumns({"margin_pct": margin,
                               "discount_band": bin_right(F.col("discount_pct"), edges, labels)})
            .filter(F.col("discount_band").isNotNull()))


def _band_agg(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    return lines.groupBy(*keys).agg(
        F.countDistinct("order_id").alias("orders"), F.sum("quantity").alias("units"),
        F.sum("line_total").alias("revenue"), exact_avg("margin_pct").alias("avg_margin")
    ).withColumn("revenue_per_order", F.col("revenue") / F.greatest(F.col("orders"), F.lit(1)))


def _band_out(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys, F.col("orders").cast("long").alias("orders"),
                     F.col("units").cast("long").alias("units"), rnd("revenue").alias("revenue"),
                     rnd("avg_margin", 4).alias("avg_margin"),
                     rnd("revenue_per_order").alias("revenue_per_order"))


def discount_effect(t: Tables, edges=BAND_EDGES, labels=BAND_LABELS) -> DataFrame:
    """Per category x band orders, units, revenue, mean row margin
    ((line_total - qty x cost) / max(line_total, .01)) and revenue per order."""
    return _band_out(_band_agg(_margin_lines(t, edges, labels), ["category", "discount_band"]),
                     ["category", "discount_band"])


def discount_band_impact(t: Tables, edges=BAND_EDGES, labels=BAND_LABELS) -> DataFrame:
    """M10 without the category split."""
    return _band_out(_band_agg(_margin_lines(t, edges, labels), ["discount_band"]),
                     ["discount_band"])


def discount_recommendation(t: Tables, edges=BAND_EDGES, labels=BAND_LABELS,
                            min_margin: float = 0.30) -> DataFrame:
    """Per category the band with the highest revenue per order among
    bands with mean margin > min_margin (first band on ties); categories with
    no such band are absent."""
    agg = _band_agg(_margin_lines(t, edges, labels), ["category", "discount_band"])
    ok = agg.filter(F.col("avg_margin") > min_margin).withColumn(
        "_ord", label_order(F.col("discount_band"), labels))
    best = ok.groupBy("category").agg(F.max_by(
        F.struct("discount_band", "revenue_per_order", "avg_margin"),
        F.struct(F.col("revenue_per_order"), -F.col("_ord"))).alias("b"))
    return best.select("category", F.col("b.discount_band").alias("recommended_discount"),
                       rnd("b.revenue_per_order").alias("expected_revenue_per_order"),
                       rnd(F.col("b.avg_margin") * 100, 1).alias("expected_margin"))


# ── M7 market basket ────────────────────────────────────────────────────────
def market_basket(t: Tables, min_support: float = 0.005, strong: float = 1.2,
                  moderate: float = 1.0) -> DataFrame:
    """M7: category pairs (A < B by name) over orders with at least one known
    product: support (per category rounded to 4 dp before use), confidence
    both ways and lift; strength on the unrounded lift.

    Each order is reduced to its sorted set of categories (at most the number
    of categories, however large the order) and identical sets are counted once
    with a weight.  A pair is no more frequent than either category, so
    categories below ``min_support`` leave the sets before any pair is made:
    at most (mean categories an order) / ``min_support`` categories stay, and
    their number, not that of all categories, bounds the pairs of a set.
    Pairs are expanded per distinct set of those: no self-join and no
    per-order pair list."""
    lines = _sold_lines(t, ["category"]).filter(F.col("category").isNotNull())
    per_order = lines.groupBy("order_id").agg(
        F.array_sort(F.collect_set("category")).alias("cats"))
    sets = per_order.groupBy("cats").agg(F.count(F.lit(1)).alias("w"))
    n = sets.agg(F.sum("w")).scalar()
    counts = sets.select(F.explode("cats").alias("category"), "w").groupBy("category").agg(F.sum("w").alias("_c"))
    frequent = counts.filter(F.col("_c") / n >= min_support)
    sup = frequent.select("category", rnd(F.col("_c") / n, 4).alias("_s"))
    some = frequent.agg(F.coalesce(F.collect_list("category"), F.array().cast("array<string>"))).scalar()
    sets = (sets.select(F.array_intersect("cats", some).alias("cats"), "w").filter(F.size("cats") > 1)
            .groupBy("cats").agg(F.sum("w").alias("w")))
    pairs = (basket_pairs(sets).groupBy("category_A", "category_B").agg(F.sum("w").alias("_co"))
             .withColumn("co_support", F.col("_co") / n)
             .filter(F.col("co_support") >= min_support))
    # One row per category; the join strategy is left to AQE's measured size.
    sa = sup.select(F.col("category").alias("category_A"), F.col("_s").alias("s_a"))
    sb = sup.select(F.col("category").alias("category_B"), F.col("_s").alias("s_b"))
    j = pairs.join(sa, "category_A").join(sb, "category_B")
    cs = F.col("co_support")
    conf_ab = F.when(F.col("s_a") > 0, cs / F.col("s_a")).otherwise(F.lit(0.0))
    conf_ba = F.when(F.col("s_b") > 0, cs / F.col("s_b")).otherwise(F.lit(0.0))
    lift = F.when(F.col("s_a") * F.col("s_b") > 0,
                  cs / (F.col("s_a") * F.col("s_b"))).otherwise(F.lit(0.0))
    return j.select("category_A", "category_B", rnd(cs, 4).alias("support"),
                    rnd(conf_ab, 4).alias("confidence_a_to_b"),
                    rnd(conf_ba, 4).alias("confidence_b_to_a"), rnd(lift, 4).alias("lift"),
                    F.when(lift > strong, "Strong").when(lift > moderate, "Moderate")
                    .otherwise("Weak").alias("rule_strength")
                    ).orderBy(F.col("lift").desc(), "category_A", "category_B")


def basket_pairs(sets: DataFrame) -> DataFrame:
    """Pairs A < B of each set of ``sets(cats, w)``, ``cats`` being sorted."""
    first = sets.select(F.posexplode("cats").alias("_i", "category_A"), "cats", "w")
    return first.select("category_A", F.explode(F.slice("cats", F.col("_i") + 2, F.size("cats"))).alias("category_B"), "w")


# ── M8 / M9 CLV ─────────────────────────────────────────────────────────────
def clv_stats(t: Tables, snapshot: str = "2025-01-01",
              tiers: Sequence[float] = (5000, 20000, 50000)) -> DataFrame:
    s = _customer_stats(t, snapshot)
    tenure = F.greatest(F.datediff("last_order", "first_order"), F.lit(1))
    avg_order = F.try_divide(F.col("monetary"), F.col("frequency"))
    rate = F.col("frequency") / (F.col("tenure_days") / F.lit(30.0))
    ret = F.least(F.greatest(F.lit(1.0) - F.col("recency") / F.lit(730.0), F.lit(0.05)), F.lit(0.99))
    pred = F.greatest(F.col("purchase_rate") * F.lit(12.0) * F.col("retention_prob"), F.lit(0.1))
    edges = (-1.0, *[float(x) for x in tiers], float("inf"))
    out = (s.withColumn("tenure_days", tenure)
           .withColumns({"avg_order": avg_order, "purchase_rate": rate, "retention_prob": ret})
           .withColumn("predicted_orders_12m", pred)
           .withColumn("clv_12m", rnd(F.col("predicted_orders_12m") * F.col("avg_order"))))
    return out.withColumn("clv_tier", bin_right(F.col("clv_12m"), edges, CLV_LABELS))


def clv_prediction(t: Tables, snapshot: str = "2025-01-01",
                   tiers: Sequence[float] = (5000, 20000, 50000)) -> DataFrame:
    """M8: 12-month CLV heuristic per customer with tier, joined to the
    customer's city, country and acquisition channel."""
    s = clv_stats(t, snapshot, tiers)
    cust = t.customers.select("customer_id", "city", "country", "acquisition_channel")
    return s.join(cust, "customer_id").select(
        "customer_id", "first_order", "last_order", F.col("frequency").cast("long").alias("frequency"),
        rnd("monetary_dec").alias("monetary"), F.col("recency").alias("recency_days"),
        "tenure_days", rnd("avg_order").alias("avg_order"),
        rnd("purchase_rate", 4).alias("purchase_rate"),
        rnd("retention_prob", 4).alias("retention_prob"),
        rnd("predicted_orders_12m", 4).alias("predicted_orders_12m"), "clv_12m", "clv_tier",
        "city", "country", "acquisition_channel")


def clv_tier_summary(t: Tables, snapshot: str = "2025-01-01",
                     tiers: Sequence[float] = (5000, 20000, 50000)) -> DataFrame:
    """M9: customers, mean and total CLV per tier, plus a Total row."""
    s = clv_stats(t, snapshot, tiers).filter(F.col("clv_tier").isNotNull())
    per = s.groupBy("clv_tier").agg(F.count(F.lit(1)).alias("customers"),
                                    rnd(exact_avg("clv_12m", 2)).alias("avg_clv"),
                                    rnd(F.sum(fixed("clv_12m", 2))).alias("total_clv"))
    total = s.agg(F.count(F.lit(1)).alias("customers"), rnd(exact_avg("clv_12m", 2)).alias("avg_clv"),
                  rnd(F.sum(fixed("clv_12m", 2))).alias("total_clv")).select(
        F.lit("Total").alias("clv_tier"), "customers", "avg_clv", "total_clv")
    return per.unionByName(total).withColumn(
        "tier_order", F.coalesce(label_order(F.col("clv_tier"), CLV_LABELS), F.lit(5)))
