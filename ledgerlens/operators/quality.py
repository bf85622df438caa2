"""Data-quality checks.

Checks on one table are fused into a single aggregate (``count_if`` per
rule) and reshaped to long form, so each table is scanned once per report
instead of once per rule.  Orphan checks are anti joins.  Output of the
check reports: ``check_name, violations``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.core import not_cancelled, rnd
from ledgerlens.functions.moments import scalar_spread
from ledgerlens.sources.adapter import Tables

# Fixed labels of the reference.
GRADE_EXCELLENT = "✅ EXCELLENT"
GRADE_GOOD = "🟡 GOOD"
GRADE_FAIR = "🟠 FAIR"
GRADE_ATTENTION = "🔴 NEEDS ATTENTION"
VALID_STATUSES = ("Delivered", "Shipped", "Processing", "Cancelled")


def fused_counts(df: DataFrame, checks: Sequence[tuple[str, Column]],
                 name_col: str = "check_name", value_col: str = "violations",
                 agg: bool = False) -> DataFrame:
    """One pass over ``df``: ``count_if(cond)`` per check (or, with
    ``agg=True``, checks that are already aggregate expressions), as long
    rows."""
    row = df.agg(*[(expr if agg else F.count_if(expr)).alias(f"_c{i}")
                   for i, (_, expr) in enumerate(checks)])
    pairs = [F.struct(F.lit(name).alias(name_col), F.col(f"_c{i}").cast("long").alias(value_col))
             for i, (name, _) in enumerate(checks)]
    return row.select(F.inline(F.array(*pairs)))


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def dup_count(key: str, pandas_rule: bool = False) -> Column:
    """Aggregate expression for duplicates of ``key``, to fuse with the other
    checks of the same table: SQL rule ``COUNT(*) - COUNT(DISTINCT key)``
    (each NULL counts); pandas ``duplicated()`` rule additionally treats the
    first NULL as not duplicated."""
    out = F.count(F.lit(1)) - F.countDistinct(F.col(key))
    if pandas_rule:
        out = out - F.max(F.col(key).isNull().cast("int"))
    return out


def row_counts(t: Tables) -> DataFrame:
    """table_name, row_count."""
    frames = [df.agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(name).alias("table_name"), "row_count")
              for name, df in (("customers", t.customers), ("products", t.products),
                               ("orders", t.orders), ("order_items", t.order_items),
                               ("returns", t.returns))]
    return _union(frames).orderBy("table_name")


def null_checks(t: Tables) -> DataFrame:
    """Null counts of the eight critical columns."""
    n = lambda c: F.col(c).isNull()
    return _union([
        fused_counts(t.customers, [("customers - null customer_id", n("customer_id")),
                                   ("customers - null email", n("email"))]),
        fused_counts(t.orders, [("orders - null order_id", n("order_id")),
                                ("orders - null customer_id", n("customer_id")),
                                ("orders - null order_date", n("order_date")),
                                ("orders - null order_total", n("order_total"))]),
        fused_counts(t.order_items, [("order_items - null product_id", n("product_id"))]),
        fused_counts(t.products, [("products - null selling_price", n("selling_price"))]),
    ])


def uniqueness_checks(t: Tables) -> DataFrame:
    """D3: duplicate counts (SQL rule: every NULL counts); both customer
    keys in one aggregate over customers."""
    return _union([
        fused_counts(t.customers, [("customers - duplicate customer_id", dup_count("customer_id")),
                                   ("customers - duplicate email", dup_count("email"))], agg=True),
        fused_counts(t.products, [("products - duplicate product_id", dup_count("product_id"))],
                     agg=True),
        fused_counts(t.orders, [("orders - duplicate order_id", dup_count("order_id"))], agg=True),
    ])


def _orphans(child: DataFrame, key: str, parent: DataFrame, pkey: str, name: str) -> DataFrame:
    """Child rows whose key has no parent (NULL keys included).  Child keys
    are counted first (partial aggregation), so the anti join shuffles one
    row per distinct key and a hot key cannot skew it."""
    parents = parent.select(F.col(pkey).alias(key))
    keys = child.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return (keys.join(parents, key, "left_anti")
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("violations"))
            .select(F.lit(name).alias("check_name"), "violations"))


def referential_checks(t: Tables) -> DataFrame:
    """Orphan counts (a NULL foreign key counts as an orphan)."""
    return _union([
        _orphans(t.orders, "customer_id", t.customers, "customer_id",
                 "orders → customers (orphan orders)"),
        _orphans(t.order_items, "order_id", t.orders, "order_id",
                 "order_items → orders (orphan items)"),
        _orphans(t.order_items, "product_id", t.products, "product_id",
                 "order_items → products (missing products)"),
        _orphans(t.returns, "order_id", t.orders, "order_id",
                 "returns → orders (orphan returns)"),
    ])


def range_check_names(max_order_total: float, max_discount: float) -> list[str]:
    return [
        "orders - negative order_total", f"orders - order_total > {max_order_total:,}",
        "products - selling_price <= 0", "products - cost_price <= 0",
        "products - rating out of [1,5]", "order_items - quantity <= 0",
        "order_items - line_total < 0", f"order_items - discount_pct out of [0,{max_discount}]",
        "returns - refund_amount < 0"]


def range_checks(t: Tables, max_order_total: float = 10_000_000,
                 max_discount: float = 0.20) -> DataFrame:
    """Nine range rules (NULLs do not violate)."""
    nm = range_check_names(max_order_total, max_discount)
    c = F.col
    return _union([
        fused_counts(t.orders, [(nm[0], c("order_total") < 0),
                                (nm[1], c("order_total") > F.lit(max_order_total))]),
        fused_counts(t.products, [(nm[2], c("selling_price") <= 0), (nm[3], c("cost_price") <= 0),
                                  (nm[4], (c("rating") < 1) | (c("rating") > 5))]),
        fused_counts(t.order_items, [(nm[5], c("quantity") <= 0), (nm[6], c("line_total") < 0),
                                     (nm[7], (c("discount_pct") < 0)
                                      | (c("discount_pct") > F.lit(max_discount)))]),
        fused_counts(t.returns, [(nm[8], c("refund_amount") < 0)]),
    ])


def business_rule_checks(t: Tables, tolerance: float = 0.01) -> DataFrame:
    """Six business rules."""
    c = F.col
    o = t.orders_delivery()
    r = t.returns.select("order_id", "return_date").join(
        t.orders.select("order_id", F.col("status").alias("o_status"),
                        F.col("order_date").alias("o_date")), "order_id")
    expected = c("unit_price") * c("quantity") * (F.lit(1) - c("discount_pct"))
    mismatch = F.abs(c("line_total") - expected) / F.when(c("line_total") != 0, c("line_total"))
    return _union([
        fused_counts(o, [("Delivered orders without delivery_date",
                          (c("status") == "Delivered") & c("delivery_date").isNull()),
                         ("delivery_date before order_date",
                          c("delivery_date").isNotNull() & (c("delivery_date") < c("order_date")))]),
        fused_counts(r, [("Returns on non-Delivered orders", c("o_status") != "Delivered"),
                         ("Return date before order date", c("return_date") < c("o_date"))]),
        fused_counts(t.products, [("Products with cost >= selling price",
                                   c("cost_price") >= c("selling_price"))]),
        fused_counts(t.order_items, [("order_items - line_total mismatch (>1% tolerance)",
                                      mismatch > F.lit(tolerance))]),
    ])


def order_value_outliers(t: Tables, k: float = 3.0) -> DataFrame:
    """Non-cancelled orders with |z| > k against the non-cancelled mean
    and population std; z rounded to 2 dp."""
    nc = not_cancelled(t.orders)
    (mean, std), = scalar_spread(nc, ["order_total"], 2)
    z = F.try_divide(F.col("order_total").cast("double") - mean, F.when(std != 0, std))
    return (nc.filter(F.abs(z) > k)
            .select("order_id", "customer_id", "order_date", rnd("order_total").alias("order_total"),
                    rnd(z).alias("z_score"))
            .orderBy(F.col("z_score").desc(), "order_id"))


def completeness_summary(t: Tables) -> DataFrame:
    """Long form ``table_name, column_name, total_rows, null_count``
    (the reference's positional union mislabels the customer columns)."""
    def one(df: DataFrame, table: str, cols: Sequence[str], extra=None) -> DataFrame:
        row = df.agg(F.count(F.lit(1)).alias("_total"),
                     *[F.count_if(F.col(x).isNull()).alias(f"_n{i}") for i, x in enumerate(cols)
                       if x not in (extra or {})])
        for i, x in enumerate(cols):
            if x in (extra or {}):
                row = row.withColumn(f"_n{i}", extra[x])
        pairs = [F.struct(F.lit(table).alias("table_name"), F.lit(x).alias("column_name"),
                          F.col("_total").alias("total_rows"),
                          F.col(f"_n{i}").cast("long").alias("null_count"))
                 for i, x in enumerate(cols)]
        return row.select(F.inline(F.array(*pairs)))
    orders = t.orders
    extra = None
    if "channel" not in orders.columns:
        # channel lives on the customer: count orders per customer first and
        # join the (one row per customer) counts, not every order.
        per_c = orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_o"))
        null_channel = (per_c.join(t.customer_geo, "customer_id", "left")
                        .agg(F.coalesce(F.sum(F.when(F.col("channel").isNull(), F.col("_o"))),
                                        F.lit(0))).scalar())
        extra = {"channel": null_channel}
    return _union([
        one(orders, "orders", ["status", "order_total", "payment_method", "channel"], extra),
        one(t.customers, "customers", ["city", "country", "gender", "age_group"]),
    ])


def duplicate_line_items(t: Tables, limit: int = 20) -> DataFrame:
    """(order, product) pairs listed more than once; top ``limit``."""
    return (t.order_items.groupBy("order_id", "product_id")
            .agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1)
            .orderBy(F.col("occurrences").desc(), "order_id", "product_id")
            .limit(limit))


def quality_score(t: Tables) -> DataFrame:
    """Total violations over eight checks, score and grade."""
    c = F.col
    o = t.orders_delivery()
    frames = [
        fused_counts(t.customers, [("null customer_id", F.count_if(c("customer_id").isNull())),
                                   ("duplicate customer_id", dup_count("customer_id"))], agg=True),
        fused_counts(o, [("duplicate order_id", dup_count("order_id")),
                         ("negative order_total", F.count_if(c("order_total") < 0)),
                         ("delivered without date",
                          F.count_if((c("status") == "Delivered") & c("delivery_date").isNull())),
                         ("delivery before order",
                          F.count_if(c("delivery_date").isNotNull()
                                     & (c("delivery_date") < c("order_date"))))], agg=True),
        fused_counts(t.order_items, [("quantity <= 0", c("quantity") <= 0)]),
        fused_counts(t.products, [("selling_price <= 0", c("selling_price") <= 0)]),
    ]
    agg = _union(frames).agg(F.sum("violations").cast("long").alias("total_violations"),
                             F.count(F.lit(1)).alias("total_checks"))
    v = c("total_violations")
    score = (F.lit(1.0) - v.cast("double") / F.when(c("total_checks") * 1000 != 0,
                                                     c("total_checks") * 1000)) * 100
    grade = (F.when(v == 0, GRADE_EXCELLENT).when(v < 10, GRADE_GOOD)
             .when(v < 50, GRADE_FAIR).otherwise(GRADE_ATTENTION))
    return agg.select("total_violations", "total_checks", rnd(score).alias("quality_score_pct"),
                      grade.alias("quality_grade"))


def _gate(df: DataFrame, checks: Sequence[tuple[str, Column, int | None]]) -> DataFrame:
    """One aggregate over ``df`` for several gate checks.  Each check is
    ``(name, count expression, minimum)``: it passes when the count is 0, or
    at least ``minimum`` when one is given (volume checks)."""
    row = df.agg(*[expr.alias(f"_c{i}") for i, (_, expr, _m) in enumerate(checks)])
    pairs = []
    for i, (name, _, minimum) in enumerate(checks):
        v = F.col(f"_c{i}").cast("long")
        ok = (v == 0) if minimum is None else (v >= minimum)
        pairs.append(F.struct(F.lit(name).alias("check_name"), v.alias("observed"),
                              ok.alias("passed")))
    return row.select(F.inline(F.array(*pairs)))


def order_facts(t: Tables, max_discount: float = 0.20) -> DataFrame:
    """One row per order id (NULL is one) with what orders, lines and returns
    say about it: numbers of each, of violations of single-row rules, and the
    last ship date.

    The three tables are laid one under the other and aggregated once, in the
    map tasks first, so no table is read for one rule alone, nothing is joined,
    and an id of any number of rows is a few rows of the shuffle.
    """
    c = F.col
    flag = lambda cond: F.when(cond, 1).otherwise(0)
    delivered = c("status") == "Delivered"
    parts = [
        (t.orders, {"orders": F.lit(1), "invalid_status": flag(~F.coalesce(c("status").isin(*VALID_STATUSES), F.lit(False))),
                    "delivered": flag(delivered),
                    **({"undated": flag(delivered & c("delivery_date").isNull())} if "delivery_date" in t.orders.columns else {})}),
        (t.order_items, {"lines": F.lit(1), "no_product": flag(c("product_id").isNull()), "no_quantity": flag(c("quantity") <= 0),
                         "negative_total": flag(c("line_total") < 0),
                         "odd_discount": flag(~F.coalesce((c("discount_pct") >= 0) & (c("discount_pct") <= F.lit(max_discount)),
                                                          F.lit(False))),
                         **({"ship_date": c("ship_date")} if "ship_date" in t.order_items.columns else {})}),
        (t.returns, {"returns": F.lit(1)}),
    ]
    if t.deliveries is not None and "ship_date" not in t.order_items.columns:
        parts.append((t.deliveries, {"ship_date": c("ship_date")}))
    rows = None
    for df, values in parts:
        df = df.select("order_id", *[v.alias(k) for k, v in values.items()])
        rows = df if rows is None else rows.unionByName(df, allowMissingColumns=True)
    sums = [F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in rows.columns if k not in ("order_id", "ship_date")]
    dated = [F.max("ship_date").alias("ship_date")] if "ship_date" in rows.columns else []
    out = rows.groupBy("order_id").agg(*sums, *dated)
    if "undated" not in out.columns:  # a delivered order's date is that of its last line
        out = out.withColumn("undated", F.when(c("ship_date").isNull() | c("order_id").isNull(), c("delivered")).otherwise(0))
    return out


def quality_gate(t: Tables, max_discount: float = 0.20, min_customers: int = 1000,
                 min_orders: int = 5000) -> DataFrame:
    """The CI gate's assertions as rows ``check_name, observed, passed``
    plus a final row for the whole gate (passed only if every check passed).

    All rules on orders, lines and returns come from one aggregate by order
    id (``order_facts``); orders are read once more for their customers.  pandas rules:
    ``duplicated()`` treats NULLs as equal; ``isin`` and the range ``all()``
    tests fail on NULL."""
    c = F.col
    n_if = F.count_if
    everything = F.count(F.lit(1))
    facts = order_facts(t, max_discount)
    none = c("order_id").isNull()

    def total(x: str | Column) -> Column:
        return F.coalesce(F.sum(x), F.lit(0))

    rows = [
        _gate(t.customers, [("customers: null customer_id", n_if(c("customer_id").isNull()), None),
                            ("customers: duplicate customer_ids", dup_count("customer_id", True), None),
                            ("customers: duplicate emails", dup_count("email", True), None),
                            (f"customers: expected ≥{min_customers}", everything, min_customers)]),
        _gate(facts, [
            ("orders: null order_id", total(F.when(none, c("orders"))), None),
            ("orders: duplicate order_ids", total(F.greatest(c("orders") - 1, F.lit(0))), None),
            ("orders: invalid status", total("invalid_status"), None),
            (f"orders: expected ≥{min_orders}", total("orders"), min_orders),
            ("order_items: null product_id", total("no_product"), None),
            ("order_items: quantity must be > 0", total("no_quantity"), None),
            ("order_items: line_total must be >= 0", total("negative_total"), None),
            (f"order_items: discount_pct out of range [0, {max_discount}]", total("odd_discount"), None),
            ("orders: Delivered orders with null delivery_date", total("undated"), None),
            ("order_items: items with missing order_id", total(F.when(none | (c("orders") == 0), c("lines"))), None),
            ("returns: returns for non-delivered orders",
             n_if((c("returns") > 0) & (none | (c("delivered") == 0))), None)]),
        _gate(t.products, [
            ("products: selling_price must be > 0", n_if(c("selling_price") <= 0), None),
            ("products: cost_price must be > 0", n_if(c("cost_price") <= 0), None),
            ("products: rating out of range [1, 5]",
             n_if(~F.coalesce((c("rating") >= 1) & (c("rating") <= 5), F.lit(False))), None)]),
        _orphans(t.orders, "customer_id", t.customers, "customer_id", "orders: orders with missing customer_id")
        .select("check_name", c("violations").alias("observed"), (c("violations") == 0).alias("passed")),
    ]
    checks = _union(rows)
    gate = checks.agg(F.count_if(~c("passed")).cast("long").alias("observed")).select(
        F.lit("quality gate (all checks)").alias("check_name"), "observed",
        (c("observed") == 0).alias("passed"))
    return checks.unionByName(gate)
