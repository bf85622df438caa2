"""Market basket over many categories: infrequent ones leave before pairs are made."""

import dataclasses
import random
from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from ledgerlens.operators import predictive as M
from ledgerlens.sources.adapter import load_tables

SF = "/root/testdata/sf0.001"
CATEGORIES = 10_000


def _tables(spark, rnd, n_orders=1500):
    """Orders over 10,000 categories, a few of them common; one huge order."""
    def some():
        common = {int(rnd.expovariate(0.08)) for _ in range(rnd.randint(1, 12))}
        return common | {rnd.randrange(CATEGORIES) for _ in range(rnd.randint(0, 8))}

    baskets = [some() for _ in range(n_orders)] + [set(range(0, CATEGORIES, 2))]
    t = load_tables(spark, SF)
    lines = spark.createDataFrame([(o, p) for o, b in enumerate(baskets) for p in b for _ in range(1 + p % 2)],
                                  "order_id long, product_id long")
    products = spark.range(CATEGORIES).select(F.col("id").alias("product_id"), F.format_string("c%05d", "id").alias("category"))
    orders = spark.range(len(baskets)).select(F.col("id").alias("order_id"), F.lit("Shipped").alias("status"))
    return dataclasses.replace(t, orders=orders, order_items=lines, products=products), baskets


def test_many_categories_equal_brute_force(spark, monkeypatch):
    t, baskets = _tables(spark, random.Random(8))
    least, n = 0.01, len(baskets)
    one = Counter(c for b in baskets for c in b)
    frequent = {c for c, k in one.items() if k / n >= least}
    two = Counter(p for b in baskets for p in combinations(sorted(b & frequent), 2))
    want = {(f"c{a:05d}", f"c{b:05d}"): k / n for (a, b), k in two.items() if k / n >= least}
    assert 20 < len(frequent) < 200 and len(want) > 50
    made = []
    pairs = M.basket_pairs
    monkeypatch.setattr(M, "basket_pairs", lambda sets: made.append(sets) or pairs(sets))
    got = M.market_basket(t, min_support=least).collect()
    assert {(r.category_A, r.category_B) for r in got} == want.keys()
    for r in got:
        support = want[r.category_A, r.category_B]
        sa, sb = (round(one[int(c[1:])] / n, 4) for c in (r.category_A, r.category_B))
        assert abs(r.support - support) <= 5.1e-5 and abs(r.lift - support / (sa * sb)) <= 5.1e-5
        assert r.rule_strength == ("Strong" if r.lift > 1.2 else "Moderate" if r.lift > 1.0 else "Weak") or abs(r.lift - 1.2) < 1e-3
    # The huge order alone has 12.5 million pairs of categories; only frequent ones are paired.
    longest, n_pairs = made[0].agg(F.max(F.size("cats")), F.sum(F.size("cats") * (F.size("cats") - 1) / 2)).first()
    assert longest <= len(frequent) and n_pairs <= sum(len(b & frequent) ** 2 / 2 for b in baskets)


def test_no_frequent_category(spark):
    t, _ = _tables(spark, random.Random(8), 50)
    assert M.market_basket(t, min_support=0.99).count() == 0
    assert M.market_basket(dataclasses.replace(t, order_items=t.order_items.limit(0)), min_support=0.01).count() == 0
