"""Ranked search against brute force, its tree and its SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from ledgerlens.llm import lexical_search as S
from ledgerlens.llm import queries as Q
from tests.llm import fixtures as X

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = {}
    for item, some in asked.items():
        scored = []
        for i, c in held:
            n = sum(c.values())
            m = 50 + 50 * n * n_docs // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in some)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out[item] = [(None if none else i, -s) for s, none, i in sorted(scored)[:k]]
    return {item: rows for item, rows in out.items() if rows}


def ranked(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r.item_id, []).append(r)
    assert all([r["rank"] for r in rows] == list(range(1, len(rows) + 1)) for rows in out.values())
    return {item: [(r.doc_id, r.score) for r in rows] for item, rows in out.items()}


def items_frame(spark, data):
    from pyspark.sql import functions as F
    return spark.createDataFrame(data, "item_id long, text string").withColumns({c: F.lit(1) for c in ("item", "rank", "n", "terms")})


@pytest.fixture(scope="module")
def data():
    rnd = random.Random(11)
    docs = X.rows() + [(500 + i, X.prose(rnd, rnd.randint(1, 200), 900)) for i in range(700)]
    docs += [(2000 + i, docs[70][1]) for i in range(150)]  # more copies than an item's best
    docs += [(3000, "ÀÉ àé Z_z z-Z 9a\x7f9A"), (None, docs[3][1])]
    items = [(i, X.prose(rnd, rnd.randint(1, 30), 900)) for i in range(37)]
    items += [(40, None), (41, ""), (42, "!?"), (43, "nowhere"), (44, docs[70][1]), (45, "à z 9a 日本語"),
              (0, "w1 w2"), (None, "w3 w4")]
    return docs, items


def test_search_is_brute_force(spark, data):
    docs, items = data
    for k in (50, 3):
        got = ranked(S.search(X.documents(spark, docs).repartition(6), items_frame(spark, items), k=k))
        assert got == brute(docs, items, k)


def test_blocks_and_small_chunks(spark, data, monkeypatch):
    docs, items = data
    monkeypatch.setattr(S, "BLOCK_ITEMS", 10)
    for name, value in (("BLOCK_TERMS", 100), ("CHUNK", 64), ("SEED_SHARE", 4)):
        monkeypatch.setattr(S, name, value)
    got = ranked(S.search(X.documents(spark, docs).repartition(3), items_frame(spark, items), k=5))
    assert got == brute(docs, items, 5)


def test_odd_tables(spark):
    docs, items = X.documents(spark, [(1, "a b"), (1, "a b"), (None, "a"), (2, None)]), items_frame(spark, [(7, "a A b")])
    got = ranked(S.search(docs, items))
    assert got == brute([(1, "a b"), (1, "a b"), (None, "a"), (2, None)], [(7, "a A b")], 50) and len(got[7]) >= 2
    assert S.search(X.documents(spark, []), items).count() == 0
    assert S.search(docs, items_frame(spark, [])).count() == 0
    assert S.search(X.documents(spark, [(1, "!")]), items).count() == 0


def test_tree_bounds_and_pruning():
    """Nodes hold the maxima of their rows, and far documents are never scored."""
    rng = np.random.default_rng(3)
    m = rng.random((64, 9)) * (rng.random((64, 9)) < 0.3)
    order = S.tree_order(m, 4)
    assert sorted(order.tolist()) == list(range(64))
    nodes = S.levels(m[order], 4)
    assert [len(x) for x in nodes] == [1, 2, 4, 8, 16]
    assert (nodes[0] == m.max(axis=0)).all() and (nodes[-1][3] == m[order][12:16].max(axis=0)).all()


def test_query_matches_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    want = sorted(con.execute(f"SELECT item_id, rank, doc_id, score FROM ({Q.OP11_SQL})").fetchall())
    got = sorted(map(tuple, Q.op11_lexical_search(spark, folder).select("item_id", "rank", "doc_id", "score").collect()))
    assert got == want and len(got) > 1000
