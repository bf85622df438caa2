"""NN-descent, URL lists and the pipeline."""

import datetime as dt
import os

import numpy as np
import pytest

import corpus_pipeline
from ledgerlens.llm import nn_descent, url_lists
from ledgerlens.llm import queries as Q
from scripts.check_oracle import compare, duck
from tests.llm import fixtures as X

SF = "/root/testdata/sf0.01"


def test_nn_descent(spark):
    rng = np.random.default_rng(4)
    vectors = list(rng.standard_normal((300, 16)))
    for k in range(40):  # a crowded group: more links than a list holds
        vectors.append(vectors[7] + 0.05 * rng.standard_normal(16))
    vectors += [vectors[3]] * 3 + [2.0 * vectors[9]]
    data = [(i, [float(x) for x in v], 0 if i in (7, 3, 9) or i >= 300 else i % 3) for i, v in enumerate(vectors)]
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [1.0, None] * 8, 1),
           (904, data[3][1], None), (905, [], 0), (906, data[3][1], 2), (907, [1.0, 2.0], 0), (907, [1.0, 2.0], 0)]
    df = spark.createDataFrame(data + odd, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS n", "2 AS unit")
    x = np.array([v for _, v, _ in data])
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([c for _, _, c in data])
    link = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    want = X.components(range(len(data)), [tuple(p) for p in np.argwhere(link).tolist()])
    out = nn_descent.near_duplicates(df).collect()
    got = {r.vec_id: r for r in out if r.vec_id < 900}
    assert {i: r.n_links for i, r in got.items()} == {i: int(n) for i, n in enumerate(link.sum(1))}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    rest = sorted((r.vec_id, r.n_links) for r in out if r.vec_id >= 900)
    assert rest == [(k, 0) for k in range(900, 907)] + [(907, 1), (907, 1)]
    assert nn_descent.near_duplicates(df.limit(0)).count() == 0


def brute(vectors, label, threshold=0.98):
    """The number of links of each vector, and its component."""
    x = np.array(vectors)
    x /= np.linalg.norm(x, axis=1)[:, None]
    link = (x @ x.T >= threshold) & (np.array(label)[:, None] == np.array(label)[None, :])
    np.fill_diagonal(link, False)
    return link.sum(1).tolist(), X.components(range(len(x)), [tuple(p) for p in np.argwhere(link).tolist()])


def vector_table(spark, vectors, label):
    return spark.createDataFrame([(i, [float(e) for e in v], c) for i, (v, c) in enumerate(zip(vectors, label))],
                                 "vec_id long, embedding array<double>, label int")


def test_nn_descent_joins_groups_whose_lists_are_full_of_their_own(spark):
    rng = np.random.default_rng(6)
    vectors = list(rng.standard_normal((100, 64)))
    for _ in range(3):  # two groups of 20 closer copies each, all links across just over the threshold
        a, b = rng.standard_normal((2, 64))
        a /= np.linalg.norm(a)
        b -= a * (a @ b)
        b = 0.984 * a + np.sqrt(1 - 0.984 ** 2) * b / np.linalg.norm(b)
        vectors += [c + 0.0005 * rng.standard_normal(64) for c in (a, b) for _ in range(20)]
    label = [0] * len(vectors)
    n_links, component = brute(vectors, label)
    assert n_links[100:] == [39] * 120
    got = {r.vec_id: r for r in nn_descent.near_duplicates(vector_table(spark, vectors, label)).collect()}
    assert [got[i].n_links for i in range(len(vectors))] == n_links
    assert {i: r.component_id for i, r in got.items()} == component
    assert [i for i in got if got[i].kept] and all(r.kept == (r.vec_id == component[r.vec_id]) for r in got.values())


def test_nn_descent_finds_lone_pairs_of_a_large_label(spark, monkeypatch):
    rng = np.random.default_rng(8)
    vectors = list(rng.standard_normal((3000, 16)))
    vectors += [v + 0.15 * np.linalg.norm(v) / 4 * rng.standard_normal(16) for v in vectors[:400]]
    label = [0] * len(vectors)
    n_links, component = brute(vectors, label)
    assert sum(n_links) > 400
    df = vector_table(spark, vectors, label)
    small = {"k": 2, "block": 4, "most_rounds": 1, "audit_every": 1}  # blocks as far below the label as in large tables
    out = nn_descent.near_duplicates(df, **small).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in out} == {i: (n, component[i]) for i, n in enumerate(n_links)}
    assert nn_descent._codes_for(10 ** 9, 0.98, 256, 8, 8, 0.001)[1] == 22
    monkeypatch.setattr(nn_descent, "_start", lambda objects, *_: objects.selectExpr("id AS u", "id AS v", "0D AS cos").limit(0))
    monkeypatch.setattr(nn_descent, "_crossing", lambda objects, *_: objects.selectExpr("id AS a", "id AS b").limit(0))
    with pytest.raises(RuntimeError, match="audited links"):
        nn_descent.near_duplicates(df, **small, most_passes=1)


def test_url_lists(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    events = [("block", "domain", "bad.example.com", "add", 5), ("block", "domain", "bad.example.com", "add", 7),
              ("block", "domain", "bad.example.com", "remove", 60), ("block", "domain", "bad.example.com", "add", 200),
              ("allow", "prefix", "www.bad.example.com/ok/", "add", 20), ("block", "domain", None, "add", 1),
              ("block", "domain", "never.example.com", "remove", 3), ("block", "domain", "same.example.com", "add", 9),
              ("block", "domain", "same.example.com", "remove", 9), ("block", "prefix", "h.example.com/a/b", "add", 1)]
    events = spark.createDataFrame([(a, b, c, d, day(n)) for a, b, c, d, n in events],
                                   "list string, kind string, pattern string, action string, day date")
    cases = [("http://www.bad.example.com/x", 4, False), ("http://www.bad.example.com/x", 5, True),
             ("HTTPS://user@WWW.Bad.example.com:80/x", 59, True), ("http://bad.example.com", 60, False),
             ("http://bad.example.com/", 300, True), ("http://notbad.example.com/", 300, False),
             ("http://www.bad.example.com/ok/page", 19, True), ("http://www.bad.example.com/ok/page", 20, False),
             ("http://never.example.com/", 10, False), ("http://same.example.com/", 9, False),
             ("http://h.example.com/a/b?q=1", 2, True), ("http://h.example.com/a/bc", 2, False), (None, 2, False),
             ("no url", 2, False), ("", 2, False), ("http://bad.example.com/" + "y/" * 3000, 6, True)]
    caps = spark.createDataFrame([(i, u, day(n), "x", 7) for i, (u, n, _) in enumerate(cases)] * 2,
                                 "id long, url string, fetch_day date, host string, capture int")
    out = url_lists.judge(caps, events).collect()
    assert sorted((r.id, r.blocked) for r in out) == sorted([(i, c[2]) for i, c in enumerate(cases)] * 2)
    assert not any(r.blocked for r in url_lists.judge(caps, events.limit(0)).collect())
    assert url_lists.judge(caps.limit(0), events).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_url_query_matches_sql_and_stays_native(spark):
    name = "op10_temporal_url_lists"
    status, msg = compare(spark, duck(SF), SF, name, Q.queries()[name], Q.oracle_sql()[name])
    assert status == "OK", msg
    plan = Q.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.common.written(stage(spark, docs, SF), name)
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        assert after.items() <= kept.items() and 0.7 * len(kept) < len(after) < len(kept)
        kept = after
    sets = {i: X.shingles(t) for i, t in kept.items()}  # no near duplicates are left
    by = {}
    for i, s in sets.items():
        for g in s:
            by.setdefault(g, []).append(i)
    shared = {}
    for ids in by.values():
        for a in ids:
            for b in ids:
                if a < b:
                    shared[a, b] = shared.get((a, b), 0) + 1
    assert not [p for p, n in shared.items() if 100 * n >= 75 * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    out = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == set(kept)


def test_entry_registers_all():
    import __spark_entry__ as E
    names = list(E.queries())
    assert [n for n in names if n.startswith("op")] == list(Q.queries()) and "pipeline" in names
    assert len(Q.queries()) == 13 and set(Q.oracle_sql()) <= set(names)
