"""Whitening against plain numpy, and the qd solver on hard triangles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import qd, whitening
from ledgerlens.llm import queries as Q

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(vectors, k):
    """(n, deviation by vector, e, unit vectors) by Python integers and numpy."""
    x = {tuple(int(np.floor(64.0 * c)) + 1_000_000 for c in v) for v in vectors}
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = np.array([[n * a - s for a, s in zip(v, sums)] for v in x], float) / n
    e, w = np.linalg.eigh(centred.T @ centred / n)
    return n, sums, e[::-1], w[:, ::-1]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    v = (rng.normal(size=(300, 24)) * np.linspace(3, 0.2, 24)).astype(np.float32)
    out = [(i, [float(c) for c in r], i % 3) for i, r in enumerate(v)]
    return out + [(i + 300, out[i % 5][1], 0) for i in range(120)]  # a group of copies


@pytest.fixture(scope="module")
def table(spark, rows):
    odd = [(900, None, 1), (901, [], 1), (902, [None] + [1.0] * 23, None), (903, [float("nan")] * 24, 1),
           (904, [1.0] * 23 + [float("inf")], 1), (None, rows[0][1], None), (7, rows[7][1], 1)]
    df = spark.createDataFrame(rows + odd, SCHEMA).repartition(7)
    return df.withColumns({c: F.lit(1) for c in ("x", "n", "component", "deviation", "whitened", "g", "r", "at")})


def test_whitening_is_that_of_numpy(table, rows):
    got = whitening.whiten(table, components=16).collect()
    n, sums, e, w = plain([r[1] for r in rows], 16)
    assert n == 300 and {r.n for r in got} == {n}
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    assert set(by) == {r[0] for r in rows} | {None}
    assert len(by[7]) == 32 and all(len(v) == 16 for i, v in by.items() if i != 7)
    z = np.array([[r.whitened for r in sorted(by[i], key=lambda r: r.component)] for i, _, _ in rows if i != 7])
    want = np.array([[(n * (np.floor(64.0 * np.float64(c)) + 1_000_000) - s) / n for c, s in zip(v, sums)]
                     for i, v, _ in rows if i != 7]) @ w[:, :16] / np.sqrt(e[:16])
    sign = np.sign((z * want).sum(axis=0))
    assert np.abs(z - want * sign).max() < 1e-9
    for i, v, _ in rows[:20]:
        x = [int(np.floor(64.0 * c)) + 1_000_000 for c in v]
        assert {r.deviation for r in by[i]} == {sum((n * a - s) ** 2 for a, s in zip(x, sums))}
    share = {r.component: r.explained for r in got}
    assert np.allclose([share[k + 1] for k in range(16)], e[:16] / e.sum(), rtol=1e-10)
    assert {r.identity_error for r in got}.pop() < 1e-9
    model = whitening.fit(table)
    assert whitening.transform(table, model).count() == len(got) // 16
    assert whitening.transform(table, model).columns == ["vec_id", "deviation", "whitened"]


def test_few_directions_and_empty_tables(spark):
    make = lambda data: spark.createDataFrame(data, SCHEMA)
    assert whitening.whiten(make([])).count() == 0
    assert whitening.whiten(make([(1, None, 1)])).count() == 0
    assert whitening.whiten(make([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)])).count() == 0  # no variance, no component
    line = whitening.whiten(make([(i, [0.5 * i, -1.0 * i, 3.0], 1) for i in range(5)])).collect()
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-12
    wide = whitening.whiten(make([(i, [1e6 * (i % 3), float(i), 0.0], 1) for i in range(4)])).collect()
    assert len(wide) == 8 and {r.n for r in wide} == {4}
    with pytest.raises(Exception, match="different lengths"):
        whitening.whiten(make([(1, [1.0], 1), (2, [1.0, 2.0], 1)]))
    with pytest.raises(Exception, match="beyond the range"):
        whitening.whiten(make([(1, [1e30], 1), (2, [1.0], 1)])).count()
    with pytest.raises(Exception, match="beyond the range"):
        whitening.whiten(make([(1, [1e15], 1), (2, [1.0], 1)])).count()


def test_query_on_the_table(spark):
    out = Q.op13_embedding_whitening(spark, "/root/testdata/sf0.01").toPandas()
    z = out.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert z.shape == (500, 16) and out["identity_error"].max() < 1e-9
    assert np.abs(z.T @ z / len(z) - np.eye(16)).max() < 1e-9


def check(r):
    values, w = qd.right_vectors(r)
    v, d = r.T @ r, r.shape[1]
    scale = max(values[0], 1e-300)
    want = np.linalg.svd(r, compute_uv=False) ** 2
    assert np.abs(values - want).max() <= 1e-13 * scale
    assert np.abs(w.T @ w - np.eye(d)).max() < 1e-12
    assert np.abs(v @ w - w * values).max() <= 1e-13 * scale


def test_qd_solver():
    rng = np.random.default_rng(0)
    q = lambda m: np.linalg.qr(m)[1]
    check(q(rng.normal(size=(100_000, 64))))  # values close together
    check(np.eye(16))
    check(np.eye(16) + np.triu(rng.normal(size=(16, 16))) * 1e-9)
    check(np.diag(10.0 ** -np.arange(16)))
    check(np.diag(10.0 ** np.arange(-16, 0)))
    check(np.zeros((5, 5)))
    check(q(rng.normal(size=(50, 1))))
    basis, turn = np.linalg.qr(rng.normal(size=(500, 32)))[0], np.linalg.qr(rng.normal(size=(32, 32)))[0]
    check(q((basis * np.repeat([8, 4, 2, 1.0], 8)) @ turn))  # values of multiplicity eight
    for _ in range(300):  # small whole numbers: zeros, ties, deficient ranks
        d = int(rng.integers(1, 20))
        m = rng.integers(-2, 3, size=(int(rng.integers(1, 30)), d)).astype(float)
        r = np.zeros((d, d))
        r[:len(q(m))] = q(m)
        check(r)


def test_qd_values_keep_their_digits():
    """Small values of a graded bidiagonal, relative to themselves."""
    a, b = 10.0 ** -np.arange(0, 12.0), 10.0 ** -np.arange(0, 11.0)
    got = np.sort(qd.squared_values(a, b))[::-1]
    from fractions import Fraction
    # The product of all squared values is the product of the diagonal's squares, exactly.
    assert np.isclose(float(np.prod([Fraction(v) for v in got]) / np.prod([Fraction(x) ** 2 for x in a])), 1, rtol=1e-13)
