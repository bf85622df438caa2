"""Invariants for the churn model outputs, and the fit against plain gradients."""

import pytest

from ledgerlens.operators import predictive as M
from ledgerlens.sources.adapter import load_tables

SF = "/root/testdata/sf0.01"
SNAP = "2001-08-02"


@pytest.fixture(scope="module")
def t(spark):
    return load_tables(spark, SF)


def test_scores_cover_every_customer_and_split(t):
    s = M.churn_scores(t, snapshot=SNAP)
    feats = M.churn_features(t, snapshot=SNAP)
    assert s.count() == feats.count() == 1497
    test_n = s.filter("is_test").count()
    assert 0.1 < test_n / 1497 < 0.3
    probs = [r.churn_probability for r in s.select("churn_probability").collect()]
    assert all(0.0 <= p <= 1.0 for p in probs)


def test_metrics_consistent_with_confusion(t):
    m = M.churn_metrics(t, snapshot=SNAP).collect()[0]
    cm = m.confusion_matrix
    test_n = M.churn_scores(t, snapshot=SNAP).filter("is_test").count()
    assert cm.TP + cm.TN + cm.FP + cm.FN == test_n
    assert m.accuracy == round((cm.TP + cm.TN) / test_n, 4)
    rate = M.churn_features(t, snapshot=SNAP).agg({"churned": "avg"}).collect()[0][0]
    assert m.churn_rate == round(rate, 4)
    # the label is a step of the recency feature: the fit must separate well
    assert m.accuracy > 0.85


def test_confusion_frame_matches_metrics(t):
    m = M.churn_metrics(t, snapshot=SNAP).collect()[0].confusion_matrix
    cf = {r.actual: (r.predicted_0, r.predicted_1) for r in M.confusion_matrix(t, snapshot=SNAP).collect()}
    assert cf[1] == (m.FN, m.TP) and cf[0] == (m.TN, m.FP)


def test_risk_summary_bands(t):
    rows = M.churn_risk_distribution(t, snapshot=SNAP).orderBy("risk_order").collect()
    assert [r.risk for r in rows] == [x for x in M.RISK_LABELS if x in {r.risk for r in rows}]
    total = sum(r["count"] for r in rows)
    banded = M.churn_scores(t, snapshot=SNAP).filter("churn_risk IS NOT NULL").count()
    assert total == banded


def test_drop_recency_option_runs(t):
    m = M.churn_metrics(t, snapshot=SNAP, drop_recency=True).collect()[0]
    assert 0.0 <= m.accuracy <= 1.0


def test_prediction_uses_the_raw_probability_and_matrix_is_whole(t):
    # every margin is slightly below zero: shown as 0.5, predicted 0
    s = M.churn_scores(t, snapshot=SNAP, model=(-1e-5, (0.0, 0.0, 0.0, 0.0)))
    assert {(r.churn_probability, r.predicted) for r in s.collect()} == {(0.5, 0)}
    assert "last_order" in s.columns
    rows = {r.actual: (r.predicted_0, r.predicted_1)
            for r in M.confusion_matrix(t, snapshot=SNAP, threshold=-1, model=(5.0, (0, 0, 0, 0))).collect()}
    assert rows[0] == (0, 0) and rows[1][0] == 0 and rows[1][1] > 0


def _labelled(spark, n=400, seed=3):
    import random
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = rnd.gauss(0, 1), rnd.gauss(0, 1)
        rows.append((a, b, int(a - 0.5 * b + rnd.gauss(0, 1) > 0.4) if i % 50 else None))
    return rows, spark.createDataFrame(rows, "a double, b double, y int")


def test_fit_is_the_minimum_of_the_penalised_loss(spark):
    import numpy as np

    from ledgerlens.operators import logistic
    rows, df = _labelled(spark)
    intercept, weights = logistic.fit(df, "y", ["a", "b"], penalty=0.01)
    data = np.array([r for r in rows if r[2] is not None], float)
    x, y = np.column_stack((np.ones(len(data)), data[:, :2])), data[:, 2]
    beta = np.zeros(3)
    for _ in range(20000):  # plain gradient descent
        p = 1 / (1 + np.exp(-x @ beta))
        beta -= 0.5 * (x.T @ (p - y) / len(y) + 0.01 * np.array([0, 1, 1]) * beta)
    assert np.abs(np.array([intercept, *weights]) - beta).max() < 1e-8


def test_fit_does_not_depend_on_partitions(spark):
    from ledgerlens.operators import logistic
    _, df = _labelled(spark)
    fits = {(i, *w) for i, w in (logistic.fit(df.repartition(n), "y", ["a", "b"]) for n in (1, 7, 200))}
    assert len(fits) == 1


def test_fit_of_no_rows_and_of_one_kind(spark):
    from ledgerlens.operators import logistic
    _, df = _labelled(spark, 60)
    assert logistic.fit(df.limit(0), "y", ["a", "b"]) == (0.0, [0.0, 0.0])
    intercept, weights = logistic.fit(df.selectExpr("a", "b", "1 AS y"), "y", ["a", "b"])
    assert intercept > 5 and all(abs(w) < 5 for w in weights)
