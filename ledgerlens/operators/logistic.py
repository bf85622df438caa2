"""Logistic regression by Newton steps over exact sums.

A step is one aggregate over the rows: gradient and curvature of the mean log
loss, k + 1 and (k + 1)(k + 2) / 2 sums for k features, each of DECIMAL terms
and so the same whatever the partitions.  The step itself solves a system of
k + 1 equations on the driver.  Nothing else leaves the executors, and the
number of passes does not depend on the data's size.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.core import sigmoid
from ledgerlens.functions.moments import fixed

MOST_STEPS = 25
LARGEST_MOVE = 4.0  #: of a coefficient in one step
SETTLED = 1e-9
DAMPING = 1e-8  #: on the intercept's curvature, for labels of one kind


def margin(intercept: float, weights: Sequence[float], features: Sequence[str]) -> Column:
    out = F.lit(float(intercept))
    for f, w in zip(features, weights):
        out = out + F.col(f) * F.lit(float(w))
    return out


def newton_sums(rows: DataFrame, label: str, features: Sequence[str], coefficients: Sequence[float]):
    """(n, gradient sums, curvature sums) of the log loss at ``coefficients``."""
    x = [F.lit(1.0), *[F.col(f) for f in features]]
    k = len(x)
    p = F.col("_p")
    at = rows.withColumn("_p", sigmoid(margin(coefficients[0], coefficients[1:], features)))
    first = [F.sum(fixed((p - F.col(label)) * x[i])) for i in range(k)]
    second = [F.sum(fixed(p * (1 - p) * x[i] * x[j])) for i in range(k) for j in range(i + 1)]
    n, *sums = at.agg(F.count(F.lit(1)), *first, *second).first()
    sums = [float(s or 0) for s in sums]
    curvature = np.zeros((k, k))
    curvature[np.tril_indices(k)] = sums[k:]
    return n, np.array(sums[:k]), curvature + np.tril(curvature, -1).T


def fit(rows: DataFrame, label: str, features: Sequence[str], penalty: float = 0.01) -> tuple[float, list[float]]:
    """Intercept and weights that minimise the mean log loss of ``label`` (0 or
    1; a NULL is left out) plus ``penalty / 2`` times the squared weights.

    ``rows`` is read once a step; NULL features count as rows of no weight.
    No rows give zeros, labels of one kind a large intercept.
    """
    rows = rows.filter(F.col(label).isNotNull()).select(label, *features)
    beta = np.zeros(len(features) + 1)
    ridge = np.array([0.0] + [penalty] * len(features))
    for _ in range(MOST_STEPS):
        n, gradient, curvature = newton_sums(rows, label, features, beta.tolist())
        if not n:
            break
        system = curvature / n + np.diag(ridge + DAMPING * (ridge == 0))
        move = np.linalg.solve(system, gradient / n + ridge * beta)
        move *= min(1.0, LARGEST_MOVE / max(float(np.abs(move).max()), 1e-300))
        beta -= move
        if float(np.abs(move).max()) < SETTLED:
            break
    return float(beta[0]), beta[1:].tolist()
