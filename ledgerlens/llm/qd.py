"""Singular values and right vectors of a small triangle, by the qd algorithm.

``right_vectors`` takes the d x d triangle that a QR reduction leaves; d is a
number of dimensions, never of rows.  Householder reflections make it
bidiagonal; the differential qd transform with shifts (dqds; Fernando and
Parlett, 1994) finds the squared singular values to high relative accuracy;
a twisted factorisation of the tridiagonal B^T B gives each vector from the
place where it is largest (Dhillon and Parlett, 2004).
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
TINY = np.finfo(float).tiny
CLOSE = 1e-3  #: relative gap below which vectors are made orthogonal one by one


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """v, beta and alpha with (I - beta v v^T) x = alpha e_1."""
    v, norm = x.copy(), float(np.linalg.norm(x))
    if norm == 0:
        return v, 0.0, 0.0
    alpha = -norm if x[0] > 0 else norm
    v[0] -= alpha
    return v, 2.0 / float(v @ v), alpha


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, superdiagonal b and V with U^T r V bidiagonal."""
    m = np.array(r, float)
    d = m.shape[1]
    right = np.eye(d)
    a, b = np.zeros(d), np.zeros(max(d - 1, 0))
    for k in range(d):
        v, beta, a[k] = _reflector(m[k:, k])
        m[k:, k:] -= beta * np.outer(v, v @ m[k:, k:])
        if k < d - 1:
            v, beta, b[k] = _reflector(m[k, k + 1:])
            m[k:, k + 1:] -= beta * np.outer(m[k:, k + 1:] @ v, v)
            right[:, k + 1:] -= beta * np.outer(right[:, k + 1:] @ v, v)
    return a, b, right


def _free_zeros(a: np.ndarray, b: np.ndarray) -> None:
    """Rotate rows, in place, until a diagonal entry below rounding has a zero
    beside it, so that the bidiagonal falls apart there."""
    least = EPS * max(a.max(), b.max(initial=0.0))
    for i in range(len(b)):
        if a[i] > least or b[i] == 0:
            continue
        over, a[i], b[i] = b[i], 0.0, 0.0
        for j in range(i + 1, len(a)):
            r = float(np.hypot(a[j], over))
            if r == 0:
                break
            c, s, a[j] = a[j] / r, over / r, r
            if j < len(b):
                over, b[j] = -s * b[j], c * b[j]


def _dqds(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """One transform; None if the shift is beyond the least value."""
    n = len(q)
    out_q, out_e = np.empty(n), np.empty(n - 1)
    d = q[0] - shift
    for i in range(n - 1):
        if d < 0:
            return None
        out_q[i] = d + e[i]
        if out_q[i] == 0:  # only for d = e = 0: the block falls apart here
            out_e[i], d = 0.0, q[i + 1] - shift
            continue
        t = q[i + 1] / out_q[i]
        out_e[i] = e[i] * t
        d = d * t - shift
    if not d >= 0:
        return None
    out_q[-1] = d
    return out_q, out_e


def squared_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal (a, b), any order."""
    found: list[float] = []
    blocks = [(a * a, b * b, 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        for _ in range(100 * max(len(q), 1) + 100):
            n = len(q)
            if n == 0:
                break
            if n == 1:
                found.append(q[0] + moved)
                q = q[:0]
                break
            # A negligible e splits the block, or frees its last value.
            cut = np.flatnonzero(e <= EPS * EPS * (moved + np.minimum(q[:-1], q[1:])) + TINY)
            if len(cut):
                k = int(cut[-1])
                blocks.append((q[:k + 1], e[:k], moved))
                q, e = q[k + 1:], e[k + 1:]
                continue
            if e[-1] <= EPS * (moved + q[-1]) * EPS:
                found.append(q[-1] + moved)
                q, e = q[:-1], e[:-1]
                continue
            if 1.5 * q[0] < q[-1]:  # large values first, so that small ones leave at the end
                q, e = q[::-1].copy(), e[::-1].copy()
            # A guess from the last two rows, less if it proves too large.
            x, y = q[-2] + e[-2] if n > 2 else q[-2], q[-1] + e[-1]
            half = 0.5 * (x - y)
            off = e[-1] * q[-2]
            guess = y - off / (half + np.copysign(np.sqrt(half * half + off), half)) if off else y
            guess = min(max(guess, 0.0), q[-1])
            for factor in (0.98, 0.5, 0.1, 0.0):
                step = _dqds(q, e, factor * guess)
                if step is not None:
                    (q, e), moved = step, moved + factor * guess
                    break
        if len(q):
            raise ArithmeticError("the qd iteration did not converge")
    return np.array(found)


def _twisted(a: np.ndarray, b: np.ndarray, value: float, given: np.ndarray | None = None) -> np.ndarray:
    """A vector of B^T B - value: the twisted solution, or the solution for a
    right-hand side."""
    n, floor = len(a), EPS * EPS * (value + float(np.max(a * a))) + TINY
    safe = lambda x: x if abs(x) > floor else -floor
    diag = np.maximum(a * a, floor)
    low = a[:-1] * b / diag[:-1] if n > 1 else np.zeros(0)
    s, plus_d, plus_l = np.empty(n), np.empty(n), np.empty(max(n - 1, 0))
    s[0] = -value
    for i in range(n - 1):  # stationary, from the top
        plus_d[i] = safe(s[i] + diag[i])
        plus_l[i] = diag[i] * low[i] / plus_d[i]
        s[i + 1] = plus_l[i] * low[i] * s[i] - value
    plus_d[-1] = safe(s[-1] + diag[-1])
    if given is not None:  # L D L^T x = given
        x = given.copy()
        for i in range(n - 1):
            x[i + 1] -= plus_l[i] * x[i]
        x /= plus_d
        for i in range(n - 2, -1, -1):
            x[i] -= plus_l[i] * x[i + 1]
        return x / np.linalg.norm(x)
    p, minus_u = np.empty(n), np.empty(max(n - 1, 0))
    p[-1] = diag[-1] - value
    for i in range(n - 2, -1, -1):  # progressive, from the bottom
        t = diag[i] / safe(diag[i] * low[i] * low[i] + p[i + 1])
        minus_u[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    k = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -plus_l[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -minus_u[i] * z[i]
    return z / np.linalg.norm(z)


def right_vectors(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of ``r`` in falling order, and the right
    vectors as columns."""
    d = r.shape[1]
    scale = float(np.max(np.abs(r))) if r.size else 0.0
    if scale == 0:
        return np.zeros(d), np.eye(d)
    a, b, right = bidiagonal(r / scale)
    # Signs do not matter to the values, and go into the vectors.
    sign, a_sign, b_sign = np.ones(d), np.where(a < 0, -1.0, 1.0), np.where(b < 0, -1.0, 1.0)
    for i in range(d - 1):  # make both diagonals non-negative: column signs, row signs being free
        sign[i + 1] = sign[i] * a_sign[i] * b_sign[i]
    a, b = np.abs(a), np.abs(b)
    _free_zeros(a, b)
    small = EPS * np.sqrt(a[:-1] * a[1:]) + TINY
    ends = [0, *(np.flatnonzero(b <= small) + 1).tolist(), d]
    values, vectors = np.empty(d), np.zeros((d, d))
    for lo, hi in zip(ends[:-1], ends[1:]):  # each block has its own values and vectors
        qa, qb = a[lo:hi], b[lo:hi - 1]
        own = np.sort(squared_values(qa, qb))[::-1]
        group: list[int] = []
        for j, value in enumerate(own.tolist()):
            if j and own[j - 1] - value > CLOSE * own[j - 1]:
                group = []
            if not group:
                z = _twisted(qa, qb, value)
            else:  # a cluster: inverse iteration, orthogonal to those found
                z = np.cos(np.arange(1, hi - lo + 1) * (j + 1.0))
                for _ in range(4):
                    for _ in range(2):
                        for g in group:
                            z -= (vectors[lo:hi, g] @ z) * vectors[lo:hi, g]
                    z = _twisted(qa, qb, value, z / np.linalg.norm(z))
                for _ in range(2):
                    for g in group:
                        z -= (vectors[lo:hi, g] @ z) * vectors[lo:hi, g]
                z /= np.linalg.norm(z)
            group.append(lo + j)
            values[lo + j] = value
            vectors[lo:hi, lo + j] = z
    order = np.argsort(-values, kind="stable")
    return values[order] * scale * scale, _polished(r / scale, values[order], (right * sign) @ vectors[:, order])


def _polished(r: np.ndarray, values: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The vectors made orthogonal to the last digits, those of clusters and
    of the null space included (a step of Ogita and Aishima, 2018)."""
    x, upper = np.linalg.qr(x)
    x *= np.where(np.diag(upper) < 0, -1.0, 1.0)
    for _ in range(2):
        y = r @ x
        own, off = y.T @ y, np.eye(len(values)) - x.T @ x
        rates = np.diag(own) / (1.0 - np.diag(off))
        gap = rates[None, :] - rates[:, None]
        noise = 2 * (np.linalg.norm(own - np.diag(rates), 2) + values[0] * np.linalg.norm(off, 2))
        apart = np.abs(gap) > noise
        x = x + x @ np.where(apart, (own + rates[None, :] * off) / np.where(apart, gap, 1.0), off / 2)
    return x
