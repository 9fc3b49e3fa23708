"""Eigendecompositions of sums of squares under rank-one updates.

An update ``V diag(d) V' + rho v v'`` keeps the eigenvectors' span: in the basis
``V`` it is a diagonal matrix plus ``w w'``. Equal eigenvalues are first turned
so that one of them carries their whole share of ``w`` and negligible entries
are left out (deflation); the others' new values are the roots of the secular
equation ``1 + sum(w_j^2 / (d_j - x)) = 0``, one between each two old values,
found relative to the nearer pole by rational steps inside a shrinking bracket.
The vectors come from weights recomputed for the roots as found, so they stay
orthogonal to working precision however close the roots lie.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps


def roots(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(w / (d - x))`` for rising ``d`` and positive ``w``, and
    the differences ``d_j - root_i`` (row j, column i)."""
    m, total = len(d), w.sum()
    if m == 1:
        return d + total, np.array([[-total]])
    i = np.arange(m)
    width = np.append(np.diff(d), total)
    half = width / 2
    left = 1 + (w[:, None] / ((d[:, None] - d) - half)).sum(axis=0) >= 0
    near_right = ~left
    near_right[-1] = False
    pole = d[np.where(near_right, np.minimum(i + 1, m - 1), i)]
    delta = d[:, None] - pole
    lo, hi = np.where(near_right, -half, 0.0), np.where(near_right, 0.0, half)
    if not left[-1]:
        lo[-1], hi[-1] = half[-1], total * (1 + 8 * EPS)
    x = (lo + hi) / 2
    # the poles on both sides of each root; the last root lies right of both
    a = np.minimum(i, m - 2)
    below = (i[:, None] <= a).astype(np.float64)
    last, weight = i == m - 1, w[:, None]
    gap, t = np.empty_like(delta), np.empty_like(delta)
    with np.errstate(all="ignore"):
        for _ in range(60):
            np.subtract(delta, x, out=gap)
            np.divide(weight, gap, out=t)
            d1, d2 = gap[a, i], gap[a + 1, i]
            f = 1 + t.sum(axis=0)
            size = 1 + np.abs(t).sum(axis=0)
            np.divide(t, gap, out=t)  # the terms' slopes, all positive
            dpsi = np.einsum("ji,ji->i", t, below)
            slope = t.sum(axis=0)
            hi, lo = np.where(f > 0, x, hi), np.where(f > 0, lo, x)
            done = (np.abs(f) <= 4 * EPS * size) | (hi - lo <= 2 * EPS * np.abs(x))
            if done.all():
                break
            p, q, c = (d1 + d2) * f - d1 * d2 * slope, d1 * d2 * f, f - d1 * dpsi - d2 * (slope - dpsi)
            s = np.sqrt(np.maximum(p * p - 4 * q * c, 0))
            step = np.where(last, np.where(p >= 0, (p + s) / (2 * c), 2 * q / (p - s)),
                            np.where(p <= 0, (p - s) / (2 * c), 2 * q / (p + s)))
            new = x + step
            x = np.where(done, x, np.where((new > lo) & (new < hi), new, (lo + hi) / 2))
    return pole + x, delta - x


def update(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors (columns) after adding ``rho v v'``."""
    z = vectors.T @ v
    norm = float(z @ z)
    if not rho * norm > 0:
        return values, vectors
    rho, z = rho * norm, z / np.sqrt(norm)
    tol = 8 * EPS * max(values[-1], rho)
    equal = np.diff(values) <= tol
    if equal.any():
        vectors = vectors.copy()
        at = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).astype(np.int8)))
        for b, e in zip(at[::2], at[1::2] + 1):  # runs of equal values: a reflection leaves one entry of z
            h = z[b:e].copy()
            size = np.sqrt(h @ h)
            to = -size if h[-1] > 0 else size
            h[-1] -= to
            if h @ h > 0:
                vectors[:, b:e] -= np.outer(vectors[:, b:e] @ h, 2 / (h @ h) * h)
                z[b:e] = 0
                z[e - 1] = to
    on = np.flatnonzero(rho * np.abs(z) > tol)
    if not len(on):
        return values, vectors
    d, z = values[on], z[on]
    found, gap = roots(d, rho * z * z)
    apart = d[:, None] - d
    np.fill_diagonal(apart, -1)
    weight = np.sqrt(np.prod(gap / apart, axis=1)) * np.sign(z)
    turn = weight[:, None] / gap
    turn /= np.sqrt((turn * turn).sum(axis=0))
    values, vectors = values.copy(), vectors.copy()
    values[on] = found
    vectors[:, on] = vectors[:, on] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, mean and eigendecomposition of the centred sum of squares of rows."""

    def __init__(self, size: int):
        self.n, self.mean = 0, np.zeros(size)
        self.values, self.vectors = np.zeros(size), np.eye(size)

    @classmethod
    def of(cls, n: int, mean: np.ndarray, values: np.ndarray, vectors: np.ndarray) -> "Spectrum":
        s = cls.__new__(cls)
        s.n, s.mean, s.values, s.vectors = n, mean, values, vectors
        return s

    def add(self, row: np.ndarray) -> None:
        """One more row: a centred rank-one update."""
        away = row - self.mean
        self.n += 1
        self.values, self.vectors = update(self.values, self.vectors, away, (self.n - 1) / self.n)
        self.mean = self.mean + away / self.n

    def merge(self, other: "Spectrum") -> None:
        """Another spectrum's directions, one rank-one update each, and one for the means."""
        if not other.n:
            return
        for value, v in zip(other.values, other.vectors.T):
            self.values, self.vectors = update(self.values, self.vectors, v, value)
        away, n = other.mean - self.mean, self.n + other.n
        self.values, self.vectors = update(self.values, self.vectors, away, self.n * other.n / n)
        self.mean = self.mean + away * (other.n / n)
        self.n = n
