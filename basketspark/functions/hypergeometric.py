"""The Gauss hypergeometric function of real arguments below one, for arrays."""

from __future__ import annotations

import numpy as np

TERMS = 64  # of a step of half the distance to one: the last is below 2^-60 of the first


def series(p: np.ndarray, q: np.ndarray, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """The defining series, to its end; not a number where a term is not finite."""
    term, total = np.ones_like(z), np.ones_like(z)
    running, n = np.arange(len(z)), 0
    while len(running):
        k = running
        with np.errstate(all="ignore"):
            term[k] *= (p[k] + n) * (q[k] + n) / ((c[k] + n) * (n + 1)) * z[k]
        total[k] += term[k]
        n += 1
        small = np.abs(term[k]) * np.maximum(1, z[k] / (1 - z[k])) <= 1e-16 * np.maximum(np.abs(total[k]), 1e-300)
        passed = n > 10 + np.maximum(0, -np.minimum(np.minimum(p[k], q[k]), c[k]))  # factors have their last signs
        running = k[np.isfinite(term[k]) & ~(small & passed)]
    return np.where(np.isfinite(total), total, np.nan)


def continued(p: np.ndarray, q: np.ndarray, c: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The value at z = 1 - y for y under a half: from z = 1/2 by Taylor steps of the differential equation.

    Each step halves the distance to one, so the terms needed grow with the logarithm of 1 / y, not with 1 / y.
    """
    at, half = np.full_like(y, 0.5), np.full_like(y, 0.5)
    w = series(p, q, c, half)
    with np.errstate(divide="ignore", invalid="ignore"):
        slope = p * q / c * series(p + 1, q + 1, c + 1, half)
    while len(k := np.flatnonzero(at > y)):
        here, to = at[k], np.maximum(y[k], at[k] / 2)
        z, h, a, b = 1 - here, here - to, p[k], q[k]
        u, v = w[k], slope[k] * h  # terms n and n + 1 of the expansion about z, with their powers of h
        value, change = u + v, v.copy()
        for n in range(TERMS):
            later = (n + a) * (n + b) * h * u - (n + 1) * ((1 - 2 * z) * n + c[k] - (a + b + 1) * z) * v
            u, v = v, later * h / (z * here * (n + 1) * (n + 2))
            value, change = value + v, change + (n + 2) * v
        w[k], slope[k], at[k] = value, change / h, to
    return w


def hyp2f1(p: np.ndarray, q: np.ndarray, c: np.ndarray, y: np.ndarray) -> np.ndarray:
    """2F1(p, q; c; 1 - y) for 0 < y <= 1.

    Near one the value is continued; the series serves elsewhere, and where it ends soon anyway (terms fall with a
    high power of their number) or the third parameter is so large that Taylor steps would lose digits.
    """
    p, q, c, y = (np.array(a, dtype=float) for a in np.broadcast_arrays(p, q, c, y))
    near = (y < 0.5) & (c - p - q < 10) & (np.abs(c) < 20)
    out = np.empty_like(y)
    out[near] = continued(p[near], q[near], c[near], y[near])
    out[~near] = series(p[~near], q[~near], c[~near], 1 - y[~near])
    return out
