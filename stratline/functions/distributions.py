"""Tail probabilities of F, t and the studentized range.

They are applied to the handful of rows a test ends in, so plain numpy is enough.
"""

from __future__ import annotations

from math import erfc, exp, inf, lgamma, log, nan, sqrt

import numpy as np


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b), by the Lentz continued fraction."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_inc(b, a, 1.0 - x)
    log_front = a * log(x) + b * np.log1p(-x) + lgamma(a + b) - lgamma(a) - lgamma(b) - log(a)
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    fraction = d
    for m in range(1, 100_000):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            fraction *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return exp(log_front) * fraction if log_front > -745 else 0.0


def f_tail(f: float, d1: float, d2: float) -> float:
    """P(F > f) with (d1, d2) degrees of freedom."""
    if f is None or np.isnan(f) or d1 <= 0 or d2 <= 0:
        return nan
    if f == inf:
        return 0.0
    return beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f)) if f > 0 else 1.0


def t_two_sided(t: float, df: float) -> float:
    """P(|T| > |t|) with df degrees of freedom."""
    if t is None or np.isnan(t) or df <= 0:
        return nan
    return beta_inc(df / 2.0, 0.5, df / (df + t * t)) if abs(t) != inf else 0.0


def correlation_p(rho: float, n: float) -> float:
    """Two-sided p-value of a correlation from n pairs."""
    if rho is None or np.isnan(rho) or n <= 2:
        return nan
    if abs(rho) >= 1.0:
        return 0.0
    return t_two_sided(rho * sqrt((n - 2) / (1.0 - rho * rho)), n - 2)


def _nodes() -> tuple[np.ndarray, np.ndarray]:
    return np.polynomial.legendre.leggauss(200)


def _normal_cdf(z: np.ndarray) -> np.ndarray:
    return np.array([0.5 * erfc(-v / sqrt(2.0)) for v in z.ravel()]).reshape(z.shape)


def _range_tail(w: np.ndarray, k: int) -> np.ndarray:
    """P(range of k standard normals > w), for a vector of widths."""
    x, weight = _nodes()
    z = 8.5 * x
    density = 8.5 * weight * np.exp(-z * z / 2.0) / sqrt(2.0 * np.pi)
    upper = _normal_cdf(z)
    # The largest of the k values lies at z, the others in [z - w, z].
    gap = upper[None, :] ** (k - 1) - (upper[None, :] - _normal_cdf(z[None, :] - w[:, None])) ** (k - 1)
    return k * (gap * density).sum(axis=1)


def studentized_range_tail(q: float, k: int, df: float) -> float:
    """P(Q > q) for k group means and df error degrees of freedom."""
    if q is None or np.isnan(q) or k < 2 or df <= 0:
        return nan
    if q <= 0:
        return 1.0
    x, weight = _nodes()
    spread = 10.0 / sqrt(2.0 * df)
    low, high = max(1e-9, 1.0 - spread), 1.0 + spread
    if df < 30:
        low, high = 1e-9, 1.0 + 14.0 / sqrt(2.0 * df)
    s = low + (high - low) * (x + 1.0) / 2.0
    log_density = (
        log(2.0) + df / 2.0 * log(df / 2.0) - lgamma(df / 2.0) + (df - 1) * np.log(s) - df * s * s / 2.0
    )
    density = np.exp(log_density) * weight * (high - low) / 2.0
    return float(min(1.0, max(0.0, (density * _range_tail(q * s, k)).sum())))


def studentized_range_quantile(p: float, k: int, df: float) -> float:
    """Critical value q with P(Q > q) = 1 - p, by bisection."""
    low, high = 0.0, 1.0
    while studentized_range_tail(high, k, df) > 1.0 - p:
        high *= 2.0
        if high > 1e6:
            return nan
    for _ in range(60):
        middle = (low + high) / 2.0
        if studentized_range_tail(middle, k, df) > 1.0 - p:
            low = middle
        else:
            high = middle
    return (low + high) / 2.0
