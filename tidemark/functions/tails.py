"""Distribution tails, evaluated on a handful of aggregated rows.

Spark has no t, F, beta or noncentral-t functions. These work on numpy arrays of one value per endpoint; the sums they
need are aggregated by Spark before.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np

_log_gamma = np.vectorize(math.lgamma, otypes=[float])
_erf = np.vectorize(math.erf, otypes=[float])


def normal_cdf(x):
    return 0.5 * (1.0 + _erf(np.asarray(x, float) / math.sqrt(2.0)))


def normal_ppf(p):
    inv = NormalDist().inv_cdf
    return np.vectorize(lambda q: inv(q) if 0 < q < 1 else (math.inf if q >= 1 else -math.inf), otypes=[float])(p)


def beta_cdf(x, a, b):
    """Regularised incomplete beta by its continued fraction (modified Lentz), in the quickly converging half."""
    x, a, b = np.broadcast_arrays(np.asarray(x, float), np.asarray(a, float), np.asarray(b, float))
    x = np.clip(x, 0.0, 1.0)
    flip = x > (a + 1.0) / (a + b + 2.0)
    aa, bb, xx = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1.0 - x, x)
    safe = np.clip(xx, 1e-300, 1.0 - 1e-16)
    front = np.exp(
        _log_gamma(aa + bb) - _log_gamma(aa) - _log_gamma(bb) + aa * np.log(safe) + bb * np.log1p(-safe)
    ) / aa
    tiny = 1e-300
    c = np.ones_like(safe)
    d = 1.0 - (aa + bb) * safe / (aa + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 2000):
        for num in (
            m * (bb - m) * safe / ((aa + 2 * m - 1) * (aa + 2 * m)),
            -(aa + m) * (aa + bb + m) * safe / ((aa + 2 * m) * (aa + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + num / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            step = c * d
            h = h * step
        if np.all(np.abs(step - 1.0) < 1e-15):
            break
    out = np.where(xx <= 0, 0.0, front * h)
    return np.where(flip, 1.0 - out, out)


def bisect(fn, target, lo, hi, steps: int = 200):
    """x with fn(x) = target for an increasing fn, element by element."""
    target, lo, hi = np.broadcast_arrays(np.asarray(target, float), np.asarray(lo, float), np.asarray(hi, float))
    lo, hi = lo.copy(), hi.copy()
    for _ in range(steps):
        mid = 0.5 * (lo + hi)
        below = fn(mid) < target
        lo, hi = np.where(below, mid, lo), np.where(below, hi, mid)
    return 0.5 * (lo + hi)


def beta_ppf(p, a, b):
    return bisect(lambda x: beta_cdf(x, a, b), p, 0.0, 1.0)


def t_cdf(t, df):
    t, df = np.asarray(t, float), np.asarray(df, float)
    tail = 0.5 * beta_cdf(df / (df + t * t), df / 2.0, 0.5)
    return np.where(t >= 0, 1.0 - tail, tail)


def t_sf(t, df):
    return t_cdf(-np.asarray(t, float), df)


def t_ppf(p, df):
    p, df = np.broadcast_arrays(np.asarray(p, float), np.asarray(df, float))
    x = beta_ppf(2.0 * np.minimum(p, 1.0 - p), df / 2.0, 0.5)
    size = np.sqrt(df * (1.0 - x) / np.maximum(x, 1e-300))
    return np.where(p >= 0.5, size, -size)


def f_ppf(p, d1, d2):
    d1, d2 = np.asarray(d1, float), np.asarray(d2, float)
    x = beta_ppf(p, d1 / 2.0, d2 / 2.0)
    return d2 * x / (d1 * np.maximum(1.0 - x, 1e-300))


def binomial_cdf(k, n, p):
    k, n = np.asarray(k, float), np.asarray(n, float)
    inner = beta_cdf(1.0 - np.asarray(p, float), np.maximum(n - k, 1e-9), k + 1.0)
    return np.where(k >= n, 1.0, inner)


def gamma_cdf(x, shape):
    """Regularised lower incomplete gamma: series below shape + 1, continued fraction above."""
    x, a = np.broadcast_arrays(np.asarray(x, float), np.asarray(shape, float))
    xs = np.maximum(x, 1e-300)
    front = np.exp(a * np.log(xs) - xs - _log_gamma(a))
    term = 1.0 / a
    total = term.copy()
    for n in range(1, 5000):
        term = term * xs / (a + n)
        total = total + term
        if np.all(np.abs(term) <= np.abs(total) * 1e-16):
            break
    return np.where(x <= 0, 0.0, np.clip(front * total, 0.0, 1.0))


def chi2_ppf(p, df):
    df = np.asarray(df, float)
    return 2.0 * bisect(lambda x: gamma_cdf(x, df / 2.0), p, 0.0, df * 10.0 + 100.0)


_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(400)


def noncentral_t_cdf(t, df, nc):
    """P(T <= t): the normal tail averaged over the distribution of the scale sqrt(chi2 / df)."""
    t, df, nc = (np.atleast_1d(np.asarray(v, float)) for v in np.broadcast_arrays(t, df, nc))
    spread = 12.0 / np.sqrt(2.0 * df)
    lo, hi = np.maximum(1e-12, 1.0 - spread), 1.0 + spread
    s = lo[:, None] + (hi - lo)[:, None] * (_NODES[None, :] + 1.0) / 2.0
    d = df[:, None]
    log_density = math.log(2.0) + (d / 2.0) * np.log(d / 2.0) - _log_gamma(d / 2.0) + (d - 1.0) * np.log(s) - d * s * s / 2.0
    inner = normal_cdf(t[:, None] * s - nc[:, None]) * np.exp(log_density)
    return np.clip((inner * _WEIGHTS[None, :]).sum(axis=1) * (hi - lo) / 2.0, 0.0, 1.0)


def tost_power(n, margin, sd, difference=0.0, alpha=0.05):
    """Lower bound on the power of two one-sided tests: P(A) + P(B) − 1."""
    n = np.asarray(n, float)
    df, scale = n - 1.0, np.sqrt(n) / sd
    crit = t_ppf(1.0 - alpha, df)
    low = 1.0 - noncentral_t_cdf(crit, df, (margin + difference) * scale)
    high = noncentral_t_cdf(-crit, df, (difference - margin) * scale)
    return np.clip(low + high - 1.0, 0.0, 1.0)


def one_sided_power(n, gap, sd, alpha=0.05):
    n = np.asarray(n, float)
    df = n - 1.0
    return 1.0 - noncentral_t_cdf(t_ppf(1.0 - alpha, df), df, gap * np.sqrt(n) / sd)


def smallest_n(power_at, power: float) -> int:
    """Smallest n of 2 and more whose power reaches the target; power grows with n, so doubling brackets it."""
    lo, hi = 2, 4
    while power_at(hi) < power:
        if hi > 1 << 52:
            raise ValueError("the power is not reached at any size")
        lo, hi = hi, hi * 2
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if power_at(mid) >= power else (mid + 1, hi)
    return lo


def ceiling_size(ceiling: float, share: float, power: float, alpha: float, most: int, block: int = 256) -> int:
    """Smallest n of 2 and more at which the exact one-sided binomial test of "share under the ceiling" has the power, searched up to
    `most`; `most` + 1 if none. The power is a saw-tooth of n, so every n is looked at."""

    def upto(n, p):
        """P(X <= k) for each n (rows) and k (columns)."""
        k = np.arange(n.max() + 1)
        inside = np.clip(n[:, None] - k[None, :], 0, None)
        log = _log_gamma(n + 1.0)[:, None] - _log_gamma(k + 1.0)[None, :] - _log_gamma(inside + 1.0) + k * math.log(p) + inside * math.log1p(-p)
        return np.cumsum(np.where(k[None, :] <= n[:, None], np.exp(log), 0.0), axis=1)

    for first in range(2, most + 1, block):
        n = np.arange(first, min(first + block, most + 1))
        allowed = (upto(n, ceiling) <= alpha).sum(axis=1) - 1  # the largest count that rejects, -1 if none does
        reached = np.where(allowed >= 0, np.take_along_axis(upto(n, share), np.maximum(allowed, 0)[:, None], axis=1)[:, 0], 0.0)
        hit = np.flatnonzero(reached >= power)
        if len(hit):
            return int(n[hit[0]])
    return most + 1
