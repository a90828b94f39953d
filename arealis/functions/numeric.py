"""Small numpy helpers: quadrature nodes, special functions and quantiles that Spark SQL lacks."""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf


def normal_quantile(prob: float) -> float:
    return NormalDist().inv_cdf(prob)


def hermite_nodes(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and weights for expectations under a standard normal."""
    x, w = np.polynomial.hermite_e.hermegauss(n)
    return x, w / np.sqrt(2 * np.pi)


def _shifted(x: np.ndarray, steps: int = 8):
    x = np.asarray(x, dtype=float)
    return [x + i for i in range(steps)], x + steps


def lgamma(x: np.ndarray) -> np.ndarray:
    """Log-gamma for positive arguments: recurrence up, then Stirling's series."""
    low, z = _shifted(x)
    prod = np.ones_like(z)
    for s in low:
        prod = prod * s
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - np.log(prod)


def digamma(x: np.ndarray) -> np.ndarray:
    low, z = _shifted(x)
    tail = np.log(z) - 1 / (2 * z) - 1 / (12 * z**2) + 1 / (120 * z**4) - 1 / (252 * z**6) + 1 / (240 * z**8)
    return tail - sum(1 / s for s in low)


def trigamma(x: np.ndarray) -> np.ndarray:
    low, z = _shifted(x)
    tail = 1 / z + 1 / (2 * z**2) + 1 / (6 * z**3) - 1 / (30 * z**5) + 1 / (42 * z**7) - 1 / (30 * z**9)
    return tail + sum(1 / s**2 for s in low)


def gamma_terms(x: np.ndarray, steps: int = 8) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-gamma, digamma and trigamma for positive arguments at once.

    The product of the arguments below Stirling's range and its first two derivatives hold what all three owe to the
    recurrence, so nothing is divided or raised to a power per step.
    """
    p, dp, ddp = x.copy(), np.ones_like(x), np.zeros_like(x)
    for i in range(1, steps):
        s = x + i
        ddp = ddp * s + 2 * dp
        dp = dp * s + p
        p = p * s
    z = x + steps
    r, log = 1 / z, np.log(z)
    r2, first, second = r * r, dp / p, ddp / p
    series = r * (1 / 12 - r2 * (1 / 360 - r2 * (1 / 1260 - r2 / 1680)))
    lg = (z - 0.5) * log - z + 0.5 * np.log(2 * np.pi) + series - np.log(p)
    dg = log - 0.5 * r - r2 * (1 / 12 - r2 * (1 / 120 - r2 * (1 / 252 - r2 / 240))) - first
    tg = r + 0.5 * r2 + r * r2 * (1 / 6 - r2 * (1 / 30 - r2 * (1 / 42 - r2 / 30))) + first * first - second
    return lg, dg, tg


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray, terms: int = 300) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b) by Lentz's continued fraction."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (a, b, x)))
    swap = x > (a + 1) / (a + b + 2)
    aa, bb, xx = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    xx = np.clip(xx, 1e-300, 1 - 1e-16)
    tiny = 1e-300
    c = np.ones_like(xx)
    d = 1 - (aa + bb) * xx / (aa + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, terms + 1):
        for num in (
            m * (bb - m) * xx / ((aa + 2 * m - 1) * (aa + 2 * m)),
            -(aa + m) * (aa + bb + m) * xx / ((aa + 2 * m) * (aa + 2 * m + 1)),
        ):
            d = 1 + num * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + num / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
        if np.all(np.abs(d * c - 1) < 1e-15):
            break
    front = np.exp(lgamma(aa + bb) - lgamma(aa) - lgamma(bb) + aa * np.log(xx) + bb * np.log1p(-xx)) / aa
    lower = front * h
    out = np.where(swap, 1 - lower, lower)
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, out))


def beta_quantile(prob: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Beta quantile by bisection on the incomplete beta function."""
    a, b = np.asarray(a, dtype=float), np.asarray(b, dtype=float)
    lo, hi = np.zeros_like(a), np.ones_like(a)
    for _ in range(60):
        mid = (lo + hi) / 2
        below = incomplete_beta(a, b, mid) < prob
        lo, hi = np.where(below, mid, lo), np.where(below, hi, mid)
    return (lo + hi) / 2


def t_quantile(prob: float, df: np.ndarray) -> np.ndarray:
    """Student quantile from the beta quantile; NaN where df < 1."""
    df = np.asarray(df, dtype=float)
    ok = df >= 1
    v = np.where(ok, df, 1.0)
    tail = 2 * min(prob, 1 - prob)
    x = beta_quantile(tail, v / 2, np.full_like(v, 0.5))
    t = np.sqrt(v * (1 - x) / x)
    return np.where(ok, t if prob >= 0.5 else -t, np.nan)


def t_quantile_column(prob: float, df_col: str | Column) -> Column:
    """Student quantile per row; rows are areas, so the batch is small."""

    @pandas_udf("double")
    def q(df: pd.Series) -> pd.Series:
        values = df.to_numpy(dtype=float)
        distinct, back = np.unique(np.where(np.isnan(values), 0, values), return_inverse=True)
        return pd.Series(t_quantile(prob, distinct)[back]).where(lambda s: s.notna(), None)

    c = (F.col(df_col) if isinstance(df_col, str) else df_col).cast("double")
    raw = q(c)
    return F.when(~F.isnan(raw), raw)


def beta_quantile_column(prob: float, a: str | Column, b: str | Column) -> Column:
    @pandas_udf("double")
    def q(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(beta_quantile(prob, x.to_numpy(dtype=float), y.to_numpy(dtype=float)))

    ca, cb = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return q(ca.cast("double"), cb.cast("double"))
