"""Linear, logistic, binomial and multinomial regression.

Rows are aggregated to cross-products (linear) or collapsed to covariate patterns (others); each Newton
step is one aggregate with the current coefficients as literals.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.functions.quadrature import probabilities
from arealis.functions.recode import softmax_ref
from arealis.operators.linalg import NARROW, cross_sums, dot, double_columns, least_squares, moment_sums, read_matrix, read_vector, task_sums, vector_sums


@dataclass(frozen=True)
class Coefficients:
    """Posterior mean and covariance of a coefficient vector (blocks of categories one after another)."""

    names: tuple[str, ...]
    mean: np.ndarray
    cov: np.ndarray
    sigma2: tuple[float, float] | None = None
    iterations: int = 0

    @property
    def sd(self) -> np.ndarray:
        return np.sqrt(np.diag(self.cov))

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(n, float(m), float(s)) for n, m, s in zip(self.names, self.mean, self.sd)]
        if self.sigma2:
            rows.append(("sigma2", *map(float, self.sigma2)))
        return spark.createDataFrame(rows, "variable string, mean double, sd double")


def mix_moments(weights: np.ndarray, means: np.ndarray, covs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of a weighted mixture of normals."""
    mean = np.einsum("g,gi->i", weights, means)
    dev = means - mean
    return mean, np.einsum("g,gij->ij", weights, covs) + np.einsum("g,gi,gj->ij", weights, dev, dev)


def log_weights(logp: np.ndarray) -> np.ndarray:
    w = np.exp(logp - logp.max())
    return w / w.sum()


def variance_grid(s2: float, n: float, points: int = 200, width: float = 8.0) -> np.ndarray:
    half = width * np.sqrt(2 / max(n, 2))
    return np.log(s2) + np.linspace(-half, half, points)


def ols(df: DataFrame, y: str, xs: Sequence[str | Column], names: Sequence[str]) -> Coefficients:
    f = least_squares(df, y, xs)
    return Coefficients(tuple(names), f["beta"], f["cov"], (f["s2"], float("nan")))


def linear_model(df: DataFrame, y: str, xs: Sequence[str | Column], names: Sequence[str], tau: float = 1000.0, shape: float = 1e-4, rate: float = 1e-4, points: int = 200) -> Coefficients:
    """Bayesian linear model with independent N(0, tau^2) and inverse-gamma priors, integrated over a variance grid."""
    f = least_squares(df, y, xs)
    p, n, xtx, b0 = len(xs), f["n"], f["xtx"], f["beta"]
    t = variance_grid(f["s2"], n, points)
    logp, means, covs = np.empty(points), np.empty((points, p)), np.empty((points, p, p))
    for k, v in enumerate(np.exp(t)):
        a = xtx / v + np.eye(p) / tau**2
        beta = np.linalg.solve(a, xtx @ b0 / v)
        quad = (f["rss"] + (beta - b0) @ xtx @ (beta - b0)) / v + beta @ beta / tau**2
        logp[k] = -n / 2 * t[k] - quad / 2 - np.linalg.slogdet(a)[1] / 2 - (shape + 1) * t[k] - rate / v + t[k]
        means[k], covs[k] = beta, np.linalg.inv(a)
    w = log_weights(logp)
    mean, cov = mix_moments(w, means, covs)
    v = np.exp(t)
    m = float(w @ v)
    return Coefficients(tuple(names), mean, cov, (m, float(np.sqrt(max(w @ v**2 - m * m, 0)))))


def linear_model_conjugate(df: DataFrame, y: str, xs: Sequence[str | Column], b: np.ndarray, B: np.ndarray, n0: float, s0: float) -> dict:
    """Normal-inverse-gamma update: prior beta | s2 ~ N(b, s2 B), s2 ~ IG(n0/2, n0 s0/2)."""
    f = least_squares(df, y, xs)
    Bi = np.linalg.inv(B)
    Bq = np.linalg.inv(Bi + f["xtx"])
    bq = Bq @ (Bi @ b + f["xty"])
    n1 = n0 + f["n"]
    ss = n0 * s0 + f["yty"] - bq @ f["xty"] + (b - bq) @ Bi @ b
    return {"Bq": Bq, "bq": bq, "n1": n1, "n1s1": float(ss), "sigma2_mean": float(ss / (n1 - 2)), "beta_cov": Bq * ss / (n1 - 2)}


def linear_model_conditionals(df: DataFrame, y: str, xs: Sequence[str | Column], b: np.ndarray, B: np.ndarray, n0: float, s0: float, sigma2: float) -> dict:
    """Conditional posteriors under independent priors: beta given sigma2, and sigma2 given that beta."""
    f = least_squares(df, y, xs)
    Bi = np.linalg.inv(B)
    Bq = np.linalg.inv(Bi + f["xtx"] / sigma2)
    bq = Bq @ (Bi @ b + f["xty"] / sigma2)
    q = (bq - f["beta"]) @ f["xtx"] @ (bq - f["beta"])
    n1 = n0 + f["n"]
    return {"Bq": Bq, "bq": bq, "n1": n1, "n1s1": float(q + f["rss"] + n0 * s0)}


def collapse_patterns(df: DataFrame, xs: dict[str, Column], sums: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Sum outcomes over rows that share all covariate values."""
    return df.select(*by, *[c.cast("double").alias(k) for k, c in xs.items()], *[c.cast("double").alias(k) for k, c in sums.items()]).groupBy(*by, *xs).agg(
        *[F.sum(k).alias(k) for k in sums]
    )


def binomial_model(df: DataFrame, y: str | Column, n: str | Column | None, xs: dict[str, Column], tau: float = 1e4, tol: float = 1e-10, max_iter: int = 50) -> Coefficients:
    """Logistic regression on counts (or 0/1 rows when ``n`` is None), N(0, tau^2) prior; Laplace covariance."""
    p = len(xs)
    yc = F.col(y) if isinstance(y, str) else y
    nc = F.lit(1.0) if n is None else (F.col(n) if isinstance(n, str) else n)
    fit = collapse_patterns(df, xs, {"__y": yc, "__n": nc}).persist(StorageLevel.MEMORY_AND_DISK)
    cols = double_columns(list(xs))
    prior = np.eye(p) / tau**2
    beta, cov, it = np.zeros(p), None, 0
    try:
        for it in range(1, max_iter + 1):
            _, mu = softmax_ref(dot(cols, beta))
            row = moment_sums(fit, cols, {"h": F.col("__n") * mu * (1 - mu)}, {"g": F.col("__y") - F.col("__n") * mu}, {})
            h = row["h"] + prior
            step = np.linalg.solve(h, row["g"] - prior @ beta)
            size = np.abs(step).max()
            beta = beta + step * min(1.0, 5.0 / max(size, 1e-300))
            cov = np.linalg.inv(h)
            if size < tol * (1 + np.abs(beta).max()):
                break
        else:
            raise RuntimeError(f"no convergence after {max_iter} Newton steps; the last one was {size:.2g}")
    finally:
        fit.unpersist()
    return Coefficients(tuple(xs), beta, cov, None, it)


def logistic_model(df: DataFrame, y: str, xs: dict[str, Column], tau: float = 1e4, **kw) -> Coefficients:
    return binomial_model(df, y, None, xs, tau, **kw)


def _narrow_sums(fit: DataFrame, cols: Sequence[Column], counts: Sequence[str], beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and negative Hessian of the baseline-category likelihood, as one SQL aggregate."""
    p, d = len(cols), len(counts) - 1
    total = sum((F.col(c) for c in counts[1:]), F.col(counts[0]))
    probs = softmax_ref(*[dot(cols, beta[k * p : (k + 1) * p]) for k in range(d)])
    named = fit.withColumns({f"__p{k}": probs[k + 1] for k in range(d)}).withColumn("__t", total)
    pi = [F.col(f"__p{k}") for k in range(d)]
    aggs = []
    for k in range(d):
        aggs += vector_sums(cols, F.col(counts[k + 1]) - F.col("__t") * pi[k], f"g{k}")
        for m in range(k, d):
            w = F.col("__t") * (pi[k] * (1 - pi[k]) if m == k else -pi[k] * pi[m])
            aggs += cross_sums(cols, f"h{k}{m}", w)
    row = named.agg(*aggs).first().asDict()
    h, g = np.zeros((p * d, p * d)), np.zeros(p * d)
    for k in range(d):
        g[k * p : (k + 1) * p] = read_vector(row, f"g{k}", p)
        for m in range(k, d):
            block = read_matrix(row, f"h{k}{m}", p)
            h[k * p : (k + 1) * p, m * p : (m + 1) * p] = block
            h[m * p : (m + 1) * p, k * p : (k + 1) * p] = block
    return g, h


def _wide_sums(fit: DataFrame, names: Sequence[str], counts: Sequence[str], beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same as matrices summed in tasks."""
    names, counts = list(names), list(counts)
    p, d = len(names), len(counts) - 1

    def sums(pdf: pd.DataFrame) -> np.ndarray:
        X, y = pdf[names].to_numpy(float), pdf[counts].to_numpy(float)
        pi, n = probabilities(X @ beta.reshape(d, p).T), y.sum(axis=1)
        parts = [(X.T @ (y[:, k + 1] - n * pi[:, k])) for k in range(d)]
        parts += [((X * (n * pi[:, k] * ((k == m) - pi[:, m]))[:, None]).T @ X).ravel() for k in range(d) for m in range(d)]
        return np.concatenate(parts)

    flat = task_sums(fit.select(*names, *counts).dropna(), sums)
    flat = flat if len(flat) else np.zeros(p * d * (1 + p * d))
    return flat[: p * d], flat[p * d :].reshape(d, d, p, p).transpose(0, 2, 1, 3).reshape(p * d, p * d)


def multinomial_model(df: DataFrame, counts: Sequence[str], xs: dict[str, Column], tau: float = 100.0, tol: float = 1e-10, max_iter: int = 50) -> Coefficients:
    """Baseline-category logit; the first count column is the reference category.

    Coefficients come category by category, ``<category>:<term>``.
    """
    p, d = len(xs), len(counts) - 1
    fit = collapse_patterns(df, xs, {c: F.col(c) for c in counts}).persist(StorageLevel.MEMORY_AND_DISK)
    cols = double_columns(list(xs))
    prior = np.eye(p * d) / tau**2
    beta, cov, it = np.zeros(p * d), None, 0
    try:
        for it in range(1, max_iter + 1):
            g, h = _wide_sums(fit, list(xs), counts, beta) if p * d > NARROW else _narrow_sums(fit, cols, counts, beta)
            h += prior
            step = np.linalg.solve(h, g - prior @ beta)
            size = np.abs(step).max()
            beta = beta + step * min(1.0, 5.0 / max(size, 1e-300))
            cov = np.linalg.inv(h)
            if size < tol * (1 + np.abs(beta).max()):
                break
        else:
            raise RuntimeError(f"no convergence after {max_iter} Newton steps; the last one was {size:.2g}")
    finally:
        fit.unpersist()
    names = tuple(f"{c}:{x}" for c in counts[1:] for x in xs)
    return Coefficients(names, beta, cov, None, it)


def predict_probabilities(df: DataFrame, fit: Coefficients, xs: dict[str, Column], categories: int = 2, prefix: str = "theta") -> DataFrame:
    """Category probabilities at the coefficient means."""
    p, cols = len(xs), [c.cast("double") for c in xs.values()]
    probs = softmax_ref(*[dot(cols, fit.mean[k * p : (k + 1) * p]) for k in range(categories - 1)])
    return df.withColumns({f"{prefix}_{k + 1}": c for k, c in enumerate(probs)})
