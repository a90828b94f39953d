"""Binomial and beta area models: logit link, area effect integrated by quadrature.

For every point of a variance grid the fixed effects are fitted by Newton steps on the integrated
likelihood.  A step is one Spark job over all grid points that still matter: tasks integrate their own areas
and send one partial sum per grid point.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.numeric import hermite_nodes
from arealis.functions.quadrature import beta_logit, integrate_groups, multinomial
from arealis.operators.area import GridFit, log_prior
from arealis.operators.glm import log_weights
from arealis.operators.linalg import double_columns, sum_vectors

CHUNK = 40_000  # area x grid points integrated at once in a task


def _family(kind: str):
    return {"binomial": multinomial, "beta": beta_logit}[kind]


def _data(kind: str, y: np.ndarray, n: np.ndarray) -> tuple:
    return (y[:, None], n) if kind == "binomial" else (y, n)


def _chunks(batches: Iterator[pd.DataFrame], p: int, size: int):
    for pdf in batches:
        for i in range(0, len(pdf), max(size, 1)):
            part = pdf.iloc[i : i + size]
            yield part, part["__y"].to_numpy(float), part["__n"].to_numpy(float), part[[f"__x{k}" for k in range(p)]].to_numpy(float)


def _newton_sums(fit: DataFrame, kind: str, beta: np.ndarray, s2: np.ndarray, nodes: int) -> dict[int, np.ndarray]:
    """Log-likelihood, gradient and negative Hessian per grid point: one job."""
    G, p = beta.shape
    width = 1 + p + p * p

    def task(batches):
        total = np.zeros((G, width))
        any_rows = False
        for _, y, n, X in _chunks(batches, p, CHUNK // G):
            any_rows = True
            B = len(y)
            base = (X @ beta.T).T.reshape(-1, 1)  # grid-major
            r = integrate_groups(
                _family(kind), base, _data(kind, np.tile(y, G), np.tile(n, G)), np.tile(X, (G, 1)), np.arange(G * B), np.repeat(1 / s2, B)[:, None, None], nodes
            )
            total += np.concatenate([r["ll"].reshape(G, B, 1), r["grad"].reshape(G, B, p), r["hess"].reshape(G, B, p * p)], axis=2).sum(axis=1)
        if any_rows:
            yield pd.DataFrame({"g": np.arange(G), "v": list(total)})

    out = {g: np.zeros(width) for g in range(G)}
    for r in sum_vectors(fit.mapInPandas(task, "g int, v array<double>"), ["g"]).collect():
        out[r["g"]][r["pos"]] = r["s"]
    return out


def _fit_table(areas: DataFrame, y: str, n: str, xs: Sequence[str | Column], keep: Sequence[str] = ()) -> DataFrame:
    return areas.select(*keep, F.col(y).cast("double").alias("__y"), F.col(n).cast("double").alias("__n"), *[c.alias(f"__x{i}") for i, c in enumerate(double_columns(xs))])


def fh_logit_fit(
    areas: DataFrame, kind: str, y: str, n: str, xs: Sequence[str | Column], prior: str, tau: float, grid: np.ndarray | None = None, points: int = 60, nodes: int = 15, tol: float = 1e-7, max_iter: int = 40
) -> GridFit:
    p = len(xs)
    s2 = np.exp(np.linspace(np.log(1e-4), np.log(30.0), points)) if grid is None else np.asarray(grid, dtype=float)
    fit = _fit_table(areas, y, n, xs)
    usable = (F.col("__n") > 0) & F.col("__y").isNotNull()
    if kind == "beta":
        usable = usable & (F.col("__y") > 0) & (F.col("__y") < 1)
    # integrals are heavy and rows light: spread them over every core, whatever size adaptive execution chose
    fit = fit.filter(usable).repartition(areas.sparkSession.sparkContext.defaultParallelism).persist(StorageLevel.MEMORY_AND_DISK)
    G = len(s2)
    beta, cov, ll = np.zeros((G, p)), np.zeros((G, p, p)), np.zeros(G)
    moved, gain = np.full(G, np.inf), np.full(G, np.inf)
    live = np.ones(G, dtype=bool)
    prior_part = log_prior(s2, prior) + np.log(s2)

    def advance(idx: np.ndarray) -> None:
        """One Newton step of some grid points; ``gain`` is what it promises to add to the log posterior."""
        sums = _newton_sums(fit, kind, beta[idx], s2[idx], nodes)
        for pos, g in enumerate(idx):
            v = sums[pos]
            grad = v[1 : 1 + p] - beta[g] / tau**2
            h = v[1 + p :].reshape(p, p) + np.eye(p) / tau**2
            h = (h + h.T) / 2
            low = np.linalg.eigvalsh(h)[0]
            if low <= 0:
                h = h + np.eye(p) * (1e-6 - low)
            step = np.linalg.solve(h, grad)
            size = np.abs(step).max()
            cov[g] = np.linalg.inv(h)
            ll[g] = v[0] - 0.5 * beta[g] @ beta[g] / tau**2
            moved[g] = size / (1 + np.abs(beta[g]).max())
            gain[g] = 0.5 * grad @ step if low > 0 and size <= 2.0 else np.inf
            beta[g] = beta[g] + step * min(1.0, 2.0 / max(size, 1e-300))

    try:
        # the other points start from the coefficients of one in the middle: a step of all of them costs as much as the whole way of one
        middle = G // 2
        for _ in range(min(10, max_iter)):
            advance(np.array([middle]))
            if moved[middle] < 1e-3:
                beta[:] = beta[middle]
                break
        else:
            beta[:] = 0.0
        ll[:] = -np.inf
        for _ in range(max_iter):
            idx = np.flatnonzero(live)
            advance(idx)
            live[idx] = moved[idx] >= tol
            # points more than e^-50 below the best have no weight at double precision, even if four times the promised gain came true
            height = ll + 0.5 * np.linalg.slogdet(cov)[1] + prior_part
            live &= height + 4 * gain > height.max() - 50
            if not live.any():
                break
    finally:
        fit.unpersist()
    logdet = np.array([np.linalg.slogdet(c)[1] for c in cov])
    steps = np.gradient(np.log(s2)) if G > 1 else np.ones(1)
    logp = ll + 0.5 * logdet + prior_part + np.log(steps)
    weights = log_weights(logp)
    if live.any() and weights[live].sum() > 1e-4:
        raise RuntimeError(f"grid points of weight {weights[live].sum():.2g} have not converged after {max_iter} Newton steps")
    return GridFit(s2, weights, beta, cov, kind)


def fh_logit_predict(areas: DataFrame, fit: GridFit, y: str, n: str, xs: Sequence[str | Column], area_effect: bool = True, nodes: int = 15) -> DataFrame:
    """Posterior mean and sd of every area's proportion.

    The coefficients are integrated by 2p cubature points per grid point, the area effect by quadrature
    under its own likelihood.  Areas without data use the prior of the effect, or no effect at all when
    ``area_effect`` is off.
    """
    f = fit.pruned(1e-10)
    G, p = f.beta.shape
    L = np.linalg.cholesky(f.cov + 1e-14 * np.eye(p))
    shift = np.sqrt(p) * np.concatenate([L.transpose(0, 2, 1), -L.transpose(0, 2, 1)], axis=1)
    b = (f.beta[:, None, :] + shift).reshape(-1, p)
    s2, w = np.repeat(f.sigma2, 2 * p), np.repeat(f.weights, 2 * p) / (2 * p)
    K, kind = len(w), fit.link
    keep = areas.columns
    table = _fit_table(areas, y, n, xs, keep)
    seen = (F.col("__n") > 0) & F.col("__y").isNotNull()
    if kind == "beta":
        seen = seen & (F.col("__y") > 0) & (F.col("__y") < 1)
    table = table.withColumn("observed", F.coalesce(seen, F.lit(False)))

    def task(batches):
        for part, y_, n_, X in _chunks(batches, p, CHUNK // K):
            obs = part["observed"].to_numpy(bool)
            yy = np.where(obs, y_, 0.5 if kind == "beta" else 0.0)
            nn = np.where(obs, n_, 0.0)
            B = len(yy)
            ok = ~np.isnan(X).any(axis=1)
            base = (np.where(ok[:, None], X, 0.0) @ b.T).T.reshape(-1, 1)
            r = integrate_groups(_family(kind), base, _data(kind, np.tile(yy, K), np.tile(nn, K)), None, np.arange(K * B), np.repeat(1 / s2, B)[:, None, None], nodes, means=True)
            m1 = np.einsum("k,kb->b", w, r["m1"].reshape(K, B))
            m2 = np.einsum("k,kb->b", w, r["m2"].reshape(K, B))
            if not area_effect:
                fixed = 1 / (1 + np.exp(-base.reshape(K, B)))
                m1 = np.where(obs, m1, w @ fixed)
                m2 = np.where(obs, m2, w @ fixed**2)
            m1, m2 = np.where(ok, m1, np.nan), np.where(ok, m2, np.nan)
            yield part[[*keep, "observed"]].assign(theta=m1, theta_sd=np.sqrt(np.maximum(m2 - m1**2, 0.0)))

    schema = table.select(*keep, "observed").schema.add("theta", "double").add("theta_sd", "double")
    out = table.mapInPandas(task, schema)
    return out.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("theta", "theta_sd")})


def fh_binomial(areas: DataFrame, y: str, n: str, xs: Sequence[str | Column], area_effect: bool = False, **kw) -> tuple[GridFit, DataFrame]:
    """Effective successes out of effective trials; areas without data get the fixed part only by default."""
    fit = fh_logit_fit(areas, "binomial", y, n, xs, "half_cauchy", 1e4, **kw)
    return fit, fh_logit_predict(areas, fit, y, n, xs, area_effect)


def fh_beta(areas: DataFrame, p: str, phi: str, xs: Sequence[str | Column], **kw) -> tuple[GridFit, DataFrame]:
    """Direct proportion with known precision; 0 and 1 cannot be fitted and are predicted like unobserved areas."""
    fit = fh_logit_fit(areas, "beta", p, phi, xs, "inverse_gamma", 100.0, **kw)
    return fit, fh_logit_predict(areas, fit, p, phi, xs, True)


def logit_normal_moments(mean: Column, var: Column, nodes: int = 20) -> tuple[Column, Column]:
    """E and E of the square of inv_logit(N(mean, var)) as column expressions."""
    z, w = hermite_nodes(nodes)
    s = F.sqrt(F.greatest(var, F.lit(0.0)))
    pairs = F.array(*[F.struct(F.lit(float(a)).alias("z"), F.lit(float(c)).alias("w")) for a, c in zip(z, w)])

    def add(acc: Column, g: Column) -> Column:
        t = 1 / (1 + F.exp(-(mean + s * g["z"])))
        return F.struct((acc["a"] + g["w"] * t).alias("a"), (acc["b"] + g["w"] * t * t).alias("b"))

    acc = F.aggregate(pairs, F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("b")), add)
    return acc.getField("a"), acc.getField("b")
