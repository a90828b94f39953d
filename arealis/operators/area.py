"""Area-level models on direct estimates.

One row is one area.  The normal and arcsine models are Gaussian once the area variance is fixed, so their
posteriors are mixtures over a variance grid whose sums come from one aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.recode import nullif_zero
from arealis.operators.cells import union_by_name
from arealis.operators.design import warn_if_saturated
from arealis.operators.glm import log_weights, mix_moments
from arealis.operators.linalg import NARROW, cross_sums, double_columns, read_matrix, read_vector, task_sums, vector_sums, with_forms


@dataclass(frozen=True)
class EblupFit:
    beta: np.ndarray
    cov: np.ndarray
    sigma2: float
    var_sigma2: float
    iterations: int


def _grid_sums(fit: DataFrame, p: int, grid: Sequence[float], second: bool = False) -> list[dict]:
    """Weighted sums at every variance of the grid, one job: ``a`` = X'WX, ``u`` = X'Wy, ``yy``, ``lw``; with ``second`` those of W^2 too."""
    cols, y = [F.col(f"__x{i}") for i in range(p)], F.col("__y")
    if p > NARROW:
        return _wide_grid_sums(fit, p, grid, second)
    tall = fit.select("*", F.posexplode(F.array(*[F.lit(float(g)) for g in grid])).alias("__g", "__s2"))
    tall = tall.withColumn("__w", 1 / (F.col("__s2") + F.col("__psi")))
    w = F.col("__w")
    aggs = [*cross_sums(cols, "a", w), *vector_sums(cols, y, "u", w), F.sum(w * y * y).alias("yy"), F.sum(F.log(w)).alias("lw"), F.count(F.lit(1)).alias("m")]
    if second:
        aggs += [*cross_sums(cols, "b", w * w), *vector_sums(cols, y, "v", w * w), F.sum(w * w * y * y).alias("yy2"), F.sum(w).alias("w1"), F.sum(w * w).alias("w2")]
    out: list[dict] = [{}] * len(grid)
    for r in tall.groupBy("__g").agg(*aggs).collect():
        d = r.asDict()
        out[d["__g"]] = d | {k: read_matrix(d, k, p) for k in ("ab" if second else "a")} | {k: read_vector(d, k, p) for k in ("uv" if second else "u")}
    return out


def _wide_grid_sums(fit: DataFrame, p: int, grid: Sequence[float], second: bool) -> list[dict]:
    """The same for wide designs: tasks sum one matrix for each point of the grid."""
    names, points = [f"__x{i}" for i in range(p)], np.asarray(grid, float)
    powers = (1, 2) if second else (1,)

    def sums(pdf: pd.DataFrame) -> np.ndarray:
        X, y, psi = pdf[names].to_numpy(float), pdf["__y"].to_numpy(float), pdf["__psi"].to_numpy(float)
        parts = []
        for g in points:
            w = 1 / (g + psi)
            for power in powers:
                z = w**power
                parts += [((X * z[:, None]).T @ X).ravel(), X.T @ (z * y), [(z * y * y).sum(), z.sum()]]
            parts.append([np.log(w).sum(), len(w)])
        return np.concatenate(parts)

    each = len(powers) * (p * p + p + 2) + 2
    flat = task_sums(fit.select("__y", "__psi", *names).dropna(), sums)
    out = []
    for row in (flat if len(flat) else np.zeros(each * len(points))).reshape(len(points), each):
        d, at = {"lw": float(row[-2]), "m": int(row[-1])}, 0
        for matrix, vector, total, weight in (("a", "u", "yy", "w1"), ("b", "v", "yy2", "w2"))[: len(powers)]:
            d |= {matrix: row[at : at + p * p].reshape(p, p), vector: row[at + p * p : at + p * p + p], total: float(row[at + p * p + p]), weight: float(row[at + p * p + p + 1])}
            at += p * p + p + 2
        out.append(d)
    return out


def _reml_sums(fit: DataFrame, p: int, grid: Sequence[float]) -> list[dict]:
    """GLS coefficients, restricted log-likelihood and its score at every variance of the grid; one job."""
    out = []
    for s2, d in zip(grid, _grid_sums(fit, p, grid, second=True)):
        if not d:
            raise ValueError("no area has an estimate and its variance")
        a, b, u = d["a"], d["b"], d["u"]
        ai = np.linalg.inv(a)
        beta = ai @ u
        score = -0.5 * (d["w1"] - np.trace(ai @ b)) + 0.5 * (d["yy2"] - 2 * beta @ d["v"] + beta @ b @ beta)
        ll = 0.5 * d["lw"] - 0.5 * np.linalg.slogdet(a)[1] - 0.5 * (d["yy"] - u @ beta)
        out.append({"s2": float(s2), "beta": beta, "cov": ai, "score": float(score), "ll": float(ll), "w2": d["w2"]})
    return out


def fh_eblup(areas: DataFrame, y: str, psi: str, xs: Sequence[str | Column], sigma2: float | None = None, points: int = 31, rounds: int = 4) -> EblupFit:
    """Area variance by REML (or fixed) and the GLS coefficients.

    The restricted score is evaluated on a whole grid of variances per job; the grid narrows around the best
    point and the root of the score is interpolated in the last one.  Zero is a candidate.
    """
    p = len(xs)
    names = [f"__x{i}" for i in range(p)]
    fit = areas.select(F.col(y).cast("double").alias("__y"), F.col(psi).cast("double").alias("__psi"), *[c.alias(n) for n, c in zip(names, double_columns(xs))])
    fit = fit.filter("__y IS NOT NULL AND __psi IS NOT NULL").persist(StorageLevel.MEMORY_AND_DISK)
    jobs = 0
    try:
        if sigma2 is None:
            grid = np.concatenate([[0.0], variance_grid(fit, "__y", "__psi", points)])
            for jobs in range(1, rounds + 1):
                e = _reml_sums(fit, p, grid)
                k = max(range(len(e)), key=lambda i: e[i]["ll"])
                lo, hi = max(k - 1, 0), min(k + 1, len(e) - 1)
                grid = np.linspace(e[lo]["s2"], e[hi]["s2"], points)
            sigma2 = e[k]["s2"]
            for i in range(lo, hi):
                s0, s1 = e[i]["score"], e[i + 1]["score"]
                if s0 > 0 >= s1:
                    sigma2 = e[i]["s2"] + (e[i + 1]["s2"] - e[i]["s2"]) * s0 / (s0 - s1)
                    r = _reml_sums(fit, p, [sigma2])[0]  # one scoring step takes out what is left of the interpolation's error
                    sigma2 = max(sigma2 + 2 * r["score"] / r["w2"], 0.0)
        r = _reml_sums(fit, p, [sigma2])[0]
        return EblupFit(r["beta"], r["cov"], float(sigma2), 2.0 / r["w2"], jobs)
    finally:
        fit.unpersist()


def eblup_table(areas: DataFrame, fit: EblupFit, y: str, psi: str, xs: Sequence[str | Column]) -> DataFrame:
    """EBLUP per area with the three-term mean squared error; unobserved areas get the synthetic value."""
    cols = double_columns(xs)
    s2 = F.lit(fit.sigma2)
    seen = F.col(y).isNotNull() & F.col(psi).isNotNull()
    gamma = F.when(seen, s2 / (s2 + F.col(psi))).otherwise(0.0)
    out = with_forms(areas.withColumn("gamma", gamma), cols, fit.beta, fit.cov, "synthetic", "__q")
    g, xvx = F.col("gamma"), F.col("__q")
    out = out.withColumns(
        {
            "theta": F.when(seen, g * F.col(y) + (1 - g) * F.col("synthetic")).otherwise(F.col("synthetic")),
            "g1": F.when(seen, g * F.col(psi)).otherwise(s2),
            "g2": F.pow(1 - g, 2) * xvx,
            "g3": F.when(seen, F.pow(F.col(psi), 2) / F.pow(s2 + F.col(psi), 3) * F.lit(fit.var_sigma2)).otherwise(0.0),
        }
    )
    return out.withColumn("mse", F.col("g1") + F.col("g2") + 2 * F.col("g3")).drop("__q")


# ---------------------------------------------------------------- Bayes by quadrature


@dataclass(frozen=True)
class GridFit:
    """Posterior over a variance grid: weights, and coefficient mean and covariance at each point."""

    sigma2: np.ndarray
    weights: np.ndarray
    beta: np.ndarray
    cov: np.ndarray
    link: str

    @property
    def beta_mean(self) -> np.ndarray:
        return mix_moments(self.weights, self.beta, self.cov)[0]

    @property
    def beta_sd(self) -> np.ndarray:
        return np.sqrt(np.diag(mix_moments(self.weights, self.beta, self.cov)[1]))

    @property
    def sigma2_mean(self) -> float:
        return float(self.weights @ self.sigma2)

    @property
    def sigma_mean(self) -> float:
        return float(self.weights @ np.sqrt(self.sigma2))

    def pruned(self, floor: float = 1e-12) -> GridFit:
        """Leave out points whose weight is below rounding error."""
        k = self.weights > floor * self.weights.max()
        w = self.weights[k] / self.weights[k].sum()
        return GridFit(self.sigma2[k], w, self.beta[k], self.cov[k], self.link)

    def summary(self, spark, names: Sequence[str]) -> DataFrame:
        rows = [(n, float(m), float(s)) for n, m, s in zip(names, self.beta_mean, self.beta_sd)]
        m = self.sigma2_mean
        rows.append(("sigma2_v", m, float(np.sqrt(max(self.weights @ self.sigma2**2 - m * m, 0.0)))))
        return spark.createDataFrame(rows, "variable string, mean double, sd double")


def variance_grid(areas: DataFrame, y: str, psi: str, points: int) -> np.ndarray:
    """Log-spaced grid from far below the median sampling variance to far above the spread of the estimates."""
    r = areas.agg(F.percentile_approx(psi, 0.5).alias("m"), F.var_samp(y).alias("v"), F.count(y).alias("n")).first()
    med = r["m"] if r["m"] and r["m"] > 0 else 1e-6
    return np.exp(np.linspace(np.log(med * 1e-4), np.log(max(100 * med, 10 * (r["v"] or 0.0))), points))


def log_prior(s2: np.ndarray, prior: str, shape: float = 1e-4, rate: float = 1e-4) -> np.ndarray:
    """Log prior density of the area variance."""
    if prior == "inverse_gamma":
        return -(shape + 1) * np.log(s2) - rate / s2
    if prior == "flat_sd":
        return -0.5 * np.log(s2)
    if prior == "half_cauchy":
        return -np.log1p((s2 / 1000.0) ** 2)
    raise ValueError(f"unknown prior {prior!r}")


def fh_gaussian_fit(
    areas: DataFrame, y: str, psi: str, xs: Sequence[str | Column], prior: str = "inverse_gamma", tau: float = 100.0, grid: np.ndarray | None = None, points: int = 200, link: str = "identity"
) -> GridFit:
    """Posterior of (beta, sigma2_v) for y ~ N(theta, psi), theta = x beta + v.

    All grid points are evaluated in one job: areas are exploded over the grid and summed per point before
    the shuffle.
    """
    p = len(xs)
    names = [f"__x{i}" for i in range(p)]
    fit = areas.select(F.col(y).cast("double").alias("__y"), F.col(psi).cast("double").alias("__psi"), *[c.alias(n) for n, c in zip(names, double_columns(xs))])
    fit = fit.filter("__y IS NOT NULL AND __psi IS NOT NULL").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if grid is None:
            grid = variance_grid(fit, "__y", "__psi", points)
        if prior == "flat_sd" and fit.count() < p + 2:
            raise ValueError("a flat prior on the area standard deviation needs at least p + 2 areas")
        rows = _grid_sums(fit, p, grid)
    finally:
        fit.unpersist()
    G = len(grid)
    logp, beta, cov = np.empty(G), np.empty((G, p)), np.empty((G, p, p))
    for g, r in enumerate(rows):
        if not r:
            raise ValueError("no area has an estimate and its variance")
        if g == 0:
            warn_if_saturated(p, r["m"])
        a, u = r["a"] + np.eye(p) / tau**2, r["u"]
        beta[g], cov[g] = np.linalg.solve(a, u), np.linalg.inv(a)
        logp[g] = 0.5 * r["lw"] - 0.5 * (r["yy"] - u @ beta[g]) - 0.5 * np.linalg.slogdet(a)[1]
    grid = np.asarray(grid, dtype=float)
    steps = np.gradient(np.log(grid)) if G > 1 else np.ones(1)
    logp = logp + log_prior(grid, prior) + np.log(grid) + np.log(steps)
    return GridFit(grid, log_weights(logp), beta, cov, link)


def grid_array(spark, fit: GridFit) -> Column:
    """The grid as one array-of-struct value, carried into expressions by a scalar subquery."""
    p = fit.beta.shape[1]
    items = [
        (float(w), float(s), [float(v) for v in b], [float(c[i, j]) * (1 if i == j else 2) for i in range(p) for j in range(i, p)])
        for w, s, b, c in zip(fit.weights, fit.sigma2, fit.beta, fit.cov)
    ]
    df = spark.createDataFrame([(items,)], "g array<struct<w:double,s2:double,b:array<double>,c:array<double>>>")
    return df.select("g").scalar()


def fh_gaussian_predict(areas: DataFrame, fit: GridFit, y: str, psi: str, xs: Sequence[str | Column], area_effect: bool = True) -> DataFrame:
    """Posterior mean and sd of every area parameter, observed or not, in one projection.

    With the arcsine link the parameter is sin^2 of the linear one and its moments are exact at each grid
    point.
    """
    fit = fit.pruned()
    cols = double_columns(xs)
    p = len(cols)
    if p > NARROW:
        return _wide_predict(areas, fit, y, psi, cols, area_effect)
    seen = F.col(y).isNotNull() & F.col(psi).isNotNull()
    yv, pv = F.coalesce(F.col(y).cast("double"), F.lit(0.0)), F.col(psi).cast("double")

    def step(acc: Column, g: Column) -> Column:
        xb = F.lit(0.0)
        for i, c in enumerate(cols):
            xb = xb + c * F.get(g["b"], i)
        q, k = F.lit(0.0), 0
        for i in range(p):
            for j in range(i, p):
                q = q + cols[i] * cols[j] * F.get(g["c"], k)
                k += 1
        gamma = F.when(seen, g["s2"] / (g["s2"] + pv)).otherwise(0.0)
        extra = F.when(seen, gamma * pv).otherwise(g["s2"] if area_effect else F.lit(0.0))
        m = gamma * yv + (1 - gamma) * xb
        v = extra + (1 - gamma) * (1 - gamma) * q
        if fit.link == "arcsine":
            c2, c4 = F.exp(-2 * v) * F.cos(2 * m), F.exp(-8 * v) * F.cos(4 * m)
            e1, e2 = 0.5 * (1 - c2), 0.375 - 0.5 * c2 + 0.125 * c4
        else:
            e1, e2 = m, v + m * m
        return F.struct((acc["e1"] + g["w"] * e1).alias("e1"), (acc["e2"] + g["w"] * e2).alias("e2"))

    zero = F.struct(F.lit(0.0).alias("e1"), F.lit(0.0).alias("e2"))
    out = areas.withColumn("__grid", grid_array(areas.sparkSession, fit)).withColumn("__a", F.aggregate("__grid", zero, step))
    var = F.greatest(F.col("__a.e2") - F.col("__a.e1") * F.col("__a.e1"), F.lit(0.0))
    return out.withColumns({"theta": F.col("__a.e1"), "theta_sd": F.sqrt(var), "observed": seen}).drop("__a", "__grid")


def _wide_predict(areas: DataFrame, fit: GridFit, y: str, psi: str, cols: Sequence[Column], area_effect: bool) -> DataFrame:
    """The same moments for wide designs, batch by batch as matrices."""
    kept, p = areas.columns, len(cols)
    table = areas.select(*kept, F.col(y).cast("double").alias("__y"), F.col(psi).cast("double").alias("__psi"), F.array(*cols).alias("__x"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            X = np.array([[np.nan if v is None else v for v in r] for r in pdf["__x"]], float).reshape(len(pdf), p)
            y_, psi_ = pdf["__y"].to_numpy(float), pdf["__psi"].to_numpy(float)
            seen = ~np.isnan(y_) & ~np.isnan(psi_)
            e1, e2 = np.zeros(len(pdf)), np.zeros(len(pdf))
            for w, s2, b, c in zip(fit.weights, fit.sigma2, fit.beta, fit.cov):
                gamma = np.where(seen, s2 / (s2 + np.where(seen, psi_, 1.0)), 0.0)
                m = gamma * np.where(seen, y_, 0.0) + (1 - gamma) * (X @ b)
                v = np.where(seen, gamma * np.where(seen, psi_, 0.0), s2 if area_effect else 0.0) + (1 - gamma) ** 2 * np.einsum("ri,ri->r", X @ c, X)
                if fit.link == "arcsine":
                    c2, c4 = np.exp(-2 * v) * np.cos(2 * m), np.exp(-8 * v) * np.cos(4 * m)
                    m, second = 0.5 * (1 - c2), 0.375 - 0.5 * c2 + 0.125 * c4
                else:
                    second = v + m * m
                e1, e2 = e1 + w * m, e2 + w * second
            yield pdf[kept].assign(theta=e1, theta_sd=np.sqrt(np.maximum(e2 - e1 * e1, 0.0)), observed=seen)

    schema = areas.schema.add("theta", "double").add("theta_sd", "double").add("observed", "boolean")
    out = table.mapInPandas(run, schema)
    return out.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("theta", "theta_sd")})


def fh_normal(areas: DataFrame, y: str, psi: str, xs: Sequence[str | Column], prior: str = "inverse_gamma", **kw) -> tuple[GridFit, DataFrame]:
    fit = fh_gaussian_fit(areas, y, psi, xs, prior, **kw)
    return fit, fh_gaussian_predict(areas, fit, y, psi, xs)


def fh_arcsine(areas: DataFrame, p: str, n_eff: str, xs: Sequence[str | Column], **kw) -> tuple[GridFit, DataFrame]:
    """Normal model on asin(sqrt(p)) with variance 1 / (4 n_eff), mapped back to the proportion."""
    z = areas.withColumns({"__z": F.asin(F.sqrt(p)), "__vz": 1 / nullif_zero(4 * F.col(n_eff))})
    fit = fh_gaussian_fit(z, "__z", "__vz", xs, link="arcsine", **kw)
    return fit, fh_gaussian_predict(z, fit, "__z", "__vz", xs).drop("__z", "__vz")


def prediction_cv(df: DataFrame, theta: str = "theta", se: str = "theta_sd") -> DataFrame:
    return df.withColumn("Cv_pred", F.col(se) / nullif_zero(theta))


def observed_and_synthetic(observed: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Stack predictions of observed and unobserved areas with their coefficients of variation."""
    return prediction_cv(union_by_name([observed, synthetic]))


def compare_direct_model(df: DataFrame, area: str, direct: str, model: str = "theta") -> DataFrame:
    """Pairs of direct and model estimates, observed areas only."""
    return df.filter(F.col(direct).isNotNull()).select(area, F.col(direct).alias("direct"), F.col(model).alias("model"))
