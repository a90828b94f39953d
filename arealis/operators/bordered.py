"""Models with one column per level of a wide factor, without ever making those columns.

The normal equations of dense columns next to the indicators of a factor are bordered: the indicators' block is diagonal.
Spark sums one small block per level (weight, sums of the dense columns and of the outcome); levels are eliminated where
they lie, so only the Schur complement of the dense columns comes to the driver, and level effects stay a table.  Of several
factors the widest is eliminated when the others have few levels; else the blocks between them are sparse co-occurrence
counts, and conjugate gradients run on tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.recode import as_column
from arealis.operators.area import GridFit, log_prior
from arealis.operators.area import variance_grid as area_grid
from arealis.operators.glm import log_weights
from arealis.operators.linalg import NARROW, cross_sums, dot, double_columns, read_matrix, read_vector, task_sums, vector_sums
from arealis.session import materialise


@dataclass(frozen=True)
class BorderedFit:
    """Dense coefficients with their covariance, and a table ``level``, ``effect``, ``effect_sd`` of the factor."""

    names: tuple[str, ...]
    beta: np.ndarray
    cov: np.ndarray
    effects: DataFrame
    sigma2: float = 1.0
    n: int = 0
    rss: float = float("nan")
    iterations: int = 0

    @property
    def sd(self) -> np.ndarray:
        return np.sqrt(np.diag(self.cov))


def _prepared(df: DataFrame, y: str | Column, xs: dict[str, Column], factors: Sequence[str], weight: Column | None) -> DataFrame:
    """Rows with all values present: ``l0``, ``l1``, ... (levels as strings), ``y``, ``w``, ``x0``, ``x1``, ..."""
    cols = [F.col(f).cast("string").alias(f"l{i}") for i, f in enumerate(factors)]
    cols += [as_column(y).cast("double").alias("y"), (F.lit(1.0) if weight is None else weight.cast("double")).alias("w")]
    cols += [c.alias(f"x{i}") for i, c in enumerate(double_columns(list(xs.values())))]
    return df.select(*cols).dropna()


def level_blocks(rows: DataFrame, q: int, level: str, by: Sequence[str] = (), weight: Column | None = None, y: Column | None = None) -> DataFrame:
    """One row per level: weight ``d``, sums ``s0..`` of the dense columns and ``t`` of the outcome, and their products."""
    w, y = F.col("w") if weight is None else weight, F.col("y") if y is None else y
    xs = [F.col(f"x{i}") for i in range(q)]
    return rows.groupBy(*by, F.col(level).alias("level")).agg(
        F.sum(w).alias("d"),
        F.sum(w * y).alias("t"),
        F.sum(w * y * y).alias("yy"),
        F.count(F.lit(1)).alias("n"),
        *[F.sum(w * x).alias(f"s{i}") for i, x in enumerate(xs)],
        *cross_sums(xs, "e", w),
        *vector_sums(xs, y, "r", w),
    )


def _schur_sums(q: int, reference: str | None, ridge: float) -> tuple[Column, list[Column]]:
    """Whether a block's level has a column of its own, and what the elimination of all levels leaves to the dense columns."""
    own = F.lit(True) if reference is None else F.col("level") != reference
    d = F.col("d") + F.lit(ridge)

    def less(total: str, a: str, b: str) -> Column:
        return F.sum(F.col(total) - F.when(own, F.col(a) * F.col(b) / d).otherwise(0.0)).alias(total)

    out = [less(f"e_{i}_{j}", f"s{i}", f"s{j}") for i in range(q) for j in range(i, q)]
    out += [less(f"r_{i}", f"s{i}", "t") for i in range(q)]
    out += [less("yy", "t", "t"), F.sum("n").alias("n"), F.sum(F.when(own, F.log(d)).otherwise(0.0)).alias("logdet"), F.sum(own.cast("long")).alias("levels")]
    return own, out


def _effects(blocks: DataFrame, q: int, own: Column, ridge: float, beta: np.ndarray, cov: np.ndarray, sigma2: float) -> DataFrame:
    """Back substitution: effect and standard deviation of every level, where it lies."""
    d = F.col("d") + F.lit(ridge)
    c = [F.col(f"s{i}") / d for i in range(q)]
    spread = F.lit(sigma2) / d
    for i in range(q):
        for j in range(q):
            spread = spread + c[i] * c[j] * F.lit(float(cov[i, j]))
    effect = F.col("t") / d - dot(c, beta)
    return blocks.select("level", F.when(own, effect).otherwise(0.0).alias("effect"), F.when(own, F.sqrt(spread)).otherwise(0.0).alias("effect_sd"))


def linear_with_factor(df: DataFrame, y: str | Column, xs: dict[str, Column], factor: str, reference: str | None = None, weight: Column | None = None, tau: float | None = None, sigma2: float | None = None) -> BorderedFit:
    """Least squares of ``y`` on dense columns and one indicator per level of ``factor``, of any number of levels.

    ``reference`` names the level without an indicator; without one, the dense columns must hold no intercept.  With ``tau``
    all coefficients have independent N(0, tau^2) priors and ``sigma2`` must be given.  Rows with missing values are left
    out.  One shuffle by level; the driver solves a system of the dense columns alone.
    """
    if tau is not None and sigma2 is None:
        raise ValueError("a prior on the coefficients needs the residual variance")
    q, ridge = len(xs), 0.0 if tau is None else sigma2 / tau**2
    blocks = materialise(level_blocks(_prepared(df, y, xs, [factor], weight), q, "l0"))
    own, sums = _schur_sums(q, reference, ridge)
    row = blocks.agg(*sums).first().asDict()
    if not row["n"]:
        raise ValueError("no row has all values")
    schur, rhs = read_matrix(row, "e", q) + ridge * np.eye(q), read_vector(row, "r", q)
    beta = np.linalg.lstsq(schur, rhs, rcond=1e-13)[0] if q else np.zeros(0)
    rss = max(row["yy"] - float(beta @ rhs), 0.0)
    free = row["n"] - q - row["levels"]
    s2 = sigma2 if sigma2 is not None else rss / free if free > 0 else float("nan")
    cov = s2 * np.linalg.pinv(schur, rcond=1e-13) if q else np.zeros((0, 0))
    return BorderedFit(tuple(xs), beta, cov, _effects(blocks, q, own, ridge, beta, cov, s2), s2, row["n"], rss)


def binomial_with_factor(df: DataFrame, y: str | Column, n: str | Column | None, xs: dict[str, Column], factor: str, reference: str | None = None, tau: float = 1e4, tol: float = 1e-9, max_iter: int = 60) -> BorderedFit:
    """Logistic regression on counts (0/1 rows when ``n`` is None) with one indicator per level of a wide factor; N(0, tau^2) priors.

    Rows collapse to covariate patterns, dealt once by level.  A Newton step joins the level effects to their patterns,
    sums one block per level, solves the Schur complement on the driver and moves the effects where they lie; the table of
    effects is checkpointed once per step.  Raises an error when the steps do not converge.
    """
    q, ridge = len(xs), 1.0 / tau**2
    trials = F.lit(1.0) if n is None else as_column(n).cast("double")
    rows = _prepared(df.withColumn("__n", trials), y, xs, [factor], F.col("__n"))
    names = [f"x{i}" for i in range(q)]
    patterns = rows.groupBy("l0", *names).agg(F.sum("y").alias("y"), F.sum("w").alias("m")).withColumnRenamed("l0", "level")
    patterns = patterns.repartition("level").persist(StorageLevel.MEMORY_AND_DISK)
    beta, it = np.zeros(q), 0
    try:
        effects = materialise(patterns.select("level").distinct().withColumn("effect", F.lit(0.0)))
        own = F.lit(True) if reference is None else F.col("level") != reference
        for it in range(1, max_iter + 1):
            eta = dot([F.col(c) for c in names], beta) + F.col("effect")
            fitted = patterns.join(effects, "level").withColumn("mu", 1 / (1 + F.exp(-eta)))
            w, left = F.col("m") * F.col("mu") * (1 - F.col("mu")), F.col("y") - F.col("m") * F.col("mu")
            xcols = [F.col(c) for c in names]
            blocks = fitted.groupBy("level").agg(
                F.first("effect").alias("effect"),
                (F.sum(w) + ridge).alias("d"),
                (F.sum(left) - ridge * F.first("effect")).alias("t"),
                F.count(F.lit(1)).alias("n"),
                *[F.sum(w * x).alias(f"s{i}") for i, x in enumerate(xcols)],
                *cross_sums(xcols, "e", w),
                *vector_sums(xcols, left, "r"),
            )
            blocks = materialise(blocks.withColumn("yy", F.lit(0.0)))
            row = blocks.agg(*_schur_sums(q, reference, 0.0)[1]).first().asDict()
            schur = read_matrix(row, "e", q) + ridge * np.eye(q)
            step = np.linalg.solve(schur, read_vector(row, "r", q) - ridge * beta) if q else np.zeros(0)
            size = float(np.abs(step).max()) if q else 0.0
            step = step * min(1.0, 5.0 / max(size, 1e-300))
            move = F.col("t") / F.col("d") - dot([F.col(f"s{i}") / F.col("d") for i in range(q)], step)
            moved = blocks.withColumn("move", F.when(own, F.greatest(F.lit(-5.0), F.least(F.lit(5.0), move))).otherwise(0.0))
            top = moved.agg(F.max(F.abs("move") / (1 + F.abs("effect")))).first()[0]
            beta = beta + step
            effects = moved.select("level", (F.col("effect") + F.col("move")).alias("effect"))
            if size < tol * (1 + np.abs(beta).max(initial=0.0)) and top < tol:
                break
            effects = materialise(effects)
        else:
            raise RuntimeError(f"no convergence after {max_iter} Newton steps; the last one was {max(size, top):.2g}")
        cov = np.linalg.inv(schur) if q else np.zeros((0, 0))
        spread = 1 / F.col("d")
        for i in range(q):
            for j in range(q):
                spread = spread + F.col(f"s{i}") * F.col(f"s{j}") / (F.col("d") * F.col("d")) * F.lit(float(cov[i, j]))
        table = moved.select("level", (F.col("effect") + F.col("move")).alias("effect"), F.when(own, F.sqrt(spread)).otherwise(0.0).alias("effect_sd"))
        return BorderedFit(tuple(xs), beta, cov, materialise(table), 1.0, int(row["n"]), float("nan"), it)
    finally:
        patterns.unpersist()


def predict_with_factor(df: DataFrame, fit: BorderedFit, xs: dict[str, Column], factor: str, out: str = "eta") -> DataFrame:
    """Linear predictor of every row; levels that the fit has not seen have the effect 0."""
    named = fit.effects.select(F.col("level").alias("__level"), F.col("effect").alias("__effect"))
    joined = df.join(named, F.col(factor).cast("string") == F.col("__level"), "left")
    return joined.withColumn(out, dot(double_columns(list(xs.values())), fit.beta) + F.coalesce("__effect", F.lit(0.0))).drop("__level", "__effect")


# ---------------------------------------------------------------- area models


@dataclass(frozen=True)
class BorderedGrid:
    """A variance grid with dense coefficients at each point, and per level one array over the points of its block."""

    grid: GridFit
    blocks: DataFrame
    reference: str | None
    tau: float


def fh_normal_with_factor(areas: DataFrame, y: str, psi: str, xs: dict[str, Column], factor: str, reference: str | None = None, prior: str = "inverse_gamma", tau: float = 100.0, grid: np.ndarray | None = None, points: int = 200, link: str = "identity") -> tuple[BorderedGrid, DataFrame]:
    """Area model y ~ N(theta, psi), theta = x beta + effect of the area's factor level + v, with one effect per level.

    Posterior over a variance grid as in ``area.fh_gaussian_fit``.  All points share one job: areas meet the grid, one block
    per (point, level) is summed, and the levels are eliminated per point; only sums of the dense columns per point come to
    the driver.  Returns the fit and ``areas`` with ``theta``, ``theta_sd`` and ``observed``; levels without observed areas
    have their prior.
    """
    q, ridge = len(xs), 1.0 / tau**2
    rows = _prepared(areas.withColumn("__psi", F.col(psi).cast("double")), y, xs, [factor], F.col("__psi")).withColumnRenamed("w", "psi")
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if grid is None:
            grid = area_grid(rows, "y", "psi", points)
        grid = np.asarray(grid, dtype=float)
        tall = rows.select("*", F.posexplode(F.array(*[F.lit(float(g)) for g in grid])).alias("g", "s2"))
        w = 1 / (F.col("s2") + F.col("psi"))
        blocks = materialise(level_blocks(tall.withColumn("w", w), q, "l0", ["g"]).withColumn("g", F.col("g").cast("int")))
        sums = {r["g"]: r.asDict() for r in blocks.groupBy("g").agg(*_schur_sums(q, reference, ridge)[1]).collect()}
        scale = {r["g"]: r["lw"] for r in tall.groupBy("g").agg(F.sum(F.log(w)).alias("lw")).collect()}
    finally:
        rows.unpersist()
    G = len(grid)
    logp, beta, cov = np.empty(G), np.empty((G, q)), np.empty((G, q, q))
    for g, r in sums.items():
        schur, rhs = read_matrix(r, "e", q) + ridge * np.eye(q), read_vector(r, "r", q)
        beta[g], cov[g] = np.linalg.solve(schur, rhs), np.linalg.inv(schur)
        # each level's prior precision leaves the determinant of its block over that of its prior
        logp[g] = 0.5 * scale[g] - 0.5 * (r["yy"] - rhs @ beta[g]) - 0.5 * (np.linalg.slogdet(schur)[1] + r["logdet"])
    steps = np.gradient(np.log(grid)) if G > 1 else np.ones(1)
    weights = log_weights(logp + log_prior(grid, prior) + np.log(grid) + np.log(steps))
    fit = BorderedGrid(GridFit(grid, weights, beta, cov, link), blocks, reference, tau)
    return fit, fh_predict_with_factor(areas, fit, y, psi, xs, factor)


def fh_predict_with_factor(areas: DataFrame, fit: BorderedGrid, y: str, psi: str, xs: dict[str, Column], factor: str) -> DataFrame:
    """Posterior mean and sd of every area: with the level eliminated, its dense columns are taken from their weighted level means."""
    kept = np.flatnonzero(fit.grid.weights > 1e-12 * fit.grid.weights.max())
    w = fit.grid.weights[kept] / fit.grid.weights[kept].sum()
    q, ridge = len(xs), 1.0 / fit.tau**2
    points = [(int(g), float(a), float(fit.grid.sigma2[g]), [float(v) for v in fit.grid.beta[g]], [float(v) for v in fit.grid.cov[g].ravel()]) for g, a in zip(kept, w)]
    spark = areas.sparkSession
    grid = spark.createDataFrame(points, "g int, w double, s2 double, b array<double>, c array<double>")
    own = F.lit(True) if fit.reference is None else F.col("level") != fit.reference
    some = fit.blocks.join(F.broadcast(grid.select("g")), "g")
    d = F.col("d") + ridge
    item = F.struct("g", (1 / d).alias("v"), (F.col("t") / d).alias("m"), F.array(*[F.col(f"s{i}") / d for i in range(q)]).cast("array<double>").alias("c"))
    table = some.where(own).groupBy("level").agg(F.sort_array(F.collect_list(item)).alias("__blocks"))
    grid_column = grid.agg(F.sort_array(F.collect_list(F.struct("g", "w", "s2", "b", "c"))).alias("a")).select("a").scalar()
    joined = areas.join(table, F.col(factor).cast("string") == F.col("level"), "left").drop("level").withColumn("__grid", grid_column)
    bare = F.transform("__grid", lambda g: F.struct(g["g"].alias("g"), F.lit(1 / ridge).alias("v"), F.lit(0.0).alias("m"), F.array_repeat(F.lit(0.0), q).alias("c")))
    if fit.reference is not None:
        is_reference = F.col(factor).cast("string") == fit.reference
        bare = F.transform("__grid", lambda g: F.struct(g["g"].alias("g"), F.when(is_reference, F.lit(0.0)).otherwise(1 / ridge).alias("v"), F.lit(0.0).alias("m"), F.array_repeat(F.lit(0.0), q).alias("c")))
    joined = joined.withColumn("__blocks", F.coalesce("__blocks", bare))
    seen = F.col(y).isNotNull() & F.col(psi).isNotNull()
    yv, pv = F.coalesce(F.col(y).cast("double"), F.lit(0.0)), F.col(psi).cast("double")
    cols = double_columns(list(xs.values()))

    def step(acc: Column, both: Column) -> Column:
        g, block = both["__grid"], both["__blocks"]
        gap = [c - F.get(block["c"], i) for i, c in enumerate(cols)]
        xb, spread = block["m"], block["v"]
        for i in range(q):
            xb = xb + gap[i] * F.get(g["b"], i)
            for j in range(q):
                spread = spread + gap[i] * gap[j] * F.get(g["c"], i * q + j)
        gamma = F.when(seen, g["s2"] / (g["s2"] + pv)).otherwise(0.0)
        m = gamma * yv + (1 - gamma) * xb
        v = F.when(seen, gamma * pv).otherwise(g["s2"]) + (1 - gamma) * (1 - gamma) * spread
        if fit.grid.link == "arcsine":
            c2, c4 = F.exp(-2 * v) * F.cos(2 * m), F.exp(-8 * v) * F.cos(4 * m)
            e1, e2 = 0.5 * (1 - c2), 0.375 - 0.5 * c2 + 0.125 * c4
        else:
            e1, e2 = m, v + m * m
        return F.struct((acc["e1"] + g["w"] * e1).alias("e1"), (acc["e2"] + g["w"] * e2).alias("e2"))

    zero = F.struct(F.lit(0.0).alias("e1"), F.lit(0.0).alias("e2"))
    out = joined.withColumn("__a", F.aggregate(F.arrays_zip("__grid", "__blocks"), zero, step))
    var = F.greatest(F.col("__a.e2") - F.col("__a.e1") * F.col("__a.e1"), F.lit(0.0))
    return out.withColumns({"theta": F.col("__a.e1"), "theta_sd": F.sqrt(var), "observed": seen}).drop("__a", "__grid", "__blocks")


# ---------------------------------------------------------------- several wide factors


FEW_LEVELS = 256  # levels of all factors but the widest up to which the driver solves their equations


def linear_with_factors(df: DataFrame, y: str | Column, xs: dict[str, Column], factors: Sequence[str], sigma2: float = 1.0, tau: float = 1e4, tol: float = 1e-10, max_iter: int = 500) -> BorderedFit:
    """Least squares on dense columns and the indicators of several wide factors, with N(0, tau^2) priors that make it unique.

    Where all factors but the widest have few levels together, the widest is eliminated where its levels lie and the rest is a
    small system: no iterations.  Otherwise conjugate gradients run on tables.  The residual variance is taken as given.
    ``effects`` has ``factor``, ``level`` and ``effect``.
    """
    ridge = sigma2 / tau**2
    rows = _prepared(df, y, xs, factors, None)
    names = [F.col(f"x{i}") for i in range(len(xs))]
    levels = [f"l{i}" for i in range(len(factors))]
    sums = [*cross_sums(names, "e"), *vector_sums(names, F.col("y"), "r"), F.count(F.lit(1)).alias("n")]
    # rows are read once; only sums of many dense columns are not worth keeping per cell
    kept = sums if len(sums) <= NARROW else []
    cells = materialise(rows.groupBy(*levels).agg(F.count(F.lit(1)).cast("double").alias("d"), F.sum("y").alias("t"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(names)], *kept))
    dense = (cells.agg(*[F.sum(c).alias(c) for c in cells.columns if c[:2] in ("e_", "r_", "n")]) if kept else rows.agg(*sums)).first().asDict()
    if not dense["n"]:
        raise ValueError("no row has all values")
    sizes = cells.agg(*[F.approx_count_distinct(c).alias(c) for c in levels]).first().asDict()
    wide = max(levels, key=lambda c: sizes[c])
    small, left = {}, FEW_LEVELS
    for c in levels:
        if c != wide and left >= 0:
            small[c] = {r["level"]: r for r in _totals(cells, c, len(xs)).limit(left + 1).collect()}
            left -= len(small[c])
    if left >= 0:
        beta, effects, it = *_eliminate(cells, wide, small, dense, len(xs), ridge), 0
    else:
        beta, effects, it = _conjugate_gradients(cells, levels, dense, len(xs), ridge, tol, max_iter)
    label = F.get(F.array(*[F.lit(f) for f in factors]), F.col("f"))
    q = len(xs)
    return BorderedFit(tuple(xs), beta, np.full((q, q), np.nan), effects.select(label.alias("factor"), "level", F.col("x").alias("effect")), sigma2, dense["n"], float("nan"), it)


def _totals(cells: DataFrame, level: str, q: int) -> DataFrame:
    """Count and sums of every level of a factor."""
    return cells.groupBy(F.col(level).alias("level")).agg(*[F.sum(c).alias(c) for c in ("d", "t", *[f"s{i}" for i in range(q)])])


def _eliminate(cells: DataFrame, wide: str, small: dict[str, dict], dense: dict, q: int, ridge: float) -> tuple[np.ndarray, DataFrame]:
    """Solve for the dense columns and the levels of the small factors with the wide factor eliminated, then go back to its levels.

    Every wide level sends the products of its counts and sums; tasks add them up as matrices.
    """
    spark = cells.sparkSession
    at = {c: {v: i for i, v in enumerate(sorted(part))} for c, part in small.items()}
    starts = dict(zip(at, np.cumsum([0, *map(len, at.values())])))
    K = sum(map(len, at.values()))
    p = K + q
    # what remains: the small levels, then the dense columns
    gram, rhs = np.zeros((p, p)), np.zeros(p)
    gram[K:, K:], rhs[K:] = read_matrix(dense, "e", q), read_vector(dense, "r", q)
    for c, part in small.items():
        for v, r in part.items():
            i = starts[c] + at[c][v]
            gram[i, i], rhs[i] = r["d"], r["t"]
            gram[i, K:] = gram[K:, i] = [r[f"s{k}"] for k in range(q)]
    for n, c in enumerate(at):
        for c2 in list(at)[n + 1 :]:
            for r in cells.groupBy(c, c2).agg(F.sum("d").alias("d")).collect():
                i, j = starts[c] + at[c][r[c]], starts[c2] + at[c2][r[c2]]
                gram[i, j] = gram[j, i] = r["d"]
    placed = cells
    for c in at:
        table = spark.createDataFrame([(v, int(starts[c] + i)) for v, i in at[c].items()], f"{c} string, at_{c} int")
        placed = placed.join(F.broadcast(table), c)
    sums = [F.sum(f"s{i}") for i in range(q)]
    blocks = placed.groupBy(F.col(wide).alias("level")).agg(
        F.sum("d").alias("d"), F.sum("t").alias("t"), F.array(*sums).cast("array<double>").alias("s"), F.collect_list(F.struct("d", *[f"at_{c}" for c in at])).alias("met")
    )
    blocks = materialise(blocks)
    flat = blocks.select("d", "t", "s", F.col("met.d").alias("k"), *[F.col(f"met.at_{c}").alias(f"at_{c}") for c in at])

    def products(pdf) -> np.ndarray:
        B = len(pdf)
        owner = np.repeat(np.arange(B), [len(k) for k in pdf["k"]])
        k = np.concatenate(pdf["k"].to_list())
        V = np.zeros(B * (p + 1))
        for c in at:
            V += np.bincount(owner * (p + 1) + np.concatenate(pdf[f"at_{c}"].to_list()), weights=k, minlength=len(V))
        V = V.reshape(B, p + 1)
        if q:
            V[:, K:p] = np.stack(pdf["s"].to_list())
        V[:, p] = pdf["t"]
        d = pdf["d"].to_numpy(float)
        own = d + ridge
        return np.concatenate([((V * w[:, None]).T @ V).ravel() for w in ((d + 2 * ridge) / own**2, 1 / own**2)])

    both = task_sums(flat, products).reshape(2, p + 1, p + 1)
    x = _solve_with_prior(gram - both[0, :p, :p], np.eye(p) + both[1, :p, :p], rhs - both[0, :p, p], both[1, :p, p], np.diag(gram), ridge)
    values = F.lit([float(v) for v in x[:K]] or [0.0])
    pull = F.aggregate("met", F.lit(0.0), lambda a, m: a + m["d"] * sum((F.get(values, m[f"at_{c}"]) for c in at), F.lit(0.0)))
    back = (F.col("t") - pull - dot([F.get("s", i) for i in range(q)], x[K:])) / (F.col("d") + ridge)
    effects = blocks.select(F.lit(int(wide[1:])).alias("f"), "level", back.alias("x"))
    for c in at:
        effects = effects.unionByName(spark.createDataFrame([(int(c[1:]), v, float(x[starts[c] + i])) for v, i in at[c].items()], "f int, level string, x double"))
    return x[K:], effects


def _solve_with_prior(P: np.ndarray, W: np.ndarray, b: np.ndarray, g: np.ndarray, size: np.ndarray, ridge: float) -> np.ndarray:
    """Solve (P + ridge W) x = b + ridge g for positive semidefinite P that may be singular, however small the ridge.

    What P leaves open (indicators of two factors add up to the same column) is settled by W and g alone, so that rounding of P
    is not divided by the ridge.
    """
    c = 1 / np.sqrt(np.where(size > 0, size, 1.0))
    P, W, b, g = P * np.outer(c, c), W * np.outer(c, c), b * c, g * c
    mu, U = np.linalg.eigh((P + P.T) / 2)
    free = mu <= 1e-12
    N, R = U[:, free], U[:, ~free]
    lower = np.hstack([ridge * R.T @ W @ N, np.diag(mu[~free]) + ridge * R.T @ W @ R])
    upper = np.hstack([N.T @ W @ N, N.T @ W @ R])
    scale = np.abs(upper).max(axis=1, initial=0.0)
    x = np.linalg.solve(np.vstack([upper / scale[:, None], lower]), np.concatenate([N.T @ g / scale, R.T @ (b + ridge * g)]))
    return c * (np.hstack([N, R]) @ x)


def _conjugate_gradients(cells: DataFrame, levels: Sequence[str], dense: dict, q: int, ridge: float, tol: float, max_iter: int) -> tuple[np.ndarray, DataFrame, int]:
    """Levels of any number in every factor.

    Between two factors the normal equations hold co-occurrence counts: a sparse table.  Conjugate gradients with the
    diagonal as preconditioner run on a table of one row per level; a step is one join with the counts, one checkpoint of
    the level table and two aggregates, and the dense columns are a small block on the driver.
    """
    parts, pairs = [], []
    for i, c in enumerate(levels):
        parts.append(_totals(cells, c, q).select(F.lit(i).alias("f"), "level", (F.col("d") + ridge).alias("d"), "t", F.array(*[F.col(f"s{k}") for k in range(q)]).cast("array<double>").alias("s")))
        for j, c2 in enumerate(levels):
            if i != j:
                pairs.append(cells.groupBy(F.lit(i).alias("f"), F.col(c).alias("level"), F.lit(j).alias("f2"), F.col(c2).alias("level2")).agg(F.sum("d").alias("k")))
    table = reduce(DataFrame.unionByName, parts)
    state = materialise(table.withColumns({"x": F.lit(0.0), "r": F.col("t"), "p": F.col("t") / F.col("d")}))
    counts = None
    try:
        if pairs:
            counts = reduce(DataFrame.unionByName, pairs).repartition("f2", "level2").persist(StorageLevel.MEMORY_AND_DISK)
        e = read_matrix(dense, "e", q) + ridge * np.eye(q)
        rb = read_vector(dense, "r", q)
        # the dense columns are preconditioned by their own block, levels by their diagonal
        xb, pb = np.zeros(q), np.linalg.solve(e, rb) if q else np.zeros(0)
        size = state.agg(F.sum(F.col("r") * F.col("r") / F.col("d"))).first()[0] + float(rb @ pb)
        start, it = size, 0
        while size > tol**2 * start and it < max_iter:
            it += 1
            moved, across = state, F.lit(0.0)
            if counts is not None:
                other = state.select(F.col("f").alias("f2"), F.col("level").alias("level2"), F.col("p").alias("p2"))
                met = counts.join(other, ["f2", "level2"]).groupBy("f", "level").agg(F.sum(F.col("k") * F.col("p2")).alias("a"))
                moved, across = state.join(met, ["f", "level"], "left"), F.coalesce("a", F.lit(0.0))
            a = F.col("d") * F.col("p") + across + dot([F.get("s", i) for i in range(q)], pb)
            moved = materialise(moved.select("f", "level", "d", "t", "s", "x", "r", "p", a.alias("a")))
            got = moved.agg(F.sum(F.col("p") * F.col("a")).alias("pa"), *[F.sum(F.get("s", i) * F.col("p")).alias(f"b{i}") for i in range(q)]).first().asDict()
            ab = e @ pb + np.array([got[f"b{i}"] for i in range(q)])
            alpha = size / (got["pa"] + float(pb @ ab))
            xb, rb = xb + alpha * pb, rb - alpha * ab
            state = moved.withColumns({"x": F.col("x") + F.lit(alpha) * F.col("p"), "r": F.col("r") - F.lit(alpha) * F.col("a")}).drop("a")
            zb = np.linalg.solve(e, rb) if q else np.zeros(0)
            new = state.agg(F.sum(F.col("r") * F.col("r") / F.col("d"))).first()[0] + float(rb @ zb)
            state = state.withColumn("p", F.col("r") / F.col("d") + F.lit(new / size) * F.col("p"))
            pb, size = zb + new / size * pb, new
        if size > tol**2 * start:
            raise RuntimeError(f"no convergence after {max_iter} steps; the residual is {np.sqrt(size / start):.2g} of the first one")
        return xb, state, it
    finally:
        if counts is not None:
            counts.unpersist()
