"""Least squares from aggregates: Spark sums cross-products, the driver solves a p x p system of any width that fits it."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.recode import as_column

NARROW = 64  # columns up to which sums and forms are SQL expressions; wider designs are summed as matrices in tasks


def cross_sums(xs: Sequence[Column], prefix: str, weight: Column | None = None) -> list[Column]:
    """Sum columns of the upper triangle of X'WX, named ``<prefix>_<i>_<j>``."""
    out = []
    for i, a in enumerate(xs):
        for j in range(i, len(xs)):
            term = a * xs[j] if weight is None else weight * a * xs[j]
            out.append(F.sum(term).alias(f"{prefix}_{i}_{j}"))
    return out


def vector_sums(xs: Sequence[Column], y: Column, prefix: str, weight: Column | None = None) -> list[Column]:
    return [F.sum(a * y if weight is None else weight * a * y).alias(f"{prefix}_{i}") for i, a in enumerate(xs)]


def read_matrix(row: Mapping, prefix: str, p: int) -> np.ndarray:
    m = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            m[i, j] = m[j, i] = row[f"{prefix}_{i}_{j}"] or 0.0
    return m


def read_vector(row: Mapping, prefix: str, p: int) -> np.ndarray:
    return np.array([row[f"{prefix}_{i}"] or 0.0 for i in range(p)])


def dot(xs: Sequence[Column], beta: Sequence[float]) -> Column:
    """Linear predictor with literal coefficients."""
    if len(xs) > NARROW:
        pairs = F.zip_with(F.array(*xs), F.array(*[F.lit(float(b)) for b in beta]), lambda x, b: x * b)
        return F.aggregate(pairs, F.lit(0.0), lambda a, v: a + v)
    out = F.lit(0.0)
    for x, b in zip(xs, beta):
        out = out + x * F.lit(float(b))
    return out


def quadratic_form(xs: Sequence[Column], m: np.ndarray) -> Column:
    out = F.lit(0.0)
    for i, a in enumerate(xs):
        for j in range(i, len(xs)):
            out = out + F.lit(float(m[i, j] * (1 if i == j else 2))) * a * xs[j]
    return out


def task_sums(df: DataFrame, sums: Callable[[pd.DataFrame], np.ndarray]) -> np.ndarray:
    """Sum what ``sums`` makes of each batch of rows, a vector of fixed length: one vector per task, then element-wise."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            if len(pdf):
                part = sums(pdf)
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"v": [total]})

    rows = sum_vectors(df.mapInPandas(run, "v array<double>"), []).collect()
    out = np.zeros(len(rows))
    for r in rows:
        out[r["pos"]] = r["s"]
    return out


def moment_sums(df: DataFrame, xs: Sequence[Column], squares: Mapping[str, Column | None], products: Mapping[str, Column], scalars: Mapping[str, Column]) -> dict:
    """Sums of ``weight * x x'``, ``x * value`` and single values over all rows, as matrices, vectors and numbers.

    Rows with a missing value are left out of the sums that need it.  Up to ``NARROW`` columns the sums are one SQL
    aggregate; beyond, tasks sum matrices and send one vector each.
    """
    p = len(xs)
    if p <= NARROW:
        aggs = [c for k, w in squares.items() for c in cross_sums(xs, k, w)]
        aggs += [F.sum(x * v).alias(f"{k}_{i}") for k, v in products.items() for i, x in enumerate(xs)]
        row = df.agg(*aggs, *[F.sum(v).alias(k) for k, v in scalars.items()]).first().asDict()
        out = {k: read_matrix(row, k, p) for k in squares} | {k: read_vector(row, k, p) for k in products}
        return out | {k: row[k] for k in scalars}
    names = [f"x{i}" for i in range(p)]
    weights = {k: F.lit(1.0) if w is None else w for k, w in squares.items()}
    extra = {f"{kind}{k}": c.cast("double") for kind, part in (("w", weights), ("v", products), ("s", scalars)) for k, c in part.items()}
    wide = df.select(*[x.cast("double").alias(n) for n, x in zip(names, xs)], *[c.alias(k) for k, c in extra.items()])

    pieces = (list(squares), list(products), list(scalars))

    def sums(pdf: pd.DataFrame) -> np.ndarray:
        X = pdf[names].to_numpy(float)
        whole = ~np.isnan(X).any(axis=1)
        X = np.where(whole[:, None], X, 0.0)
        parts = [(X * np.where(whole, np.nan_to_num(pdf[f"w{k}"].to_numpy(float)), 0.0)[:, None]).T @ X for k in pieces[0]]
        parts += [X.T @ np.nan_to_num(pdf[f"v{k}"].to_numpy(float)) for k in pieces[1]]
        parts += [np.array([np.nansum(pdf[f"s{k}"].to_numpy(float))]) for k in pieces[2]]
        return np.concatenate([m.ravel() for m in parts])

    flat = task_sums(wide, sums)
    if not len(flat):
        flat = np.zeros(len(squares) * p * p + len(products) * p + len(scalars))
    out, at = {}, 0
    for kinds, shape in ((squares, (p, p)), (products, (p,)), (scalars, ())):
        for k in kinds:
            size = int(np.prod(shape))
            out[k] = flat[at : at + size].reshape(shape) if shape else float(flat[at])
            at += size
    return out


def with_forms(df: DataFrame, xs: Sequence[Column], beta: np.ndarray, m: np.ndarray, linear: str, square: str) -> DataFrame:
    """Add the linear predictor ``x'beta`` and the form ``x'Mx`` of every row."""
    if len(xs) <= NARROW:
        return df.withColumns({linear: dot(xs, beta), square: quadratic_form(xs, m)})
    x = F.array(*[c.cast("double") for c in xs])

    @F.pandas_udf("double")
    def form(rows: pd.Series) -> pd.Series:
        X = np.array([[np.nan if v is None else v for v in r] for r in rows], float).reshape(len(rows), len(beta))
        return pd.Series(np.einsum("ri,ij,rj->r", X, m, X, optimize=True))

    value = form(x)
    return df.withColumns({linear: dot(xs, beta), square: F.when(~F.isnan(value), value)})


def double_columns(xs: Sequence[str | Column]) -> list[Column]:
    return [as_column(x).cast("double") for x in xs]


def least_squares(df: DataFrame, y: str | Column, xs: Sequence[str | Column], refinements: int = 1) -> dict:
    """Ordinary least squares.

    Columns are scaled to unit length before solving and the solution is refined on the aggregated
    residual, so strongly related columns keep their accuracy.
    """
    cols, yc, p = double_columns(xs), as_column(y).cast("double"), len(xs)
    row = moment_sums(df, cols, {"xx": None}, {"xy": yc}, {"yy": yc * yc, "n": F.when(yc.isNotNull(), 1)})
    row["n"] = int(row["n"] or 0)
    xtx, xty = row["xx"], row["xy"]
    scale = 1 / np.sqrt(np.where(np.diag(xtx) > 0, np.diag(xtx), 1.0))
    g = xtx * np.outer(scale, scale)
    beta = scale * np.linalg.lstsq(g, xty * scale, rcond=1e-14)[0]
    rss = None
    for _ in range(refinements):
        resid = yc - dot(cols, beta)
        r = moment_sums(df, cols, {}, {"xr": resid}, {"rss": resid * resid})
        step = scale * np.linalg.lstsq(g, r["xr"] * scale, rcond=1e-14)[0]
        beta, rss = beta + step, max(r["rss"] - float(step @ r["xr"]), 0.0)
    if rss is None:
        rss = max(row["yy"] - float(beta @ xty), 0.0)
    inv = np.linalg.pinv(g, rcond=1e-14) * np.outer(scale, scale)
    n = row["n"]
    s2 = rss / (n - p) if n > p else float("nan")
    return {"beta": beta, "xtx": xtx, "xty": xty, "yty": row["yy"], "n": n, "rss": rss, "s2": s2, "inv": inv, "cov": s2 * inv}


def sum_vectors(df: DataFrame, keys: Sequence[str], vector: str = "v") -> DataFrame:
    """Element-wise sum of an array column per group: rows (keys, pos, s).

    For partial sums that tasks have already reduced.  Hundreds of sum columns in one aggregate would cost
    seconds of code generation per job; one keyed sum does not.
    """
    return df.select(*keys, F.posexplode(vector).alias("pos", "__e")).groupBy(*keys, "pos").agg(F.sum("__e").alias("s"))
