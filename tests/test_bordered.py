import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from arealis.operators import area as ar
from arealis.operators import bordered as bd


def xs(*names):
    return {k: F.lit(1.0) if k == "one" else F.col(k) for k in names or ("one", "a", "b")}


@pytest.fixture(scope="module")
def people(spark):
    """Half of all rows in one of 2000 levels, many levels of one or two rows, some values missing."""
    rng = np.random.default_rng(3)
    n = 9000
    level = np.where(rng.random(n) < 0.5, 7, rng.integers(0, 2000, n))
    level[:2000] = np.arange(2000)
    a, b = rng.normal(size=n) + 0.01 * (level % 50), (rng.random(n) < 0.4).astype(float)
    effect = rng.normal(size=2000)
    y = 1.0 + 0.5 * a - 0.3 * b + effect[level] + 0.4 * rng.normal(size=n)
    hit = (rng.random(n) < 1 / (1 + np.exp(-(0.2 + 0.8 * a - 0.6 * b + effect[level])))).astype(float)
    pdf = pd.DataFrame({"level": [f"m{v:04d}" for v in level], "other": [f"k{v}" for v in rng.integers(0, 80, n)], "a": a, "b": b, "y": y, "hit": hit})
    gaps = spark.createDataFrame([(None, "k1", 1.0, 1.0, 1.0, 1.0), ("m0001", "k1", None, None, 1.0, 1.0), ("m0001", "k1", 1.0, 1.0, None, None)], "level string, other string, a double, b double, y double, hit double")
    return pdf, spark.createDataFrame(pdf).unionByName(gaps).repartition(5).cache()


def dense(pdf, reference, *factors):
    names = sorted(pdf["level"].unique())
    kept = [v for v in names if v != reference]
    X = np.column_stack([np.ones(len(pdf)), pdf["a"], pdf["b"], *[(pdf["level"] == v).astype(float) for v in kept]])
    return X, kept


def test_least_squares_equals_dense_solve(people):
    pdf, df = people
    fit = bd.linear_with_factor(df, "y", xs(), "level", reference="m0000")
    X, kept = dense(pdf, "m0000")
    want, inv = np.linalg.lstsq(X, pdf["y"], rcond=None)[0], np.linalg.inv(X.T @ X)
    rss = ((pdf["y"] - X @ want) ** 2).sum()
    s2 = rss / (len(pdf) - X.shape[1])
    assert X.shape[1] == 2002 and fit.n == len(pdf)
    assert np.allclose(fit.beta, want[:3], atol=1e-8) and np.isclose(fit.sigma2, s2, rtol=1e-8) and np.allclose(fit.cov, s2 * inv[:3, :3], rtol=1e-6)
    got = fit.effects.toPandas().set_index("level").loc[kept]
    assert np.allclose(got["effect"], want[3:], atol=1e-8) and np.allclose(got["effect_sd"], np.sqrt(s2 * np.diag(inv)[3:]), rtol=1e-6)


def test_ridge_and_weights_equal_dense_solve(people):
    pdf, df = people
    tau, s2 = 0.7, 0.3
    fit = bd.linear_with_factor(df, "y", xs(), "level", weight=1 + F.col("b"), tau=tau, sigma2=s2)
    X, kept = dense(pdf, None)
    A = (X.T * (1 + pdf["b"].to_numpy())) @ X / s2 + np.eye(X.shape[1]) / tau**2
    want, cov = np.linalg.solve(A, X.T @ ((1 + pdf["b"]) * pdf["y"]) / s2), np.linalg.inv(A)
    assert np.allclose(fit.beta, want[:3], atol=1e-8) and np.allclose(fit.cov, cov[:3, :3], rtol=1e-6)
    got = fit.effects.toPandas().set_index("level").loc[kept]
    assert np.allclose(got["effect"], want[3:], atol=1e-8) and np.allclose(got["effect_sd"], np.sqrt(np.diag(cov)[3:]), rtol=1e-6)


def test_logistic_equals_dense_newton(people):
    pdf, df = people
    pdf, df = pdf[pdf["level"] < "m0300"], df.where("level < 'm0300'")
    tau = 2.0
    fit = bd.binomial_with_factor(df, "hit", None, xs("one", "b"), "level", reference="m0000", tau=tau)
    X, kept = dense(pdf, "m0000")
    X = np.delete(X, 1, axis=1)
    beta = np.zeros(X.shape[1])
    for _ in range(12):
        p = 1 / (1 + np.exp(-X @ beta))
        H = (X.T * (p * (1 - p))) @ X + np.eye(len(beta)) / tau**2
        beta = beta + np.linalg.solve(H, X.T @ (pdf["hit"] - p) - beta / tau**2)
    assert np.allclose(fit.beta, beta[:2], atol=1e-6) and np.allclose(fit.cov, np.linalg.inv(H)[:2, :2], rtol=1e-4)
    got = fit.effects.toPandas().set_index("level").loc[kept]
    assert np.allclose(got["effect"], beta[2:], atol=1e-6) and np.allclose(got["effect_sd"], np.sqrt(np.diag(np.linalg.inv(H)))[2:], rtol=1e-4)
    eta = bd.predict_with_factor(df.dropna(), fit, xs("one", "b"), "level").agg(F.sum("eta")).first()[0]
    assert np.isclose(eta, (X @ beta).sum(), atol=1e-3)


def test_separated_levels_raise_or_converge(spark):
    rows = [(f"g{i}", float(i % 2)) for i in range(6) for _ in range(4)]
    df = spark.createDataFrame(rows, "g string, y double")
    fit = bd.binomial_with_factor(df, "y", None, {}, "g", tau=3.0)
    assert sorted(np.sign(r["effect"]) for r in fit.effects.collect()) == [-1] * 3 + [1] * 3
    with pytest.raises(RuntimeError):
        bd.binomial_with_factor(df, "y", None, {}, "g", max_iter=2)
    with pytest.raises(ValueError):
        bd.linear_with_factor(df.where("false"), "y", {"one": F.lit(1.0)}, "g", reference="g0")


def test_area_model_equals_dense_columns(spark):
    rng = np.random.default_rng(5)
    n = 240
    pdf = pd.DataFrame({"segm": range(n), "m": [f"m{v:02d}" for v in rng.integers(0, 30, n)], "x": rng.normal(size=n), "psi": rng.uniform(0.01, 0.05, n)})
    pdf["y"] = 0.4 + 0.1 * pdf["x"] + 0.2 * rng.normal(size=n)
    pdf.loc[::9, ["y", "psi"]] = np.nan
    pdf.loc[n - 1, ["m", "y", "psi"]] = ["only unobserved", np.nan, np.nan]
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    grid = np.exp(np.linspace(np.log(1e-3), np.log(1.0), 25))
    names = sorted(pdf["m"].unique())
    for reference, dense_x in ((None, {"x": F.col("x")}), ("m00", {"one": F.lit(1.0), "x": F.col("x")})):
        fit, pred = bd.fh_normal_with_factor(df, "y", "psi", dense_x, "m", reference=reference, grid=grid, tau=5.0)
        columns = [*dense_x.values(), *[(F.col("m") == v).cast("double") for v in names if v != reference]]
        full = ar.fh_gaussian_fit(df, "y", "psi", columns, grid=grid, tau=5.0)
        want = ar.fh_gaussian_predict(df, full, "y", "psi", columns).toPandas().sort_values("segm")
        got = pred.toPandas().sort_values("segm")
        assert np.allclose(fit.grid.weights, full.weights, atol=1e-8) and np.allclose(fit.grid.beta, full.beta[:, : len(dense_x)], atol=1e-8)
        assert np.allclose(got["theta"], want["theta"], atol=1e-8) and np.allclose(got["theta_sd"], want["theta_sd"], rtol=1e-6)
        assert (got["observed"].to_numpy() == want["observed"].to_numpy()).all()


def test_two_wide_factors_by_conjugate_gradients(people):
    pdf, df = people
    pdf, df = pdf[pdf["level"] < "m0300"], df.where("level < 'm0300'")
    tau = 3.0
    fit = bd.linear_with_factors(df, "y", xs("a", "b"), ["level", "other"], sigma2=0.2, tau=tau)
    columns = [("level", v) for v in sorted(pdf["level"].unique())] + [("other", v) for v in sorted(pdf["other"].unique())]
    X = np.column_stack([pdf["a"], pdf["b"], *[(pdf[f] == v).astype(float) for f, v in columns]])
    want = np.linalg.solve(X.T @ X / 0.2 + np.eye(X.shape[1]) / tau**2, X.T @ pdf["y"] / 0.2)
    got = {(r["factor"], r["level"]): r["effect"] for r in fit.effects.collect()}
    assert np.allclose(fit.beta, want[:2], atol=1e-7) and np.allclose([got[c] for c in columns], want[2:], atol=1e-6)
    assert fit.iterations < 60


@pytest.mark.parametrize("few", [256, 0])
@pytest.mark.parametrize("tau", [1e4, 2.0])
def test_factors_with_few_levels_need_no_steps(spark, monkeypatch, few, tau):
    """Three factors, two parts of the table that share no level, a dense column that the levels fix: equal to a dense solve."""
    monkeypatch.setattr(bd, "FEW_LEVELS", few)
    rng = np.random.default_rng(12)
    n = 1200
    part = rng.integers(0, 2, n)
    pdf = pd.DataFrame({"u": [f"u{2 * v + k}" for v, k in zip(rng.integers(0, 60, n), part)], "v": [f"v{2 * v + k}" for v, k in zip(rng.integers(0, 5, n), part)], "w": [f"w{2 * v + k}" for v, k in zip(rng.integers(0, 3, n), part)]})
    pdf["a"], pdf["half"] = 100 * rng.normal(size=n), part.astype(float)
    pdf["y"] = 10 + 0.02 * pdf["a"] + part + rng.normal(size=n)
    df = spark.createDataFrame(pdf).repartition(4)
    columns = [(f, v) for f in "uvw" for v in sorted(pdf[f].unique())]
    X = np.column_stack([pdf["a"], pdf["half"], *[(pdf[f] == v).astype(float) for f, v in columns]])
    # the ridge as rows of its own, so that the reference does not square it
    want = np.linalg.lstsq(np.vstack([X, np.eye(X.shape[1]) / tau]), np.concatenate([pdf["y"], np.zeros(X.shape[1])]), rcond=1e-13)[0]
    fit = bd.linear_with_factors(df, "y", xs("a", "half"), ["v", "u", "w"], tau=tau, tol=1e-12, max_iter=1 if few else 500)
    assert (fit.iterations == 0) == (few > 0) and fit.n == n
    got = {(r["factor"], r["level"]): r["effect"] for r in fit.effects.collect()}
    assert set(got) == set(columns)
    found = np.concatenate([fit.beta, [got[c] for c in columns]])
    assert np.allclose(X @ found, X @ want, atol=1e-6)
    if few or tau < 1e4:
        assert np.allclose(found, want, atol=1e-5)


def test_many_dense_columns(spark):
    """Beyond the width of SQL sums: least squares, logistic, multinomial and area models with 90 columns equal numpy."""
    from arealis.operators import glm

    rng = np.random.default_rng(8)
    n, k = 600, 90
    X = np.column_stack([np.ones(n), rng.normal(size=(n, k - 1))])
    beta = rng.normal(size=k) * 0.1
    pdf = pd.DataFrame(X, columns=[f"c{i}" for i in range(k)])
    pdf["y"] = X @ beta + 0.3 * rng.normal(size=n)
    pdf["hit"] = (rng.random(n) < 1 / (1 + np.exp(-X @ beta))).astype(float)
    pdf["a"], pdf["b"], pdf["c"] = rng.multinomial(3, [0.5, 0.3, 0.2], n).T.astype(float)
    pdf["psi"] = rng.uniform(0.05, 0.2, n)
    df = spark.createDataFrame(pdf).repartition(3)
    xs = {f"c{i}": F.col(f"c{i}") for i in range(k)}
    fit = glm.ols(df, "y", list(xs.values()), list(xs))
    want = np.linalg.lstsq(X, pdf["y"], rcond=None)[0]
    assert np.allclose(fit.mean, want, atol=1e-9)
    logit, tau = glm.logistic_model(df, "hit", xs, tau=2.0), 2.0
    p = 1 / (1 + np.exp(-X @ logit.mean))
    assert np.abs(X.T @ (pdf["hit"] - p) - logit.mean / tau**2).max() < 1e-6
    multi = glm.multinomial_model(df, ["a", "b", "c"], xs, tau=2.0)
    eta = X @ multi.mean.reshape(2, k).T
    pi = np.exp(eta) / (1 + np.exp(eta).sum(1, keepdims=True))
    score = np.concatenate([X.T @ (pdf[c] - 3 * pi[:, j]) for j, c in enumerate("bc")]) - multi.mean / 4
    assert np.abs(score).max() < 1e-6
    eblup = ar.fh_eblup(df, "y", "psi", list(xs.values()), sigma2=0.05)
    w = 1 / (0.05 + pdf["psi"].to_numpy())
    assert np.allclose(eblup.beta, np.linalg.solve((X.T * w) @ X, X.T @ (w * pdf["y"])), atol=1e-9)
    table = ar.eblup_table(df, eblup, "y", "psi", list(xs.values())).select("y", "synthetic", "g2").toPandas().sort_values("y")
    order = np.argsort(pdf["y"].to_numpy())
    assert np.allclose(table["synthetic"], (X @ eblup.beta)[order], atol=1e-9)
    full, pred = ar.fh_normal(df, "y", "psi", list(xs.values()), grid=np.array([0.02, 0.05, 0.1]))
    got = pred.select("y", "theta", "theta_sd").toPandas().sort_values("y")
    m = sum(wt * ((g := s / (s + pdf["psi"].to_numpy())) * pdf["y"].to_numpy() + (1 - g) * (X @ b)) for wt, s, b in zip(full.weights, full.sigma2, full.beta))
    assert np.allclose(got["theta"], m[order], atol=1e-9) and (got["theta_sd"] > 0).all()
