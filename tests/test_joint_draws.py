"""Area standard errors of mixed models against dense references, where effects and coefficients depend on each other."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from arealis.operators import mixed as mx
from arealis.operators import mrp


def test_gaussian_areas_with_few_units(spark):
    rng = np.random.default_rng(4)
    groups = 12
    sizes = rng.integers(1, 4, groups)
    g = np.repeat(np.arange(groups), sizes)
    x = 3 + rng.normal(size=len(g)) + 0.8 * g / groups
    y = 1 + 0.5 * x + rng.normal(size=groups)[g] + 0.7 * rng.normal(size=len(g))
    df = spark.createDataFrame(pd.DataFrame({"g": [f"a{v:02d}" for v in g], "x": x, "y": y}))
    xs = {"one": F.lit(1.0), "x": F.col("x")}
    fit, effects = mx.random_intercept_model(df, "y", xs, "g")
    cells = pd.DataFrame({"g": [f"a{v:02d}" for v in range(groups + 1) for _ in range(2)], "x": np.tile([2.0, 4.5], groups + 1), "n": np.tile([3, 5], groups + 1)})
    cells["cell_id"] = [f"c{i}" for i in range(len(cells))]
    s2u, s2 = float(fit.sigma2_u[0, 0]), fit.sigma2_e
    # coefficients, then all group effects, one of them unseen
    A = np.column_stack([np.ones(len(x)), x, (g[:, None] == np.arange(groups + 1)).astype(float)])
    prior = np.diag([0.0, 0.0, *[1 / s2u] * (groups + 1)])
    joint = np.linalg.inv(A.T @ A / s2 + prior)
    mean = joint @ A.T @ y / s2
    own = cells["g"].str[1:].astype(int).to_numpy()
    C = np.column_stack([np.ones(len(cells)), cells["x"], (own[:, None] == np.arange(groups + 1)).astype(float)])
    table = spark.createDataFrame(cells)
    got = mx.predict_epred(table, fit, effects, xs, "g").toPandas().set_index("cell_id").loc[cells["cell_id"]]
    assert np.allclose(got["epred"], C @ mean, atol=1e-6) and np.allclose(got["epred_sd"], np.sqrt(np.einsum("ci,ij,cj->c", C, joint, C)), rtol=1e-6)
    draws = mx.predict_epred_draws(table, fit, effects, xs, "g", "cell_id", 4000, seed=2, keep=["n"])
    area = mrp.mrp_estimate(draws, ["g"]).toPandas().set_index("g").sort_index()
    W = np.array([[3 / 8 if j == 2 * a else 5 / 8 if j == 2 * a + 1 else 0 for j in range(len(cells))] for a in range(groups + 1)])
    exact = np.sqrt(np.einsum("ai,ij,aj->a", W @ C, joint, W @ C))
    assert np.abs(area["mrp_estimate_se"].to_numpy() / exact - 1).max() < 0.06
    overall = mrp.mrp_estimate(draws, None).first()["mrp_estimate_se"]
    total = cells["n"].to_numpy() / cells["n"].sum() @ C
    assert abs(overall / np.sqrt(total @ joint @ total) - 1) < 0.06


def test_nested_logistic_areas(spark):
    rng = np.random.default_rng(6)
    rows = []
    for up in range(6):
        v = rng.normal() * 0.6
        for g in range(5):
            u = rng.normal() * 0.5
            for x in (0.0, 1.0):
                n = int(rng.integers(15, 40))
                rows.append((f"u{up}", f"u{up}g{g}", x, n, int(rng.binomial(n, 1 / (1 + np.exp(-(-0.3 + 0.7 * x + u + v)))))))
    pdf = pd.DataFrame(rows, columns=["up", "g", "x", "n", "y"]).assign(m="only")
    df = spark.createDataFrame(pdf)
    xs = {"one": F.lit(1.0), "x": F.col("x")}
    fits, effects, uppers = mx.binomial_mixed_models(df, "m", "y", "n", xs, "g", "up")
    fit = fits["only"]
    got = mx.linear_predictor(df, fit, effects, xs, "g", "up", uppers).toPandas().sort_values(["g", "x"])
    pdf = pdf.sort_values(["g", "x"])
    ups, gs = sorted(pdf["up"].unique()), sorted(pdf["g"].unique())
    A = np.column_stack([np.ones(len(pdf)), pdf["x"], *[pdf["up"] == k for k in ups], *[pdf["g"] == k for k in gs]]).astype(float)
    prior = np.diag([1e-4, 1e-4, *[1 / fit.sigma2_upper] * len(ups), *[1 / float(fit.sigma2_u[0, 0])] * len(gs)])
    beta = np.zeros(A.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-A @ beta))
        H = (A.T * (pdf["n"] * p * (1 - p)).to_numpy()) @ A + prior
        beta = beta + np.linalg.solve(H, A.T @ (pdf["y"] - pdf["n"] * p) - prior @ beta)
    sd = np.sqrt(np.einsum("ci,ij,cj->c", A, np.linalg.inv(H), A))
    assert np.abs(got["lp_mean"].to_numpy() - A @ beta).max() < 0.06
    assert np.abs(np.sqrt(got["lp_var"].to_numpy()) / sd - 1).max() < 0.08
    wide = mx.epred_draw_columns(df.withColumn("c", F.concat_ws(":", "g", "x")), fits, effects, uppers, xs, "m", "g", "up", "c", 2000, seed=1).toPandas()
    spread = np.log(wide["only"] / (1 - wide["only"])).groupby([wide["g"], wide["c"]]).std().to_numpy()
    assert np.abs(spread / np.sqrt(got["lp_var"].to_numpy()) - 1).max() < 0.12


def test_variances_are_integrated(spark):
    """Ten areas: moments and draws equal a brute-force integral over both variances, and are wider than with them fixed."""
    rng = np.random.default_rng(11)
    groups = 10
    g = np.repeat(np.arange(groups), 4)
    x = rng.normal(size=len(g)) + 0.3 * g
    y = 0.5 + 0.4 * x + 0.7 * rng.normal(size=groups)[g] + rng.normal(size=len(g))
    df = spark.createDataFrame(pd.DataFrame({"g": [f"a{v:02d}" for v in g], "x": x, "y": y}))
    xs = {"one": F.lit(1.0), "x": F.col("x")}
    fit, effects = mx.random_intercept_posterior(df, "y", xs, "g")
    X, Z, n = np.column_stack([np.ones(len(x)), x]), (g[:, None] == np.arange(groups)).astype(float), len(g)
    A = np.column_stack([X, Z])
    total, mean, second, rows = 0.0, 0.0, 0.0, []
    for lam in np.exp(np.linspace(np.log(1e-6), np.log(1e3), 150)):
        V = np.eye(n) + lam * Z @ Z.T
        Vi = np.linalg.inv(V)
        S = X.T @ Vi @ X
        b = np.linalg.solve(S, X.T @ Vi @ y)
        rss = (y - X @ b) @ Vi @ (y - X @ b)
        C = np.linalg.inv(A.T @ A + np.diag([0, 0, *[1 / lam] * groups]))
        m = C @ A.T @ y
        for s2 in np.exp(np.linspace(np.log(0.1), np.log(20), 120)):
            logp = -0.5 * (n - 2) * np.log(s2) - 0.5 * np.linalg.slogdet(V)[1] - 0.5 * np.linalg.slogdet(S)[1] - rss / (2 * s2) - np.log1p(lam) + 0.5 * np.log(lam)
            rows.append((logp, m, s2 * C, s2, lam * s2))
    w = np.exp(np.array([r[0] for r in rows]) - max(r[0] for r in rows))
    w /= w.sum()
    mean = sum(a * r[1] for a, r in zip(w, rows))
    second = sum(a * (r[2] + np.outer(r[1], r[1])) for a, r in zip(w, rows))
    cov = second - np.outer(mean, mean)
    got_mean, got_cov = fit.moments()
    assert np.allclose(got_mean, mean[:2], atol=2e-4) and np.allclose(np.sqrt(np.diag(got_cov)), np.sqrt(np.diag(cov))[:2], rtol=2e-3)
    e = effects.toPandas().sort_values("group")
    assert np.allclose(e["u"], mean[2:], atol=5e-4) and np.allclose(np.sqrt(e["u_var"]), np.sqrt(np.diag(cov))[2:], rtol=2e-3)
    table = {r["variable"]: r["mean"] for r in fit.table(spark).collect()}
    assert np.isclose(table["sigma2_e"], w @ [r[3] for r in rows], rtol=2e-3) and np.isclose(table["sigma2_u"], w @ [r[4] for r in rows], rtol=2e-2)
    fixed, _ = mx.random_intercept_model(df, "y", xs, "g")
    assert got_cov[0, 0] > 1.05 * fixed.cov[0, 0]
    cells = spark.createDataFrame([(f"c{v}", f"a{v:02d}", 2.0) for v in range(groups)], "cell_id string, g string, x double")
    d = mx.posterior_epred_draws(cells, fit, effects, xs, "g", "cell_id", 4000).groupBy("g").agg(F.avg("value").alias("m"), F.stddev("value").alias("s")).toPandas().sort_values("g")
    C = np.column_stack([np.ones(groups), np.full(groups, 2.0), np.eye(groups)])
    sd = np.sqrt(np.einsum("ci,ij,cj->c", C, cov, C))
    assert np.abs((d["m"] - C @ mean) / sd).max() < 0.1 and np.abs(d["s"] / sd - 1).max() < 0.06


def test_area_draws_follow_the_posterior(spark):
    """Draws of area parameters have the moments of the exact posterior and feed the predictive check."""
    from arealis.operators import area as ar
    from arealis.operators import draws as dr

    rng = np.random.default_rng(7)
    n = 40
    pdf = pd.DataFrame({"segm": [f"s{i:02d}" for i in range(n)], "x": rng.normal(size=n), "psi": rng.uniform(0.01, 0.05, n)})
    pdf["y"] = 0.4 + 0.1 * pdf["x"] + 0.15 * rng.normal(size=n)
    pdf.loc[::8, ["y", "psi"]] = np.nan
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    xs = [F.lit(1.0), F.col("x")]
    fit = ar.fh_gaussian_fit(df, "y", "psi", xs)
    want = ar.fh_gaussian_predict(df, fit, "y", "psi", xs).toPandas().sort_values("segm")
    draws = dr.area_draws(df, fit, "y", "psi", xs, "segm", 3000)
    assert draws.columns == ["chain", "iteration", "draw", "segm", "value"] and draws.count() == 3000 * n
    got = draws.groupBy("segm").agg(F.avg("value").alias("m"), F.stddev("value").alias("s")).toPandas().sort_values("segm")
    assert (np.abs(got["m"].to_numpy() - want["theta"].to_numpy()) / want["theta_sd"].to_numpy()).max() < 0.1
    assert np.abs(got["s"].to_numpy() / want["theta_sd"].to_numpy() - 1).max() < 0.08
    one = draws.groupBy("draw").agg(F.avg("value").alias("v")).agg(F.stddev("v")).first()[0]
    assert one > 1.1 * np.sqrt((want["theta_sd"] ** 2).sum()) / n  # areas share coefficients, so their mean varies more than if drawn apart
