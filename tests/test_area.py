import numpy as np
import pytest
from pyspark.sql import functions as F

from arealis.functions.quadrature import beta_logit, integrate_groups, multinomial
from arealis.operators import area as ar
from arealis.operators import area_logit as al
from arealis.operators import gvf


@pytest.fixture(scope="module")
def fh60(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=60)
    psi = rng.uniform(0.1, 0.5, 60)
    y = 1 + 0.5 * x + rng.normal(size=60) * 0.6 + rng.normal(size=60) * np.sqrt(psi)
    rows = [(i, float(x[i]), float(y[i]) if i < 55 else None, float(psi[i])) for i in range(60)]
    return spark.createDataFrame(rows, "id int, x double, y double, psi double").repartition(5), x, y, psi


def terms():
    return [F.lit(1.0), F.col("x")]


def reml(s2, x, y, psi):
    X, w = np.c_[np.ones(len(x)), x], 1 / (s2 + psi)
    A = X.T @ (w[:, None] * X)
    b = np.linalg.solve(A, X.T @ (w * y))
    return 0.5 * np.log(w).sum() - 0.5 * np.linalg.slogdet(A)[1] - 0.5 * (w * (y - X @ b) ** 2).sum(), b, np.linalg.inv(A)


def test_reml_variance_is_the_maximum(fh60):
    df, x, y, psi = fh60
    fit = ar.fh_eblup(df, "y", "psi", terms())
    x, y, psi = x[:55], y[:55], psi[:55]
    best = reml(fit.sigma2, x, y, psi)
    for s in (0.99, 0.999, 1.001, 1.01):
        assert reml(fit.sigma2 * s, x, y, psi)[0] < best[0]
    assert fit.beta == pytest.approx(best[1])
    assert fit.var_sigma2 == pytest.approx(2 / (1 / (fit.sigma2 + psi) ** 2).sum())


def test_eblup_shrinks_and_predicts(fh60):
    df, x, y, psi = fh60
    fit = ar.fh_eblup(df, "y", "psi", terms())
    got = ar.eblup_table(df, fit, "y", "psi", terms()).orderBy("id").toPandas()
    xb = np.c_[np.ones(60), x] @ fit.beta
    g = fit.sigma2 / (fit.sigma2 + psi)
    assert got.theta[:55].to_numpy() == pytest.approx((g * y + (1 - g) * xb)[:55])
    assert got.theta[55:].to_numpy() == pytest.approx(xb[55:])
    assert (np.abs(got.theta - xb) <= np.abs(got.y.fillna(got.theta) - xb) + 1e-12).all()
    q = np.einsum("ij,jk,ik->i", np.c_[np.ones(60), x], fit.cov, np.c_[np.ones(60), x])
    g3 = psi**2 / (fit.sigma2 + psi) ** 3 * fit.var_sigma2
    assert got.mse[:55].to_numpy() == pytest.approx((g * psi + (1 - g) ** 2 * q + 2 * g3)[:55])
    assert got.mse[55:].to_numpy() == pytest.approx((fit.sigma2 + q)[55:])


def test_zero_variance_is_allowed(spark):
    rows = [(float(i % 3), float(i % 3) * 0.5, 1.0) for i in range(30)]
    df = spark.createDataFrame(rows, "x double, y double, psi double")
    assert ar.fh_eblup(df, "y", "psi", terms()).sigma2 == 0.0


@pytest.mark.parametrize("prior", ["inverse_gamma", "flat_sd"])
def test_bayes_normal_against_plain_quadrature(fh60, prior):
    df, x, y, psi = fh60
    fit, pred = ar.fh_normal(df, "y", "psi", terms(), prior=prior)
    X = np.c_[np.ones(60), x]
    o = slice(0, 55)
    grid = np.exp(np.linspace(np.log(1e-5), np.log(60), 3000))
    logs, m, v = [], [], []
    for s2 in grid:
        w = 1 / (s2 + psi[o])
        A = X[o].T @ (w[:, None] * X[o]) + np.eye(2) / 1e4
        b = np.linalg.solve(A, X[o].T @ (w * y[o]))
        logs.append(0.5 * np.log(w).sum() - 0.5 * ((w * y[o] ** 2).sum() - b @ (X[o].T @ (w * y[o]))) - 0.5 * np.linalg.slogdet(A)[1] + ar.log_prior(s2, prior) + np.log(s2))
        g = np.where(np.arange(60) < 55, s2 / (s2 + psi), 0)
        q = np.einsum("ij,jk,ik->i", X, np.linalg.inv(A), X)
        m.append(g * np.nan_to_num(y) + (1 - g) * (X @ b))
        v.append(np.where(np.arange(60) < 55, g * psi, s2) + (1 - g) ** 2 * q)
    wt = np.exp(np.array(logs) - max(logs))
    wt /= wt.sum()
    mean = wt @ np.array(m)
    sd = np.sqrt(wt @ (np.array(v) + np.array(m) ** 2) - mean**2)
    got = pred.orderBy("id").toPandas()
    assert got.theta.to_numpy() == pytest.approx(mean, abs=2e-3)
    assert got.theta_sd.to_numpy() == pytest.approx(sd, abs=4e-3)


def test_flat_prior_needs_enough_areas(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0.1), (2.0, 1.5, 0.1), (0.5, 1.2, 0.1)], "x double, y double, psi double")
    with pytest.raises(ValueError, match="p \\+ 2"):
        ar.fh_normal(df, "y", "psi", terms(), prior="flat_sd")


def test_arcsine_back_transform_matches_simulation(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(float(i), p, 20.0) for i, p in enumerate([0.1, 0.2, 0.3, 0.4, 0.15, 0.25])], "x double, p double, n double")
    fit, pred = ar.fh_arcsine(df, "p", "n", [F.lit(1.0)], grid=np.array([0.01]))
    got = pred.orderBy("x").toPandas()
    z, v = np.arcsin(np.sqrt(got.p.to_numpy())), 1 / 80
    g = 0.01 / (0.01 + v)
    m, s2 = g * z + (1 - g) * fit.beta[0, 0], g * v + (1 - g) ** 2 * fit.cov[0, 0, 0]
    sim = np.sin(rng.normal(m, np.sqrt(s2), size=(400_000, 6))) ** 2
    assert got.theta.to_numpy() == pytest.approx(sim.mean(0), abs=5e-4)
    assert got.theta_sd.to_numpy() == pytest.approx(sim.std(0), abs=5e-4)


def test_group_integral_against_dense_grid():
    u = np.linspace(-8, 8, 40001)
    h = u[1] - u[0]
    prior = np.exp(-(u**2) / (2 * 0.7)) / np.sqrt(2 * np.pi * 0.7)
    base, y, n = np.array([[-0.4], [0.8]]), np.array([[2.0], [3.0]]), np.array([7.0, 4.0])
    r = integrate_groups(multinomial, base, (y, n), np.ones((2, 1)), np.array([0]), np.array([[[1 / 0.7]]]), 15, means=True)
    lik = prior * np.exp(sum(y[c, 0] * (base[c, 0] + u) - n[c] * np.log1p(np.exp(base[c, 0] + u)) for c in range(2)))
    Z = lik.sum() * h
    assert r["ll"][0] == pytest.approx(np.log(Z), abs=1e-8)
    assert r["u"][0, 0] == pytest.approx((u * lik).sum() * h / Z, abs=1e-7)
    th = 1 / (1 + np.exp(-(base[0, 0] + u)))
    assert r["m1"][0, 0] == pytest.approx((th * lik).sum() * h / Z, abs=1e-7)
    eps = 1e-5
    up, down = (integrate_groups(multinomial, base + e, (y, n), None, np.array([0]), np.array([[[1 / 0.7]]]), 15)["ll"][0] for e in (eps, -eps))
    assert r["grad"][0, 0] == pytest.approx((up - down) / (2 * eps), abs=1e-5)
    assert r["hess"][0, 0, 0] == pytest.approx(-(up - 2 * r["ll"][0] + down) / eps**2, rel=1e-3)


def test_beta_family_derivatives():
    eta, data, e = np.array([[0.3], [-1.2]]), (np.array([0.4, 0.1]), np.array([12.0, 0.0])), 1e-5
    ll, s, info = beta_logit(eta, data)
    up, down = beta_logit(eta + e, data)[0], beta_logit(eta - e, data)[0]
    assert s[:, 0] == pytest.approx((up - down) / (2 * e), abs=1e-5)
    assert info[:, 0, 0] == pytest.approx(-(up - 2 * ll + down) / e**2, abs=1e-3)
    assert ll[1] == 0 and s[1, 0] == 0


def test_gamma_terms_equal_the_single_functions():
    from arealis.functions.numeric import digamma, gamma_terms, lgamma, trigamma

    x = np.r_[1e-8, 1e-3, np.linspace(0.01, 60, 500), 1e6]
    for got, f in zip(gamma_terms(x), (lgamma, digamma, trigamma)):
        assert got == pytest.approx(f(x), rel=1e-10, abs=1e-10)


@pytest.mark.parametrize("name", ["binomial", "beta", "two categories"])
def test_group_integral_evaluates_each_node_once(name):
    from arealis.functions import quadrature as qd

    rng = np.random.default_rng(4)
    m, d, nodes = (1, 1, 15) if name == "beta" else (4, 2 if name == "two categories" else 1, 5)
    C, starts = 30 * m, np.arange(30) * m
    X = np.column_stack([np.ones(C), rng.normal(size=C)])
    data = (rng.uniform(0.1, 0.9, C), np.full(C, 20.0)) if name == "beta" else (rng.integers(0, 3, (C, d)).astype(float), np.full(C, 6.0))
    calls = []

    def family(eta, data):
        calls.append(len(eta))
        return (qd.beta_logit if name == "beta" else qd.multinomial)(eta, data)

    B, prec = rng.normal(0, 0.3, (d, 2)), np.broadcast_to(np.eye(d) * 2.0, (30, d, d))
    r = qd.integrate_groups(family, X @ B.T, data, X, starts, prec, nodes)
    assert len(calls) <= nodes**d + 10
    # gradient and Hessian are the derivatives of the integral
    total = lambda b: qd.integrate_groups(family, X @ b.T, data, X, starts, prec, nodes)["ll"].sum()
    for i in range(d):
        for j in range(2):
            e = np.zeros((d, 2))
            e[i, j] = 1e-4
            up, mid, low = total(B + e), total(B), total(B - e)
            k = i * 2 + j
            assert r["grad"].sum(0)[k] == pytest.approx((up - low) / 2e-4, rel=2e-2, abs=2e-2)
            assert r["hess"].sum(0)[k, k] == pytest.approx(-(up - 2 * mid + low) / 1e-8, rel=3e-2)


@pytest.fixture(scope="module")
def proportions(spark):
    rng = np.random.default_rng(11)
    D = 120
    x = rng.normal(size=D)
    theta = 1 / (1 + np.exp(-(-0.8 + 0.6 * x + rng.normal(size=D) * 0.7)))
    n = rng.integers(5, 40, D)
    y = rng.binomial(n, theta)
    p = np.clip(rng.beta(theta * n, (1 - theta) * n), 1e-3, 1 - 1e-3)
    rows = [(i, float(x[i]), float(y[i]) if i < 110 else None, float(n[i]) if i < 110 else None, float(p[i]) if i < 110 else None) for i in range(D)]
    return spark.createDataFrame(rows, "id int, x double, y double, n double, p double"), x, theta, n, y, p


def test_binomial_model_recovers_simulated_areas(proportions):
    df, x, theta, n, y, _ = proportions
    fit, pred = al.fh_binomial(df, "y", "n", terms(), points=25)
    got = pred.orderBy("id").toPandas()
    raw = (y / n)[:110]
    assert np.abs(got.theta[:110] - theta[:110]).mean() < 0.85 * np.abs(raw - theta[:110]).mean()
    assert abs(fit.beta_mean[1] - 0.6) < 0.25 and 0.15 < fit.sigma2_mean < 1.2
    # without an effect, unobserved areas carry only the uncertainty of the coefficients
    wide = al.fh_logit_predict(df, fit, "y", "n", terms(), area_effect=True).orderBy("id").toPandas()
    assert (wide.theta_sd[110:] > got.theta_sd[110:]).all()
    assert list(got.observed) == [True] * 110 + [False] * 10


def test_beta_model_recovers_simulated_areas(proportions):
    df, x, theta, n, _, p = proportions
    fit, pred = al.fh_beta(df, "p", "n", terms(), points=25)
    got = pred.orderBy("id").toPandas()
    assert np.abs(got.theta[:110] - theta[:110]).mean() < np.abs(p - theta)[:110].mean()
    assert abs(fit.beta_mean[1] - 0.6) < 0.25


@pytest.mark.parametrize("kind", ["binomial", "beta"])
def test_points_start_from_one_fit(proportions, monkeypatch, kind):
    """Few evaluations beyond one per grid point; each point that matters is where it gets alone, and weights leave none out."""
    df = proportions[0].withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(16)))).coalesce(2).cache()
    y, n, prior, tau = ("y", "n", "half_cauchy", 1e4) if kind == "binomial" else ("p", "n", "inverse_gamma", 100.0)
    grid = np.exp(np.linspace(np.log(1e-3), np.log(20.0), 24))
    visits, sums = [], al._newton_sums
    monkeypatch.setattr(al, "_newton_sums", lambda fit, kind, beta, s2, nodes: visits.append(len(s2)) or sums(fit, kind, beta, s2, nodes))
    fit = al.fh_logit_fit(df, kind, y, n, terms(), prior, tau, grid=grid)
    assert sum(visits) < 3 * len(grid), visits
    seen = al._fit_table(df.where(f"{y} is not null"), y, n, terms()).cache()
    best = int(fit.weights.argmax())
    height = {}
    for g in {0, best - 2, best - 1, best, best + 1, best + 2}:
        s = grid[[g]]
        alone = al.fh_logit_fit(df, kind, y, n, terms(), prior, tau, grid=s)
        b = alone.beta[0]
        height[g] = sums(seen, kind, alone.beta, s, 15)[0][0] - 0.5 * b @ b / tau**2 + 0.5 * np.linalg.slogdet(alone.cov[0])[1] + al.log_prior(s, prior)[0] + np.log(s[0])
        if fit.weights[g] > 1e-12:
            assert np.allclose(fit.beta[g], b, atol=1e-6) and np.allclose(fit.cov[g], alone.cov[0], rtol=1e-4)
    for g, h in height.items():
        assert fit.weights[g] == pytest.approx(fit.weights[best] * np.exp(h - height[best]), rel=1e-4, abs=1e-12)


def test_missing_covariate_gives_missing_prediction(spark, proportions):
    df = proportions[0]
    fit, _ = al.fh_binomial(df, "y", "n", terms(), points=5)
    hole = spark.createDataFrame([(999, None, None, None, None)], df.schema)
    assert al.fh_logit_predict(hole, fit, "y", "n", terms()).first()["theta"] is None


@pytest.fixture(scope="module")
def direct(spark):
    rng = np.random.default_rng(3)
    n = rng.integers(15, 90, 150)
    p = rng.uniform(0.02, 0.5, 150)
    v = p * (1 - p) / n * np.exp(rng.normal(size=150) * 0.4)
    p[:4], v[:4] = 0.0, 0.0
    rows = [(i, float(p[i]), int(n[i]), float(v[i]), None if v[i] == 0 else 1.3) for i in range(150)]
    return spark.createDataFrame(rows, "id int, pobreza double, nd int, vardir double, deff_area double"), p, n, v


def test_gvf_equals_least_squares_and_keeps_the_sum(direct):
    df, p, n, v = direct
    fit = gvf.gvf_fit(df)
    k = v > 0
    X = np.column_stack([np.ones(150), p, n, n**2.0, p * n, np.sqrt(p), np.sqrt(n), np.sqrt(p * n)])
    b = np.linalg.lstsq(X[k], np.log(v[k]), rcond=None)[0]
    assert X @ fit.beta == pytest.approx(X @ b, abs=1e-6)
    out = gvf.gvf_predict(df, fit).orderBy("id").toPandas()
    assert out.hat_var[k].sum() == pytest.approx(v[k].sum())
    assert (out.hat_var[~k] > 0).all()


def test_gvf_design_effects(direct):
    df, p, n, v = direct
    out = gvf.gvf_deff(gvf.gvf_predict(df, gvf.gvf_fit(df))).orderBy("id").toPandas()
    assert (out.deff_FGV >= 1).all() and (out.deff_FGV[:4] == 1).all()
    want = np.maximum(out.hat_var[4:] / (v[4:] / 1.3), 1)
    assert out.deff_FGV[4:].to_numpy() == pytest.approx(want.to_numpy())
    assert out.n_eff_FGV.to_numpy() == pytest.approx((n / out.deff_FGV).to_numpy())


def test_gvf_leverages_sum_to_the_number_of_terms(direct):
    df = direct[0]
    d = gvf.gvf_diagnostics(df, gvf.gvf_fit(df)).toPandas()
    assert d.leverage.sum() == pytest.approx(8, abs=1e-3)
    assert abs(d.residual.mean()) < 1e-8


def test_more_columns_than_areas_warns(spark):
    import pytest
    from pyspark.sql import functions as F

    from arealis.operators import area as ar

    df = spark.createDataFrame([(float(i), 0.1 * i, 0.02) for i in range(3)], "x double, y double, psi double")
    with pytest.warns(UserWarning, match="only the prior"):
        ar.fh_gaussian_fit(df, "y", "psi", [F.lit(1.0), F.col("x"), F.col("x") ** 2], grid=[0.01, 0.1])
