import numpy as np
import pytest
from pyspark.sql import functions as F

from arealis.operators import conjugate as cj
from arealis.operators import design as dm
from arealis.operators import glm
from arealis.operators import mixed as mx


def test_bernoulli_example(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 0, 0, 0, 0, 0, 0, 0, 1)], "y int")
    r = cj.beta_binomial_posterior(df, "y").first()
    assert (r["alpha"], r["beta"], r["mean"]) == (3.0, 9.0, 0.25)
    i = cj.beta_interval(cj.beta_binomial_posterior(df, "y")).first()
    assert (i["low"], i["high"]) == pytest.approx((0.06021773, 0.51775585), abs=1e-6)
    dens = cj.beta_density(cj.beta_binomial_posterior(df, "y"), [], 400).toPandas()
    assert (dens.theta * dens.density).sum() / 400 == pytest.approx(0.25, abs=1e-4)


def test_normal_posteriors(spark):
    rng = np.random.default_rng(0)
    y = rng.normal(5, 2, 80)
    df = spark.createDataFrame([(float(v),) for v in y], "y double")
    r = cj.normal_posterior_known_var(df, "y", mu=1.0, tau2=4.0, sigma2=4.0).first()
    assert r["mu_n"] == pytest.approx((20 * y.mean() + 0.25) / 20.25)
    u = cj.normal_posterior_unknown_var(df, "y").first()
    assert u["theta_mean"] == pytest.approx(y.mean(), abs=1e-3)
    assert u["sigma2_mean"] == pytest.approx(y.var(ddof=1) * 79 / 77, rel=0.02)
    compat = cj.normal_posterior_unknown_var(df, "y", stan_compat=True).first()
    assert compat["sigma2_mean"] < u["sigma2_mean"]


def test_dirichlet_and_gamma(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    got = {r["category"]: r["mean"] for r in cj.dirichlet_posterior(df, "k", {1: 1, 2: 1, 3: 1}, delta=[1, 2]).collect()}
    assert got == pytest.approx({"1": 0.5, "2": 2 / 6, "3": 1 / 6, "delta": 5 / 6})
    g = cj.gamma_poisson_posterior(df, "k").first()
    assert (g["shape"], g["rate"]) == (42.0, 12.0)


@pytest.fixture(scope="module")
def linear(spark):
    rng = np.random.default_rng(4)
    X = np.c_[np.ones(200), rng.normal(size=200), rng.normal(size=200) + 50]
    y = X @ np.array([1.0, 2.0, -0.3]) + rng.normal(size=200)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(y, X[:, 1], X[:, 2])], "y double, a double, b double")
    return df, X, y


def cols():
    return [F.lit(1.0), F.col("a"), F.col("b")]


def test_least_squares_and_wide_prior(linear):
    df, X, y = linear
    b = np.linalg.lstsq(X, y, rcond=None)[0]
    s2 = ((y - X @ b) ** 2).sum() / 197
    ols = glm.ols(df, "y", cols(), ["1", "a", "b"])
    assert ols.mean == pytest.approx(b) and ols.cov == pytest.approx(s2 * np.linalg.inv(X.T @ X))
    bayes = glm.linear_model(df, "y", cols(), ["1", "a", "b"])
    assert bayes.mean == pytest.approx(b, abs=1e-3)
    assert bayes.sigma2[0] == pytest.approx(s2 * 197 / 195, rel=0.01)


def test_normal_inverse_gamma_update(linear):
    df, X, y = linear
    B, b = np.diag([10.0, 5.0, 2.0]), np.array([0.5, 0.0, 0.1])
    r = glm.linear_model_conjugate(df, "y", cols(), b, B, 4.0, 2.0)
    Bq = np.linalg.inv(np.linalg.inv(B) + X.T @ X)
    bq = Bq @ (np.linalg.inv(B) @ b + X.T @ y)
    assert r["bq"] == pytest.approx(bq) and r["n1"] == 204
    assert r["n1s1"] == pytest.approx(8 + (y - X @ bq) @ y + (b - bq) @ np.linalg.inv(B) @ b)
    c = glm.linear_model_conditionals(df, "y", cols(), b, B, 4.0, 2.0, 1.5)
    Bc = np.linalg.inv(np.linalg.inv(B) + X.T @ X / 1.5)
    bc = Bc @ (np.linalg.inv(B) @ b + X.T @ y / 1.5)
    assert c["bq"] == pytest.approx(bc) and c["n1s1"] == pytest.approx(((y - X @ bc) ** 2).sum() + 8)


def newton(X, y, n):
    b = np.zeros(X.shape[1])
    for _ in range(50):
        mu = 1 / (1 + np.exp(-X @ b))
        b = b + np.linalg.solve(X.T @ ((n * mu * (1 - mu))[:, None] * X), X.T @ (y - n * mu))
    return b


def test_logistic_and_binomial_agree(spark):
    rng = np.random.default_rng(6)
    x = rng.integers(0, 4, 500).astype(float)
    y = rng.binomial(1, 1 / (1 + np.exp(-(-1 + 0.5 * x)))).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    xs = {"1": F.lit(1.0), "x": F.col("x")}
    a = glm.logistic_model(df, "y", xs)
    b = glm.binomial_model(df.groupBy("x").agg(F.sum("y").alias("y"), F.count("*").alias("n")), "y", "n", xs)
    assert a.mean == pytest.approx(newton(np.c_[np.ones(500), x], y, np.ones(500)), abs=1e-6)
    assert a.mean == pytest.approx(b.mean) and a.sd == pytest.approx(b.sd)


def test_multinomial_with_two_categories_is_logistic(spark):
    df = spark.createDataFrame([(0.0, 10, 5), (1.0, 8, 9), (2.0, 3, 12)], "x double, c1 int, c2 int")
    xs = {"1": F.lit(1.0), "x": F.col("x")}
    m = glm.multinomial_model(df, ["c1", "c2"], xs, tau=1e4)
    b = glm.binomial_model(df.withColumn("n", F.col("c1") + F.col("c2")), "c2", "n", xs)
    assert m.mean == pytest.approx(b.mean, abs=1e-6)
    p = glm.predict_probabilities(df, m, xs, 2).first()
    assert p["theta_1"] + p["theta_2"] == pytest.approx(1)


def test_design_levels_and_alignment(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "f string, v double")
    new = spark.createDataFrame([("a", 1.0), ("c", 2.0), ("d", 3.0)], "f string, v double")
    spec = dm.fit_design(train, [dm.Factor("f"), dm.Numeric("v")])
    assert spec.columns == ("(Intercept)", "fb", "fc", "v")
    assert [tuple(r) for r in spec.apply(new).collect()] == [(1.0, 0.0, 0.0, 1.0), (1.0, 0.0, 1.0, 2.0), (1.0, 0.0, 0.0, 3.0)]
    free = dm.fit_design(train, [dm.Factor("f"), dm.Factor("f")], intercept=False)
    assert free.columns == ("fa", "fb", "fc", "fb", "fc")
    own = dm.fit_design(new, [dm.Factor("f")], intercept=False)
    assert dm.missing_columns(["fa", "fb"], own.columns) == ["fb"]
    assert dm.align_columns(own.apply(new), ["fa", "fb"]).columns == ["fa", "fb"]
    with pytest.raises(ValueError, match="levels"):
        dm.fit_design(train, [dm.Factor("f")], max_levels=2)
    with pytest.warns(UserWarning):
        dm.warn_if_saturated(5, 5)


@pytest.fixture(scope="module")
def groups(spark):
    rng = np.random.default_rng(12)
    rows = []
    for g in range(40):
        u = rng.normal() * 0.8
        for _ in range(int(rng.integers(5, 50))):
            x = rng.normal()
            rows.append((f"g{g}", float(x), float(1 + 0.7 * x + u + rng.normal() * 1.1), float(rng.integers(1, 4))))
    return spark.createDataFrame(rows, "g string, x double, y double, w double").repartition(4), rows


def test_random_intercept_is_the_restricted_maximum(groups):
    df, rows = groups
    xs = {"1": F.lit(1.0), "x": F.col("x")}
    fit, eff = mx.random_intercept_model(df, "y", xs, "g")
    names = sorted({r[0] for r in rows})
    Z = np.array([[r[0] == n for n in names] for r in rows], float)
    X, y = np.array([[1, r[1]] for r in rows]), np.array([r[2] for r in rows])

    def ll(su, se):
        V = se * np.eye(len(y)) + su * Z @ Z.T
        Vi = np.linalg.inv(V)
        A = X.T @ Vi @ X
        b = np.linalg.solve(A, X.T @ Vi @ y)
        r = y - X @ b
        return -0.5 * (np.linalg.slogdet(V)[1] + np.linalg.slogdet(A)[1] + r @ Vi @ r), b, su * Z.T @ Vi @ r

    su, se = float(fit.sigma2_u[0, 0]), fit.sigma2_e
    best, b, u = ll(su, se)
    for a, c in ((1.02, 1), (0.98, 1), (1, 1.02), (1, 0.98)):
        assert ll(su * a, se * c)[0] < best
    assert fit.beta == pytest.approx(b, abs=1e-4)
    got = {r["group"]: r["u"] for r in eff.collect()}
    assert [got[n] for n in names] == pytest.approx(u, abs=1e-3)


def test_weights_count_like_repeated_rows(spark, groups):
    df, rows = groups
    xs = {"1": F.lit(1.0), "x": F.col("x")}
    repeated = spark.createDataFrame([r for r in rows for _ in range(int(r[3]))], df.schema)
    a, _ = mx.random_intercept_model(df, "y", xs, "g", "w")
    b, _ = mx.random_intercept_model(repeated, "y", xs, "g")
    assert a.beta == pytest.approx(b.beta, abs=1e-6) and a.sigma2_e == pytest.approx(b.sigma2_e, rel=1e-4)


def test_group_intercepts_without_pooling(groups):
    df, rows = groups
    fit, eff = mx.group_intercept_model(df, "y", {"x": F.col("x")}, "g")
    xs, ys, gs = (np.array([r[i] for r in rows]) for i in (1, 2, 0))
    xc, yc = xs.astype(float).copy(), ys.astype(float).copy()
    for g in set(gs):
        xc[gs == g] -= xc[gs == g].mean()
        yc[gs == g] -= yc[gs == g].mean()
    slope = (xc @ yc) / (xc @ xc)
    assert fit.beta_mean[0] == pytest.approx(slope, abs=1e-3)
    got = {r["group"]: r["effect"] for r in eff.collect()}
    k = gs == "g3"
    assert got["g3"] == pytest.approx((ys[k] - slope * xs[k]).mean(), abs=0.01)


def test_unseen_groups_use_the_prior(spark, groups):
    df, _ = groups
    xs = {"1": F.lit(1.0), "x": F.col("x")}
    fit, eff = mx.random_intercept_model(df, "y", xs, "g")
    cells = spark.createDataFrame([("g1", 0.0), ("new", 0.0)], "g string, x double")
    r = {x["g"]: x for x in mx.predict_epred(cells, fit, eff, xs, "g").collect()}
    assert r["new"]["new_group"] and not r["g1"]["new_group"]
    assert r["new"]["epred"] == pytest.approx(fit.beta[0])
    assert r["new"]["epred_sd"] == pytest.approx(np.sqrt(fit.sigma2_u[0, 0] + fit.cov[0, 0]))
    draws = mx.predict_epred_draws(cells.withColumn("cell_id", F.col("g")), fit, eff, xs, "g", "cell_id", 2000, seed=5)
    m = {x["cell_id"]: (x["m"], x["s"]) for x in draws.groupBy("cell_id").agg(F.avg("value").alias("m"), F.stddev("value").alias("s")).collect()}
    assert m["new"][0] == pytest.approx(fit.beta[0], abs=0.08) and m["new"][1] == pytest.approx(r["new"]["epred_sd"], rel=0.1)
    assert m["g1"][0] == pytest.approx(r["g1"]["epred"], abs=0.05)


def test_nested_binomial_models_recover(spark):
    rng = np.random.default_rng(9)
    rows, truth = [], {}
    for k, (b0, b1, su, sv) in {"a": (-0.5, 0.8, 0.6, 0.5), "b": (0.3, -0.4, 0.3, 0.8)}.items():
        for D in range(14):
            v = rng.normal() * sv
            for m in range(10):
                u = rng.normal() * su
                for x in (0.0, 1.0):
                    n = int(rng.integers(5, 25))
                    truth[k, f"d{D}m{m}", x] = 1 / (1 + np.exp(-(b0 + b1 * x + u + v)))
                    rows.append((k, f"d{D}", f"d{D}m{m}", x, float(rng.binomial(n, truth[k, f"d{D}m{m}", x])), float(n)))
    df = spark.createDataFrame(rows, "ind string, d string, m string, x double, y double, n double")
    fits, eff, up = mx.binomial_mixed_models(df, "ind", "y", "n", {"1": F.lit(1.0), "x": F.col("x")}, "m", "d", nodes=5)
    with pytest.raises(mx.NotConverged):
        mx.binomial_mixed_models(df, "ind", "y", "n", {"1": F.lit(1.0), "x": F.col("x")}, "m", "d", nodes=5, max_iter=2)
    assert abs(fits["a"].beta[1] - 0.8) < 0.2 and abs(fits["b"].beta[1] + 0.4) < 0.2
    assert 0.35 < np.sqrt(fits["a"].sigma2_u[0, 0]) < 0.9 and 0.1 < np.sqrt(fits["b"].sigma2_u[0, 0]) < 0.55
    assert 0.4 < np.sqrt(fits["b"].sigma2_upper) < 1.4
    assert eff.count() == 280 and up.count() == 28
    xs = {"1": F.lit(1.0), "x": F.col("x")}
    cells = df.filter("ind = 'b' and x = 1").select("d", "m", "x", (F.col("y") / F.col("n")).alias("rate"))
    cells = cells.union(spark.createDataFrame([("d3", "new", 1.0, None), ("unseen", "new", 1.0, None)], "d string, m string, x double, rate double")).withColumn("cell", F.concat("d", "m"))
    mine, tops = eff.filter("ind = 'b'"), up.filter("ind = 'b'")
    out = mx.predict_epred(cells, fits["b"], mine, xs, "m", "d", tops).toPandas()
    seen = out[out.rate.notna()]
    real = [truth["b", m, 1.0] for m in seen.m]
    assert np.corrcoef(seen.epred, real)[0, 1] > 0.85 and abs(seen.epred.mean() - np.mean(real)) < 0.03
    flat = mx.predict_epred(cells, fits["b"], mine, xs, "m", "d", tops.limit(0)).toPandas()
    assert np.corrcoef(flat[flat.rate.notna()].epred, real)[0, 1] < np.corrcoef(seen.epred, real)[0, 1]
    known, unknown = out[out.d == "d3"], out[out.d == "unseen"].iloc[0]
    assert unknown.new_group and unknown.epred_sd > known[known.m == "new"].iloc[0].epred_sd > known[known.m != "new"].epred_sd.mean()
    with pytest.raises(ValueError):
        mx.predict_epred(cells, fits["b"], mine, xs, "m")
    draws = mx.predict_epred_draws(cells, fits["b"], mine, xs, "m", "cell", 400, upper="d", upper_effects=tops).groupBy("cell").agg(F.avg("value").alias("a"), F.stddev("value").alias("s")).toPandas()
    both = draws.merge(out, on="cell")
    assert np.abs(both.a - both.epred).max() < 0.06 and np.abs(both.s - both.epred_sd).max() < 0.05


def test_multinomial_mixed_model_recovers(spark):
    rng = np.random.default_rng(10)
    S = np.array([[0.6, 0.3], [0.3, 0.5]])
    L, B = np.linalg.cholesky(S), np.array([[-0.4, 0.5], [0.2, -0.4]])
    rows = []
    for g in range(90):
        u = L @ rng.normal(size=2)
        for x in (0.0, 1.0, 2.0):
            e = np.exp(B[:, 0] + B[:, 1] * x + u)
            c = rng.multinomial(int(rng.integers(10, 40)), np.r_[1, e] / (1 + e.sum()))
            rows.append((f"g{g}", x, *map(float, c)))
    df = spark.createDataFrame(rows, "g string, x double, c1 double, c2 double, c3 double")
    xs = {"1": F.lit(1.0), "x": F.col("x")}
    fit, eff = mx.multinomial_mixed_model(df, ["c1", "c2", "c3"], xs, "g", nodes=3)
    assert fit.beta[:, 1] == pytest.approx(B[:, 1], abs=0.15)
    assert fit.sigma2_u == pytest.approx(S, abs=0.3) and fit.sigma2_u[0, 1] > 0
    new = spark.createDataFrame([("g1", 1.0), ("new", 1.0)], "g string, x double")
    for r in mx.predict_multinomial(new, fit, eff, xs, "g").collect():
        assert r["theta_1"] + r["theta_2"] + r["theta_3"] == pytest.approx(1)


def test_poverty_pipeline_agrees_with_the_survey(spark):
    from arealis.operators import mrp
    from arealis.plans import fixtures as fx
    from arealis.plans import model_queries as mq

    d = "/root/testdata/sf0.001"
    e = mq.fitted_dimension_draws(spark, d, draws=20).cache()
    assert e.count() == 20 * fx.census(spark, d).select("segm", "sexo").distinct().count()
    long = e.unpivot(["draw", "n"], list(fx.INDICATORS), "indicator", "value")
    got = {r["indicator"]: r["mrp_estimate"] for r in mrp.dimension_estimates(long, "indicator", []).collect()}
    survey = fx.survey(spark, d).agg(*[F.avg(i).alias(i) for i in fx.INDICATORS]).first().asDict()
    assert all(abs(got[i] - survey[i]) < 0.03 for i in fx.INDICATORS)
