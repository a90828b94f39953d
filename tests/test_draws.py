import hashlib
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealis.functions.rng import normal, uniform
from arealis.operators import area as ar
from arealis.operators import draws as dr
from arealis.operators.ranks import group_quantiles, group_ranks


@pytest.fixture(scope="module")
def chains(spark):
    rng = np.random.default_rng(1)
    rows = []
    for c in range(4):
        z = rng.normal(size=250)
        ar1 = np.zeros(250)
        for t in range(1, 250):
            ar1[t] = 0.8 * ar1[t - 1] + rng.normal()
        for t in range(250):
            rows += [(c + 1, t + 1, c * 250 + t + 1, "iid", float(z[t])), (c + 1, t + 1, c * 250 + t + 1, "ar", float(ar1[t])), (c + 1, t + 1, c * 250 + t + 1, "apart", float(z[t] + 3 * c))]
    return spark.createDataFrame(rows, "chain int, iteration int, draw int, variable string, value double"), rows


def test_summary_matches_numpy(chains):
    df, rows = chains
    got = {r["variable"]: r for r in dr.summarise_draws(df).collect()}
    x = np.array([r[4] for r in rows if r[3] == "ar"])
    r = got["ar"]
    assert (r["mean"], r["median"], r["sd"]) == pytest.approx((x.mean(), np.median(x), x.std(ddof=1)))
    assert r["mad"] == pytest.approx(1.4826 * np.median(np.abs(x - np.median(x))))
    assert (r["q5"], r["q95"]) == pytest.approx(tuple(np.quantile(x, [0.05, 0.95])))


def test_draws_are_not_gathered_to_join_their_ranks(chains):
    df, _ = chains
    plan = dr.rank_normalised(df)._jdf.queryExecution().sparkPlan().toString()
    on_values = [line for line in plan.splitlines() if "Join" in line and line.split("Inner")[0].count("value") > 1]
    assert on_values and all("SortMergeJoin" in line for line in on_values)
    # totals of few groups go to the rows, so that a group is not one task
    assert all("BroadcastHashJoin" in line for line in plan.splitlines() if "Join" in line and line not in on_values)
    few, many = (sorted(map(tuple, group_ranks(df, ["variable"], "value", few=f).collect())) for f in (True, False))
    assert few == many


def ess_by_definition(x):
    m, n = x.shape
    c = x - x.mean(1, keepdims=True)
    acov = np.array([(c[:, : n - k] * c[:, k:]).sum(1).mean() / n for k in range(n)])
    w = acov[0] * n / (n - 1)
    vplus = acov[0] + x.mean(1).var(ddof=1)
    rho = 1 - (w - acov) / vplus
    rho[0] = 1
    total, low = 0.0, np.inf
    for k in range(0, n - 1, 2):
        low = min(low, rho[k] + rho[k + 1])
        if low <= 0:
            break
        total += low
    return m * n / max(2 * total - 1, 1 / np.log10(m * n))


def test_rhat_and_ess(chains):
    df, rows = chains
    plain = {r["variable"]: r["rhat"] for r in dr.rhat(df).collect()}
    rank = {r["variable"]: r["rhat"] for r in dr.rhat_rank(df).collect()}
    assert plain["iid"] < 1.02 and rank["iid"] < 1.02
    assert plain["apart"] > 1.5 and rank["apart"] > 1.5
    ess = {r["variable"]: r["ess"] for r in dr.ess(df).collect()}
    for v in ("iid", "ar", "apart"):
        x = np.array([r[4] for r in rows if r[3] == v]).reshape(1000, -1)[:, 0].reshape(4, 250)
        assert ess[v] == pytest.approx(ess_by_definition(x.reshape(8, 125)), rel=1e-6)
    assert ess["apart"] < ess["ar"] < 200 < 700 < ess["iid"] < 1400


def test_ranks_with_ties_and_one_crowded_group(spark):
    rng = np.random.default_rng(0)
    rows = [("big", float(v)) for v in rng.integers(0, 50, 3000)] + [("small", float(v)) for v in rng.normal(size=11)] + [("one", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    q = {r["g"]: (r["a"], r["b"]) for r in group_quantiles(df, ["g"], "v", {"a": 0.1, "b": 0.77}).collect()}
    for g in ("big", "small", "one"):
        x = np.array([v for k, v in rows if k == g])
        assert q[g] == pytest.approx(tuple(np.quantile(x, [0.1, 0.77])))
    ranks = {r["v"]: (r["below"], r["k"], r["n"]) for r in group_ranks(df, ["g"], "v").filter("g = 'big'").collect()}
    x = np.array([v for k, v in rows if k == "big"])
    assert all(ranks[v] == ((x < v).sum(), (x == v).sum(), 3000) for v in set(x))
    whole = group_quantiles(df, [], "v", {"m": 0.5}).first()["m"]
    assert whole == pytest.approx(np.median([v for _, v in rows]))


def test_normal_quantile_column(spark):
    from statistics import NormalDist

    p = [0.001, 0.02, 0.3, 0.5, 0.9, 0.999]
    df = spark.createDataFrame([(v,) for v in p], "p double")
    got = [r[0] for r in df.select(dr.normal_quantile_column(F.col("p"))).collect()]
    assert got == pytest.approx([NormalDist().inv_cdf(v) for v in p], abs=1e-7)


def test_keyed_randomness(spark):
    df = spark.range(20000)
    u = df.select(uniform(1, "id").alias("u"), normal(2, "id").alias("z")).toPandas()
    assert u.u.between(0, 1, inclusive="left").all() and abs(u.u.mean() - 0.5) < 0.01
    assert abs(u.z.mean()) < 0.03 and abs(u.z.std() - 1) < 0.02
    a = [r[0] for r in df.repartition(11).select("id", uniform(1, "id").alias("u")).orderBy("id").select("u").collect()]
    assert a == list(u.u)


def test_replicated_outcomes(spark):
    df = spark.range(20000).withColumn("n", F.lit(12))
    cols = [
        dr.replicate_bernoulli(F.lit(0.3), "b", "id").alias("bern"),
        dr.replicate_binomial(F.col("n"), F.lit(0.25), "c", "id").alias("bin"),
        dr.replicate_binomial(F.lit(5000), F.lit(0.25), "d", "id").alias("big"),
        dr.replicate_poisson(F.lit(900.0), "k", "id").alias("bigpois"),
        dr.replicate_normal(F.lit(2.0), F.lit(0.5), "e", "id").alias("norm"),
        dr.replicate_poisson(F.lit(3.5), "f", "id").alias("pois"),
        dr.replicate_category([F.lit(0.2), F.lit(0.3), F.lit(0.5)], "g", "id").alias("cat"),
    ]
    m = dr.replicate_multinomial(F.col("n"), [F.lit(0.2), F.lit(0.3), F.lit(0.5)], "h", "id")
    x = df.select(*cols, *[c.alias(f"m{i}") for i, c in enumerate(m)]).toPandas()
    assert x.bern.mean() == pytest.approx(0.3, abs=0.015)
    assert x.bin.mean() == pytest.approx(3, abs=0.05) and x.bin.var() == pytest.approx(2.25, rel=0.06)
    assert x.big.mean() == pytest.approx(1250, rel=0.005) and x.big.std() == pytest.approx(30.6, rel=0.05)
    # the distribution functions of the large draws, not only their moments
    for values, law in ((x.big, [math.lgamma(5001) - math.lgamma(k + 1) - math.lgamma(5001 - k) + k * math.log(0.25) + (5000 - k) * math.log(0.75) for k in range(5001)]), (x.bigpois, [k * math.log(900) - 900 - math.lgamma(k + 1) for k in range(2000)])):
        expected = np.cumsum(np.exp(law))
        seen = np.searchsorted(np.sort(values), np.arange(len(law)), "right") / len(values)
        assert np.abs(seen - expected).max() < 1.63 / np.sqrt(len(values))
    assert x.norm.mean() == pytest.approx(2, abs=0.02)
    assert x.pois.mean() == pytest.approx(3.5, abs=0.06) and x.pois.var() == pytest.approx(3.5, rel=0.06)
    assert x.cat.value_counts(normalize=True).sort_index().to_numpy() == pytest.approx([0.2, 0.3, 0.5], abs=0.015)
    assert (x.m0 + x.m1 + x.m2 == 12).all() and x.m1.mean() == pytest.approx(3.6, abs=0.06)


def test_replicated_counts_are_those_of_their_uniforms(spark):
    """Draws equal a loop over the same uniforms, missing values included, and Python runs once for all categories."""
    rows = [(i, n, q) for i, (n, q) in enumerate(itertools.product([None, 0, 1, 7, 8, 9, 40, 1000, 1001, 30000], [None, 0.0, 1e-9, 0.3, 1.0]))]
    df = spark.createDataFrame(rows, "id long, n long, q double")
    q = F.col("q")
    parts = dr.replicate_multinomial(F.col("n"), [q, (1 - q) / 2, (1 - q) / 2], "m", "id", "n")
    made = df.select("*", dr.replicate_binomial(F.col("n"), q, "b", "id").alias("b"), dr.replicate_poisson(F.col("n") * q, "p", "id").alias("p"), *[c.alias(f"m{i}") for i, c in enumerate(parts)])

    def u(*words):
        return int(hashlib.md5("|".join(str(w) for w in words if w is not None).encode()).hexdigest()[:13], 16) / 2**52

    def nearest(law, mode, goal):
        """Counts in the order mode, above, below against the goal, as the draws take them."""
        above, below = law[mode:] / law[mode], law[:mode][::-1] / law[mode]
        goal *= above.sum() + below.sum()
        walk = np.concatenate([above, below]).cumsum()
        i = int((walk < goal).sum())
        return mode + i if i < len(above) else mode - 1 - (i - len(above))

    def binomial(n, p, seed, *key):
        if n < 1 or p <= 0 or p >= 1:
            return n if p >= 1 else 0
        if n <= 1000:
            return sum(u(seed, *key, t) < p for t in range(1, n + 1))
        k = np.arange(n + 1)
        log = np.array([math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in k]) + k * math.log(p) + (n - k) * math.log1p(-p)
        return nearest(np.exp(log - log.max()), min(n, math.floor((n + 1) * p)), u(seed, *key))

    def poisson(rate, *key):
        k = np.arange(int(rate + 12 * rate**0.5 + 40) + 1)
        law = np.exp(k * math.log(rate) - rate - np.array([math.lgamma(i + 1) for i in k])) if rate > 0 else np.eye(len(k))[0]
        return int((law.cumsum() < u(*key)).sum()) if rate <= 500 else nearest(law, math.floor(rate), u(*key))

    for r in made.collect():
        n, p = r["n"], r["q"]
        assert r["b"] == (None if n is None or (n and p is None) else binomial(n, p or 0.0, "b", r["id"])), r
        assert r["p"] == (None if n is None or p is None else poisson(n * p, "p", r["id"])), r
        if n is None:
            assert r["m0"] is r["m1"] is r["m2"] is None
        elif p is None:  # as before: a share without a chance takes all
            assert (r["m0"], r["m1"], r["m2"]) == (n, 0, 0)
        else:
            m0 = binomial(n, p, "m.0", r["id"], n)
            m1 = binomial(n - m0, min((1 - p) / 2 / (1 - p), 1.0) if p < 1 else 0.0, "m.1", r["id"], n)
            assert (r["m0"], r["m1"], r["m2"]) == (m0, m1, n - m0 - m1), r
    plan = made.select("m0", "m1", "m2")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("made(") == 1 and "md5" not in plan


def test_draws_follow_the_posterior(spark):
    mean, cov = np.array([1.0, -2.0]), np.array([[1.0, 0.6], [0.6, 2.0]])
    d = dr.posterior_draws(spark, mean, cov, ["a", "b"], 8000).toPandas()
    w = d.pivot(index="draw", columns="variable", values="value")
    assert w.mean().to_numpy() == pytest.approx(mean, abs=0.06)
    assert np.cov(w.to_numpy().T) == pytest.approx(cov, abs=0.1)
    assert set(d.chain) == {1, 2, 3, 4} and d.iteration.max() == 2000


def test_grid_draws_mix_over_the_grid(spark):
    fit = ar.GridFit(np.array([0.5, 2.0]), np.array([0.25, 0.75]), np.array([[0.0], [10.0]]), np.array([[[1.0]], [[1.0]]]), "identity")
    d = dr.grid_draws(spark, fit, ["a"], 4000).toPandas()
    s = d[d.variable == "sigma2_v"].value
    assert (s == 2.0).mean() == pytest.approx(0.75, abs=0.03)
    assert d[d.variable == "a"].value.mean() == pytest.approx(7.5, abs=0.3)


def test_predictive_tables(spark, chains):
    df, _ = chains
    obs = spark.createDataFrame([(0,), (1,), (1,)], "y int")
    rep = spark.createDataFrame([(1, 0), (1, 0), (1, 1), (2, 1), (2, 1), (2, 1)], "draw int, yrep int")
    got = {(r["source"], r["draw"], r["value"]): r["n"] for r in dr.ppc_counts(obs, "y", rep, "yrep").collect()}
    assert got == {("y", None, 0): 1, ("y", None, 1): 2, ("yrep", 1, 0): 2, ("yrep", 1, 1): 1, ("yrep", 2, 1): 3}
    dens = dr.ppc_density(obs, "y", rep, "yrep", 2, 0.0, 1.0, k=1)
    assert dens.filter("source = 'yrep'").select("draw").distinct().count() == 1
    assert dr.trace_table(df, ["iid"]).count() == 1000
    assert dr.chain_density(df.filter("variable = 'iid'"), 10, -4.0, 4.0).groupBy("chain").agg((F.sum("density") * 0.8).alias("s")).agg(F.max(F.abs(F.col("s") - 1))).first()[0] < 1e-9
