"""Closed-form posteriors from sufficient statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.numeric import beta_quantile_column


def beta_binomial_posterior(df: DataFrame, y: str, by: Sequence[str] = (), a: float = 1.0, b: float = 1.0, trials: str | None = None) -> DataFrame:
    """Beta(a + s, b + n - s) with its mean and variance.

    Rows are 0/1 outcomes, or counts out of ``trials``; no ``by`` pools everything.
    """
    n = F.count(y) if trials is None else F.sum(trials)
    s = df.groupBy(*by).agg(n.cast("double").alias("n"), F.sum(y).cast("double").alias("s"))
    s = s.withColumns({"alpha": F.lit(float(a)) + F.col("s"), "beta": F.lit(float(b)) + F.col("n") - F.col("s")})
    t = F.col("alpha") + F.col("beta")
    return s.withColumns({"mean": F.col("alpha") / t, "var": F.col("alpha") * F.col("beta") / (t * t * (t + 1))})


def beta_interval(posterior: DataFrame, level: float = 0.95) -> DataFrame:
    """Equal-tail interval of each Beta posterior."""
    tail = (1 - level) / 2
    return posterior.withColumns({"low": beta_quantile_column(tail, "alpha", "beta"), "high": beta_quantile_column(1 - tail, "alpha", "beta")})


def beta_density(posterior: DataFrame, keys: Sequence[str], points: int = 200, alpha: str = "alpha", beta: str = "beta") -> DataFrame:
    """Density of each Beta on cell midpoints of (0, 1), normalised on that grid."""
    step = 1.0 / points
    grid = F.transform(F.sequence(F.lit(1), F.lit(points)), lambda i: (i - 0.5) * step)
    a, b = F.col(alpha) - 1, F.col(beta) - 1
    top = F.when((a > 0) & (b > 0), a * F.log(a / (a + b)) + b * F.log(b / (a + b))).otherwise(0.0)
    raw = F.transform(grid, lambda t: F.struct(t.alias("theta"), F.exp(a * F.log(t) + b * F.log(1 - t) - top).alias("k")))
    out = posterior.select(*keys, raw.alias("__g"))
    total = F.aggregate("__g", F.lit(0.0), lambda acc, g: acc + g["k"])
    out = out.withColumn("__t", total * step).select(*keys, "__t", F.explode("__g").alias("g"))
    return out.select(*keys, F.col("g.theta").alias("theta"), (F.col("g.k") / F.col("__t")).alias("density"))


def normal_posterior_known_var(df: DataFrame, y: str, by: Sequence[str] = (), mu: float = 0.0, tau2: float = 1e6, sigma2: float | None = None) -> DataFrame:
    """Posterior of a normal mean with known variance; the sample variance stands in when none is given."""
    s = df.groupBy(*by).agg(F.count(y).alias("n"), F.avg(y).alias("ybar"), F.var_samp(y).alias("s2"))
    v = F.col("s2") if sigma2 is None else F.lit(float(sigma2))
    precision = F.when(v > 0, F.col("n") / v) + F.lit(1 / tau2)
    mean = (F.when(v > 0, F.col("n") / v) * F.col("ybar") + F.lit(mu / tau2)) / precision
    return s.select(*by, "n", "ybar", mean.alias("mu_n"), (1 / precision).alias("tau2_n"))


def normal_posterior_unknown_var(
    df: DataFrame,
    y: str,
    by: Sequence[str] = (),
    mu: float = 0.0,
    tau2: float = 1e6,
    shape: float = 0.001,
    rate: float = 0.001,
    points: int = 200,
    width: float = 8.0,
    stan_compat: bool = False,
) -> DataFrame:
    """Posterior mean and sd of (theta, sigma2) under independent normal and inverse-gamma priors.

    Given sigma2 the mean is normal in closed form, so one log-spaced grid over sigma2 per group, centred at
    the sample variance and ``width`` standard deviations wide, is all that is integrated numerically.  Where the
    values of a group are equal, or there is only one, the grid is centred at what the prior alone would give.
    ``stan_compat`` puts the inverse-gamma density on sigma2 without the change of variable from sigma.
    """
    s = df.groupBy(*by).agg(F.count(y).cast("double").alias("n"), F.avg(y).alias("ybar"), F.var_samp(y).alias("s2"))
    s = s.filter(F.col("n") > 0).withColumn("s2", F.coalesce("s2", F.lit(0.0)))
    n, ybar, s2 = F.col("n"), F.col("ybar"), F.col("s2")
    centre = F.when(s2 > 0, s2).otherwise(F.lit(2 * rate) / (n - 1 + F.lit(2 * shape)))
    half = F.lit(width) * F.sqrt(2.0 / n)
    grid = F.transform(
        F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.log(centre) - half + 2 * half * i / F.lit(float(points - 1))
    )
    jac = 0.5 if stan_compat else 1.0  # log grid step: d sigma2 = sigma2 d log; d sigma = sigma/2 d log

    def point(t: Column) -> Column:
        v = F.exp(t)
        prec = n / v + F.lit(1 / tau2)
        m = (n / v * ybar + F.lit(mu / tau2)) / prec
        logp = (
            -n / 2 * t
            - (n - 1) * s2 / (2 * v)
            - 0.5 * F.log(1 + n * F.lit(tau2) / v)
            - 0.5 * F.pow(ybar - F.lit(mu), 2) / (F.lit(tau2) + v / n)
            - F.lit(shape + 1) * t
            - F.lit(rate) / v
            + F.lit(jac) * t
        )
        return F.struct(v.alias("v"), m.alias("m"), (1 / prec).alias("s"), logp.alias("lp"))

    s = s.withColumn("__g", F.transform(grid, point))
    s = s.withColumn("__top", F.array_max(F.transform("__g", lambda g: g["lp"])))
    zero = F.struct(*[F.lit(0.0).alias(k) for k in ("w", "m", "mm", "v", "vv")])

    def add(acc: Column, g: Column) -> Column:
        w = F.exp(g["lp"] - F.col("__top"))
        return F.struct(
            (acc["w"] + w).alias("w"),
            (acc["m"] + w * g["m"]).alias("m"),
            (acc["mm"] + w * (g["s"] + g["m"] * g["m"])).alias("mm"),
            (acc["v"] + w * g["v"]).alias("v"),
            (acc["vv"] + w * g["v"] * g["v"]).alias("vv"),
        )

    s = s.withColumn("a", F.aggregate("__g", zero, add))
    w = F.col("a.w")
    mean, var = F.col("a.m") / w, F.col("a.v") / w
    return s.select(
        *by,
        "n",
        mean.alias("theta_mean"),
        F.sqrt(F.greatest(F.col("a.mm") / w - mean * mean, F.lit(0.0))).alias("theta_sd"),
        var.alias("sigma2_mean"),
        F.sqrt(F.greatest(F.col("a.vv") / w - var * var, F.lit(0.0))).alias("sigma2_sd"),
    )


def dirichlet_posterior(df: DataFrame, category: str, alpha: Mapping[int | str, float], by: Sequence[str] = (), delta: Sequence[int | str] = ()) -> DataFrame:
    """Dirichlet(y + alpha): mean and variance per category, and of the sum of the ``delta`` categories."""
    levels = list(alpha)
    counts = df.groupBy(*by).agg(*[F.count_if(F.col(category) == v).alias(f"__y{i}") for i, v in enumerate(levels)])
    post = [F.col(f"__y{i}") + F.lit(float(alpha[v])) for i, v in enumerate(levels)]
    total = sum(post[1:], post[0])
    items = [F.struct(F.lit(str(v)).alias("category"), F.col(f"__y{i}").alias("y"), post[i].alias("a")) for i, v in enumerate(levels)]
    if delta:
        picked = [i for i, v in enumerate(levels) if v in delta]
        ys = sum((F.col(f"__y{i}") for i in picked[1:]), F.col(f"__y{picked[0]}"))
        items.append(F.struct(F.lit("delta").alias("category"), ys.alias("y"), sum((post[i] for i in picked[1:]), post[picked[0]]).alias("a")))
    out = counts.select(*by, total.alias("t"), F.explode(F.array(*items)).alias("i"))
    m = F.col("i.a") / F.col("t")
    return out.select(*by, "i.category", "i.y", m.alias("mean"), (m * (1 - m) / (F.col("t") + 1)).alias("var"))


def gamma_poisson_posterior(df: DataFrame, y: str, by: Sequence[str] = (), shape: float = 38.0, rate: float = 9.0) -> DataFrame:
    s = df.groupBy(*by).agg(F.count(y).alias("n"), F.sum(y).cast("double").alias("s"))
    a, b = F.lit(float(shape)) + F.col("s"), F.lit(float(rate)) + F.col("n")
    return s.select(*by, "n", a.alias("shape"), b.alias("rate"), (a / b).alias("mean"), (a / (b * b)).alias("var"))
