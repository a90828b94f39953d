"""Posterior draws, replicated data and their summaries.

A draws table is long: (chain, iteration, draw, variable, value).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arealis.functions.digest import as_lists
from arealis.functions.discrete import binomial, poisson
from arealis.functions.rng import key_text, normal, uniform
from arealis.operators.area import GridFit
from arealis.operators.cells import histogram_table, sample_rows, union_by_name
from arealis.operators.joins import few_groups
from arealis.operators.linalg import double_columns
from arealis.operators.ranks import group_ranks, pick_quantiles


def posterior_draws(spark: SparkSession, mean: np.ndarray, cov: np.ndarray, names: Sequence[str], n: int, seed: object = 1, chains: int = 4) -> DataFrame:
    """Normal draws from a posterior mean and covariance, laid out like sampler output."""
    p = len(mean)
    L = np.linalg.cholesky(np.asarray(cov) + 1e-14 * np.eye(p))
    base = _draw_index(spark, n, chains).withColumns({f"__z{k}": normal(f"{seed}.{k}", "draw") for k in range(p)})
    values = []
    for i in range(p):
        v = F.lit(float(mean[i]))
        for k in range(i + 1):
            v = v + F.lit(float(L[i, k])) * F.col(f"__z{k}")
        values.append(F.struct(F.lit(names[i]).alias("variable"), v.alias("value")))
    return base.select("chain", "iteration", "draw", F.explode(F.array(*values)).alias("v")).select("chain", "iteration", "draw", "v.variable", "v.value")


def _draw_index(spark: SparkSession, n: int, chains: int) -> DataFrame:
    d = spark.range(1, n + 1).withColumnRenamed("id", "draw")
    return d.withColumns({"chain": ((F.col("draw") - 1) % chains + 1).cast("int"), "iteration": (F.floor((F.col("draw") - 1) / chains) + 1).cast("int")})


def grid_draws(spark: SparkSession, fit: GridFit, names: Sequence[str], n: int, seed: object = 1, chains: int = 4) -> DataFrame:
    """Draws from a mixture posterior: pick a grid point by its weight, then the coefficients given it."""
    f = fit.pruned()
    p = f.beta.shape[1]
    L = np.linalg.cholesky(f.cov + 1e-14 * np.eye(p))
    items = [
        (float(c), float(s), [float(x) for x in b], [float(x) for x in l.ravel()]) for c, s, b, l in zip(np.cumsum(f.weights), f.sigma2, f.beta, L)
    ]
    grid = spark.createDataFrame([(items,)], "g array<struct<c:double,s2:double,b:array<double>,l:array<double>>>").select("g").scalar()
    d = _draw_index(spark, n, chains).withColumn("__grid", grid).withColumn("__u", uniform(f"{seed}.g", "draw"))
    d = d.withColumn("__i", F.least(F.size(F.filter("__grid", lambda g: g["c"] < F.col("__u"))), F.size("__grid") - 1))
    d = d.withColumn("__g", F.get("__grid", F.col("__i"))).withColumns({f"__z{k}": normal(f"{seed}.{k}", "draw") for k in range(p)})
    values = []
    for i in range(p):
        v = F.get("__g.b", i)
        for k in range(i + 1):
            v = v + F.get("__g.l", i * p + k) * F.col(f"__z{k}")
        values.append(F.struct(F.lit(names[i]).alias("variable"), v.alias("value")))
    values.append(F.struct(F.lit("sigma2_v").alias("variable"), F.col("__g.s2").alias("value")))
    return d.select("chain", "iteration", "draw", F.explode(F.array(*values)).alias("v")).select("chain", "iteration", "draw", "v.variable", "v.value")


def area_draws(areas: DataFrame, fit: GridFit, y: str, psi: str, xs: Sequence[str | Column], area: str, n: int, seed: object = 1, chains: int = 4, area_effect: bool = True) -> DataFrame:
    """Joint posterior draws of all area parameters, long: (chain, iteration, draw, area, value).

    A draw takes a variance and coefficients from the grid, shared by all areas, as :func:`grid_draws` does with the same
    seed; given both, the parameter of an observed area is normal around its shrunken estimate, that of an unobserved one
    around its synthetic value.  Only one array of draws travels; the parameters are made where the areas lie.
    """
    names = [f"b{i}" for i in range(len(xs))]
    shared = grid_draws(areas.sparkSession, fit, names, n, seed, chains).groupBy("chain", "iteration", "draw").pivot("variable", [*names, "sigma2_v"]).agg(F.first("value"))
    items = shared.agg(F.sort_array(F.collect_list(F.struct("draw", "chain", "iteration", F.col("sigma2_v").alias("s2"), F.array(*names).alias("b")))).alias("d")).select("d").scalar()
    cols = double_columns(xs)
    seen = F.col(y).isNotNull() & F.col(psi).isNotNull()
    table = areas.select(F.col(area), seen.alias("__seen"), F.coalesce(F.col(y).cast("double"), F.lit(0.0)).alias("__y"), F.col(psi).cast("double").alias("__psi"), F.array(*cols).alias("__x"))
    tall = table.withColumn("__d", F.explode(items))
    xb = F.lit(0.0)
    for i in range(len(cols)):
        xb = xb + F.get("__x", i) * F.get("__d.b", i)
    s2 = F.col("__d.s2")
    gamma = F.when(F.col("__seen"), s2 / (s2 + F.col("__psi"))).otherwise(0.0)
    var = F.when(F.col("__seen"), gamma * F.col("__psi")).otherwise(s2 if area_effect else F.lit(0.0))
    theta = gamma * F.col("__y") + (1 - gamma) * xb + F.sqrt(var) * normal(f"{seed}.theta", "__d.draw", area)
    value = F.pow(F.sin(theta), F.lit(2)) if fit.link == "arcsine" else theta
    return tall.select("__d.chain", "__d.iteration", "__d.draw", area, value.alias("value"))



# ---------------------------------------------------------------- replicated data


def replicate_bernoulli(p: Column, seed: object, *keys: str) -> Column:
    return (uniform(seed, *keys) < p).cast("int")


def _joined(keys: Sequence[str]) -> Column:
    """The keys of a row as one text, each with the separator before it."""
    return F.concat(F.lit(""), *[key_text(k) for k in keys])


def _counts(n: Column, shares: Sequence[Column], seeds: Sequence[str], keys: Sequence[str], trials_up_to: int) -> Column:
    """Nested binomial draws as an array: of ``n``, then of what is left, and what is left in the end; all hashed in one go."""

    @F.arrow_udf("array<int>")
    def made(key: pa.Array, size: pa.Array, *chances: pa.Array) -> pa.Array:
        known = size.is_valid().to_numpy(zero_copy_only=False).copy()
        left, out, valid = size.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), [], []
        for seed, chance in zip(seeds, chances):
            # without trials nothing depends on the chance
            known &= (left < 1) | chance.is_valid().to_numpy(zero_copy_only=False)
            hits = binomial(key, np.where(known, left, 0), chance.fill_null(0.0).to_numpy(zero_copy_only=False), seed, trials_up_to)
            out.append(hits)
            valid.append(known.copy())
            left = left - hits
        return as_lists(np.stack([*out, left], axis=1).astype(np.int32), np.stack([*valid, known], axis=1))

    return made(_joined(keys), n.cast("int"), *[c.cast("double") for c in shares])


def replicate_binomial(n: Column, p: Column, seed: object, *keys: str, trials_up_to: int = 1000) -> Column:
    """An exact binomial draw: the sum of keyed Bernoulli trials, or by inversion beyond ``trials_up_to`` trials."""
    return F.get(_counts(n, [p], [str(seed)], keys, trials_up_to), 0)


def replicate_normal(mean: Column, sd: Column, seed: object, *keys: str) -> Column:
    return mean + sd * normal(seed, *keys)


def replicate_poisson(rate: Column, seed: object, *keys: str, from_zero_up_to: float = 500.0) -> Column:
    """An exact Poisson draw by inversion at a keyed uniform, from zero upwards or, where that would underflow, from the mode."""
    seed = str(seed)

    @F.arrow_udf("int")
    def made(key: pa.Array, rate: pa.Array, none: pa.Array) -> pa.Array:
        r, p0 = (a.fill_null(float("nan")).to_numpy(zero_copy_only=False) for a in (rate, none))
        return pa.array(poisson(key, r, p0, seed, from_zero_up_to).astype(np.int32), mask=np.isnan(r))

    rate = rate.cast("double")
    return made(_joined(keys), rate, F.exp(-rate))


def replicate_category(probs: Sequence[Column], seed: object, *keys: str) -> Column:
    """Category number 1..P by thresholds of one keyed uniform."""
    u, out, cum = uniform(seed, *keys), F.lit(1), F.lit(0.0)
    for p in probs[:-1]:
        cum = cum + p
        out = out + (u >= cum).cast("int")
    return out


def replicate_multinomial(n: Column, probs: Sequence[Column], seed: object, *keys: str, trials_up_to: int = 1000) -> list[Column]:
    """Counts per category as nested binomials, drawn in one pass over the rows."""
    rest, shares = F.lit(1.0), []
    for p in probs[:-1]:
        shares.append(F.when(rest > 1e-12, F.least(p / rest, F.lit(1.0))).otherwise(0.0))
        rest = rest - p
    counts = _counts(n, shares, [f"{seed}.{k}" for k in range(len(shares))], keys, trials_up_to)
    return [F.get(counts, k) for k in range(len(probs))]


# ---------------------------------------------------------------- summaries


def summarise_draws(draws: DataFrame, by: Sequence[str] = ("variable",), value: str = "value") -> DataFrame:
    """Mean, median, sd, mad, 5 % and 95 % quantile per variable."""
    by = list(by)
    moments = draws.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
    few = few_groups(draws, by)
    q = pick_quantiles(group_ranks(draws, by, value, few=few), by, value, {"median": 0.5, "q5": 0.05, "q95": 0.95})
    medians = q.select(*by, "median")
    dev = draws.join(F.broadcast(medians) if few else medians, by).withColumn("__dev", F.abs(F.col(value) - F.col("median")))
    mad = pick_quantiles(group_ranks(dev, by, "__dev", few=few), by, "__dev", {"__mad": 0.5})
    out = moments.join(q, by).join(mad, by)
    return out.select(*by, "mean", "median", "sd", (1.4826 * F.col("__mad")).alias("mad"), "q5", "q95")


def split_chains(draws: DataFrame, few: bool | None = None) -> DataFrame:
    """Halve every chain; with an odd length the middle draw belongs to no half."""
    few = few_groups(draws, ["variable", "chain"]) if few is None else few
    last = draws.groupBy("variable", "chain").agg(F.max("iteration").alias("__t"))
    d = draws.join(F.broadcast(last) if few else last, ["variable", "chain"])
    half = F.floor(F.col("__t") / 2)
    d = d.filter((F.col("iteration") <= half) | (F.col("iteration") > F.col("__t") - half))
    second = (F.col("iteration") > half).cast("int")
    return d.withColumns({"half": second, "step": F.when(second == 1, F.col("iteration") - F.col("__t") + half).otherwise(F.col("iteration"))}).drop("__t")


def _rhat(d: DataFrame) -> DataFrame:
    c = d.groupBy("variable", "chain", "half").agg(F.avg("value").alias("m"), F.var_samp("value").alias("v"), F.count(F.lit(1)).alias("n"))
    a = c.groupBy("variable").agg(F.avg("v").alias("w"), F.var_samp("m").alias("b"), F.avg("n").alias("n"))
    n, w = F.col("n"), F.col("w")
    return a.select("variable", F.when(w > 0, F.sqrt(((n - 1) / n * w + F.col("b")) / w)).alias("rhat"))


def rhat(draws: DataFrame) -> DataFrame:
    """Potential scale reduction of the split chains."""
    return _rhat(split_chains(draws))


# Coefficients of Acklam's rational approximation to the normal quantile.
_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01, 1.0)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0)


def _poly(c: Sequence[float], x: Column) -> Column:
    out = F.lit(c[0])
    for k in c[1:]:
        out = out * x + F.lit(k)
    return out


def normal_quantile_column(p: Column) -> Column:
    q = p - 0.5
    mid = _poly(_A, q * q) * q / _poly(_B, q * q)
    tail_p = F.least(p, 1 - p)
    t = F.sqrt(-2 * F.log(F.greatest(tail_p, F.lit(1e-300))))
    tail = _poly(_C, t) / _poly(_D, t)
    return F.when(tail_p >= 0.02425, mid).when(p < 0.5, tail).otherwise(-tail)


def rank_normalised(d: DataFrame, few: bool | None = None) -> DataFrame:
    """Replace values by normal scores of their average ranks within the variable."""
    ranks = group_ranks(d, ["variable"], "value", few=few)
    r = F.col("below") + (F.col("k") + 1) / 2
    z = ranks.select("variable", "value", normal_quantile_column((r - 0.375) / (F.col("n") + 0.25)).alias("__z"))
    # both sides are as long as the draws; sizes guessed before the run take one for small and would gather it on the driver
    return d.join(z.hint("merge"), ["variable", "value"]).drop("value").withColumnRenamed("__z", "value")


def rhat_rank(draws: DataFrame) -> DataFrame:
    """Rank-normalised split R-hat, the larger of the bulk and the folded one."""
    few = few_groups(draws, ["variable", "chain"])
    d = split_chains(draws, few)
    med = pick_quantiles(group_ranks(d, ["variable"], "value", few=few), ["variable"], "value", {"__med": 0.5})
    folded = d.join(F.broadcast(med) if few else med, "variable").withColumn("value", F.abs(F.col("value") - F.col("__med"))).drop("__med")
    a = _rhat(rank_normalised(d, few)).withColumnRenamed("rhat", "bulk")
    b = _rhat(rank_normalised(folded, few)).withColumnRenamed("rhat", "folded")
    return a.join(b, "variable").select("variable", F.greatest("bulk", "folded").alias("rhat"))


def ess(draws: DataFrame) -> DataFrame:
    """Effective sample size of the split chains by the initial monotone positive sequence.

    A half chain is one ordered run, so its autocovariances are computed in one task; chains are spread over
    the cluster.
    """
    d = split_chains(draws).select("variable", "chain", "half", "step", F.col("value").cast("double").alias("value"))

    def autocov(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values("step")["value"].to_numpy()
        n = len(x)
        c = x - x.mean()
        f = np.fft.rfft(c, 2 ** int(np.ceil(np.log2(max(2 * n, 2)))))
        acov = np.fft.irfft(f * np.conj(f))[:n] / n
        return pd.DataFrame({"variable": pdf["variable"].iloc[0], "chain": pdf["chain"].iloc[0], "m": x.mean(), "n": n, "lag": np.arange(n), "acov": acov})

    ac = d.groupBy("variable", "chain", "half").applyInPandas(autocov, "variable string, chain int, m double, n int, lag int, acov double")
    lags = ac.groupBy("variable", "lag").agg(F.avg("acov").alias("g"), F.count(F.lit(1)).alias("c"), F.min("n").alias("n"), F.coalesce(F.var_samp("m"), F.lit(0.0)).alias("b"))
    w0 = lags.filter("lag = 0").select("variable", (F.col("g") * F.col("n") / (F.col("n") - 1)).alias("w"), (F.col("g") + F.col("b")).alias("vplus"), (F.col("n") * F.col("c")).alias("total"))
    rho = lags.join(w0, "variable").withColumn("rho", 1 - (F.col("w") - F.col("g")) / F.col("vplus"))
    pairs = rho.groupBy("variable", F.floor(F.col("lag") / 2).alias("t")).agg(
        F.sum(F.when(F.col("lag") == 0, 1.0).otherwise(F.col("rho"))).alias("p"), F.count(F.lit(1)).alias("k"), F.max("total").alias("total")
    )
    order = Window.partitionBy("variable").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    pairs = pairs.filter("k = 2").withColumn("low", F.min("p").over(order))
    s = pairs.groupBy("variable").agg(F.sum(F.when(F.col("low") > 0, F.col("low")).otherwise(0.0)).alias("s"), F.max("total").alias("total"))
    tau = F.greatest(2 * F.col("s") - 1, 1 / F.log10(F.col("total")))
    return s.select("variable", (F.col("total") / tau).alias("ess"))


def trace_table(draws: DataFrame, variables: Sequence[str]) -> DataFrame:
    return draws.filter(F.col("variable").isin(*variables)).orderBy("variable", "chain", "iteration").select("variable", "chain", "iteration", "value")


def chain_density(draws: DataFrame, bins: int, lo: float, hi: float) -> DataFrame:
    return histogram_table(draws, "value", bins, lo, hi, by=["variable", "chain"])


def interval_table(draws: DataFrame, inner: float = 0.5, outer: float = 0.9) -> DataFrame:
    """Median with inner and outer equal-tail intervals."""
    q = {"ll": (1 - outer) / 2, "l": (1 - inner) / 2, "m": 0.5, "h": (1 + inner) / 2, "hh": (1 + outer) / 2}
    return pick_quantiles(group_ranks(draws, ["variable"], "value"), ["variable"], "value", q)


def ppc_density(observed: DataFrame, y: str, replicated: DataFrame, yrep: str, bins: int, lo: float, hi: float, k: int = 100, draw: str = "draw", seed: object = 1, draw_ids: DataFrame | None = None) -> DataFrame:
    """Density of the observed outcome and of ``k`` replicated data sets.

    ``draw_ids`` lists the draws when they are known; otherwise they are read from the replicates.
    """
    ids = replicated.select(draw).distinct() if draw_ids is None else draw_ids.select(draw)
    chosen = sample_rows(ids, k, draw, seed)
    reps = histogram_table(replicated.join(chosen, draw), yrep, bins, lo, hi, by=[draw])
    obs = histogram_table(observed, y, bins, lo, hi)
    return union_by_name({"y": obs, "yrep": reps}, "source")


def ppc_counts(observed: DataFrame, y: str, replicated: DataFrame, yrep: str, draw: str = "draw") -> DataFrame:
    """Frequency of every value per draw, and in the sample."""
    rep = replicated.groupBy(draw, F.col(yrep).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    obs = observed.groupBy(F.col(y).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return union_by_name({"y": obs, "yrep": rep}, "source")

