"""Generalised variance function: smooth the sampling variances of direct estimates."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.recode import arcsine, nullif_zero
from arealis.operators.linalg import dot, least_squares, quadratic_form

TERMS = ("1", "p", "n", "n^2", "p*n", "sqrt(p)", "sqrt(n)", "sqrt(p*n)")


@dataclass(frozen=True)
class GvfFit:
    beta: np.ndarray
    scale: float
    inv: np.ndarray
    s2: float
    n: int


def sae_base(direct: DataFrame, area: str) -> DataFrame:
    """Accepted areas with the inputs of the area models."""
    return direct.filter(F.col("Flag") != "Excluir").select(
        area,
        F.col("n").alias("nd"),
        F.col("n_eff").alias("n_effec"),
        F.col("p").alias("pobreza"),
        arcsine("p").alias("pobreza_T"),
        (F.col("ee") * F.col("ee")).alias("vardir"),
        F.col("CV").alias("cv"),
        (1 / nullif_zero(4 * F.col("n_eff"))).alias("var_zd"),
        F.col("deff").alias("deff_area"),
    )


def gvf_terms(p: str = "pobreza", n: str = "nd") -> list[Column]:
    pc, nc = F.col(p).cast("double"), F.col(n).cast("double")
    return [F.lit(1.0), pc, nc, nc * nc, pc * nc, F.sqrt(pc), F.sqrt(nc), F.sqrt(pc * nc)]


def gvf_fit(base: DataFrame, p: str = "pobreza", n: str = "nd", var: str = "vardir") -> GvfFit:
    """Regress log variance on the size and level of the estimate, over areas with a positive variance.

    The scale brings the sum of the smoothed variances back to the sum of the raw ones.
    """
    used = base.filter(F.col(var) > 0)
    fit = least_squares(used, F.log(var), gvf_terms(p, n), refinements=2)
    row = used.agg(F.sum(var).alias("raw"), F.sum(F.exp(dot(gvf_terms(p, n), fit["beta"]))).alias("fitted")).first()
    return GvfFit(fit["beta"], row["raw"] / row["fitted"], fit["inv"], fit["s2"], fit["n"])


def gvf_predict(base: DataFrame, fit: GvfFit, p: str = "pobreza", n: str = "nd", var: str = "vardir") -> DataFrame:
    """Smoothed variance for every area with an estimate, each from its own features."""
    smooth = F.lit(fit.scale) * F.exp(dot(gvf_terms(p, n), fit.beta))
    ok = F.col(p).isNotNull() & F.col(var).isNotNull()
    return base.withColumn("hat_var", F.when(ok, smooth))


def gvf_deff(smoothed: DataFrame, n: str = "nd", var: str = "vardir", deff: str = "deff_area") -> DataFrame:
    """Design effect and effective size under the smoothed variance; the design effect is at least 1."""
    d = F.when(F.isnan(deff) | F.col(deff).isNull(), 1.0).otherwise(F.col(deff))
    raw = F.when(F.col(var) == 0, 1.0).otherwise(F.col("hat_var") / nullif_zero(F.col(var) / d))
    return smoothed.withColumn(deff, d).withColumn("deff_FGV", F.when(raw < 1, 1.0).otherwise(raw)).withColumn("n_eff_FGV", F.col(n) / F.col("deff_FGV"))


def gvf_diagnostics(base: DataFrame, fit: GvfFit, p: str = "pobreza", n: str = "nd", var: str = "vardir") -> DataFrame:
    """Fitted and observed log variance, residual, leverage and standardised residual."""
    terms = gvf_terms(p, n)
    out = base.filter(F.col(var) > 0).withColumns(
        {"observed": F.log(var), "fitted": dot(terms, fit.beta), "leverage": quadratic_form(terms, fit.inv)}
    )
    out = out.withColumn("residual", F.col("observed") - F.col("fitted"))
    scale = F.sqrt(F.lit(fit.s2) * (1 - F.col("leverage")))
    return out.withColumn("std_residual", F.when(F.col("leverage") < 1, F.col("residual") / scale))
