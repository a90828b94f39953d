"""Area-level models on direct estimates with covariates."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from arealis.functions.rng import normal_sql, uniform_sql
from arealis.operators import area as ar
from arealis.operators import area_logit as al
from arealis.operators import design as dm
from arealis.operators import draws as dr
from arealis.operators.joins import with_covariates_keep
from arealis.plans import fixtures as fx
from arealis.plans.registry import query, rounded
from arealis.plans.survey_queries import smoothed
from arealis.session import materialise

NAMES = ["(Intercept)", "x"]


def terms():
    return [F.lit(1.0), F.col("x")]


def areas(spark, d, observed="l_partkey % 10 <> 3"):
    """Areas with a covariate; a tenth of them has no estimate unless ``observed`` is true."""
    s = fx.survey(spark, d).filter(observed).groupBy("segm").agg(F.avg("pobreza").alias("y"), F.count(F.lit(1)).alias("nd"))
    s = s.withColumns({"psi": (F.col("y") * (1 - F.col("y")) + 0.01) / F.col("nd"), "n_eff": F.col("nd") / 1.3})
    cov = fx.covariates(spark, d).select("segm", (F.col("p_size") / 50.0).alias("x"))
    return materialise(with_covariates_keep(cov, s, "segm"))


AREAS = """areas AS (SELECT segm, p_size/50.0 AS x, y, psi, nd, nd/1.3 AS n_eff FROM covariates LEFT JOIN
(SELECT segm, avg(pobreza) AS y, (avg(pobreza)*(1-avg(pobreza))+0.01)/count(*) AS psi, count(*) AS nd FROM survey WHERE l_partkey%10<>3 GROUP BY segm) USING (segm))"""

FIXED_S2 = 0.01
EBLUP = f"""ob AS (SELECT *, 1/({FIXED_S2}+psi) AS w FROM areas WHERE y IS NOT NULL),
sm AS (SELECT sum(w) AS s0, sum(w*x) AS s1, sum(w*x*x) AS s2, sum(w*y) AS t0, sum(w*x*y) AS t1, 2/sum(w*w) AS vs FROM ob),
co AS (SELECT *, s2/(s0*s2-s1*s1) AS c00, -s1/(s0*s2-s1*s1) AS c01, s0/(s0*s2-s1*s1) AS c11, (s2*t0-s1*t1)/(s0*s2-s1*s1) AS b0, (s0*t1-s1*t0)/(s0*s2-s1*s1) AS b1 FROM sm),
e AS (SELECT segm, y, psi, x, b0+b1*x AS xb, c00+2*c01*x+c11*x*x AS q, CASE WHEN y IS NULL THEN 0 ELSE {FIXED_S2}/({FIXED_S2}+psi) END AS gamma, vs FROM areas, co),
eb AS (SELECT segm, y, gamma, CASE WHEN y IS NULL THEN xb ELSE gamma*y+(1-gamma)*xb END AS theta, CASE WHEN y IS NULL THEN {FIXED_S2} ELSE gamma*psi END AS g1,
 pow(1-gamma,2)*q AS g2, CASE WHEN y IS NULL THEN 0 ELSE psi*psi/pow({FIXED_S2}+psi,3)*vs END AS g3 FROM e)"""


def _fixed(spark, d):
    a = areas(spark, d)
    return ar.eblup_table(a, ar.fh_eblup(a, "y", "psi", terms(), sigma2=FIXED_S2), "y", "psi", terms())


@query(
    "fh_eblup_fixed_variance",
    fx.ctes("survey", "covariates", extra=AREAS + ", " + EBLUP)
    + "SELECT segm, round(gamma,6) AS gamma, round(theta,6) AS theta, round(g1,8) AS g1, round(g2,8) AS g2, round(g3,8) AS g3, round(g1+g2+2*g3,8) AS mse FROM eb",
)
def fh_eblup_fixed_variance(spark, d):
    return rounded(_fixed(spark, d).select("segm", "gamma", "theta", "g1", "g2", "g3", "mse"), {"g1": 8, "g2": 8, "g3": 8, "mse": 8})


def reml_sql(steps: int = 60) -> str:
    """CTE chain ending in ``reml``: scoring steps for the area variance under the restricted likelihood, two coefficients."""
    parts = ["oy AS (SELECT * FROM areas WHERE y IS NOT NULL)", "r0 AS (SELECT CAST(0.01 AS DOUBLE) AS s2)"]
    for k in range(steps):
        sums = f"""SELECT s2, sum(w) AS a0, sum(w*x) AS a1, sum(w*x*x) AS a2, sum(w*y) AS u0, sum(w*x*y) AS u1, sum(w*w) AS b0, sum(w*w*x) AS b1, sum(w*w*x*x) AS b2,
 sum(w*w*y) AS v0, sum(w*w*x*y) AS v1, sum(w*w*y*y) AS yy FROM (SELECT oy.*, s2, 1/(s2+psi) AS w FROM oy, r{k}) GROUP BY s2"""
        solved = f"SELECT *, a0*a2-a1*a1 AS det, (a2*u0-a1*u1)/(a0*a2-a1*a1) AS c0, (a0*u1-a1*u0)/(a0*a2-a1*a1) AS c1 FROM ({sums})"
        score = "-0.5*(a0-(a2*b0-2*a1*b1+a0*b2)/det)+0.5*(yy-2*(c0*v0+c1*v1)+c0*c0*b0+2*c0*c1*b1+c1*c1*b2)"
        parts.append(f"r{k + 1} AS MATERIALIZED (SELECT greatest(s2+({score})/(0.5*b0), 0) AS s2 FROM ({solved}))")
    return ", ".join(parts) + f", reml AS (SELECT s2 FROM r{steps})"


@query(
    "fh_eblup_reml",
    fx.ctes("survey", "covariates", extra=AREAS.replace("areas AS (", "areas AS MATERIALIZED (") + ", " + reml_sql() + ", " + EBLUP.replace(str(FIXED_S2), "(SELECT s2 FROM reml)"))
    + "SELECT segm, round(theta,5) AS theta, round(g1+g2+2*g3,6) AS mse FROM eb",
)
def fh_eblup_reml(spark, d):
    a = areas(spark, d)
    return rounded(ar.eblup_table(a, ar.fh_eblup(a, "y", "psi", terms()), "y", "psi", terms()).select("segm", "theta", "mse"), {"theta": 5})


@query(
    "prediction_cv",
    fx.ctes("survey", "covariates", extra=AREAS + ", " + EBLUP)
    + 'SELECT segm, round(theta,6) AS theta, round(sqrt(g1+g2+2*g3),6) AS theta_sd, round(sqrt(g1+g2+2*g3)/theta,5) AS "Cv_pred" FROM eb',
)
def prediction_cv(spark, d):
    e = _fixed(spark, d).withColumn("theta_sd", F.sqrt("mse"))
    both = ar.observed_and_synthetic(e.filter("y IS NOT NULL").select("segm", "y", "theta", "theta_sd"), e.filter("y IS NULL").select("segm", "theta", "theta_sd"))
    return rounded(both.select("segm", "theta", "theta_sd", "Cv_pred"), {"Cv_pred": 5})


@query(
    "compare_direct_model",
    fx.ctes("survey", "covariates", extra=AREAS + ", " + EBLUP) + "SELECT segm, round(y,6) AS direct, round(theta,6) AS model FROM eb WHERE y IS NOT NULL",
)
def compare_direct_model(spark, d):
    return rounded(ar.compare_direct_model(_fixed(spark, d), "segm", "y"))


POINTS = 40
GRID = np.exp(np.linspace(np.log(1e-5), np.log(1.0), POINTS))


FIXED_GRID = f"g AS (SELECT exp(ln(0.00001)+i*(ln(1.0)-ln(0.00001))/{POINTS - 1}) AS v, i FROM (SELECT unnest(range(0,{POINTS})) AS i))"
FITTED_GRID = """g AS (SELECT exp(lo+i*(hi-lo)/199) AS v, i FROM (SELECT ln(m*0.0001) AS lo, ln(greatest(100*m,10*s)) AS hi FROM (SELECT quantile_disc(psi,0.5) AS m, var_samp(y) AS s FROM areas WHERE y IS NOT NULL)),
 (SELECT unnest(range(0,200)) AS i))"""


def _weights_sql(prior: str, arcsine: bool, grid: str) -> str:
    """CTE chain ending in ``wt``: weight, coefficients and sums at every point of the variance grid."""
    y, psi = ("asin(sqrt(y))", "1/(4*n_eff)") if arcsine else ("y", "psi")
    lp = {"inverse_gamma": "-(1.0001)*ln(v)-0.0001/v", "flat_sd": "-0.5*ln(v)"}[prior]
    return f"""z AS (SELECT segm, x, {y} AS z, {psi} AS vz, y IS NOT NULL AS seen FROM areas),
{grid},
sm AS (SELECT i, v, sum(1/(v+vz))+0.0001 AS s0, sum(x/(v+vz)) AS s1, sum(x*x/(v+vz))+0.0001 AS s2, sum(z/(v+vz)) AS t0, sum(x*z/(v+vz)) AS t1, sum(z*z/(v+vz)) AS yy, sum(ln(1/(v+vz))) AS lw
 FROM z, g WHERE seen GROUP BY i, v),
co AS (SELECT *, s0*s2-s1*s1 AS dt, (s2*t0-s1*t1)/(s0*s2-s1*s1) AS b0, (s0*t1-s1*t0)/(s0*s2-s1*s1) AS b1 FROM sm),
lg AS (SELECT *, 0.5*lw-0.5*(yy-t0*b0-t1*b1)-0.5*ln(dt)+({lp})+ln(v) AS lp FROM co),
wt AS (SELECT *, exp(lp-max(lp) OVER ())/sum(exp(lp-(SELECT max(lp) FROM lg))) OVER () AS w FROM lg)"""


def _grid_sql(prior: str, arcsine: bool, grid: str = FIXED_GRID) -> str:
    if arcsine:
        e1 = "0.5*(1-exp(-2*va)*cos(2*m))"
        e2 = "0.375-0.5*exp(-2*va)*cos(2*m)+0.125*exp(-8*va)*cos(4*m)"
    else:
        e1, e2 = "m", "va+m*m"
    return f"""{_weights_sql(prior, arcsine, grid)},
ga AS (SELECT z.*, w, b0+b1*x AS xb, (s2-2*s1*x+s0*x*x)/dt AS q, v, CASE WHEN seen THEN v/(v+vz) ELSE 0 END AS gm FROM z, wt),
mv AS (SELECT segm, seen, w, gm*coalesce(z,0)+(1-gm)*xb AS m, CASE WHEN seen THEN gm*vz ELSE v END+pow(1-gm,2)*q AS va FROM ga),
mo AS (SELECT segm, seen, sum(w*({e1})) AS e1, sum(w*({e2})) AS e2 FROM mv GROUP BY segm, seen)
SELECT segm, seen AS observed, round(e1,6) AS theta, round(sqrt(greatest(e2-e1*e1,0)),6) AS theta_sd FROM mo"""


@query("fh_normal", fx.ctes("survey", "covariates", extra=AREAS + ", " + _grid_sql("inverse_gamma", False)))
def fh_normal(spark, d):
    _, pred = ar.fh_normal(areas(spark, d), "y", "psi", terms(), grid=GRID)
    return rounded(pred.select("segm", "observed", "theta", "theta_sd"))


@query("fh_normal_flat_sd", fx.ctes("survey", "covariates", extra=AREAS + ", " + _grid_sql("flat_sd", False)))
def fh_normal_flat_sd(spark, d):
    _, pred = ar.fh_normal(areas(spark, d), "y", "psi", terms(), prior="flat_sd", grid=GRID)
    return rounded(pred.select("segm", "observed", "theta", "theta_sd"))


@query("fh_arcsine", fx.ctes("survey", "covariates", extra=AREAS + ", " + _grid_sql("inverse_gamma", True)))
def fh_arcsine(spark, d):
    _, pred = ar.fh_arcsine(areas(spark, d), "y", "n_eff", terms(), grid=GRID)
    return rounded(pred.select("segm", "observed", "theta", "theta_sd"))


@query("fh_normal_fitted_grid", fx.ctes("survey", "covariates", extra=AREAS + ", " + _grid_sql("inverse_gamma", False, FITTED_GRID)))
def fh_normal_fitted_grid(spark, d):
    """Grid chosen from the data, 200 points."""
    _, pred = ar.fh_normal(areas(spark, d), "y", "psi", terms())
    return rounded(pred.select("segm", "observed", "theta", "theta_sd"))


@query(
    "fh_normal_coefficients",
    fx.ctes("survey", "covariates", extra=AREAS.replace("l_partkey%10<>3", "true") + ", " + _weights_sql("inverse_gamma", False, FITTED_GRID))
    + """SELECT '(Intercept)' AS variable, round(sum(w*b0),6) AS mean, round(sqrt(sum(w*(s2/dt+b0*b0))-pow(sum(w*b0),2)),6) AS sd FROM wt
UNION ALL SELECT 'x', round(sum(w*b1),6), round(sqrt(sum(w*(s0/dt+b1*b1))-pow(sum(w*b1),2)),6) FROM wt
UNION ALL SELECT 'sigma2_v', round(sum(w*v),6), round(sqrt(greatest(sum(w*v*v)-pow(sum(w*v),2),0)),6) FROM wt""",
)
def fh_normal_coefficients(spark, d):
    return rounded(ar.fh_gaussian_fit(areas(spark, d, "true"), "y", "psi", terms()).summary(spark, NAMES))


AREA_DRAWS = 200


def _area_draws_sql(arcsine: bool) -> str:
    """Per area mean and deviation of draws: grid point by its weight, coefficients by the Cholesky factor, then the area."""
    value = "pow(sin(theta),2)" if arcsine else "theta"
    return f"""{grid_draws_sql(FIXED_GRID, AREA_DRAWS, arcsine)},
th AS (SELECT segm, draw, s2, vz, seen, coalesce(z,0) AS z, c0+c1*x AS xb, CASE WHEN seen THEN s2/(s2+vz) ELSE 0 END AS gm, {normal_sql("1.theta", "draw", "segm")} AS e FROM z, co2),
va AS (SELECT segm, gm*z+(1-gm)*xb+sqrt(CASE WHEN seen THEN gm*vz ELSE s2 END)*e AS theta FROM th)
SELECT segm, round(avg({value}),5) AS mean, round(stddev_samp({value}),5) AS sd FROM va GROUP BY segm"""


def grid_draws_sql(grid: str, draws: int, arcsine: bool = False) -> str:
    """CTE chain ending in ``co2``: variance and two coefficients of every draw."""
    return f"""{_weights_sql("inverse_gamma", arcsine, grid)},
pr AS (SELECT *, w/sum(w) OVER () AS wn FROM wt WHERE w > 0.000000000001*(SELECT max(w) FROM wt)),
cu AS (SELECT *, sum(wn) OVER (ORDER BY v) AS c, sqrt(s2/dt+0.00000000000001) AS l00 FROM pr),
ch AS (SELECT *, -s1/dt/l00 AS l10, sqrt(s0/dt+0.00000000000001-pow(s1/dt/l00,2)) AS l11, row_number() OVER (ORDER BY v)-1 AS k FROM cu),
dr AS (SELECT draw, {uniform_sql("1.g", "draw")} AS u, {normal_sql("1.0", "draw")} AS z0, {normal_sql("1.1", "draw")} AS z1 FROM (SELECT unnest(range(1,{draws + 1})) AS draw)),
pk AS (SELECT dr.*, least((SELECT count(*) FROM ch WHERE c < u), (SELECT count(*) FROM ch)-1) AS k FROM dr),
co2 AS (SELECT draw, ch.v AS s2, b0+l00*z0 AS c0, b1+l10*z0+l11*z1 AS c1 FROM pk JOIN ch USING (k))"""


@query("area_draws_normal", fx.ctes("survey", "covariates", extra=AREAS + ", " + _area_draws_sql(False)))
def area_draws_normal(spark, d):
    """Joint draws of all area parameters of the normal model, summarised per area."""
    a = areas(spark, d)
    fit = ar.fh_gaussian_fit(a, "y", "psi", terms(), grid=GRID)
    out = dr.area_draws(a, fit, "y", "psi", terms(), "segm", AREA_DRAWS)
    return rounded(out.groupBy("segm").agg(F.avg("value").alias("mean"), F.stddev("value").alias("sd")), 5)


@query("area_draws_arcsine", fx.ctes("survey", "covariates", extra=AREAS + ", " + _area_draws_sql(True)))
def area_draws_arcsine(spark, d):
    """The same on the arcsine scale, draws mapped back to proportions."""
    a = areas(spark, d).withColumns({"z": F.asin(F.sqrt("y")), "vz": 1 / (4 * F.col("n_eff"))})
    fit = ar.fh_gaussian_fit(a, "z", "vz", terms(), grid=GRID, link="arcsine")
    out = dr.area_draws(a, fit, "z", "vz", terms(), "segm", AREA_DRAWS)
    return rounded(out.groupBy("segm").agg(F.avg("value").alias("mean"), F.stddev("value").alias("sd")), 5)


@query("fh_binomial")
def fh_binomial(spark, d):
    a = areas(spark, d).withColumns({"n_eff_FGV": F.col("n_eff"), "pobreza": F.col("y")})
    _, pred = al.fh_binomial(dm.effective_counts(a).select("segm", "x", "y_effect", "n_effec"), "y_effect", "n_effec", terms())
    return rounded(pred.select("segm", "observed", "theta", "theta_sd"), 5)


@query("fh_beta")
def fh_beta(spark, d):
    a = areas(spark, d).withColumns({"n_eff_FGV": F.col("n_eff"), "pobreza": F.col("y")})
    _, pred = al.fh_beta(dm.effective_counts(a).select("segm", "x", "y", "phi"), "y", "phi", terms())
    return rounded(pred.select("segm", "observed", "theta", "theta_sd"), 5)


@query("area_poverty_map")
def area_poverty_map(spark, d):
    """Survey to map table: direct estimates, smoothed variances, effective counts, binomial model, classes."""
    from arealis.operators.geo import classify

    base = smoothed(spark, d).select("segm", "pobreza", "n_eff_FGV")
    cov = fx.covariates(spark, d).select("segm", (F.col("p_size") / 50.0).alias("x"))
    joined = materialise(cov.join(base, "segm", "left"))
    _, pred = al.fh_binomial(dm.effective_counts(joined).select("segm", "x", "pobreza", "y_effect", "n_effec"), "y_effect", "n_effec", terms())
    out = ar.prediction_cv(pred).withColumn("class", classify("theta", [0, 0.05, 0.1, 0.2, 0.4, 1]))
    return rounded(out.select("segm", "pobreza", "observed", "theta", "theta_sd", "Cv_pred", "class"), 5)
