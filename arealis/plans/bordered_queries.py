"""Models with one effect per level of a wide factor: areas as people's factor, municipalities as areas' factor."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from arealis.operators import bordered as bd
from arealis.plans import fixtures as fx
from arealis.plans.area_queries import areas
from arealis.plans.registry import query, rounded

MUNICIPALITIES = 150


def people(spark, d):
    s = fx.survey(spark, d)
    return s.select("segm", "upm", "pobreza", F.log1p("ingreso").alias("y"), (F.col("sexo") == "2").cast("double").alias("x0"), F.col("empleo").cast("double").alias("x1"))


PEOPLE = "people AS (SELECT segm, upm, pobreza, ln(ingreso+1) AS y, CAST(sexo='2' AS DOUBLE) AS x0, CAST(empleo AS DOUBLE) AS x1 FROM survey)"
WITHIN = """bl AS (SELECT segm, CAST(count(*) AS DOUBLE) AS d, sum(y) AS t, sum(x0) AS s0, sum(x1) AS s1, sum(x0*x0) AS e00, sum(x0*x1) AS e01, sum(x1*x1) AS e11, sum(x0*y) AS r0, sum(x1*y) AS r1, sum(y*y) AS yy FROM people GROUP BY segm),
sc AS (SELECT sum(e00-s0*s0/d) AS a, sum(e01-s0*s1/d) AS b, sum(e11-s1*s1/d) AS c, sum(r0-s0*t/d) AS u, sum(r1-s1*t/d) AS v, sum(yy-t*t/d) AS w, sum(d) AS n, count(*) AS levels FROM bl),
co AS (SELECT *, (c*u-b*v)/(a*c-b*b) AS b0, (a*v-b*u)/(a*c-b*b) AS b1 FROM sc),
va AS (SELECT *, (w-b0*u-b1*v)/(n-2-levels) AS s2, a*c-b*b AS det FROM co)"""


@query(
    "linear_model_wide_factor",
    fx.ctes("survey", extra=f"{PEOPLE}, {WITHIN}")
    + """SELECT segm AS variable, round(t/d-s0/d*b0-s1/d*b1,6) AS mean, round(sqrt(s2*(1/d+(c*s0*s0-2*b*s0*s1+a*s1*s1)/(d*d*det))),6) AS sd FROM bl, va
UNION ALL SELECT 'x0', round(b0,6), round(sqrt(s2*c/det),6) FROM va UNION ALL SELECT 'x1', round(b1,6), round(sqrt(s2*a/det),6) FROM va""",
)
def linear_model_wide_factor(spark, d):
    """Log income on sex and employment with one effect per area."""
    fit = bd.linear_with_factor(people(spark, d), "y", {c: F.col(c) for c in ("x0", "x1")}, "segm")
    dense = spark.createDataFrame([(n, float(m), float(s)) for n, m, s in zip(fit.names, fit.beta, fit.sd)], "variable string, mean double, sd double")
    return rounded(fit.effects.select(F.col("level").alias("variable"), F.col("effect").alias("mean"), F.col("effect_sd").alias("sd")).unionByName(dense))


TAU = 10.0


@query("logistic_wide_factor", fx.ctes("survey", extra=PEOPLE) + "SELECT segm, count(*) AS n, round(CAST(sum(pobreza) AS DOUBLE),5) AS total FROM people GROUP BY segm")
def logistic_wide_factor(spark, d):
    """Poverty on sex with one effect per area: at the mode, fitted totals of an area miss the observed ones by the prior's pull alone."""
    p, xs = people(spark, d), {"x0": F.col("x0")}
    fit = bd.binomial_with_factor(p, "pobreza", None, xs, "segm", tau=TAU)
    fitted = bd.predict_with_factor(p, fit, xs, "segm").groupBy("segm").agg(F.count(F.lit(1)).alias("n"), F.sum(1 / (1 + F.exp(-F.col("eta")))).alias("total"))
    pull = fitted.join(fit.effects, F.col("segm") == F.col("level")).withColumn("total", F.col("total") + F.col("effect") / TAU**2)
    return rounded(pull.select("segm", "n", "total"), 5)


@query(
    "linear_model_two_factors",
    fx.ctes("survey", extra=PEOPLE) + "SELECT 'segm' AS factor, segm AS level, round(sum(y),4) AS total FROM people GROUP BY segm UNION ALL SELECT 'upm', CAST(upm AS VARCHAR), round(sum(y),4) FROM people GROUP BY upm",
)
def linear_model_two_factors(spark, d):
    """Log income on sex, areas and sampling units: the normal equations say that fitted totals of every level are the observed ones."""
    p, xs = people(spark, d), {"x0": F.col("x0")}
    fit = bd.linear_with_factors(p, "y", xs, ["segm", "upm"], tol=1e-12)
    both = p.select("segm", F.col("upm").cast("string").alias("upm"), "x0")
    for f in ("segm", "upm"):
        both = both.join(fit.effects.where(F.col("factor") == f).select(F.col("level").alias(f), F.col("effect").alias(f"e_{f}")), f)
    both = both.withColumn("fitted", F.col("x0") * float(fit.beta[0]) + F.col("e_segm") + F.col("e_upm"))
    ridge = 1e-8
    parts = [both.groupBy(F.lit(f).alias("factor"), F.col(f).alias("level")).agg((F.sum("fitted") + ridge * F.first(f"e_{f}")).alias("total")) for f in ("segm", "upm")]
    return rounded(parts[0].unionByName(parts[1]), 4)


POINTS = 40
GRID = np.exp(np.linspace(np.log(1e-5), np.log(1.0), POINTS))
PRIOR = 1e-4  # 1 / tau^2
STEP = f"(ln(1.0)-ln(0.00001))/{POINTS - 1}"
GRID_SQL = f"""z AS (SELECT segm, x, y, psi, y IS NOT NULL AS seen, CAST(split_part(segm,'-',2) AS BIGINT)%{MUNICIPALITIES} AS m FROM areas),
g AS (SELECT i, exp(ln(0.00001)+i*{STEP}) AS v FROM (SELECT unnest(range(0,{POINTS})) AS i)),
bl AS (SELECT i, v, m, sum(1/(v+psi))+{PRIOR} AS d, sum(x/(v+psi)) AS s, sum(y/(v+psi)) AS t, sum(x*x/(v+psi)) AS e, sum(x*y/(v+psi)) AS r, sum(y*y/(v+psi)) AS yy, sum(ln(1/(v+psi))) AS lw FROM z, g WHERE seen GROUP BY i, v, m),
sc AS (SELECT i, v, sum(e-s*s/d)+{PRIOR} AS a, sum(r-s*t/d) AS u, sum(yy-t*t/d) AS w, sum(ln(d)) AS ld, sum(lw) AS lw FROM bl GROUP BY i, v),
lg AS (SELECT *, u/a AS b, 0.5*lw-0.5*(w-u*u/a)-0.5*(ln(a)+ld)-1.0001*ln(v)-0.0001/v+ln(v) AS lp FROM sc),
wt AS (SELECT *, exp(lp-(SELECT max(lp) FROM lg)) AS w0 FROM lg),
wn AS (SELECT *, w0/sum(w0) OVER () AS wg FROM wt),
ga AS (SELECT segm, seen, y, psi, wg, wn.v, b, a, CASE WHEN seen THEN wn.v/(wn.v+psi) ELSE 0 END AS gm, coalesce(t/d,0) AS m0, coalesce(1/d,1/{PRIOR}) AS vl, x-coalesce(s/d,0) AS gap
 FROM z CROSS JOIN wn LEFT JOIN bl ON bl.i=wn.i AND bl.m=z.m),
mv AS (SELECT segm, seen, wg, gm*coalesce(y,0)+(1-gm)*(m0+gap*b) AS mu, CASE WHEN seen THEN gm*psi ELSE v END+pow(1-gm,2)*(vl+gap*gap/a) AS va FROM ga)
SELECT segm, seen AS observed, round(sum(wg*mu),6) AS theta, round(sqrt(greatest(sum(wg*(va+mu*mu))-pow(sum(wg*mu),2),0)),5) AS theta_sd FROM mv GROUP BY segm, seen"""


@query("fh_normal_wide_factor", fx.ctes("survey", "covariates", extra=f"""areas AS (SELECT segm, p_size/50.0 AS x, y, psi FROM covariates LEFT JOIN
(SELECT segm, avg(pobreza) AS y, (avg(pobreza)*(1-avg(pobreza))+0.01)/count(*) AS psi FROM survey WHERE l_partkey%10<>3 GROUP BY segm) USING (segm)), {GRID_SQL}"""))
def fh_normal_wide_factor(spark, d):
    """Area model with one effect per municipality, of which there are more than areas of some of them."""
    a = areas(spark, d).withColumn("m", (F.split_part("segm", F.lit("-"), F.lit(2)).cast("long") % MUNICIPALITIES).cast("string"))
    _, pred = bd.fh_normal_with_factor(a, "y", "psi", {"x": F.col("x")}, "m", grid=GRID)
    return rounded(pred.select("segm", "observed", "theta", "theta_sd"), {"theta_sd": 5})
