"""Conjugate posteriors, regressions, mixed models, draws and post-stratification."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from arealis.functions.recode import clamp_negative
from arealis.functions.rng import normal_sql, uniform_sql
from arealis.operators import area as ar
from arealis.operators import cells as ce
from arealis.operators import conjugate as cj
from arealis.operators import draws as dr
from arealis.operators import glm
from arealis.operators import mixed as mx
from arealis.operators import mrp
from arealis.plans import fixtures as fx
from arealis.plans.area_queries import AREAS, FITTED_GRID, NAMES, areas, grid_draws_sql, terms
from arealis.plans.registry import query, rounded

# ---------------------------------------------------------------- conjugate


def _beta_sql(by: str, a: float, b: float) -> str:
    g = f"{by}, " if by else ""
    return (
        fx.ctes("survey")
        + f"""SELECT {g}CAST(count(pobreza) AS DOUBLE) AS n, CAST(sum(pobreza) AS DOUBLE) AS s, {a}+sum(pobreza) AS alpha, {b}+count(pobreza)-sum(pobreza) AS beta,
round(({a}+sum(pobreza))/({a}+{b}+count(pobreza)),6) AS mean, round(({a}+sum(pobreza))*({b}+count(pobreza)-sum(pobreza))/(pow({a}+{b}+count(pobreza),2)*({a}+{b}+count(pobreza)+1)),8) AS var
FROM survey {'GROUP BY ' + by if by else ''}"""
    ).replace(f"{a}+sum", f"CAST({a} AS DOUBLE)+sum").replace(f"{b}+count", f"CAST({b} AS DOUBLE)+count")


@query("beta_binomial_by_area", _beta_sql("segm", 1.0, 1.0))
def beta_binomial_by_area(spark, d):
    return rounded(cj.beta_binomial_posterior(fx.survey(spark, d), "pobreza", ["segm"]), {"var": 8})


@query("beta_binomial_pooled", _beta_sql("", 0.5, 0.5))
def beta_binomial_pooled(spark, d):
    counts = fx.survey(spark, d).groupBy("mpio").agg(F.sum("pobreza").alias("y"), F.count(F.lit(1)).alias("trials"))
    return rounded(cj.beta_binomial_posterior(counts, "y", a=0.5, b=0.5, trials="trials"), {"var": 8})


# with whole parameters the beta distribution function is a binomial tail; its root is bisected
BETA_TAIL = "list_sum(list_transform(range(a, a+b), lambda k: exp(lgamma(a+b)-lgamma(k+1)-lgamma(a+b-k)+k*ln(x)+(a+b-1-k)*ln(1-x))))"


@query(
    "beta_interval",
    fx.ctes(
        "survey",
        extra=f"""ps AS (SELECT segm, CAST(1+sum(pobreza) AS BIGINT) AS a, CAST(1+count(*)-sum(pobreza) AS BIGINT) AS b FROM survey GROUP BY segm),
bs AS (SELECT segm, a, b, q, 0 AS step, CAST(0 AS DOUBLE) AS lo, CAST(1 AS DOUBLE) AS hi, CAST(0.5 AS DOUBLE) AS x FROM ps, (SELECT unnest([0.025, 0.975]) AS q)
UNION ALL SELECT segm, a, b, q, step+1, CASE WHEN p<q THEN x ELSE lo END, CASE WHEN p<q THEN hi ELSE x END, CASE WHEN p<q THEN (x+hi)/2 ELSE (lo+x)/2 END FROM (SELECT *, {BETA_TAIL} AS p FROM bs WHERE step<45))""",
    ).replace("WITH ", "WITH RECURSIVE ", 1)
    + "SELECT segm, round(CAST(max(a) AS DOUBLE)/(max(a)+max(b)),6) AS mean, round(max(x) FILTER (q<0.5),6) AS low, round(max(x) FILTER (q>0.5),6) AS high FROM bs WHERE step=45 GROUP BY segm",
)
def beta_interval(spark, d):
    post = cj.beta_binomial_posterior(fx.survey(spark, d), "pobreza", ["segm"])
    return rounded(cj.beta_interval(post, 0.95).select("segm", "mean", "low", "high"))


@query(
    "beta_density",
    fx.ctes("survey")
    + """, p AS (SELECT mpio, 1.0+sum(pobreza) AS a, 1.0+count(*)-sum(pobreza) AS b FROM survey GROUP BY mpio),
g AS (SELECT mpio, a, b, (i-0.5)/200 AS theta FROM p, (SELECT unnest(range(1,201)) AS i)),
k AS (SELECT mpio, theta, exp((a-1)*ln(theta)+(b-1)*ln(1-theta)-(CASE WHEN a>1 AND b>1 THEN (a-1)*ln((a-1)/(a+b-2))+(b-1)*ln((b-1)/(a+b-2)) ELSE 0 END)) AS k FROM g)
SELECT mpio, round(theta,6) AS theta, round(k/(sum(k) OVER (PARTITION BY mpio)/200),5) AS density FROM k""",
)
def beta_density(spark, d):
    post = cj.beta_binomial_posterior(fx.survey(spark, d), "pobreza", ["mpio"])
    return rounded(cj.beta_density(post, ["mpio"]), {"density": 5})


@query(
    "normal_posterior_known_var",
    fx.ctes("survey")
    + "SELECT segm, n, round(ybar,6) AS ybar, round(n/s2*ybar/(n/s2+0.000001),6) AS mu_n, round(1/(n/s2+0.000001),6) AS tau2_n FROM (SELECT segm, count(*) AS n, avg(ln(ingreso+1)) AS ybar, var_samp(ln(ingreso+1)) AS s2 FROM survey GROUP BY segm)",
)
def normal_posterior_known_var(spark, d):
    s = fx.survey(spark, d).withColumn("y", F.log1p("ingreso"))
    return rounded(cj.normal_posterior_known_var(s, "y", ["segm"], 0.0, 1e6))


UNKNOWN = """st AS (SELECT mpio, CAST(count(*) AS DOUBLE) AS n, avg(ln(ingreso+1)) AS ybar, var_samp(ln(ingreso+1)) AS s2 FROM survey GROUP BY mpio),
gr AS (SELECT st.*, ln(s2)-8*sqrt(2/n)+2*8*sqrt(2/n)*i/199.0 AS t FROM st, (SELECT unnest(range(0,200)) AS i)),
lp AS (SELECT mpio, n, exp(t) AS v, (n/exp(t)*ybar)/(n/exp(t)+0.000001) AS m, 1/(n/exp(t)+0.000001) AS s,
 -n/2*t-(n-1)*s2/(2*exp(t))-0.5*ln(1+n*1000000/exp(t))-0.5*ybar*ybar/(1000000+exp(t)/n)-1.001*t-0.001/exp(t)+t AS lp FROM gr),
ww AS (SELECT *, exp(lp-max(lp) OVER (PARTITION BY mpio)) AS w FROM lp),
mm AS (SELECT mpio, n, sum(w*m)/sum(w) AS tm, sum(w*(s+m*m))/sum(w) AS t2, sum(w*v)/sum(w) AS vm, sum(w*v*v)/sum(w) AS v2 FROM ww GROUP BY mpio, n)"""


@query(
    "normal_posterior_unknown_var",
    fx.ctes("survey", extra=UNKNOWN)
    + "SELECT mpio, n, round(tm,6) AS theta_mean, round(sqrt(greatest(t2-tm*tm,0)),5) AS theta_sd, round(vm,6) AS sigma2_mean, round(sqrt(greatest(v2-vm*vm,0)),5) AS sigma2_sd FROM mm",
)
def normal_posterior_unknown_var(spark, d):
    s = fx.survey(spark, d).withColumn("y", F.log1p("ingreso"))
    return rounded(cj.normal_posterior_unknown_var(s, "y", ["mpio"], 0.0, 1e6), {"theta_sd": 5, "sigma2_sd": 5})


@query(
    "dirichlet_posterior",
    fx.ctes("survey")
    + """, c AS (SELECT mpio, count(*) FILTER (empleo=1) AS y1, count(*) FILTER (empleo=2) AS y2, count(*) FILTER (empleo=3) AS y3, count(*)+3.0 AS t FROM survey GROUP BY mpio),
u AS (SELECT mpio, '1' AS category, y1 AS y, y1+1.0 AS a, t FROM c UNION ALL SELECT mpio, '2', y2, y2+1.0, t FROM c UNION ALL SELECT mpio, '3', y3, y3+1.0, t FROM c UNION ALL SELECT mpio, 'delta', y1+y2, y1+y2+2.0, t FROM c)
SELECT mpio, category, y, round(a/t,6) AS mean, round(a/t*(1-a/t)/(t+1),8) AS var FROM u""",
)
def dirichlet_posterior(spark, d):
    return rounded(cj.dirichlet_posterior(fx.survey(spark, d), "empleo", {1: 1.0, 2: 1.0, 3: 1.0}, ["mpio"], delta=[1, 2]), {"var": 8})


@query(
    "gamma_poisson_posterior",
    fx.ctes("survey")
    + """SELECT mpio, count(*) AS n, 38+sum(y) AS shape, CAST(9+count(*) AS DOUBLE) AS rate, round((38+sum(y))/(9+count(*)),6) AS mean, round((38+sum(y))/pow(9+count(*),2),6) AS var
FROM (SELECT mpio, segm, CAST(sum(pobreza) AS DOUBLE) AS y FROM survey GROUP BY mpio, segm) GROUP BY mpio""",
)
def gamma_poisson_posterior(spark, d):
    counts = fx.survey(spark, d).groupBy("mpio", "segm").agg(F.sum("pobreza").alias("y"))
    return rounded(cj.gamma_poisson_posterior(counts, "y", ["mpio"]))


# ---------------------------------------------------------------- regressions


def _log_survey(spark, d):
    return fx.survey(spark, d).withColumns({"ly": F.log1p("ingreso"), "q": F.col("fep") / 10.0, "woman": (F.col("sexo") == "2").cast("double")})


@query(
    "linear_model_ols",
    fx.ctes("survey", extra="r AS (SELECT ln(ingreso+1) AS y, fep/10 AS x FROM survey), f AS (SELECT regr_slope(y,x) AS b1, regr_intercept(y,x) AS b0, avg(x) AS mx, regr_sxx(y,x) AS sxx, count(*) AS n FROM r), e AS (SELECT sum(pow(y-b0-b1*x,2))/(max(n)-2) AS s2 FROM r, f)")
    + "SELECT '(Intercept)' AS variable, round(b0,6) AS mean, round(sqrt(s2*(1.0/n+mx*mx/sxx)),6) AS sd FROM f, e UNION ALL SELECT 'q', round(b1,6), round(sqrt(s2/sxx),6) FROM f, e",
)
def linear_model_ols(spark, d):
    fit = glm.ols(_log_survey(spark, d), "ly", [F.lit(1.0), F.col("q")], ["(Intercept)", "q"])
    return rounded(fit.table(spark).filter("variable <> 'sigma2'"))


BAYES = """r AS (SELECT ln(ingreso+1) AS y, fep/10 AS x, CAST(sexo='2' AS DOUBLE) AS z FROM survey),
m AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(x) AS x1, sum(z) AS z1, sum(x*x) AS xx, sum(x*z) AS xz, sum(z*z) AS zz, sum(y) AS y1, sum(x*y) AS xy, sum(z*y) AS zy, sum(y*y) AS yy FROM r),
o AS (SELECT *, n*(xx*zz-xz*xz)-x1*(x1*zz-xz*z1)+z1*(x1*xz-xx*z1) AS det FROM m),
e AS (SELECT *, ((xx*zz-xz*xz)*y1+(z1*xz-x1*zz)*xy+(x1*xz-z1*xx)*zy)/det AS f0, ((xz*z1-x1*zz)*y1+(n*zz-z1*z1)*xy+(z1*x1-n*xz)*zy)/det AS f1, ((x1*xz-xx*z1)*y1+(x1*z1-n*xz)*xy+(n*xx-x1*x1)*zy)/det AS f2 FROM o),
f AS (SELECT sum(pow(y-f0-f1*x-f2*z,2)) AS rss FROM r, e),
g AS (SELECT m.*, rss, ln(rss/(n-3))+8*sqrt(2/n)*(2*i/199.0-1) AS t FROM m, f, (SELECT unnest(range(0,200)) AS i)),
a AS (SELECT *, exp(t) AS v, n/exp(t)+0.000001 AS a, x1/exp(t) AS b, z1/exp(t) AS c, xx/exp(t)+0.000001 AS d, xz/exp(t) AS h, zz/exp(t)+0.000001 AS k, y1/exp(t) AS p, xy/exp(t) AS q, zy/exp(t) AS s FROM g),
i AS (SELECT *, a*(d*k-h*h)-b*(b*k-h*c)+c*(b*h-d*c) AS dt FROM a),
j AS (SELECT *, ((d*k-h*h)*p+(c*h-b*k)*q+(b*h-c*d)*s)/dt AS b0, ((h*c-b*k)*p+(a*k-c*c)*q+(c*b-a*h)*s)/dt AS b1, ((b*h-d*c)*p+(b*c-a*h)*q+(a*d-b*b)*s)/dt AS b2, (d*k-h*h)/dt AS c0, (a*k-c*c)/dt AS c1, (a*d-b*b)/dt AS c2 FROM i),
l AS (SELECT *, -n/2*t-0.5*(yy/v-p*b0-q*b1-s*b2)-0.5*ln(dt)-1.0001*t-0.0001/v+t AS lp FROM j),
w AS (SELECT *, exp(lp-(SELECT max(lp) FROM l)) AS w0 FROM l), u AS (SELECT *, w0/sum(w0) OVER () AS w FROM w)"""


@query(
    "linear_model_bayes",
    fx.ctes("survey", extra=BAYES)
    + " UNION ALL ".join(
        f"SELECT '{name}' AS variable, round(sum(w*{b}),6) AS mean, round(sqrt(greatest(sum(w*({c}+{b}*{b}))-pow(sum(w*{b}),2),0)),6) AS sd FROM u"
        for name, b, c in (("(Intercept)", "b0", "c0"), ("q", "b1", "c1"), ("woman", "b2", "c2"), ("sigma2", "v", "0"))
    ),
)
def linear_model_bayes(spark, d):
    fit = glm.linear_model(_log_survey(spark, d), "ly", [F.lit(1.0), F.col("q"), F.col("woman")], ["(Intercept)", "q", "woman"])
    return rounded(fit.table(spark))


@query(
    "linear_model_conjugate",
    fx.ctes("survey", extra="""r AS (SELECT ln(ingreso+1) AS y, fep/10 AS x FROM survey),
m AS (SELECT count(*) AS n, count(*)+0.0001 AS a, sum(x) AS b, sum(x*x)+0.0001 AS c, sum(y) AS u, sum(x*y) AS v, sum(y*y) AS yy FROM r),
k AS (SELECT *, a*c-b*b AS det, (c*u-b*v)/(a*c-b*b) AS b0, (a*v-b*u)/(a*c-b*b) AS b1 FROM m), f AS (SELECT *, (2+yy-b0*u-b1*v)/n AS s2 FROM k)""")
    + "SELECT '(Intercept)' AS variable, round(b0,6) AS mean, round(sqrt(s2*c/det),6) AS sd FROM f UNION ALL SELECT 'q', round(b1,6), round(sqrt(s2*a/det),6) FROM f UNION ALL SELECT 'sigma2', round(s2,6), NULL FROM f",
)
def linear_model_conjugate(spark, d):
    r = glm.linear_model_conjugate(_log_survey(spark, d), "ly", [F.lit(1.0), F.col("q")], np.zeros(2), np.eye(2) * 1e4, 2.0, 1.0)
    rows = [(n, float(m), float(np.sqrt(v))) for n, m, v in zip(["(Intercept)", "q"], r["bq"], np.diag(r["beta_cov"]))]
    return rounded(spark.createDataFrame([*rows, ("sigma2", r["sigma2_mean"], None)], "variable string, mean double, sd double"))



def sex_terms():
    return {"(Intercept)": F.lit(1.0), "woman": (F.col("sexo") == "2").cast("double")}


@query(
    "logistic_model",
    fx.ctes("survey")
    + """, c AS (SELECT sum(pobreza) FILTER (sexo='1') AS y0, count(*) FILTER (sexo='1') AS n0, sum(pobreza) FILTER (sexo='2') AS y1, count(*) FILTER (sexo='2') AS n1 FROM survey)
SELECT '(Intercept)' AS variable, round(ln(y0/(n0-y0)),5) AS mean, round(sqrt(1/y0+1/(n0-y0)),5) AS sd FROM c UNION ALL
SELECT 'woman', round(ln(y1/(n1-y1))-ln(y0/(n0-y0)),5), round(sqrt(1/y0+1/(n0-y0)+1/y1+1/(n1-y1)),5) FROM c""",
)
def logistic_model(spark, d):
    return rounded(glm.logistic_model(fx.survey(spark, d), "pobreza", sex_terms()).table(spark), 5)


@query(
    "binomial_model",
    fx.ctes("survey")
    + """, c AS (SELECT sum(ipm_agua) FILTER (sexo='1') AS y0, count(*) FILTER (sexo='1') AS n0, sum(ipm_agua) FILTER (sexo='2') AS y1, count(*) FILTER (sexo='2') AS n1 FROM survey)
SELECT '(Intercept)' AS variable, round(ln(y0/(n0-y0)),5) AS mean, round(sqrt(1/y0+1/(n0-y0)),5) AS sd FROM c UNION ALL
SELECT 'woman', round(ln(y1/(n1-y1))-ln(y0/(n0-y0)),5), round(sqrt(1/y0+1/(n0-y0)+1/y1+1/(n1-y1)),5) FROM c""",
)
def binomial_model(spark, d):
    counts = fx.survey(spark, d).groupBy("segm", "sexo").agg(F.sum("ipm_agua").alias("y"), F.count(F.lit(1)).alias("n"))
    return rounded(glm.binomial_model(counts, "y", "n", sex_terms()).table(spark), 5)


@query(
    "multinomial_model",
    fx.ctes("survey")
    + """, c AS (SELECT k, count(*) FILTER (sexo='1' AND empleo=1) AS r0, count(*) FILTER (sexo='1' AND empleo=k) AS y0, count(*) FILTER (sexo='2' AND empleo=1) AS r1, count(*) FILTER (sexo='2' AND empleo=k) AS y1
FROM survey, (SELECT unnest([2,3]) AS k) GROUP BY k)
SELECT concat('empleo_',CAST(k AS VARCHAR),':(Intercept)') AS variable, round(ln(y0/r0),5) AS mean, round(sqrt(1/y0+1/r0),5) AS sd FROM c UNION ALL
SELECT concat('empleo_',CAST(k AS VARCHAR),':woman'), round(ln(y1/r1)-ln(y0/r0),5), round(sqrt(1/y0+1/r0+1/y1+1/r1),5) FROM c""",
)
def multinomial_model(spark, d):
    counts = ce.collapse_multinomial(fx.survey(spark, d), ["segm", "sexo"], "empleo", [1, 2, 3])
    return rounded(glm.multinomial_model(counts, ["empleo_1", "empleo_2", "empleo_3"], sex_terms(), tau=1e5).table(spark), 5)


@query("multinomial_probabilities")
def multinomial_probabilities(spark, d):
    counts = ce.collapse_multinomial(fx.survey(spark, d), ["sexo", "edad"], "empleo", [1, 2, 3])
    xs = cell_terms()
    fit = glm.multinomial_model(counts, ["empleo_1", "empleo_2", "empleo_3"], xs)
    return rounded(glm.predict_probabilities(counts, fit, xs, 3))


# ---------------------------------------------------------------- mixed models


def _income_cells(spark, d, observed="l_partkey % 10 <> 3"):
    """Survey cells of the observed areas with mean log income and count."""
    s = _log_survey(spark, d).filter(observed)
    return ce.collapse_mean(s, ["segm", "sexo", "edad"], "ly")



def cell_terms():
    return {**sex_terms(), **{f"edad{k}": (F.col("edad") == k).cast("double") for k in "2345"}}


@query("group_intercept_model")
def group_intercept_model(spark, d):
    _, effects = mx.group_intercept_model(_log_survey(spark, d), "ly", {"woman": F.col("woman"), "q": F.col("q")}, "segm")
    return rounded(effects)


@query("random_intercept_model")
def random_intercept_model(spark, d):
    fit, _ = mx.random_intercept_model(_income_cells(spark, d, "true"), "ly", cell_terms(), "segm", "n")
    return rounded(fit.table(spark), 5)


RATIO_POINTS = 81
RATIOS = np.exp(np.linspace(np.log(1e-8), np.log(1e4), RATIO_POINTS))
RATIO_SQL = f"""gs AS (SELECT segm, CAST(count(*) AS DOUBLE) AS s, sum(ln(ingreso+1)-10) AS sy, sum(pow(ln(ingreso+1)-10,2)) AS yy FROM survey GROUP BY segm),
tt AS (SELECT sum(s) AS n, sum(sy) AS ty, sum(yy) AS tyy FROM gs),
gr AS (SELECT exp(ln(0.00000001)+i*(ln(10000.0)-ln(0.00000001))/{RATIO_POINTS - 1}) AS lam FROM (SELECT unnest(range(0,{RATIO_POINTS})) AS i)),
el AS (SELECT lam, sum(lam/(1+lam*s)*s*s) AS a, sum(lam/(1+lam*s)*s*sy) AS b, sum(lam/(1+lam*s)*sy*sy) AS q, sum(ln(1+lam*s)) AS ld FROM gs, gr GROUP BY lam),
so AS (SELECT *, n-a AS d, (ty-b)/(n-a) AS m, tyy-q-(ty-b)*(ty-b)/(n-a) AS rss FROM el, tt),
lg AS (SELECT *, -0.5*((n-1)*ln(rss)+ld+ln(d))-ln(1+lam)+0.5*ln(lam) AS lp FROM so),
wt AS (SELECT *, exp(lp-(SELECT max(lp) FROM lg))/(SELECT sum(exp(lp-(SELECT max(lp) FROM lg))) FROM lg) AS w FROM lg)"""


@query(
    "random_intercept_posterior",
    fx.ctes("survey", extra=RATIO_SQL)
    + """SELECT '(Intercept)' AS variable, round(sum(w*m),5) AS mean, round(sqrt(sum(w*(rss/(n-3)/d+m*m))-pow(sum(w*m),2)),5) AS sd FROM wt
UNION ALL SELECT 'sigma2_e', round(sum(w*rss/(n-3)),5), round(sqrt(sum(w*rss*rss/((n-3)*(n-5)))-pow(sum(w*rss/(n-3)),2)),5) FROM wt
UNION ALL SELECT 'sigma2_u', round(sum(w*lam*rss/(n-3)),5), round(sqrt(sum(w*lam*lam*rss*rss/((n-3)*(n-5)))-pow(sum(w*lam*rss/(n-3)),2)),5) FROM wt""",
)
def random_intercept_posterior(spark, d):
    """Variances of log income between and within areas with their uncertainty."""
    s = fx.survey(spark, d).select("segm", (F.log1p("ingreso") - 10).alias("y"))
    fit, _ = mx.random_intercept_posterior(s, "y", {"(Intercept)": F.lit(1.0)}, "segm", grid=RATIOS)
    return rounded(fit.table(spark), 5)


@query("predict_epred")
def predict_epred(spark, d):
    """Expected log income per census cell; a tenth of the areas was not in the sample."""
    fit, effects = mx.random_intercept_model(_income_cells(spark, d), "ly", cell_terms(), "segm", "n")
    cells = ce.collapse(fx.census(spark, d), ["segm", "mpio", "sexo", "edad"], "n")
    out = mx.predict_epred(cells, fit, effects, cell_terms(), "segm")
    return rounded(out.select("segm", "sexo", "edad", "n", "new_group", "epred", "epred_sd"), 5)


@query("income_poststratified")
def income_poststratified(spark, d):
    """Draws of expected income in poverty lines, negative values set to zero, averaged over census cells."""
    s = fx.survey(spark, d).filter("l_partkey % 10 <> 3")
    fit, effects = mx.random_intercept_posterior(ce.collapse_mean(s, ["segm", "sexo", "edad"], "ingreso"), "ingreso", cell_terms(), "segm", "n")
    cells = ce.collapse(fx.census(spark, d), ["segm", "mpio", "sexo", "edad"], "n").withColumn("cell_id", ce.cell_id("segm", "sexo", "edad"))
    e = mx.packed_posterior_draws(cells, fit, effects, cell_terms(), "segm", "cell_id", 100, seed=3, keep=["mpio", "n"])
    e = e.withColumn("value", F.transform("value", lambda v: clamp_negative(v) / 10000.0))
    return rounded(mrp.mrp_levels(e, [[], ["mpio"], ["segm"]]), 4)


@query("binomial_mixed_models")
def binomial_mixed_models(spark, d):
    """Eight deprivation models with area effects nested in municipality effects, fitted together."""
    long = ce.collapse_binomial(fx.survey(spark, d), ["mpio", "segm", "sexo", "area"], list(fx.INDICATORS))
    xs = {**sex_terms(), "urban": (F.col("area") == "1").cast("double")}
    fits, _, _ = mx.binomial_mixed_models(long, "indicator", "yno", "n", xs, "segm", "mpio")
    rows = [(k, n, float(b), float(s)) for k, f in fits.items() for n, b, s in zip(f.names, f.beta, np.sqrt(np.diag(f.cov)))]
    rows += [(k, "sigma_group", float(np.sqrt(f.sigma2_u[0, 0])), None) for k, f in fits.items()]
    return rounded(spark.createDataFrame(rows, "indicator string, variable string, mean double, sd double"), 4)


@query("multinomial_mixed_model")
def multinomial_mixed_model(spark, d):
    """Employment probabilities per census cell with correlated area effects, then rates by municipality."""
    cats = ["empleo_1", "empleo_2", "empleo_3"]
    counts = ce.collapse_multinomial(fx.survey(spark, d).filter("l_partkey % 10 <> 3"), ["segm", "sexo", "edad"], "empleo", [1, 2, 3])
    fit, effects = mx.multinomial_mixed_model(counts, cats, cell_terms(), "segm")
    cells = ce.collapse(fx.census(spark, d), ["segm", "mpio", "sexo", "edad"], "n")
    theta = mx.predict_multinomial(cells, fit, effects, cell_terms(), "segm")
    return rounded(ce.employment_rates_census(theta, ["mpio"]), 3)


# ---------------------------------------------------------------- draws


DRAW_SQL = "SELECT CAST((draw-1)%4+1 AS INT) AS chain, CAST(floor((draw-1)/4)+1 AS INT) AS iteration, CAST(draw AS BIGINT) AS draw"
OLS_SQL = f"""r AS (SELECT ln(ingreso+1) AS y, fep/10 AS x FROM survey), f AS (SELECT regr_slope(y,x) AS b1, regr_intercept(y,x) AS b0, avg(x) AS mx, regr_sxx(y,x) AS sxx, count(*) AS n FROM r),
e AS (SELECT sum(pow(y-b0-b1*x,2))/(max(n)-2) AS s2 FROM r, f), ch AS (SELECT b0, b1, s2, mx, sxx, sqrt(s2*(1.0/n+mx*mx/sxx)+0.00000000000001) AS l00 FROM f, e),
cl AS (SELECT *, -s2*mx/sxx/l00 AS l10, sqrt(s2/sxx+0.00000000000001-pow(s2*mx/sxx/l00,2)) AS l11 FROM ch),
dr AS (SELECT draw, {normal_sql("1.0", "draw")} AS z0, {normal_sql("1.1", "draw")} AS z1 FROM (SELECT unnest(range(1,1001)) AS draw))"""


@query(
    "posterior_draws",
    fx.ctes("survey", extra=OLS_SQL)
    + f"{DRAW_SQL}, '(Intercept)' AS variable, round(b0+l00*z0,5) AS value FROM cl, dr UNION ALL {DRAW_SQL}, 'q', round(b1+l10*z0+l11*z1,5) FROM cl, dr",
)
def posterior_draws(spark, d):
    fit = glm.ols(_log_survey(spark, d), "ly", [F.lit(1.0), F.col("q")], ["(Intercept)", "q"])
    return rounded(dr.posterior_draws(spark, fit.mean, fit.cov, fit.names, 1000), 5)


@query(
    "grid_draws",
    fx.ctes("survey", "covariates", extra=f"{AREAS}, {grid_draws_sql(FITTED_GRID, 1000)}")
    + " UNION ALL ".join(f"{DRAW_SQL}, '{name}' AS variable, round({v},5) AS value FROM co2" for name, v in (("(Intercept)", "c0"), ("x", "c1"), ("sigma2_v", "s2"))),
)
def grid_draws(spark, d):
    fit = ar.fh_gaussian_fit(areas(spark, d), "y", "psi", terms())
    return rounded(dr.grid_draws(spark, fit, NAMES, 1000), 5)


REP_DRAWS = 20
REP_AREAS = f"ap AS (SELECT segm, count(*) AS n, avg(pobreza) AS p FROM survey GROUP BY segm), rp AS (SELECT segm, n, p, draw FROM ap, (SELECT unnest(range(1,{REP_DRAWS + 1})) AS draw))"


def _replicated_areas(spark, d):
    a = fx.survey(spark, d).groupBy("segm").agg(F.count(F.lit(1)).alias("n"), F.avg("pobreza").alias("p"))
    return ce.spread_groups(a, "segm").withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(REP_DRAWS)).cast("array<bigint>")))


@query(
    "posterior_predictive_binomial",
    fx.ctes("survey", extra=REP_AREAS)
    + f"SELECT draw, segm, CAST(sum(CAST({uniform_sql('ppb', 'k', 't')} < p AS INT)) AS INT) AS yrep FROM (SELECT draw, segm, p, concat(CAST(draw AS VARCHAR),'|',segm) AS k, unnest(range(1,n+1)) AS t FROM rp) GROUP BY draw, segm",
)
def posterior_predictive_binomial(spark, d):
    return _replicated_areas(spark, d).select("draw", "segm", dr.replicate_binomial(F.col("n"), F.col("p"), "ppb", "draw", "segm").alias("yrep"))


@query(
    "posterior_predictive_bernoulli_normal",
    fx.ctes("survey", extra=REP_AREAS)
    + f"SELECT draw, segm, CAST({uniform_sql('ppc', 'draw', 'segm')} < p AS INT) AS bern, round(p+0.1*{normal_sql('ppn', 'draw', 'segm')},5) AS norm, 1+CAST({uniform_sql('ppk', 'draw', 'segm')}>=p AS INT)+CAST({uniform_sql('ppk', 'draw', 'segm')}>=p+(1-p)/2 AS INT) AS cat FROM rp",
)
def posterior_predictive_bernoulli_normal(spark, d):
    p = F.col("p")
    out = _replicated_areas(spark, d).select(
        "draw",
        "segm",
        dr.replicate_bernoulli(p, "ppc", "draw", "segm").alias("bern"),
        dr.replicate_normal(p, F.lit(0.1), "ppn", "draw", "segm").alias("norm"),
        dr.replicate_category([p, (1 - p) / 2, (1 - p) / 2], "ppk", "draw", "segm").alias("cat"),
    )
    return rounded(out, 5)


@query("posterior_predictive_poisson_multinomial")
def posterior_predictive_poisson_multinomial(spark, d):
    p = F.col("p")
    rep = _replicated_areas(spark, d)
    counts = dr.replicate_multinomial(F.col("n"), [p, (1 - p) / 2, (1 - p) / 2], "ppm", "draw", "segm")
    return rep.select("draw", "segm", dr.replicate_poisson(F.col("n") * p, "ppo", "draw", "segm").alias("pois"), *[c.alias(f"m{i + 1}") for i, c in enumerate(counts)])


DRAWS = "WITH " + fx.draws_sql() + "\n"


@query(
    "summarise_draws",
    DRAWS
    + """, m AS (SELECT variable, avg(value) AS mean, median(value) AS med, stddev_samp(value) AS sd, quantile_cont(value,0.05) AS q5, quantile_cont(value,0.95) AS q95 FROM draws GROUP BY variable),
a AS (SELECT variable, 1.4826*median(abs(value-med)) AS mad FROM draws JOIN m USING (variable) GROUP BY variable)
SELECT variable, round(mean,6) AS mean, round(med,6) AS median, round(sd,6) AS sd, round(mad,6) AS mad, round(q5,6) AS q5, round(q95,6) AS q95 FROM m JOIN a USING (variable)""",
)
def summarise_draws(spark, d):
    return rounded(dr.summarise_draws(fx.draws_table(spark, d)))


def _rhat_sql(converged: bool) -> str:
    return (
        "WITH "
        + fx.draws_sql(converged)
        + """, l AS (SELECT variable, chain, max(iteration) AS t FROM draws GROUP BY ALL),
h AS (SELECT variable, chain, iteration>floor(t/2) AS half, value FROM draws JOIN l USING (variable, chain) WHERE iteration<=floor(t/2) OR iteration>t-floor(t/2)),
c AS (SELECT variable, chain, half, avg(value) AS m, var_samp(value) AS v, count(*) AS n FROM h GROUP BY ALL),
a AS (SELECT variable, avg(v) AS w, var_samp(m) AS b, avg(n) AS n FROM c GROUP BY variable)
SELECT variable, round(sqrt(((n-1)/n*w+b)/w),6) AS rhat FROM a"""
    )


@query("rhat", _rhat_sql(True))
def rhat(spark, d):
    return rounded(dr.rhat(fx.draws_table(spark, d)))


@query("rhat_not_converged", _rhat_sql(False))
def rhat_not_converged(spark, d):
    return rounded(dr.rhat(fx.draws_table(spark, d, converged=False)))


@query("rhat_rank_normalised")
def rhat_rank_normalised(spark, d):
    return rounded(dr.rhat_rank(fx.draws_table(spark, d)))


@query("effective_sample_size")
def effective_sample_size(spark, d):
    return rounded(dr.ess(fx.draws_table(spark, d)), 3)


@query("trace_table", DRAWS + "SELECT variable, chain, iteration, round(value,6) AS value FROM draws WHERE variable IN ('beta_1','beta_3')")
def trace_table(spark, d):
    return rounded(dr.trace_table(fx.draws_table(spark, d), ["beta_1", "beta_3"]))


@query(
    "chain_density",
    DRAWS
    + """, h AS (SELECT variable, chain, CAST(least(floor(value/0.05),19) AS BIGINT) AS bin, count(*) AS n FROM draws WHERE value BETWEEN 0 AND 1 GROUP BY ALL)
SELECT variable, chain, bin, round(CAST(bin*0.05 AS DOUBLE),6) AS lower, n, round(n/(sum(n) OVER (PARTITION BY variable, chain)*0.05),6) AS density FROM h""",
)
def chain_density(spark, d):
    return rounded(dr.chain_density(fx.draws_table(spark, d), 20, 0.0, 1.0))


@query(
    "interval_table",
    DRAWS
    + "SELECT variable, round(quantile_cont(value,0.05),6) AS ll, round(quantile_cont(value,0.25),6) AS l, round(quantile_cont(value,0.5),6) AS m, round(quantile_cont(value,0.75),6) AS h, round(quantile_cont(value,0.95),6) AS hh FROM draws GROUP BY variable",
)
def interval_table(spark, d):
    return rounded(dr.interval_table(fx.draws_table(spark, d)))


def _hist_sql(col: str, source: str, by: str = "") -> str:
    g = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"SELECT {g}bin, CAST(bin*0.05 AS DOUBLE) AS lower, n, n/(sum(n) OVER ({part})*0.05) AS density FROM (SELECT {g}CAST(least(floor({col}/0.05),19) AS BIGINT) AS bin, count(*) AS n FROM {source} WHERE {col} BETWEEN 0 AND 1 GROUP BY ALL)"


@query(
    "ppc_density",
    fx.ctes("survey", extra=REP_AREAS + f", ch AS (SELECT draw FROM (SELECT unnest(range(1,{REP_DRAWS + 1})) AS draw) ORDER BY {uniform_sql(11, 'draw')}, draw LIMIT 10), rr AS (SELECT draw, segm, p+0.1*{normal_sql('ppn', 'draw', 'segm')} AS yrep FROM rp JOIN ch USING (draw))")
    + f"SELECT 'y' AS source, NULL AS draw, bin, round(lower,6) AS lower, n, round(density,6) AS density FROM ({_hist_sql('p', 'ap')}) UNION ALL SELECT 'yrep', draw, bin, round(lower,6), n, round(density,6) FROM ({_hist_sql('yrep', 'rr', 'draw')})",
)
def ppc_density(spark, d):
    rep = _replicated_areas(spark, d).withColumn("yrep", dr.replicate_normal(F.col("p"), F.lit(0.1), "ppn", "draw", "segm"))
    obs = fx.survey(spark, d).groupBy("segm").agg(F.avg("pobreza").alias("p"))
    return rounded(dr.ppc_density(obs, "p", rep, "yrep", 20, 0.0, 1.0, k=10, seed=11).select("source", "draw", "bin", "lower", "n", "density"))


@query(
    "ppc_counts",
    fx.ctes("survey", extra=REP_AREAS)
    + f"SELECT 'yrep' AS source, draw, bern AS value, count(*) AS n FROM (SELECT draw, CAST({uniform_sql('ppc', 'draw', 'segm')} < p AS INT) AS bern FROM rp) GROUP BY ALL UNION ALL SELECT 'y', NULL, pobreza, count(*) FROM survey GROUP BY pobreza",
)
def ppc_counts(spark, d):
    rep = _replicated_areas(spark, d).withColumn("yrep", dr.replicate_bernoulli(F.col("p"), "ppc", "draw", "segm"))
    return dr.ppc_counts(fx.survey(spark, d), "pobreza", rep, "yrep").select("source", "draw", "value", "n")


# ---------------------------------------------------------------- post-stratification

MRP_DRAWS = 50


def _mrp_sql(by: str | None, draws: int = MRP_DRAWS, where: str = "") -> str:
    g = f"{by}, " if by else ""
    name = "" if by else "'Nacional' AS \"Nacional\", "
    return (
        fx.ctes("census", extra=fx.epred_sql(draws))
        + f", r AS (SELECT {g}draw, sum(n*value)/sum(n) AS v FROM epred {where} GROUP BY {g}draw) SELECT {g}{name}round(avg(v),6) AS mrp_estimate, round(stddev_samp(v),6) AS mrp_estimate_se FROM r {'GROUP BY ' + by if by else ''}"
    )


@query("mrp_estimate_by_area", _mrp_sql("segm"))
def mrp_estimate_by_area(spark, d):
    return rounded(mrp.mrp_estimate(fx.packed_epred(spark, d, MRP_DRAWS, cluster="segm"), ["segm"]))


@query("mrp_estimate_national", _mrp_sql(None))
def mrp_estimate_national(spark, d):
    return rounded(mrp.mrp_estimate(fx.packed_epred(spark, d, MRP_DRAWS), None))


@query("mrp_estimate_joined_cells", _mrp_sql("mpio", 20))
def mrp_estimate_joined_cells(spark, d):
    """Expected values that carry only their cell identifier, joined to the cells."""
    cells = fx.census(spark, d)
    e = fx.packed_epred(spark, d, 20, cells.select("cell_id"))
    return rounded(mrp.mrp_estimate(e, ["mpio"], cells=cells))


@query("mrp_without_schooling_gaps", _mrp_sql("anoest", where="WHERE anoest NOT IN ('98','99')"))
def mrp_without_schooling_gaps(spark, d):
    return rounded(mrp.mrp_estimate(fx.packed_epred(spark, d, MRP_DRAWS), ["anoest"]))


@query(
    "mrp_benchmarked",
    fx.ctes("theta_cells", extra=fx.epred_sql(MRP_DRAWS, "theta_cells"))
    + ', r AS (SELECT mpio, edad, draw, sum(n*value)/sum(n) AS v, sum(n*gk*value)/sum(n) AS b, sum(n) AS nn FROM epred GROUP BY ALL) SELECT mpio, edad, round(avg(v),6) AS mrp_estimate, round(stddev_samp(v),6) AS mrp_estimate_se, round(avg(b),6) AS "Benchmarking_estimate", CAST(max(nn) AS BIGINT) AS "N" FROM r GROUP BY mpio, edad',
)
def mrp_benchmarked(spark, d):
    return rounded(mrp.mrp_benchmarked(fx.packed_epred(spark, d, MRP_DRAWS, fx.theta_cells(spark, d)), ["mpio", "edad"]))


def _level(name: str, by: list[str], keys: list[str], where: str = "") -> str:
    g = "".join(f"{k}, " for k in by)
    out = ", ".join(k if k in by else f"NULL AS {k}" for k in keys)
    return f"SELECT '{name}' AS level, {out}, round(avg(v),6) AS mrp_estimate, round(stddev_samp(v),6) AS mrp_estimate_se FROM (SELECT {g}draw, sum(n*value)/sum(n) AS v FROM epred {where} GROUP BY {g}draw) {'GROUP BY ' + ', '.join(by) if by else ''}"


LEVEL_KEYS = ["mpio", "sexo", "anoest"]


@query(
    "mrp_levels",
    fx.ctes("census", extra=fx.epred_sql(MRP_DRAWS))
    + " UNION ALL ".join(
        [_level("Nacional", [], LEVEL_KEYS), _level("mpio", ["mpio"], LEVEL_KEYS), _level("mpio x sexo", ["mpio", "sexo"], LEVEL_KEYS), _level("anoest", ["anoest"], LEVEL_KEYS, "WHERE anoest NOT IN ('98','99')")]
    ),
)
def mrp_levels(spark, d):
    return rounded(mrp.mrp_levels(fx.packed_epred(spark, d, MRP_DRAWS), [[], ["mpio"], ["mpio", "sexo"], ["anoest"]]))


@query(
    "bernoulli_draws",
    fx.ctes("census", extra=fx.epred_sql(20)) + f"SELECT mpio, draw, CAST(sum(CAST({uniform_sql('dim1', 'draw', 'cell_id')} < value AS INT)) AS BIGINT) AS deprived FROM epred GROUP BY mpio, draw",
)
def bernoulli_draws(spark, d):
    e = mrp.long_draws(mrp.bernoulli_draws(fx.packed_epred(spark, d, 20), "dim1"), "value")
    return e.groupBy("mpio", "draw").agg(F.sum("value").alias("deprived"))


LIGHT = list(fx.INDICATORS)[:6]
HEAVY = list(fx.INDICATORS)[6:]


@query(
    "multidim_poverty",
    fx.ctes("survey") + f"SELECT segm, CAST(sum(CAST({'+'.join(LIGHT)}+2*({'+'.join(HEAVY)})>4 AS INT)) AS BIGINT) AS poor, count(*) AS n FROM survey GROUP BY segm",
)
def multidim_poverty(spark, d):
    s = fx.survey(spark, d).withColumn("poor", mrp.multidim_poverty(LIGHT, HEAVY))
    return s.groupBy("segm").agg(F.sum("poor").alias("poor"), F.count(F.lit(1)).alias("n"))


IPM_DRAWS = 10


def _dimension_draws(spark, d):
    """0/1 draws of the eight dimensions per census cell."""
    e = fx.packed_epred(spark, d, IPM_DRAWS)
    for i in fx.INDICATORS:
        e = mrp.bernoulli_draws(e, i, out=i)
    return mrp.long_draws(e, "value", *fx.INDICATORS)


IPM = fx.ctes("census", extra=fx.epred_sql(IPM_DRAWS) + ", ip AS (SELECT *, " + ", ".join(f"CAST({uniform_sql(i, 'draw', 'cell_id')} < value AS INT) AS {i}" for i in fx.INDICATORS) + " FROM epred)")


@query(
    "multidim_poverty_draws",
    IPM
    + f", r AS (SELECT mpio, draw, sum(n*CAST({'+'.join(LIGHT)}+2*({'+'.join(HEAVY)})>4 AS INT))/sum(n) AS v FROM ip GROUP BY mpio, draw) SELECT mpio, round(avg(v),8) AS mrp_estimate, round(stddev_samp(v),8) AS mrp_estimate_se FROM r GROUP BY mpio",
)
def multidim_poverty_draws(spark, d):
    e = _dimension_draws(spark, d).withColumn("value", mrp.multidim_poverty(LIGHT, HEAVY))
    return rounded(mrp.mrp_estimate(e, ["mpio"]), 8)


@query(
    "dimension_estimates",
    IPM
    + ", r AS (SELECT indicator, mpio, draw, sum(n*value)/sum(n) AS v FROM (UNPIVOT (SELECT mpio, draw, n, "
    + ", ".join(fx.INDICATORS)
    + " FROM ip) ON "
    + ", ".join(fx.INDICATORS)
    + " INTO NAME indicator VALUE value) GROUP BY ALL) SELECT indicator, mpio, round(avg(v),8) AS mrp_estimate, round(stddev_samp(v),8) AS mrp_estimate_se FROM r GROUP BY indicator, mpio",
)
def dimension_estimates(spark, d):
    e = _dimension_draws(spark, d).drop("value").unpivot(["mpio", "draw", "n"], list(fx.INDICATORS), "indicator", "value")
    return rounded(mrp.dimension_estimates(e, "indicator", ["mpio"]), 8)


def packed_dimension_draws(spark, d, draws=200):
    """0/1 draws of the eight dimensions per census cell, an array of each, from eight fitted models; a tenth of the areas was not in the sample.

    Terms are sex, urban or rural, and the unemployment rate of the area.  Age, schooling and ethnicity would leave hardly
    two persons of an area with the same terms, and each step of the fit integrates over every pattern.
    """
    xs = {**sex_terms(), "urban": (F.col("area") == "1").cast("double"), "unemployment": F.col("unemployment")}
    rate = fx.survey(spark, d).groupBy("segm").agg(F.avg((F.col("empleo") == 2).cast("double")).alias("unemployment"))
    long = ce.collapse_binomial(fx.deprivations(spark, d).filter("l_partkey % 10 <> 3"), ["mpio", "segm", "sexo", "area"], list(fx.INDICATORS)).join(rate, "segm")
    fits, effects, uppers = mx.binomial_mixed_models(long, "indicator", "yno", "n", xs, "segm", "mpio")
    cells = ce.collapse(fx.census(spark, d), ["segm", "mpio", "sexo", "area"], "n").withColumn("cell_id", ce.cell_id("segm", "sexo", "area")).join(rate, "segm")
    e = mx.packed_epred_columns(cells, fits, effects, uppers, xs, "indicator", "segm", "mpio", "cell_id", draws, seed=5, keep=["n"])
    for i in fx.INDICATORS:
        e = mrp.bernoulli_draws(e, i, value=i, out=i)
    return e


def fitted_dimension_draws(spark, d, draws=200):
    """The draws of :func:`packed_dimension_draws`, one row per draw and cell."""
    return mrp.long_draws(packed_dimension_draws(spark, d, draws), *sorted(fx.INDICATORS))


@query("poverty_pipeline")
def poverty_pipeline(spark, d):
    """Multidimensional poverty by municipality: eight fitted models, Bernoulli draws, weighted score, estimates over draws."""
    e = packed_dimension_draws(spark, d).withColumn("value", mrp.packed_multidim_poverty(LIGHT, HEAVY))
    return rounded(mrp.mrp_estimate(e, ["mpio"]), 5)
