"""Design-based estimates, weight trimming and variance smoothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.functions.recode import floor_deff, floor_se
from arealis.operators import gvf, survey as sv
from arealis.plans import fixtures as fx
from arealis.plans.registry import query, rounded
from arealis.session import materialise

# Fixed value: the 97.5 % normal quantile used in the interval checks.
Z975 = 1.959963984540054


def variance_sql(by: list[str], y: str = "pobreza", weight: str = "fep", source: str = "survey", strata: str = "estrato", psu: str = "upm") -> str:
    """CTE chain ending in ``est``: linearised variance from explicit PSU scores."""
    b = ", ".join(by)
    using = f"USING ({b})" if by else "ON true"
    b_ = f"{b}, " if by else ""
    group = f"GROUP BY {b}" if by else ""
    return f"""dom AS (SELECT {b_}count(*) AS n, sum({weight}) AS w, sum({weight}*{y})/sum({weight}) AS p, sum({y}) AS y,
  sum({weight}*{y}*{y}) AS wyy FROM {source} {group}),
psu AS (SELECT {b_}{strata} AS h, {psu} AS i, sum({weight}*({y}-p)/dom.w) AS z
  FROM {source} JOIN dom {using} GROUP BY {b_}{strata}, {psu}),
nh AS (SELECT h, count(*) AS k FROM (SELECT DISTINCT {strata} AS h, {psu} AS i FROM {source}) GROUP BY h),
st AS (SELECT {b_}h, sum(z) AS z, sum(z*z) AS zz, count(*) AS units FROM psu GROUP BY {b_}h),
vr AS (SELECT {b_}sum(CASE WHEN k>1 THEN k/(k-1.0)*(zz-z*z/k) ELSE zz END) AS var, sum(units) AS units, count(*) AS strata
  FROM st JOIN nh USING (h) {group}),
est AS (SELECT dom.*, vr.var, vr.units, vr.strata FROM dom JOIN vr {using})"""


def _design(spark, d):
    return sv.SurveyDesign(fx.survey(spark, d), weight="fep", strata="estrato", psu="upm")


DEFF = "var / nullif(CASE WHEN w>n THEN n/(n-1.0)*(wyy/w-p*p)*(w-n)/(w*n) END, 0)"


@query(
    "survey_mean",
    fx.ctes("survey", extra=variance_sql(["segm"]))
    + f"SELECT segm, n, round(p,6) AS mean, round(var,8) AS var, round(sqrt(var),6) AS se, round({DEFF},5) AS deff FROM est",
)
def survey_mean(spark, d):
    return rounded(sv.survey_mean(_design(spark, d), "pobreza", ["segm"]), {"var": 8, "deff": 5})


@query(
    "survey_mean_income_national",
    fx.ctes("survey", extra=variance_sql([], y="ingreso"))
    + f"SELECT n, round(p,4) AS mean, round(var,3) AS var, round(sqrt(var),4) AS se, round({DEFF},5) AS deff FROM est",
)
def survey_mean_income_national(spark, d):
    return rounded(sv.survey_mean(_design(spark, d), "ingreso"), {"mean": 4, "var": 3, "se": 4, "deff": 5})


@query(
    "survey_mean_element_sampling",
    fx.ctes("survey")
    + """, dom AS (SELECT mpio, count(*) AS n, sum(fep) AS w, sum(fep*ingreso)/sum(fep) AS p FROM survey GROUP BY mpio),
nh AS (SELECT estrato, count(*) AS k FROM survey GROUP BY estrato),
sc AS (SELECT mpio, estrato, sum(fep*(ingreso-p)/w) AS z, sum(pow(fep*(ingreso-p)/w,2)) AS zz FROM survey JOIN dom USING (mpio) GROUP BY mpio, estrato),
vr AS (SELECT mpio, sum(k/(k-1.0)*(zz-z*z/k)) AS var FROM sc JOIN nh USING (estrato) GROUP BY mpio)
SELECT mpio, n, round(p,4) AS mean, round(sqrt(var),3) AS se FROM dom JOIN vr USING (mpio)""",
)
def survey_mean_element_sampling(spark, d):
    design = sv.SurveyDesign(fx.survey(spark, d), weight="fep", strata="estrato")
    return rounded(sv.survey_mean(design, "ingreso", ["mpio"]).select("mpio", "n", "mean", "se"), {"mean": 4, "se": 3})


@query(
    "lonely_psu",
    fx.ctes("survey", extra=variance_sql(["mpio"], source="(SELECT * FROM survey WHERE estrato<>'BUILDING' OR upm=1)"))
    + "SELECT mpio, n, round(p,6) AS mean, round(sqrt(var),6) AS se FROM est",
)
def lonely_psu(spark, d):
    only = fx.survey(spark, d).filter("estrato <> 'BUILDING' OR upm = 1")
    design = sv.SurveyDesign(only, weight="fep", strata="estrato", psu="upm", lonely_psu="adjust")
    return rounded(sv.survey_mean(design, "pobreza", ["mpio"]).select("mpio", "n", "mean", "se"))


@query(
    "design_counts",
    fx.ctes("survey")
    + """SELECT segm, count(*) AS n, count(DISTINCT estrato) AS strata, count(DISTINCT concat(estrato,'|',CAST(upm AS VARCHAR))) AS "UPMs",
count(DISTINCT concat(estrato,'|',CAST(upm AS VARCHAR)))-count(DISTINCT estrato) AS grados FROM survey GROUP BY segm""",
)
def design_counts(spark, d):
    return sv.design_counts(_design(spark, d), ["segm"])


@query("unweighted_counts", fx.ctes("survey") + "SELECT segm, count(*) AS n, CAST(sum(pobreza) AS BIGINT) AS y FROM survey GROUP BY segm")
def unweighted_counts(spark, d):
    return sv.unweighted_counts(fx.survey(spark, d), "pobreza", ["segm"])


VARI = "(1-nn/tt)*(tt*tt/nn)*(1/(tt-1))*((wyy-p*p*w)/(w*w))"
WHOLE = "tot AS (SELECT CAST(count(*) AS DOUBLE) AS nn, sum(fep) AS tt FROM survey)"


@query(
    "srs_reference_variance",
    fx.ctes("survey", extra=variance_sql(["segm"]) + ", " + WHOLE) + f"SELECT segm, round(greatest({VARI},0),8) AS vari FROM est, tot",
)
def srs_reference_variance(spark, d):
    return rounded(sv.srs_reference_variance(_design(spark, d), "pobreza", ["segm"]), 8)


DIRECT = (
    f"""q AS (SELECT *, sqrt(var) AS ee, units-strata AS grados, CASE WHEN p>0 AND p<1 THEN greatest({VARI},0) END AS vari FROM est, tot),
direct AS (SELECT segm, p, ee, n, y, grados, units, CASE WHEN vari>0 THEN var/vari END AS deff,
 100*ee/nullif(p,0) AS cv,
 CASE WHEN p>0 AND p<1 THEN (CASE WHEN p<=0.5 THEN 100*ee/(-p*ln(p)) ELSE 100*ee/(-(1-p)*ln(1-p)) END) END AS cvl,
 CASE WHEN p>0 AND p<1 THEN 1/(1+exp(-(ln(p/(1-p))-{Z975}*ee/(p*(1-p))))) END AS li,
 CASE WHEN p>0 AND p<1 THEN 1/(1+exp(-(ln(p/(1-p))+{Z975}*ee/(p*(1-p))))) END AS ls FROM q)"""
)


@query(
    "direct_estimates",
    fx.ctes("survey", extra=variance_sql(["segm"]) + ", " + WHOLE + ", " + DIRECT)
    + """SELECT segm, round(p,6) AS p, round(li,6) AS "LI", round(ls,6) AS "LS", round(ee,6) AS ee, round(cv,5) AS "CV", round(deff,5) AS deff, n,
round(n/nullif(deff,0),4) AS n_eff, CAST(grados AS BIGINT) AS grados, CAST(y AS DOUBLE) AS y, round(cvl,5) AS "CVl", CAST(units AS BIGINT) AS "UPMs",
CAST(grados>=3 AS INT) AS "Inclusion_GL", CAST(n<5 AS INT) AS "Exclusion_n", CAST(deff<1 AS INT) AS "Exclusion_DEFF",
CAST(grados<=2 AS INT) AS "Exclusion_GL", CAST((n<5) OR (deff<1) OR (grados<=2) AS INT) AS "Exclusion",
CASE WHEN grados>=3 THEN 'Incluir' ELSE 'Excluir' END AS "Flag" FROM direct""",
)
def direct_estimates(spark, d):
    e = sv.direct_estimates(_design(spark, d), "pobreza", ["segm"], interval="normal")
    return rounded(e, {"CV": 5, "CVl": 5, "deff": 5, "n_eff": 4})


def student_sql(degrees: str, prob: str = "0.95", steps: int = 60) -> str:
    """Recursive table ``tq`` (grados, t): two-sided Student quantiles of the distinct ``degrees`` by bisection of the closed form for whole degrees."""
    odd = "2/pi()*(a+CASE WHEN grados>1 THEN sin(a)*list_sum(list_transform(range(1,CAST((grados+1)/2 AS BIGINT)), lambda j: 0.5*sqrt(pi())*exp(lgamma(j)-lgamma(j+0.5))*pow(cos(a),2*j-1))) ELSE 0 END)"
    even = "sin(a)*list_sum(list_transform(range(0,CAST(grados/2 AS BIGINT)), lambda j: exp(lgamma(j+0.5)-lgamma(j+1))/sqrt(pi())*pow(cos(a),2*j)))"
    return f"""tb AS (SELECT DISTINCT CAST(grados AS BIGINT) AS grados, 0 AS k, CAST(0 AS DOUBLE) AS lo, pi()/2 AS hi, pi()/4 AS a FROM ({degrees}) WHERE grados>=1
UNION ALL SELECT grados, k+1, CASE WHEN p<{prob} THEN a ELSE lo END, CASE WHEN p<{prob} THEN hi ELSE a END, CASE WHEN p<{prob} THEN (a+hi)/2 ELSE (lo+a)/2 END
FROM (SELECT *, CASE WHEN grados%2=1 THEN {odd} ELSE {even} END AS p FROM tb WHERE k<{steps})),
tq AS (SELECT grados, sqrt(grados)*tan(a) AS t FROM tb WHERE k={steps})"""


STUDENT = DIRECT.replace("direct AS (SELECT segm", "direct0 AS (SELECT segm").replace("FROM q)", "FROM q LEFT JOIN tq USING (grados))").replace(str(Z975), "t")


@query(
    "direct_estimates_student",
    fx.ctes("survey", extra=variance_sql(["segm"]) + ", " + WHOLE + ", " + student_sql("SELECT units-strata AS grados FROM est") + ", " + STUDENT).replace("WITH ", "WITH RECURSIVE ", 1)
    + """SELECT segm, round(p,6) AS p, round(li,6) AS "LI", round(ls,6) AS "LS", round(ee,6) AS ee, round(cv,5) AS "CV", round(deff,5) AS deff, n,
round(n/nullif(deff,0),4) AS n_eff, CAST(grados AS BIGINT) AS grados, CAST(y AS DOUBLE) AS y, round(cvl,5) AS "CVl", CAST(units AS BIGINT) AS "UPMs",
CAST(grados>=3 AS INT) AS "Inclusion_GL", CAST(n<5 AS INT) AS "Exclusion_n", CAST(deff<1 AS INT) AS "Exclusion_DEFF",
CAST(grados<=2 AS INT) AS "Exclusion_GL", CAST((n<5) OR (deff<1) OR (grados<=2) AS INT) AS "Exclusion",
CASE (n<5) OR (deff<1) OR (grados<=2) WHEN true THEN 'Excluir' WHEN false THEN 'Incluir' END AS "Flag" FROM direct0""",
)
def direct_estimates_student(spark, d):
    e = sv.direct_estimates(_design(spark, d), "pobreza", ["segm"], interval="student", strict=True)
    return rounded(e, {"CV": 5, "CVl": 5, "deff": 5, "n_eff": 4})


@query(
    "direct_estimates_few_degrees",
    fx.ctes("survey")
    + """SELECT segm, n, grados, CASE WHEN grados>=3 THEN 'Incluir' ELSE 'Excluir' END AS "Flag"
FROM (SELECT segm, count(*) AS n, count(DISTINCT segm)-count(DISTINCT mpio) AS grados FROM survey GROUP BY segm)""",
)
def direct_estimates_few_degrees(spark, d):
    design = sv.SurveyDesign(fx.survey(spark, d), weight="fep", strata="mpio", psu="segm")
    return sv.direct_estimates(design, "pobreza", ["segm"], interval="normal").select("segm", "n", "grados", "Flag")


@query(
    "logit_interval",
    fx.ctes("survey", extra=variance_sql(["mpio"]))
    + f"""SELECT mpio, round(1/(1+exp(-(ln(p/(1-p))-{Z975}*sqrt(var)/(p*(1-p))))),6) AS low,
round(1/(1+exp(-(ln(p/(1-p))+{Z975}*sqrt(var)/(p*(1-p))))),6) AS high FROM est""",
)
def logit_interval(spark, d):
    m = sv.survey_mean(_design(spark, d), "pobreza", ["mpio"])
    low, high = sv.logit_interval("mean", "se", alpha=0.05)
    return rounded(m.select("mpio", low.alias("low"), high.alias("high")))


@query(
    "cv_measures",
    fx.ctes("survey", extra=variance_sql(["segm"]))
    + """SELECT segm, round(100*sqrt(var)/nullif(p,0),5) AS cv, CASE WHEN p>0 AND p<1 THEN
round(CASE WHEN p<=0.5 THEN 100*sqrt(var)/(-p*ln(p)) ELSE 100*sqrt(var)/(-(1-p)*ln(1-p)) END,5) END AS cv_log FROM est""",
)
def cv_measures(spark, d):
    m = sv.survey_mean(_design(spark, d), "pobreza", ["segm"])
    return rounded(m.select("segm", sv.cv_percent(F.col("mean"), F.col("se")).alias("cv"), sv.cv_log(F.col("mean"), F.col("se")).alias("cv_log")), 5)


@query(
    "floor_values",
    fx.ctes("survey", extra=variance_sql(["segm"]))
    + f"""SELECT segm, CASE WHEN se<0.00001 THEN 0.00001 ELSE round(se,6) END AS se, CASE WHEN deff<0.00001 OR deff IS NULL THEN 1 ELSE round(deff,5) END AS deff
FROM (SELECT segm, sqrt(var) AS se, {DEFF} AS deff FROM est)""",
)
def floor_values(spark, d):
    m = sv.survey_mean(_design(spark, d), "pobreza", ["segm"])
    return rounded(m.select("segm", floor_se("se").alias("se"), floor_deff("deff").alias("deff")), {"deff": 5})


@query(
    "potter_trim",
    fx.ctes("survey")
    + """, k AS (SELECT sqrt(1.2*avg(fep*fep)) AS cap FROM survey), s AS (SELECT sum(fep) AS w, sum(least(fep,cap)) AS t FROM survey, k)
SELECT fep, count(*) AS n, round(min(least(fep,cap)*w/t),6) AS weight_trim FROM survey, k, s GROUP BY fep""",
)
def potter_trim(spark, d):
    t = sv.potter_trim(fx.survey(spark, d), "fep", 1.2)
    return rounded(t.groupBy("fep").agg(F.count(F.lit(1)).alias("n"), F.min("weight_trim").alias("weight_trim")))


@query(
    "potter_trim_by_stratum",
    fx.ctes("survey")
    + """, k AS (SELECT estrato, sqrt(1.1*avg(fep*fep)) AS cap FROM survey GROUP BY estrato),
s AS (SELECT estrato, sum(fep) AS w, sum(least(fep,cap)) AS t FROM survey JOIN k USING (estrato) GROUP BY estrato)
SELECT estrato, round(sum(least(fep,cap)*w/t),4) AS total, round(max(least(fep,cap)*w/t),6) AS largest FROM survey JOIN k USING (estrato) JOIN s USING (estrato) GROUP BY estrato""",
)
def potter_trim_by_stratum(spark, d):
    t = sv.potter_trim(fx.survey(spark, d), "fep", 1.1, by=["estrato"])
    return rounded(t.groupBy("estrato").agg(F.sum("weight_trim").alias("total"), F.max("weight_trim").alias("largest")), {"total": 4})


CS = [1.0, 1.05, 1.1, 1.2, 1.5, 2.0, 3.0]
TRIM = f"""k AS (SELECT avg(fep*fep) AS q FROM survey), g AS (SELECT NULL AS c UNION ALL SELECT unnest([{', '.join(f'CAST({c} AS DOUBLE)' for c in CS)}])),
tw AS (SELECT coalesce(c,-1) AS c, estrato, upm, ingreso, CASE WHEN c IS NULL THEN fep ELSE least(fep, sqrt(c*q)) END AS t FROM survey, k, g),
{variance_sql(['c'], y='ingreso', weight='t', source='tw')},
base AS (SELECT p AS p0 FROM est WHERE c=-1),
grid AS (SELECT c, p AS mean, var, var+pow(p0-p,2) AS mse FROM est, base WHERE c>0)"""


@query("trim_grid", fx.ctes("survey", extra=TRIM) + 'SELECT c AS "C", round(mean,4) AS mean, round(var,2) AS var, round(mse,2) AS mse FROM grid')
def trim_grid(spark, d):
    return rounded(sv.trim_grid(_design(spark, d), "ingreso", CS), {"mean": 4, "var": 2, "mse": 2})


@query("best_trim", fx.ctes("survey", extra=TRIM) + 'SELECT arg_min(c, mse) AS "C", round(min(mse),2) AS mse FROM grid')
def best_trim(spark, d):
    return rounded(sv.best_trim(sv.trim_grid(_design(spark, d), "ingreso", CS)), 2)


@query("trim_mse", fx.ctes("survey", extra=TRIM) + 'SELECT c AS "C", round(mean,4) AS mean, round(var,2) AS var, round(mse,2) AS mse FROM grid WHERE c=1.2')
def trim_mse(spark, d):
    return rounded(sv.trim_mse(_design(spark, d), "ingreso", 1.2), {"mean": 4, "var": 2, "mse": 2})


def direct(spark, d):
    return sv.direct_estimates(_design(spark, d), "pobreza", ["segm"], interval="normal")


@query(
    "sae_base",
    fx.ctes("survey", extra=variance_sql(["segm"]) + ", " + WHOLE + ", " + DIRECT)
    + """SELECT segm, n AS nd, round(n/nullif(deff,0),4) AS n_effec, round(p,6) AS pobreza, round(asin(sqrt(p)),6) AS "pobreza_T", round(ee*ee,8) AS vardir,
round(cv,5) AS cv, round(deff/(4*n),6) AS var_zd, round(deff,5) AS deff_area FROM direct WHERE grados>=3""",
)
def sae_base(spark, d):
    return rounded(gvf.sae_base(direct(spark, d), "segm"), {"n_effec": 4, "vardir": 8, "cv": 5, "deff_area": 5})


def smoothed(spark, d):
    base = materialise(gvf.sae_base(direct(spark, d), "segm"))
    return gvf.gvf_deff(gvf.gvf_predict(base, gvf.gvf_fit(base)))


BASE = """base AS (SELECT segm, n AS nd, n/nullif(deff,0) AS n_effec, p AS pobreza, asin(sqrt(p)) AS "pobreza_T", ee*ee AS vardir, cv, deff/(4*n) AS var_zd, deff AS deff_area FROM direct WHERE grados>=3)"""
FEATURES = ["1.0", "pobreza", "CAST(nd AS DOUBLE)", "CAST(nd AS DOUBLE)*nd", "pobreza*nd", "sqrt(pobreza)", "sqrt(nd)", "sqrt(pobreza*nd)"]


def orthogonal_sql(source: str, features: list[str], used: str, y: str) -> str:
    """CTE chain ending in ``fit``: least squares by Gram-Schmidt, each feature taken out of the later ones twice.

    Adds ``fitted`` for all rows, and ``leverage`` and ``s2`` over the ``used`` ones.
    """
    k, have = len(features), ", ".join(f"CAST({f} AS DOUBLE) AS q{i}" for i, f in enumerate(features))
    parts = [f"o0 AS (SELECT *, {used} AS used, CASE WHEN {used} THEN {y} END AS target, {have} FROM {source})"]
    at = 0
    for i in range(1, k):
        for _ in range(2):
            less = " - ".join([f"q{i}"] + [f"q{j}*(sum(q{i}*q{j}) FILTER (WHERE used) OVER ())/(sum(q{j}*q{j}) FILTER (WHERE used) OVER ())" for j in range(i)])
            parts.append(f"o{at + 1} AS (SELECT * REPLACE ({less} AS q{i}) FROM o{at})")
            at += 1
    norm = [f"(sum(q{i}*q{i}) FILTER (WHERE used) OVER ())" for i in range(k)]
    fitted = " + ".join(f"q{i}*(sum(q{i}*target) FILTER (WHERE used) OVER ())/{norm[i]}" for i in range(k))
    leverage = " + ".join(f"q{i}*q{i}/{norm[i]}" for i in range(k))
    parts.append(f"of AS (SELECT *, {fitted} AS fitted, {leverage} AS leverage FROM o{at})")
    parts.append(f"fit AS (SELECT *, (sum(pow(target-fitted,2)) FILTER (WHERE used) OVER ())/((count(*) FILTER (WHERE used) OVER ())-{k}) AS s2 FROM of)")
    return ", ".join(parts)


GVF = fx.ctes("survey", extra=", ".join([variance_sql(["segm"]), WHOLE, DIRECT, BASE, orthogonal_sql("base", FEATURES, "vardir>0", "ln(vardir)")]))
BASE_OUT = 'segm, nd, round(n_effec,6) AS n_effec, round(pobreza,6) AS pobreza, round("pobreza_T",6) AS "pobreza_T", round(vardir,6) AS vardir, round(cv,6) AS cv, round(var_zd,6) AS var_zd'


@query(
    "gvf_smooth",
    GVF
    + f"""SELECT {BASE_OUT}, round(d,6) AS deff_area, round(hat_var,6) AS hat_var, round(CASE WHEN raw<1 THEN 1 ELSE raw END,6) AS "deff_FGV", round(nd/(CASE WHEN raw<1 THEN 1 ELSE raw END),6) AS "n_eff_FGV"
FROM (SELECT *, CASE WHEN vardir=0 THEN 1 ELSE hat_var/nullif(vardir/d,0) END AS raw FROM (SELECT *, coalesce(deff_area,1) AS d, CASE WHEN pobreza IS NOT NULL AND vardir IS NOT NULL THEN
 exp(fitted)*(sum(vardir) FILTER (WHERE used) OVER ())/(sum(exp(fitted)) FILTER (WHERE used) OVER ()) END AS hat_var FROM fit))""",
)
def gvf_smooth(spark, d):
    return rounded(smoothed(spark, d))


@query(
    "gvf_diagnostics",
    GVF
    + f"""SELECT {BASE_OUT}, round(deff_area,6) AS deff_area, round(target,4) AS observed, round(fitted,3) AS fitted, round(leverage,3) AS leverage, round(target-fitted,3) AS residual,
round(CASE WHEN leverage<1 THEN (target-fitted)/sqrt(s2*(1-leverage)) END,3) AS std_residual FROM fit WHERE used""",
)
def gvf_diagnostics(spark, d):
    base = materialise(gvf.sae_base(direct(spark, d), "segm"))
    return rounded(gvf.gvf_diagnostics(base, gvf.gvf_fit(base)), {"observed": 4, "fitted": 3, "leverage": 3, "residual": 3, "std_residual": 3})


@query(
    "gvf_feature_sums",
    fx.ctes("survey", extra=variance_sql(["segm"]) + ", " + WHOLE + ", " + DIRECT)
    + """SELECT count(*) AS n, round(sum(p),5) AS sp, CAST(sum(n) AS DOUBLE) AS sn, CAST(sum(n*n) AS DOUBLE) AS snn, round(sum(p*n),4) AS spn, round(sum(sqrt(p)),5) AS srp,
round(sum(sqrt(n)),4) AS srn, round(sum(sqrt(p*n)),4) AS srpn, round(sum(ln(ee*ee)),4) AS slv FROM direct WHERE ee>1e-9""",
)
def gvf_feature_sums(spark, d):
    base = gvf.sae_base(direct(spark, d), "segm").filter("vardir > 1e-18")
    names = ["one", "sp", "sn", "snn", "spn", "srp", "srn", "srpn"]
    cols = [F.sum(t).alias(k) for t, k in zip(gvf.gvf_terms(), names)]
    out = base.agg(F.count(F.lit(1)).alias("n"), *cols, F.sum(F.log("vardir")).alias("slv")).drop("one")
    return rounded(out, {"sp": 5, "spn": 4, "srp": 5, "srn": 4, "srpn": 4, "slv": 4})
