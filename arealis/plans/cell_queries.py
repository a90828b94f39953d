"""Cross-tabs, rates, joins, order, sets and comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.functions import codelists as cl
from arealis.functions.recode import log_income
from arealis.operators import cells as ce
from arealis.operators import joins as jn
from arealis.operators import survey as sv
from arealis.plans import fixtures as fx
from arealis.plans.registry import query, rounded
from arealis.plans.survey_queries import variance_sql


def _years_with_gaps(df):
    return df.withColumn("years", F.when(F.col("anoest") != 99, F.col("anoest"))).withColumn("band", fx.age_band("edad"))


XTAB = """x AS (SELECT mpio, sexo, nullif(anoest,99) AS years, """ + fx.AGE_SQL + """ AS band FROM survey_raw),
cube_x AS (SELECT mpio, sexo, band, years, count(*) AS value, grouping(mpio) AS g1, grouping(sexo) AS g2, grouping(band) AS g3, grouping(years) AS g4 FROM x GROUP BY CUBE(mpio, sexo, band, years))"""


def _label(col: str, g: str) -> str:
    return f"CASE WHEN {g}=1 THEN '__tot__' ELSE coalesce(CAST({col} AS VARCHAR), '__na__') END"


XTAB_SELECT = f"""SELECT mpio AS mpio_value, {_label('mpio', 'g1')} AS mpio_label, sexo AS sexo_value, {_label('sexo', 'g2')} AS sexo_label,
band AS band_value, {_label('band', 'g3')} AS band_label, years AS years_value, {_label('years', 'g4')} AS years_label, value FROM cube_x"""
XVARS = ["mpio", "sexo", "band", "years"]


@query("crosstab", fx.ctes("survey_raw", extra=XTAB) + XTAB_SELECT)
def crosstab(spark, d):
    return ce.crosstab(_years_with_gaps(fx.survey_raw(spark, d)), XVARS)


@query(
    "crosstab_six_variables",
    fx.ctes("survey")
    + """SELECT mpio AS mpio_value, CASE WHEN grouping(mpio)=1 THEN '__tot__' ELSE coalesce(mpio,'__na__') END AS mpio_label,
area AS area_value, CASE WHEN grouping(area)=1 THEN '__tot__' ELSE area END AS area_label,
sexo AS sexo_value, CASE WHEN grouping(sexo)=1 THEN '__tot__' WHEN sexo='1' THEN 'Hombre' ELSE 'Mujer' END AS sexo_label,
edad AS edad_value, CASE WHEN grouping(edad)=1 THEN '__tot__' ELSE edad END AS edad_label,
etnia AS etnia_value, CASE WHEN grouping(etnia)=1 THEN '__tot__' ELSE etnia END AS etnia_label,
anoest AS anoest_value, CASE WHEN grouping(anoest)=1 THEN '__tot__' ELSE anoest END AS anoest_label,
count(*) AS value FROM survey GROUP BY CUBE(mpio, area, sexo, edad, etnia, anoest)""",
)
def crosstab_six_variables(spark, d):
    return ce.crosstab(fx.survey(spark, d), ["mpio", "area", "sexo", "edad", "etnia", "anoest"], labels={"sexo": cl.CODE_LISTS["sexo"]})


@query("drop_margins", fx.ctes("survey_raw", extra=XTAB) + XTAB_SELECT + " WHERE g1+g2+g3+g4=0 AND years IS NOT NULL")
def drop_margins(spark, d):
    return ce.drop_margins(ce.crosstab(_years_with_gaps(fx.survey_raw(spark, d)), XVARS, margins=False), also_missing=True)


@query("collapse", fx.ctes("census") + f"SELECT {', '.join(fx.CELL_KEYS)}, n FROM census")
def collapse(spark, d):
    return ce.collapse(fx.survey(spark, d), fx.CELL_KEYS)


@query("collapse_counts", fx.ctes("census") + "SELECT mpio, sexo, edad, CAST(sum(n) AS BIGINT) AS n FROM census GROUP BY ALL")
def collapse_counts(spark, d):
    return ce.collapse(fx.census(spark, d), ["mpio", "sexo", "edad"], "n")


@query("collapse_mean", fx.ctes("survey") + f"SELECT {', '.join(fx.CELL_KEYS)}, count(*) AS n, round(avg(ingreso),4) AS ingreso FROM survey GROUP BY ALL")
def collapse_mean(spark, d):
    return rounded(ce.sort_desc(ce.collapse_mean(fx.survey(spark, d), fx.CELL_KEYS, "ingreso"), "n", ties=fx.CELL_KEYS), 4)


@query(
    "collapse_binomial",
    fx.ctes("survey", "covariates")
    + "SELECT segm, area, sexo, p_size, n, indicator, CAST(v AS BIGINT) AS yno, n-CAST(v AS BIGINT) AS ysi FROM (UNPIVOT (SELECT segm, area, sexo, count(*) AS n, "
    + ", ".join(f"sum({i}) AS {i}" for i in fx.INDICATORS)
    + " FROM survey GROUP BY segm, area, sexo) ON "
    + ", ".join(fx.INDICATORS)
    + " INTO NAME indicator VALUE v) JOIN covariates USING (segm)",
)
def collapse_binomial(spark, d):
    cov = fx.covariates(spark, d).select("segm", "p_size")
    return ce.collapse_binomial(fx.survey(spark, d), ["segm", "area", "sexo"], list(fx.INDICATORS), cov, ["segm"])


@query(
    "collapse_multinomial",
    fx.ctes("survey")
    + "SELECT segm, sexo, edad, count(*) FILTER (empleo=1) AS empleo_1, count(*) FILTER (empleo=2) AS empleo_2, count(*) FILTER (empleo=3) AS empleo_3 FROM survey GROUP BY segm, sexo, edad",
)
def collapse_multinomial(spark, d):
    return ce.collapse_multinomial(fx.survey(spark, d), ["segm", "sexo", "edad"], "empleo", [1, 2, 3])


@query(
    "conditional_rate",
    fx.ctes("survey_raw")
    + """SELECT segm, round(count(*) FILTER (edad>20 AND anoest>12)/nullif(count(*) FILTER (edad>20),0),6) AS escolaridad,
round(count(*) FILTER (edad>=15 AND anoest=0)/nullif(count(*) FILTER (edad>=15),0),6) AS alfabeta,
round(count(*) FILTER (edad>=15 AND anoest=0)/nullif(count(*) FILTER (edad>=20),0),6) AS alfabeta20 FROM survey_raw GROUP BY segm""",
)
def conditional_rate(spark, d):
    age, years = F.col("edad"), F.col("anoest")
    rates = [
        ce.conditional_columns((age > 20) & (years > 12), age > 20, out="escolaridad"),
        ce.conditional_columns((age >= 15) & (years == 0), age >= 15, out="alfabeta"),
        ce.conditional_columns((age >= 15) & (years == 0), age >= 20, out="alfabeta20"),
    ]
    return rounded(ce.area_rates(fx.survey_raw(spark, d), ["segm"], *rates))


LABELS = {i: (i, "1") for i in fx.INDICATORS}


@query(
    "label_rates",
    fx.ctes("survey") + "SELECT segm, " + ", ".join(f"round(sum({i})/count(*),6) AS {i}" for i in fx.INDICATORS) + " FROM survey GROUP BY segm",
)
def label_rates(spark, d):
    return rounded(ce.label_rates(fx.survey(spark, d), ["segm"], LABELS))


@query(
    "label_rates_long",
    fx.ctes("survey") + "SELECT mpio, " + ", ".join(f"round(sum({i})/count(*),6) AS {i}" for i in fx.INDICATORS) + " FROM survey GROUP BY mpio",
)
def label_rates_long(spark, d):
    long = ce.collapse_binomial(fx.survey(spark, d), ["mpio"], list(fx.INDICATORS))
    sides = F.array(F.struct(F.lit("1").alias("label"), F.col("yno").alias("value")), F.struct(F.lit("0").alias("label"), F.col("ysi").alias("value")))
    long = long.select("mpio", F.col("indicator").alias("variable"), F.explode(sides).alias("s")).select("mpio", "variable", "s.label", "s.value")
    return rounded(ce.label_rates_long(long, ["mpio"], LABELS, "value"))


@query(
    "unemployment_rate",
    fx.ctes("survey") + "SELECT segm, round(u/(u+e),6) AS tasa_desocupacion FROM (SELECT segm, nullif(count(*) FILTER (empleo=1),0) AS e, nullif(count(*) FILTER (empleo=2),0) AS u FROM survey GROUP BY segm)",
)
def unemployment_rate(spark, d):
    return rounded(ce.unemployment_rate(fx.survey(spark, d), ["segm"], "empleo", employed=[1], unemployed=[2]))


@query(
    "share_profile_age",
    fx.ctes("census") + "SELECT segm, " + ", ".join(f"""round(sum(n) FILTER (edad='{k}')/sum(n),6) AS "{v}\"""" for k, v in cl.AGE_SHARE_NAMES.items()) + " FROM census GROUP BY segm",
)
def share_profile_age(spark, d):
    return rounded(ce.share_profile(fx.census(spark, d), ["segm"], "edad", cl.AGE_SHARE_NAMES))


@query(
    "share_profile_schooling",
    fx.ctes("census") + "SELECT segm, " + ", ".join(f"""round(sum(n) FILTER (anoest='{k}')/sum(n),6) AS "{v}\"""" for k, v in cl.SCHOOLING_SHARE_NAMES.items()) + " FROM census GROUP BY segm",
)
def share_profile_schooling(spark, d):
    return rounded(ce.share_profile(fx.census(spark, d), ["segm"], "anoest", cl.SCHOOLING_SHARE_NAMES))


@query(
    "area_rates",
    fx.ctes("survey")
    + "SELECT segm, "
    + ", ".join(f"""round(count(*) FILTER (edad='{k}')/NULLIF(count(*),0) + CASE WHEN count(*) FILTER (edad='{k}')=0 THEN NULL ELSE 0 END,6) AS "{v}\"""" for k, v in cl.AGE_SHARE_NAMES.items())
    + ", "
    + ", ".join(f"""round(count(*) FILTER (anoest='{k}')/count(*),6) AS "{v}\"""" for k, v in cl.SCHOOLING_SHARE_NAMES.items())
    + """, round(count(*) FILTER (etnia='2')/count(*),6) AS "Afro", round(count(*) FILTER (area='0')/count(*),6) AS "Rural",
round(count(*) FILTER (edad>='2' AND anoest='1')/nullif(count(*) FILTER (edad>='2'),0),6) AS alfabeta,
round(nullif(count(*) FILTER (empleo=2),0)/(nullif(count(*) FILTER (empleo=1),0)+nullif(count(*) FILTER (empleo=2),0)),6) AS tasa_desocupacion, """
    + ", ".join(f"round(sum({i})/count(*),6) AS {i}" for i in fx.INDICATORS)
    + " FROM survey GROUP BY segm",
)
def area_rates(spark, d):
    """Every covariate rate of an area from one scan."""
    out = ce.area_rates(
        fx.survey(spark, d),
        ["segm"],
        ce.share_columns("edad", cl.AGE_SHARE_NAMES, None),
        ce.share_columns("anoest", cl.SCHOOLING_SHARE_NAMES, None, fill=0),
        ce.share_columns("etnia", {"2": "Afro"}, None, fill=0),
        ce.share_columns("area", {"0": "Rural"}, None, fill=0),
        ce.conditional_columns((F.col("edad") >= "2") & (F.col("anoest") == "1"), F.col("edad") >= "2", out="alfabeta"),
        ce.unemployment_columns("empleo", employed=[1], unemployed=[2]),
        ce.label_columns({i: (i, "1") for i in fx.INDICATORS}),
    )
    return rounded(out)


def _profiles(spark, d):
    c = fx.census(spark, d)
    return (
        ce.share_profile(c, ["segm"], "sexo", {"1": "Hombre", "2": "Mujer"}, require_all=True),
        ce.share_profile(c, ["segm"], "etnia", cl.CODE_LISTS["etnia"], fill=0),
        ce.share_profile(c, ["segm"], "area", {"0": "Rural", "1": "Urbano"}, fill=0),
    )


@query(
    "share_profile_sex_ethnicity_area",
    fx.ctes("census")
    + """SELECT segm, round(sum(n) FILTER (sexo='1')/sum(n) + 0*sum(n) FILTER (sexo='2'),6) AS "Hombre", round(sum(n) FILTER (sexo='2')/sum(n) + 0*sum(n) FILTER (sexo='1'),6) AS "Mujer",
round(coalesce(sum(n) FILTER (etnia='1'),0)/sum(n),6) AS "Indigena", round(coalesce(sum(n) FILTER (etnia='2'),0)/sum(n),6) AS "Afro", round(coalesce(sum(n) FILTER (etnia='3'),0)/sum(n),6) AS "Otro",
round(coalesce(sum(n) FILTER (area='0'),0)/sum(n),6) AS "Rural", round(coalesce(sum(n) FILTER (area='1'),0)/sum(n),6) AS "Urbano" FROM census GROUP BY segm""",
)
def share_profile_sex_ethnicity_area(spark, d):
    return rounded(jn.join_all_inner(_profiles(spark, d), "segm"))


@query(
    "margin_check",
    fx.ctes("census")
    + " UNION ALL ".join(f"SELECT '{v}' AS variable, {v} AS level, CAST(sum(n) AS BIGINT) AS n, round(sum(n)/(SELECT sum(n) FROM census),6) AS prop, (SELECT CAST(sum(n) AS BIGINT) FROM census) AS total FROM census GROUP BY {v}" for v in ["area", "sexo", "edad", "etnia", "anoest"]),
)
def margin_check(spark, d):
    return rounded(ce.margin_check(fx.census(spark, d), ["area", "sexo", "edad", "etnia", "anoest"], "n"))


RATES = """round(100*sum(fep) FILTER (empleo=2)/nullif(sum(fep) FILTER (empleo<>3),0),6) AS "TD", round(100*coalesce(sum(fep) FILTER (empleo=1),0)/sum(fep),6) AS "TO",
round(100*coalesce(sum(fep) FILTER (empleo<>3),0)/sum(fep),6) AS "TP" """
RATES = RATES.replace("100*sum(fep) FILTER (empleo=2)", "100*coalesce(sum(fep) FILTER (empleo=2),0)")


@query("employment_rates_survey", fx.ctes("survey") + f"SELECT segm, count(*) AS n_sample, {RATES} FROM survey GROUP BY segm")
def employment_rates_survey(spark, d):
    return rounded(ce.employment_rates_survey(fx.survey(spark, d), ["segm"]))


@query("employment_rates_national", fx.ctes("survey") + f"SELECT 'Nacional' AS \"Nacional\", count(*) AS n_sample, {RATES} FROM survey")
def employment_rates_national(spark, d):
    return rounded(ce.employment_rates_survey(fx.survey(spark, d)))


def _census_rates(n: str = "n") -> str:
    return f"""round(100*sum({n}*theta_2)/sum({n}*(theta_1+theta_2)),6) AS "TD", round(100*sum({n}*theta_1)/sum({n}),6) AS "TO", round(100*sum({n}*(theta_1+theta_2))/sum({n}),6) AS "TP" """


@query("employment_rates_census", fx.ctes("theta_cells") + f"SELECT segm, {_census_rates()} FROM theta_cells GROUP BY segm")
def employment_rates_census(spark, d):
    return rounded(ce.employment_rates_census(fx.theta_cells(spark, d), ["segm"]))


@query(
    "employment_poststrat",
    fx.ctes("theta_cells") + f"SELECT mpio, {_census_rates()} FROM theta_cells GROUP BY mpio",
)
def employment_poststrat(spark, d):
    t = fx.theta_cells(spark, d)
    theta = t.select("cell_id", "theta_1", "theta_2")
    return rounded(ce.employment_rates_census(t.select("cell_id", "mpio", "n").join(theta, "cell_id"), ["mpio"]))


@query(
    "interaction_means",
    fx.ctes("survey")
    + """SELECT sexo, edad, round(avg(pobreza),6) AS "Pobreza", CASE sexo WHEN '1' THEN 'Hombre' ELSE 'Mujer' END AS "by_Color",
CASE edad WHEN '1' THEN '0 -14' WHEN '2' THEN '15 - 29' WHEN '3' THEN '30 - 44' WHEN '4' THEN '45 - 64' ELSE '65 - más' END AS by_x FROM survey GROUP BY sexo, edad""",
)
def interaction_means(spark, d):
    return rounded(ce.interaction_means(fx.survey(spark, d), "sexo", "edad"))


COMPARE = """a AS (SELECT etnia, count(*) AS ns FROM survey GROUP BY etnia), b AS (SELECT etnia, sum(n) AS nc FROM census GROUP BY etnia),
cmp AS (SELECT CASE etnia WHEN '1' THEN 'Indigena' WHEN '2' THEN 'Afro' ELSE 'Otro' END AS etnia, round(ns/(SELECT sum(ns) FROM a),6) AS "Sample", round(nc/(SELECT sum(nc) FROM b),6) AS "Population" FROM a FULL JOIN b USING (etnia))"""


@query("compare_proportions", fx.ctes("census", extra=COMPARE) + "SELECT * FROM cmp")
def compare_proportions(spark, d):
    return rounded(ce.compare_proportions(fx.survey(spark, d), fx.census(spark, d), "etnia"))


@query("melt", fx.ctes("census", extra=COMPARE) + 'SELECT etnia, \'Sample\' AS variable, "Sample" AS value FROM cmp UNION ALL SELECT etnia, \'Population\', "Population" FROM cmp')
def melt(spark, d):
    return rounded(ce.melt(ce.compare_proportions(fx.survey(spark, d), fx.census(spark, d), "etnia"), ["etnia"]))


def _direct(spark, d, by):
    m = sv.survey_mean(sv.SurveyDesign(fx.survey(spark, d), weight="fep", strata="estrato", psu="upm"), "pobreza", by)
    return m.select(*by, F.col("mean").alias("directo"), F.col("se").alias("directo_se"), F.col("n").alias("n_sample"))


CENSUS_MEANS = 'SELECT mpio, sum(n*theta_1)/sum(n) AS lmer, sum(n*theta_1*gk)/sum(n) AS bench, sum(n*theta_1)/sum(n/gk) AS lmer_gk FROM theta_cells GROUP BY mpio'


@query(
    "compare_estimates",
    fx.ctes("theta_cells", extra=variance_sql(["mpio"]) + f", cm AS ({CENSUS_MEANS})")
    + "SELECT mpio, round(p,6) AS directo, round(sqrt(var),6) AS directo_se, n AS n_sample, round(lmer,6) AS lmer, round(bench,6) AS bench FROM est FULL JOIN cm USING (mpio)",
)
def compare_estimates(spark, d):
    t = fx.theta_cells(spark, d).withColumn("yb", F.col("theta_1") * F.col("gk"))
    return rounded(ce.compare_estimates(_direct(spark, d, ["mpio"]), t, ["mpio"], "theta_1", "yb"))


@query(
    "compare_estimates_long",
    fx.ctes("theta_cells", extra=variance_sql(["mpio"]) + f", cm AS ({CENSUS_MEANS}), t AS (SELECT mpio, n AS n_sample, round(sqrt(var),6) AS directo_se, p AS directo, lmer_gk AS lmer, bench FROM est FULL JOIN cm USING (mpio))")
    + " UNION ALL ".join(f"SELECT mpio, n_sample, directo_se, '{v}' AS variable, round({v},6) AS value FROM t" for v in ("directo", "lmer", "bench")),
)
def compare_estimates_long(spark, d):
    t = fx.theta_cells(spark, d).withColumn("yb", F.col("theta_1") * F.col("gk"))
    return rounded(ce.compare_estimates_long(ce.compare_estimates(_direct(spark, d, ["mpio"]), t, ["mpio"], "theta_1", "yb", gk="gk"), ["mpio"]))


@query(
    "compare_estimates_not_in_survey",
    fx.ctes("theta_cells", extra=f"cm AS ({CENSUS_MEANS})")
    + "SELECT mpio, CAST(NULL AS DOUBLE) AS directo, CAST(NULL AS DOUBLE) AS directo_se, CAST(1 AS BIGINT) AS n_sample, round(lmer,6) AS lmer, round(bench,6) AS bench FROM cm",
)
def compare_estimates_not_in_survey(spark, d):
    t = fx.theta_cells(spark, d).withColumn("yb", F.col("theta_1") * F.col("gk"))
    return rounded(ce.compare_estimates(None, t, ["mpio"], "theta_1", "yb"))


@query(
    "compare_indicators",
    fx.ctes("survey", "theta_cells", extra=f"""s AS (SELECT mpio, count(*) AS n_sample, {RATES} FROM survey GROUP BY mpio),
m AS (SELECT mpio, {_census_rates()} FROM theta_cells GROUP BY mpio), b AS (SELECT mpio, {_census_rates('n*gk')} FROM theta_cells GROUP BY mpio),
u AS (SELECT mpio, "TD", "TO", "TP", 'directo' AS variable FROM s UNION ALL SELECT mpio, "TD", "TO", "TP", 'lmer' FROM m UNION ALL SELECT mpio, "TD", "TO", "TP", 'bench' FROM b)""")
    + 'SELECT mpio, variable, "TD", "TO", "TP", n_sample, "TD" AS value FROM u JOIN (SELECT mpio, n_sample FROM s) USING (mpio)',
)
def compare_indicators(spark, d):
    return rounded(ce.compare_indicators(fx.survey(spark, d), fx.theta_cells(spark, d), ["mpio"]))


@query(
    "axis_order",
    fx.ctes("census")
    + "SELECT variable, levels, row_number() OVER (ORDER BY levels DESC) AS axis FROM ("
    + " UNION ALL ".join(f"SELECT '{v}' AS variable, count(DISTINCT {v}) AS levels FROM census" for v in ("segm", "edad", "sexo"))
    + ")",
)
def axis_order(spark, d):
    """Axis of each variable, with its number of levels."""
    cells = fx.census(spark, d)
    order = spark.createDataFrame([(v, i) for i, v in enumerate(ce.axis_order(cells, ["sexo", "segm", "edad"]), 1)], "variable string, axis bigint")
    return ce.level_counts(cells, ["sexo", "segm", "edad"]).join(order, "variable")


@query(
    "correlations",
    fx.ctes("survey", "covariates", extra="j AS (SELECT pobreza, p_size, p_retailprice, avg_tax FROM (SELECT segm, avg(pobreza) AS pobreza FROM survey GROUP BY segm) JOIN covariates USING (segm))")
    + "SELECT 'p_size' AS covariate, round(corr(pobreza,p_size),6) AS r FROM j UNION ALL SELECT 'log_price', round(corr(pobreza,ln(p_retailprice)),6) FROM j UNION ALL SELECT 'log1_tax', round(corr(pobreza,ln(avg_tax+1)),6) FROM j",
)
def correlations(spark, d):
    p = fx.survey(spark, d).groupBy("segm").agg(F.avg("pobreza").alias("pobreza"))
    j = jn.with_covariates(p, fx.covariates(spark, d), "segm")
    return rounded(ce.correlations(j, "pobreza", {"p_size": F.col("p_size"), "log_price": log_income("p_retailprice", shift=0), "log1_tax": log_income("avg_tax")}))


@query("frequency_table", fx.ctes("survey") + "SELECT CAST(pobreza AS VARCHAR) AS pobreza, count(*) AS n FROM survey GROUP BY pobreza UNION ALL SELECT '__tot__', count(*) FROM survey")
def frequency_table(spark, d):
    return ce.frequency_table(fx.survey(spark, d), "pobreza")


@query(
    "histogram_table",
    fx.ctes("survey")
    + """, h AS (SELECT CAST(least(floor(ingreso/2500),39) AS BIGINT) AS bin, count(*) AS n FROM survey WHERE ingreso BETWEEN 0 AND 100000 GROUP BY 1)
SELECT bin, CAST(bin*2500 AS DOUBLE) AS lower, n, round(n/((SELECT sum(n) FROM h)*2500),9) AS density FROM h""",
)
def histogram_table(spark, d):
    return rounded(ce.histogram_table(fx.survey(spark, d), "ingreso", 40, 0.0, 100000.0), 9)


@query("share_where", "SELECT round(avg(CASE WHEN c_acctbal<0 THEN 1.0 ELSE 0.0 END),6) AS share FROM customer")
def share_where(spark, d):
    return rounded(ce.share_where(fx.table(spark, d, "customer"), F.col("c_acctbal") < 0))


@query(
    "flag_tally",
    fx.ctes("survey") + """SELECT CASE WHEN g>=14 THEN 'Incluir' ELSE 'Excluir' END AS "Flag", count(*) AS n FROM (SELECT segm, count(DISTINCT concat(estrato,CAST(upm AS VARCHAR)))-count(DISTINCT estrato) AS g FROM survey GROUP BY segm) GROUP BY 1""",
)
def flag_tally(spark, d):
    counts = sv.design_counts(sv.SurveyDesign(fx.survey(spark, d), weight="fep", strata="estrato", psu="upm"), ["segm"])
    return ce.flag_tally(counts.withColumn("Flag", F.when(F.col("grados") >= 14, "Incluir").otherwise("Excluir")))


@query(
    "row_shares",
    fx.ctes("survey")
    + """SELECT *, round(empleo_1/(empleo_1+empleo_2+empleo_3),6) AS empleo_1_p, round(empleo_2/(empleo_1+empleo_2+empleo_3),6) AS empleo_2_p, round(empleo_3/(empleo_1+empleo_2+empleo_3),6) AS empleo_3_p
FROM (SELECT segm, count(*) FILTER (empleo=1) AS empleo_1, count(*) FILTER (empleo=2) AS empleo_2, count(*) FILTER (empleo=3) AS empleo_3 FROM survey GROUP BY segm)""",
)
def row_shares(spark, d):
    c = ce.collapse_multinomial(fx.survey(spark, d), ["segm"], "empleo", [1, 2, 3])
    return rounded(ce.row_shares(c, ["empleo_1", "empleo_2", "empleo_3"]))


@query(
    "share_within",
    fx.ctes("census") + "SELECT mpio, segm, CAST(sum(n) AS BIGINT) AS n, round(sum(n)/sum(sum(n)) OVER (PARTITION BY mpio),6) AS share FROM census GROUP BY mpio, segm",
)
def share_within(spark, d):
    return rounded(ce.share_within(ce.collapse(fx.census(spark, d), ["mpio", "segm"], "n"), "n", ["mpio"]))


@query("row_position", fx.ctes("census") + "SELECT cell_id, n, row_number() OVER (ORDER BY cell_id) AS position FROM census")
def row_position(spark, d):
    return ce.row_position(fx.census(spark, d), fx.CELL_KEYS).select("cell_id", "n", F.col("position").cast("bigint").alias("position"))


# ---------------------------------------------------------------- joins


@query(
    "join_all_inner",
    fx.ctes("survey", "census", "covariates")
    + """SELECT segm, round(a.pobreza,6) AS pobreza, round(u.urbano,6) AS urbano, c.p_size FROM (SELECT segm, avg(pobreza) AS pobreza FROM survey GROUP BY segm) a
JOIN (SELECT segm, coalesce(sum(n) FILTER (area='1'),0)/sum(n) AS urbano FROM census GROUP BY segm) u USING (segm) JOIN covariates c USING (segm)""",
)
def join_all_inner(spark, d):
    a = fx.survey(spark, d).groupBy("segm").agg(F.avg("pobreza").alias("pobreza"))
    u = ce.share_profile(fx.census(spark, d), ["segm"], "area", {"1": "urbano"}, fill=0)
    return rounded(jn.join_all_inner([a, u, fx.covariates(spark, d).select("segm", "p_size")], "segm"))


def _join_sql(kind: str) -> str:
    return f"SELECT segm, sum(n) AS n, round(sum(n*p_size),2) AS weighted FROM census {kind} JOIN covariates USING (segm) GROUP BY segm".replace("sum(n) AS", "CAST(sum(n) AS BIGINT) AS")


@query("join_covariates_inner", fx.ctes("census", "covariates_gaps") + _join_sql("INNER"))
def join_covariates_inner(spark, d):
    j = jn.with_covariates(fx.census(spark, d), fx.covariates(spark, d, gaps=True), "segm")
    return rounded(j.groupBy("segm").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("p_size")).alias("weighted")), 2)


@query("join_covariates_left", fx.ctes("census", "covariates_gaps") + _join_sql("LEFT"))
def join_covariates_left(spark, d):
    j = jn.with_covariates_keep(fx.census(spark, d), fx.covariates(spark, d, gaps=True), "segm")
    return rounded(j.groupBy("segm").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("p_size")).alias("weighted")), 2)


OBS = "obs AS (SELECT segm, count(*) AS nd, avg(pobreza) AS p FROM survey WHERE l_partkey%10<>3 GROUP BY segm), fj AS (SELECT segm, nd, p, p_size FROM obs FULL JOIN covariates USING (segm))"


def _estimates_with_covariates(spark, d):
    s = fx.survey(spark, d).filter("l_partkey % 10 <> 3")
    obs = s.groupBy("segm").agg(F.count(F.lit(1)).alias("nd"), F.avg("pobreza").alias("p"))
    return jn.full_join(obs, fx.covariates(spark, d, gaps=True).select("segm", "p_size"), "segm")


@query("full_join", fx.ctes("survey", "covariates_gaps", extra=OBS) + "SELECT segm, nd, round(p,6) AS p, p_size FROM fj")
def full_join(spark, d):
    return rounded(_estimates_with_covariates(spark, d))


@query("unobserved_areas", fx.ctes("survey", "covariates_gaps", extra=OBS) + "SELECT segm, p_size FROM covariates ANTI JOIN obs USING (segm)")
def unobserved_areas(spark, d):
    seen = fx.survey(spark, d).filter("l_partkey % 10 <> 3").select("segm").distinct()
    return jn.unobserved(fx.covariates(spark, d, gaps=True).select("segm", "p_size"), seen, "segm")


@query(
    "split_observed",
    fx.ctes("survey", "covariates_gaps", extra=OBS)
    + "SELECT segm, p_size, 'observed' AS part FROM fj WHERE p>0 AND p_size IS NOT NULL UNION ALL SELECT segm, p_size, 'synthetic' FROM fj WHERE NOT coalesce(p>0,false) AND p_size IS NOT NULL",
)
def split_observed(spark, d):
    seen, rest = jn.split_observed(_estimates_with_covariates(spark, d), "p", "p_size")
    return ce.union_by_name({"observed": seen, "synthetic": rest}, "part").select("segm", "p_size", "part")


@query(
    "complete_grid",
    fx.ctes("census", extra="c AS (SELECT segm, edad, etnia, CAST(sum(n) AS BIGINT) AS n FROM census GROUP BY ALL)")
    + "SELECT segm, edad, etnia, n FROM (SELECT DISTINCT segm FROM c) CROSS JOIN (SELECT DISTINCT edad FROM c) CROSS JOIN (SELECT DISTINCT etnia FROM c) LEFT JOIN c USING (segm, edad, etnia)",
)
def complete_grid(spark, d):
    return jn.complete_grid(ce.collapse(fx.census(spark, d), ["segm", "edad", "etnia"], "n"), ["segm", "edad", "etnia"])


ENTITIES = "SELECT r_name, n_name, count(*) AS households FROM region JOIN nation ON n_regionkey=r_regionkey JOIN customer ON c_nationkey=n_nationkey JOIN orders ON o_custkey=c_custkey GROUP BY ALL"


def _levels(spark, d):
    return [
        (fx.table(spark, d, "region"), "r_regionkey", None),
        (fx.table(spark, d, "nation"), "n_nationkey", "n_regionkey"),
        (fx.table(spark, d, "customer"), "c_custkey", "c_nationkey"),
        (fx.table(spark, d, "orders"), "o_orderkey", "o_custkey"),
        (fx.table(spark, d, "lineitem"), None, "l_orderkey"),
    ]


@query("flatten_entities_households", ENTITIES)
def flatten_entities_households(spark, d):
    return jn.flatten_entities(_levels(spark, d), lowest=3).groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("households"))


@query(
    "flatten_entities_persons",
    "SELECT r_name, c_mktsegment, l_returnflag, count(*) AS persons FROM region JOIN nation ON n_regionkey=r_regionkey JOIN customer ON c_nationkey=n_nationkey JOIN orders ON o_custkey=c_custkey JOIN lineitem ON l_orderkey=o_orderkey GROUP BY ALL",
)
def flatten_entities_persons(spark, d):
    return jn.flatten_entities(_levels(spark, d)).groupBy("r_name", "c_mktsegment", "l_returnflag").agg(F.count(F.lit(1)).alias("persons"))


# ---------------------------------------------------------------- order, samples, sets


@query(
    "order_by_two_keys",
    fx.ctes("survey") + "SELECT segm, count(*) AS n, CAST(sum(pobreza) AS BIGINT) AS y FROM survey GROUP BY segm ORDER BY n DESC, y DESC, segm",
)
def order_by_two_keys(spark, d):
    return ce.sort_desc(sv.unweighted_counts(fx.survey(spark, d), "pobreza", ["segm"]), "n", "y", ties=["segm"])


@query("top_k", fx.ctes("census") + "SELECT cell_id, n FROM census ORDER BY n DESC, cell_id LIMIT 10")
def top_k(spark, d):
    return ce.top_k(fx.census(spark, d).select("cell_id", "n"), 10, "n", ties=["cell_id"])


@query("sample_rows", fx.ctes("census") + f"SELECT cell_id, n FROM census ORDER BY {fx.uniform_sql(7, 'cell_id')}, cell_id LIMIT 100")
def sample_rows(spark, d):
    return ce.sample_rows(fx.census(spark, d).select("cell_id", "n"), 100, "cell_id", seed=7)


@query(
    "sample_with_replacement",
    fx.ctes("census", extra="p AS (SELECT cell_id, n, row_number() OVER (ORDER BY cell_id) AS position FROM census)")
    + f"SELECT pick, cell_id, n FROM (SELECT pick, CAST(floor({fx.uniform_sql(9, 'pick')}*(SELECT count(*) FROM p))+1 AS BIGINT) AS position FROM (SELECT unnest(range(1,201)) AS pick)) JOIN p USING (position)",
)
def sample_with_replacement(spark, d):
    cells = fx.census(spark, d)
    rows = ce.row_position(cells, fx.CELL_KEYS)
    return ce.sample_with_replacement(rows, 200, "position", ce.row_total(cells, fx.CELL_KEYS), seed=9).select("pick", "cell_id", "n")


@query(
    "union_by_name",
    fx.ctes("survey") + "SELECT mpio, NULL AS edad, count(*) AS n, 'mpio' AS source FROM survey GROUP BY mpio UNION ALL SELECT NULL, edad, count(*), 'edad' FROM survey GROUP BY edad",
)
def union_by_name(spark, d):
    s = fx.survey(spark, d)
    return ce.union_by_name({"mpio": ce.collapse(s, ["mpio"]), "edad": ce.collapse(s, ["edad"])}, "source")


@query("distinct_combinations", fx.ctes("survey") + "SELECT DISTINCT mpio, estrato, upm FROM survey")
def distinct_combinations(spark, d):
    return ce.distinct_combinations(fx.survey(spark, d), ["mpio", "estrato", "upm"])
