"""Sources, recodes, scalar transforms and design columns."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from arealis.functions import codelists as cl
from arealis.functions import recode as rc
from arealis.operators import design as dm
from arealis.operators.cells import collapse
from arealis.plans import fixtures as fx
from arealis.plans.registry import query, rounded
from arealis.session import ensure_checkpoint_dir
from arealis.sources import io


def _counted(df, *cols):
    """Count rows per combination: checks a recode on every row without a row key."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "read_survey",
    "SELECT l_returnflag, count(*) AS n, round(sum(CASE WHEN isnan(l_quantity) THEN NULL ELSE l_quantity END),3) AS q, count(l_tax) AS known FROM lineitem GROUP BY l_returnflag",
)
def read_survey(spark, d):
    s = io.read_survey(spark, f"{d}/lineitem.parquet", ["l_returnflag", "l_quantity", "l_tax"])
    return rounded(s.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"), F.count("l_tax").alias("known")), 3)


@query(
    "read_census",
    "SELECT l_returnflag AS condact3, CAST(count(*) AS BIGINT) AS n, round(sum(l_quantity),2) AS years FROM lineitem WHERE l_quantity > 14 AND l_returnflag IN ('A','N') GROUP BY l_returnflag",
)
def read_census(spark, d):
    rows = io.read_census(spark, f"{d}/lineitem.parquet", 14, ["A", "N"], ["l_returnflag", "l_quantity"], age_column="l_quantity", status_column="l_returnflag")
    return rounded(rows.groupBy(F.col("l_returnflag").alias("condact3")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("years")), 2)


@query(
    "read_covariates",
    "SELECT CASE WHEN length(CAST(p_partkey AS VARCHAR))<7 THEN lpad(CAST(p_partkey AS VARCHAR),7,'0') ELSE CAST(p_partkey AS VARCHAR) END AS p_partkey, p_size, round(p_retailprice,2) AS p_retailprice FROM part",
)
def read_covariates(spark, d):
    return rounded(io.read_covariates(spark, f"{d}/part.parquet", "p_partkey", 7).select("p_partkey", "p_size", "p_retailprice"), 2)


@query("read_zones", "SELECT lpad(CAST(c_custkey AS VARCHAR),9,'0') AS c_custkey, c_name FROM customer WHERE c_mktsegment='BUILDING'")
def read_zones(spark, d):
    return io.read_zones(spark, f"{d}/customer.parquet", "c_mktsegment", "BUILDING", "c_custkey", 9).select("c_custkey", "c_name")


@query(
    "read_pixels",
    fx.ctes("pixels")
    + "SELECT band, count(*) AS n, round(sum(value),2) AS total FROM pixels WHERE date>=TIMESTAMP '1999-01-01' AND date<TIMESTAMP '2001-01-01' AND band IN ('A','R') GROUP BY band",
)
def read_pixels(spark, d):
    px = io.read_pixels(spark, f"{d}/lineitem.parquet", "1999-01-01", "2001-01-01", ["A", "R"], "l_shipdate", "l_returnflag", ["l_returnflag", "l_extendedprice"])
    return rounded(px.groupBy(F.col("l_returnflag").alias("band")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("total")), 2)


@query("write_table", fx.ctes("survey") + "SELECT mpio, count(*) AS n, CAST(sum(pobreza) AS BIGINT) AS y FROM survey GROUP BY mpio")
def write_table(spark, d):
    path = f"{ensure_checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"
    out = fx.survey(spark, d).groupBy("mpio").agg(F.count(F.lit(1)).alias("n"), F.sum("pobreza").alias("y"))
    io.write_table(out, path)
    return spark.read.schema(out.schema).parquet(path)


@query(
    "code_lists",
    fx.ctes("survey")
    + """SELECT CASE etnia WHEN '1' THEN 'Indigena' WHEN '2' THEN 'Afro' ELSE 'Otro' END AS etnia,
CASE anoest WHEN '1' THEN 'Sin educacion' WHEN '2' THEN '1 - 6 años' WHEN '3' THEN '7 - 12 años' WHEN '4' THEN 'Más de 12' WHEN '98' THEN 'No aplica' WHEN '99' THEN 'NS/NR' END AS anoest,
CASE sexo WHEN '1' THEN 'Hombre' ELSE 'Mujer' END AS sexo, count(*) AS rows FROM survey GROUP BY ALL""",
)
def code_lists(spark, d):
    s = fx.survey(spark, d)
    return _counted(s.select(*[cl.relabel(v).alias(v) for v in ("etnia", "anoest", "sexo")]), "etnia", "anoest", "sexo")


@query(
    "pad_code",
    "SELECT l_partkey, CASE WHEN length(CAST(l_partkey AS VARCHAR))<3 THEN lpad(CAST(l_partkey AS VARCHAR),3,'0') ELSE CAST(l_partkey AS VARCHAR) END AS code, count(*) AS rows FROM lineitem GROUP BY ALL",
)
def pad_code(spark, d):
    li = fx.table(spark, d, "lineitem")
    return _counted(li.select("l_partkey", rc.pad_code("l_partkey", 3).alias("code")), "l_partkey", "code")


@query(
    "concat_key",
    "SELECT concat(l_returnflag, l_linestatus, coalesce(CAST(nullif(l_linenumber,3) AS VARCHAR),'NA')) AS key, count(*) AS rows FROM lineitem GROUP BY ALL",
)
def concat_key(spark, d):
    li = fx.table(spark, d, "lineitem")
    third = F.when(F.col("l_linenumber") != 3, F.col("l_linenumber"))
    return _counted(li.select(rc.concat_key("l_returnflag", "l_linestatus", third).alias("key")), "key")


@query("age_band", fx.ctes("survey_raw") + f"SELECT edad, {fx.AGE_SQL} AS band, count(*) AS rows FROM survey_raw GROUP BY edad")
def age_band(spark, d):
    return _counted(fx.survey_raw(spark, d).select("edad", rc.age_band("edad").alias("band")), "edad", "band")


LATE_SQL = "CASE WHEN edad<5 OR anoest=-1 THEN '98' WHEN anoest<1 THEN '1' WHEN anoest<=6 THEN '2' WHEN anoest<=12 THEN '3' WHEN anoest>12 THEN '4' ELSE 'Error' END"


@query(
    "schooling_band",
    fx.ctes("survey_raw") + f"SELECT edad, anoest, {fx.SCHOOL_SQL} AS strict, {LATE_SQL} AS late, count(*) AS rows FROM survey_raw GROUP BY edad, anoest",
)
def schooling_band(spark, d):
    s = fx.survey_raw(spark, d)
    cols = s.select("edad", "anoest", rc.schooling_band("anoest", "edad").alias("strict"), rc.schooling_band("anoest", "edad", "late").alias("late"))
    return _counted(cols, "edad", "anoest", "strict", "late")


@query(
    "ethnicity_area_code",
    fx.ctes("survey_raw")
    + "SELECT etnia_ee, CASE WHEN etnia_ee=4 THEN '1' WHEN etnia_ee=1 THEN '2' ELSE '3' END AS etnia, CASE WHEN areageo2=1 THEN '1' ELSE '0' END AS area, count(*) AS rows FROM survey_raw GROUP BY ALL",
)
def ethnicity_area_code(spark, d):
    s = fx.survey_raw(spark, d).select("etnia_ee", rc.ethnicity_code("etnia_ee", indigenous=4, afro=1).alias("etnia"), rc.area_code("areageo2").alias("area"))
    return _counted(s, "etnia_ee", "etnia", "area")


@query(
    "poverty_flag",
    fx.ctes("survey_raw") + "SELECT mpio, CAST(ingcorte < CASE WHEN sexo=1 THEN lp END AS INT) AS pobreza, count(*) AS rows FROM survey_raw GROUP BY ALL",
)
def poverty_flag(spark, d):
    line = F.when(F.col("sexo") == 1, F.col("lp"))
    return _counted(fx.survey_raw(spark, d).select("mpio", rc.poverty_flag(F.col("ingcorte"), line).alias("pobreza")), "mpio", "pobreza")


@query(
    "log_income",
    fx.ctes("survey_raw")
    + "SELECT mpio, round(sum(ln(ingcorte+1)),4) AS log_income, round(sum(ln(ingcorte/100)),4) AS log_scaled, round(sum(ln(ingcorte/100+1)),4) AS log_scaled1 FROM survey_raw GROUP BY mpio",
)
def log_income(spark, d):
    s = fx.survey_raw(spark, d)
    return rounded(
        s.groupBy("mpio").agg(
            F.sum(rc.log_income("ingcorte")).alias("log_income"),
            F.sum(rc.log_income("ingcorte", shift=0, scale=100)).alias("log_scaled"),
            F.sum(rc.log_income("ingcorte", shift=1, scale=100)).alias("log_scaled1"),
        ),
        4,
    )


@query(
    "relabel",
    fx.ctes("survey")
    + "SELECT CASE edad WHEN '1' THEN '0 -14' WHEN '2' THEN '15 - 29' WHEN '3' THEN '30 - 44' WHEN '4' THEN '45 - 64' WHEN '5' THEN '65 - más' END AS edad, CASE area WHEN '1' THEN 'Urbana' ELSE 'Rural' END AS area, mpio AS depto, count(*) AS rows FROM survey GROUP BY ALL",
)
def relabel(spark, d):
    s = fx.survey(spark, d).select(cl.relabel("edad").alias("edad"), cl.relabel("area").alias("area"), cl.relabel("depto", "mpio").alias("depto"))
    return _counted(s, "edad", "area", "depto")


@query(
    "fix_codes",
    fx.ctes("survey") + "SELECT CASE mpio WHEN '0018' THEN '0108' WHEN '0003' THEN '0300' ELSE mpio END AS mpio, count(*) AS rows FROM survey GROUP BY 1",
)
def fix_codes(spark, d):
    return _counted(fx.survey(spark, d).select(cl.fix_codes("mpio", {"0018": "0108", "0003": "0300"}).alias("mpio")), "mpio")


@query(
    "select_columns",
    """SELECT l_returnflag, count(*) AS n, round(sum(l_quantity+l_extendedprice+l_discount+l_tax+l_orderkey+l_partkey+l_suppkey+l_linenumber),2) AS numeric_total,
round(sum(l_discount+l_tax),4) AS matched_total FROM lineitem GROUP BY l_returnflag""",
)
def select_columns(spark, d):
    li = fx.table(spark, d, "lineitem")
    numeric = rc.select_numeric(li, keep=["l_returnflag"])
    cols = [c for c in numeric.columns if c != "l_returnflag"]
    matched = rc.matching_columns(rc.select_matching(numeric, "disc|tax", keep=["l_returnflag"]), "disc|tax")
    total = sum((F.col(c) for c in cols), F.lit(0.0))
    part = sum((F.col(c) for c in matched), F.lit(0.0))
    out = numeric.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum(total).alias("numeric_total"), F.sum(part).alias("matched_total"))
    return rounded(out, {"numeric_total": 2, "matched_total": 4})


@query("filter_all", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem WHERE l_returnflag<>'N' AND l_linestatus<>'N' GROUP BY ALL")
def filter_all(spark, d):
    li = fx.table(spark, d, "lineitem").select("l_returnflag", "l_linestatus")
    return rc.filter_all(li, ["l_returnflag", "l_linestatus"], lambda c: c != "N").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "row_predicates",
    fx.ctes("survey_raw") + "SELECT mpio, count(*) AS n FROM survey_raw WHERE edad>13 AND condact3 IN (1,2) AND nullif(anoest,99) IS NOT NULL AND segm<>'0007-7' GROUP BY mpio",
)
def row_predicates(spark, d):
    s = fx.survey_raw(spark, d).withColumn("anoest", F.when(F.col("anoest") != 99, F.col("anoest")))
    keep = s.filter((F.col("edad") > 13) & F.col("condact3").isin(1, 2) & F.col("anoest").isNotNull() & (F.col("segm") != "0007-7"))
    return collapse(keep, ["mpio"])


@query("rename_transmute", fx.ctes("survey") + "SELECT mpio AS municipio, round(sum(fep),2) AS peso FROM survey GROUP BY mpio")
def rename_transmute(spark, d):
    s = fx.survey(spark, d).select("mpio", "fep").withColumnsRenamed({"mpio": "municipio", "fep": "peso"})
    return rounded(s.groupBy("municipio").agg(F.sum("peso").alias("peso")), 2)


@query("rescale_columns", fx.ctes("covariates") + "SELECT segm, CAST(1 AS DOUBLE) AS intercept, round(p_size/100,6) AS p_size, round(p_retailprice/100,6) AS p_retailprice FROM covariates")
def rescale_columns(spark, d):
    c = fx.covariates(spark, d).select("segm", F.lit(1.0).alias("intercept"), "p_size", "p_retailprice")
    return rounded(rc.rescale_columns(c, ["p_size", "p_retailprice"], 100))


@query(
    "round_half_even",
    "SELECT l_quantity, round_even(l_quantity/2, 0) AS half, count(*) AS rows FROM lineitem GROUP BY ALL",
)
def round_half_even(spark, d):
    li = fx.table(spark, d, "lineitem")
    return _counted(li.select("l_quantity", rc.round_half_even(F.col("l_quantity") / 2).alias("half")), "l_quantity", "half")


@query(
    "arcsine_transform",
    fx.ctes("survey") + "SELECT segm, round(asin(sqrt(avg(pobreza))),6) AS z, round(pow(sin(asin(sqrt(avg(pobreza)))),2),6) AS back FROM survey GROUP BY segm",
)
def arcsine_transform(spark, d):
    p = fx.survey(spark, d).groupBy("segm").agg(F.avg("pobreza").alias("p"))
    return rounded(p.select("segm", rc.arcsine("p").alias("z"), rc.arcsine_inverse(rc.arcsine("p")).alias("back")))


@query(
    "link_functions",
    """WITH c AS (SELECT p_partkey, p_size/10.0-2 AS e2, p_retailprice/500-3 AS e3 FROM part)
SELECT p_partkey, round(1/(1+exp(-e2)),6) AS inv, round(ln((1/(1+exp(-e2)))/(1-1/(1+exp(-e2)))),6) AS back,
round(1/(1+exp(e2)+exp(e3)),6) AS t1, round(exp(e2)/(1+exp(e2)+exp(e3)),6) AS t2, round(exp(e3)/(1+exp(e2)+exp(e3)),6) AS t3 FROM c""",
)
def link_functions(spark, d):
    c = fx.table(spark, d, "part").select("p_partkey", (F.col("p_size") / 10.0 - 2).alias("e2"), (F.col("p_retailprice") / 500 - 3).alias("e3"))
    t = rc.softmax_ref("e2", "e3")
    inv = rc.inv_logit("e2")
    return rounded(c.select("p_partkey", inv.alias("inv"), rc.logit(inv).alias("back"), *[x.alias(f"t{i + 1}") for i, x in enumerate(t)]))


@query("clamp_negative", "SELECT c_custkey, CASE WHEN c_acctbal<0 THEN 0 ELSE c_acctbal END AS balance FROM customer")
def clamp_negative(spark, d):
    return fx.table(spark, d, "customer").select("c_custkey", rc.clamp_negative("c_acctbal").alias("balance"))


@query("per_poverty_line", fx.ctes("survey") + "SELECT segm, round(sum(ingreso/10000),6) AS lines FROM survey GROUP BY segm")
def per_poverty_line(spark, d):
    s = fx.survey(spark, d)
    return rounded(rc.per_poverty_line(s.select("segm", "ingreso"), "ingreso", "lp", s.select("lp")).groupBy("segm").agg(F.sum("ingreso").alias("lines")))


@query(
    "design_matrix",
    fx.ctes("survey")
    + """SELECT CAST(1 AS DOUBLE) AS "(Intercept)", CAST(sexo='2' AS DOUBLE) AS sexo2, CAST(edad='2' AS DOUBLE) AS edad2, CAST(edad='3' AS DOUBLE) AS edad3, CAST(edad='4' AS DOUBLE) AS edad4, CAST(edad='5' AS DOUBLE) AS edad5,
CAST(empleo AS DOUBLE) AS empleo, count(*) AS rows FROM survey GROUP BY ALL""",
)
def design_matrix(spark, d):
    s = fx.survey(spark, d)
    spec = dm.fit_design(s, [dm.Factor("sexo"), dm.Factor("edad"), dm.Numeric("empleo")])
    return _counted(spec.apply(s), *[f"`{c}`" for c in spec.columns])


@query(
    "design_matrix_no_intercept",
    fx.ctes("survey")
    + "SELECT CAST(sexo='1' AS DOUBLE) AS sexo1, CAST(sexo='2' AS DOUBLE) AS sexo2, CAST(etnia='2' AS DOUBLE) AS etnia2, CAST(etnia='3' AS DOUBLE) AS etnia3, count(*) AS rows FROM survey GROUP BY ALL",
)
def design_matrix_no_intercept(spark, d):
    s = fx.survey(spark, d)
    spec = dm.fit_design(s, [dm.Factor("sexo"), dm.Factor("etnia")], intercept=False)
    return _counted(spec.apply(s), *spec.columns)


@query(
    "align_columns",
    fx.ctes("survey")
    + "SELECT CAST(sexo='2' AS DOUBLE) AS sexo2, CAST(0 AS DOUBLE) AS edad9, CAST(edad='5' AS DOUBLE) AS edad5, count(*) AS rows FROM survey GROUP BY ALL",
)
def align_columns(spark, d):
    s = fx.survey(spark, d)
    spec = dm.fit_design(s, [dm.Factor("sexo"), dm.Factor("edad")])
    train = ["sexo2", "edad9", "edad5"]
    return _counted(dm.align_columns(spec.apply(s), train), *train)


@query(
    "group_incidence",
    fx.ctes("survey") + 'SELECT segm AS "group", count(*) AS n, round(sum(ingreso),2) AS zy FROM survey GROUP BY segm',
)
def group_incidence(spark, d):
    s = fx.survey(spark, d).withColumn("group", dm.group_column("segm"))
    return rounded(s.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.sum("ingreso").alias("zy")), 2)


@query(
    "effective_counts",
    fx.ctes("survey")
    + """SELECT segm, n_effec, round_even(p*n_effec, 0) AS y_effect, n_effec-1 AS phi FROM (SELECT segm, avg(pobreza) AS p, round_even(count(*)/2.0, 0) AS n_effec FROM survey GROUP BY segm)""",
)
def effective_counts(spark, d):
    a = fx.survey(spark, d).groupBy("segm").agg(F.avg("pobreza").alias("pobreza"), (F.count(F.lit(1)) / 2.0).alias("n_eff_FGV"))
    return dm.effective_counts(a).select("segm", "n_effec", "y_effect", "phi")
