"""Map-ready tables and zonal statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.operators import geo
from arealis.operators.cells import collapse
from arealis.operators.joins import attach_to_zones
from arealis.plans import fixtures as fx
from arealis.plans.registry import query, rounded
from arealis.sources.io import pixels_between

BREAKS = [0.0, 0.05, 0.1, 0.2, 0.4, 1.0]


def _class_sql(v: str) -> str:
    out = "CASE "
    for i, (a, b) in enumerate(zip(BREAKS, BREAKS[1:])):
        last = i == len(BREAKS) - 2
        out += f"WHEN {v}>={a} AND {v}{'<=' if last else '<'}{b} THEN '[{a:g}, {b:g}{']' if last else ')'}' "
    return out + "END"


RATES = "rate AS (SELECT segm, avg(pobreza) AS p FROM survey WHERE l_partkey%10<>3 GROUP BY segm)"


def _rates(spark, d, observed="l_partkey % 10 <> 3"):
    return fx.survey(spark, d).filter(observed).groupBy("segm").agg(F.avg("pobreza").alias("p"))


@query("classify", fx.ctes("survey", extra=RATES.replace(" WHERE l_partkey%10<>3", "")) + f"SELECT segm, round(p,6) AS p, {_class_sql('p')} AS class FROM rate")
def classify(spark, d):
    return rounded(_rates(spark, d, "true").withColumn("class", geo.classify("p", BREAKS)))


@query("attach_to_zones", fx.ctes("survey", "covariates", extra=RATES) + "SELECT segm, p_size, round(p,6) AS p FROM covariates LEFT JOIN rate USING (segm)")
def attach_zones(spark, d):
    return rounded(attach_to_zones(fx.covariates(spark, d).select("segm", "p_size"), _rates(spark, d), "segm"))


@query("map_table", fx.ctes("survey", "covariates", extra=RATES) + f"SELECT segm, p_size, round(p,6) AS p, {_class_sql('p')} AS class FROM covariates LEFT JOIN rate USING (segm)")
def map_table(spark, d):
    return rounded(geo.map_table(fx.covariates(spark, d).select("segm", "p_size"), _rates(spark, d), "segm", "p", BREAKS))


@query(
    "facet_table",
    fx.ctes("survey", "covariates", extra="r AS (SELECT segm, edad, sexo, avg(pobreza) AS p FROM survey GROUP BY ALL), g AS (SELECT * FROM (SELECT DISTINCT segm FROM r) CROSS JOIN (SELECT DISTINCT edad FROM r) CROSS JOIN (SELECT DISTINCT sexo FROM r) LEFT JOIN r USING (segm, edad, sexo))")
    + f"""SELECT segm, edad, sexo, round(p,6) AS p, CASE edad WHEN '1' THEN '0 -14' WHEN '2' THEN '15 - 29' WHEN '3' THEN '30 - 44' WHEN '4' THEN '45 - 64' WHEN '5' THEN '65 - más' END AS "Fila",
CASE sexo WHEN '1' THEN 'Hombre' WHEN '2' THEN 'Mujer' END AS "Col", 'Edad' AS title_row, 'Sexo' AS title_col, {_class_sql('p')} AS class FROM (SELECT segm FROM covariates) LEFT JOIN g USING (segm)""",
)
def facet_table(spark, d):
    r = fx.survey(spark, d).groupBy("segm", "edad", "sexo").agg(F.avg("pobreza").alias("p"))
    return rounded(geo.facet_table(fx.covariates(spark, d).select("segm"), r, "segm", "edad", "sexo", "p", BREAKS))


ZONE = "concat('Z',CAST(CAST(floor(x/10) AS BIGINT) AS VARCHAR),'_',CAST(CAST(floor(y/2) AS BIGINT) AS VARCHAR))"


@query("points_in_zones", fx.ctes("pixels") + f"SELECT {ZONE} AS zone, band, count(*) AS n FROM pixels GROUP BY ALL")
def points_in_zones(spark, d):
    hit = geo.points_in_zones(fx.pixels(spark, d), fx.zones(spark, d), "zone", cell=5.0)
    return collapse(hit, ["zone", "band"])


@query(
    "zonal_sum",
    fx.ctes("pixels")
    + f"""SELECT {ZONE} AS zone, round(sum(value) FILTER (band='A'),2) AS "A", round(sum(value) FILTER (band='R'),2) AS "R" FROM pixels WHERE band IN ('A','R') AND date>=TIMESTAMP '1999-01-01' AND date<TIMESTAMP '2001-01-01' GROUP BY 1""",
)
def zonal_sum(spark, d):
    px = pixels_between(fx.pixels(spark, d), "1999-01-01", "2001-01-01", ["A", "R"])
    return rounded(geo.zonal_sum(px, fx.zones(spark, d), "zone", ["A", "R"], cell=5.0), 2)


@query(
    "zonal_sum_two_collections",
    fx.ctes("pixels", extra=f"""a AS (SELECT {ZONE} AS zone, sum(value) FILTER (band='A') AS "A" FROM pixels WHERE band='A' GROUP BY 1), b AS (SELECT {ZONE} AS zone, sum(value) FILTER (band='N') AS "N" FROM pixels WHERE band='N' GROUP BY 1)""")
    + 'SELECT zone, round("A",2) AS "A", round("N",2) AS "N" FROM a FULL JOIN b USING (zone)',
)
def zonal_sum_two_collections(spark, d):
    px, zones = fx.pixels(spark, d), fx.zones(spark, d)
    a = geo.zonal_sum(px, zones, "zone", ["A"], cell=5.0)
    b = geo.zonal_sum(px, zones, "zone", ["N"], cell=5.0)
    return rounded(geo.zonal_join(a, b, "zone"), 2)
