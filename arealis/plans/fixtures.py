"""Survey, census, covariate, zone and pixel tables derived from the order tables.

Each builder has an equal SQL text, so a query and its check start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.functions.recode import age_band, area_code, concat_key, ethnicity_code, pad_code, poverty_flag, schooling_band
from arealis.functions.rng import seeded_uniforms, uniform, uniform_draws, uniform_sql
from arealis.operators.cells import cell_id, cluster_cells
from arealis.operators.mrp import long_draws
from arealis.sources.io import read_survey, read_table

CELL_KEYS = ["segm", "mpio", "area", "sexo", "edad", "etnia", "anoest"]
# The eight 0/1 indicators and the condition that sets each of them.
INDICATORS = {
    "ipm_material": "l_discount >= 0.05",
    "ipm_hacinamiento": "l_discount >= 0.08",
    "ipm_agua": "l_tax >= 0.04",
    "ipm_saneamiento": "l_tax >= 0.06",
    "ipm_energia": "l_linenumber = 1",
    "ipm_internet": "l_quantity < 20",
    "ipm_educacion": "l_extendedprice < 30000",
    "ipm_empleo": "l_returnflag = 'N'",
}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, f"{d}/{name}.parquet")


def survey_raw(spark: SparkSession, d: str) -> DataFrame:
    li = read_survey(
        spark,
        f"{d}/lineitem.parquet",
        "l_orderkey l_partkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus".split(),
    )
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey"))
    mpio = pad_code(F.col("l_partkey") % 20, 4)
    return j.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        mpio.alias("mpio"),
        concat_key(mpio, F.lit("-"), "l_partkey").alias("segm"),
        F.col("c_mktsegment").alias("estrato"),
        F.col("c_nationkey").alias("upm"),
        F.col("l_quantity").alias("fep"),
        F.col("l_extendedprice").alias("ingcorte"),
        F.lit(10000.0).alias("lp"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("sexo"),
        F.floor(F.col("l_quantity") * 1.8).cast("int").alias("edad"),
        F.when(F.col("l_tax") >= 0.08, 99).otherwise(F.round(F.col("l_discount") * 200).cast("int")).alias("anoest"),
        F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 2).otherwise(3).alias("etnia_ee"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3).alias("condact3"),
        (F.col("l_linenumber") % 2).alias("areageo2"),
    )


SURVEY_RAW = """survey_raw AS (
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
       lpad(CAST(l_partkey % 20 AS VARCHAR(10)),4,'0') AS mpio,
       concat(lpad(CAST(l_partkey % 20 AS VARCHAR(10)),4,'0'),'-',CAST(l_partkey AS VARCHAR(10))) AS segm,
       c_mktsegment AS estrato, c_nationkey AS upm,
       l_quantity AS fep, l_extendedprice AS ingcorte, CAST(10000 AS DOUBLE) AS lp,
       CASE WHEN l_linestatus='F' THEN 1 ELSE 2 END AS sexo,
       CAST(floor(l_quantity*1.8) AS INT) AS edad,
       CASE WHEN l_tax>=0.08 THEN 99 ELSE CAST(round(l_discount*200) AS INT) END AS anoest,
       CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS etnia_ee,
       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS condact3,
       l_linenumber % 2 AS areageo2
FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey)"""


def survey(spark: SparkSession, d: str) -> DataFrame:
    """Recoded survey, one row per person."""
    raw = survey_raw(spark, d)
    return raw.select(
        "l_partkey",
        "mpio",
        "segm",
        "estrato",
        "upm",
        area_code("areageo2").alias("area"),
        F.col("sexo").cast("string").alias("sexo"),
        schooling_band("anoest", "edad").alias("anoest"),
        age_band("edad").alias("edad"),
        ethnicity_code("etnia_ee").alias("etnia"),
        F.col("condact3").alias("empleo"),
        F.col("ingcorte").alias("ingreso"),
        "lp",
        "fep",
        poverty_flag("ingcorte", "lp").alias("pobreza"),
        *[F.expr(cond).cast("int").alias(name) for name, cond in INDICATORS.items()],
    )


def deprivations(spark: SparkSession, d: str) -> DataFrame:
    """The survey with eight deprivations that depend on age, sex, schooling and area without being fixed by them.

    Each is a keyed uniform of the person against a logistic probability with an effect of the area, so that models with
    all terms have something to find.
    """
    raw = survey_raw(spark, d).withColumn("__row", F.concat_ws(":", "l_orderkey", "l_linenumber"))
    people = raw.select(
        "__row",
        "l_partkey",
        "mpio",
        "segm",
        area_code("areageo2").alias("area"),
        F.col("sexo").cast("string").alias("sexo"),
        schooling_band("anoest", "edad").alias("anoest"),
        age_band("edad").alias("edad"),
        ethnicity_code("etnia_ee").alias("etnia"),
    )
    seeds = {"__place": ([f"place{k}" for k in range(len(INDICATORS))], "segm"), "__town": ([f"town{k}" for k in range(len(INDICATORS))], "mpio"), "__own": (list(INDICATORS), "__row")}
    people = people.withColumns({c: seeded_uniforms(names, key) for c, (names, key) in seeds.items()})
    out = {}
    for k, name in enumerate(INDICATORS):
        eta = F.lit(-1.2 + 0.2 * k) + 0.15 * (k % 3) * F.col("edad").cast("double") - 0.3 * (F.col("sexo") == "2").cast("double") + 0.4 * (F.col("area") == "1").cast("double")
        eta = eta - 0.25 * (F.col("anoest") == "3").cast("double") + 0.3 * (F.col("etnia") == "1").cast("double") + 1.2 * (F.get("__place", k) - 0.5) + 0.8 * (F.get("__town", k) - 0.5)
        out[name] = (F.get("__own", k) < 1 / (1 + F.exp(-eta))).cast("int")
    return people.withColumns(out).drop("__row", *seeds)


AGE_SQL = "CASE WHEN edad<15 THEN '1' WHEN edad<30 THEN '2' WHEN edad<45 THEN '3' WHEN edad<65 THEN '4' ELSE '5' END"
SCHOOL_SQL = (
    "CASE WHEN edad<4 OR anoest IS NULL THEN '98' WHEN anoest IN (88,99) THEN '99' WHEN anoest=0 THEN '1' "
    "WHEN anoest BETWEEN 1 AND 6 THEN '2' WHEN anoest BETWEEN 7 AND 12 THEN '3' WHEN anoest>12 THEN '4' ELSE 'Error' END"
)
SURVEY = (
    """survey AS (
SELECT l_partkey, mpio, segm, estrato, upm, CASE WHEN areageo2=1 THEN '1' ELSE '0' END AS area, CAST(sexo AS VARCHAR) AS sexo,
       """
    + SCHOOL_SQL
    + " AS anoest, "
    + AGE_SQL
    + """ AS edad,
       CASE WHEN etnia_ee=1 THEN '1' WHEN etnia_ee=2 THEN '2' ELSE '3' END AS etnia, condact3 AS empleo, ingcorte AS ingreso, lp, fep,
       CAST(ingcorte<lp AS INT) AS pobreza, """
    + ", ".join(f"CAST({c} AS INT) AS {n}" for n, c in INDICATORS.items())
    + "\nFROM survey_raw)"
)


def census(spark: SparkSession, d: str) -> DataFrame:
    """Post-stratification cells with their counts and identifier."""
    cells = survey(spark, d).groupBy(*CELL_KEYS).agg(F.count(F.lit(1)).alias("n"))
    return cells.withColumn("cell_id", cell_id(*CELL_KEYS))


def cell_id_sql(*keys: str) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(concat('=', CAST({k} AS VARCHAR)), '~')" for k in keys) + "))"


CENSUS = f"""census AS (
SELECT *, {cell_id_sql(*CELL_KEYS)} AS cell_id
FROM (SELECT {', '.join(CELL_KEYS)}, count(*) AS n FROM survey GROUP BY ALL))"""


def covariates(spark: SparkSession, d: str, gaps: bool = False) -> DataFrame:
    """Area covariates; with ``gaps`` every fiftieth part has none, to meet areas without a match."""
    li = table(spark, d, "lineitem").groupBy("l_partkey").agg(
        F.avg("l_tax").alias("avg_tax"), F.avg((F.col("l_returnflag") == "R").cast("double")).alias("share_r")
    )
    part = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    if gaps:
        part = part.filter("p_partkey % 50 <> 7")
    mpio = pad_code(F.col("p_partkey") % 20, 4)
    return part.join(li, F.col("p_partkey") == F.col("l_partkey")).select(
        concat_key(mpio, F.lit("-"), "p_partkey").alias("segm"), F.col("p_size").cast("double").alias("p_size"), "p_retailprice", "avg_tax", "share_r"
    )


COVARIATES = """covariates AS (
SELECT concat(lpad(CAST(p_partkey % 20 AS VARCHAR),4,'0'),'-',CAST(p_partkey AS VARCHAR)) AS segm,
       CAST(p_size AS DOUBLE) AS p_size, p_retailprice, avg_tax, share_r
FROM part JOIN (SELECT l_partkey, avg(l_tax) AS avg_tax, avg(CASE WHEN l_returnflag='R' THEN 1.0 ELSE 0.0 END) AS share_r
                FROM lineitem GROUP BY l_partkey) ON p_partkey=l_partkey)"""
COVARIATES_GAPS = COVARIATES[:-1] + "\nWHERE p_partkey % 50 <> 7)"


def theta_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells with three category probabilities and a benchmark factor."""
    c = census(spark, d)
    u = [uniform(f"theta{k}", "cell_id") for k in (1, 2, 3)]
    c = c.withColumns({f"u{k + 1}": u[k] for k in range(3)}).withColumn("gk", 0.9 + 0.2 * uniform("gk", "cell_id"))
    tot = F.col("u1") + F.col("u2") + F.col("u3")
    return c.select(*CELL_KEYS, "cell_id", "n", *[(F.col(f"u{k}") / tot).alias(f"theta_{k}") for k in (1, 2, 3)], "gk")


THETA = f"""theta_cells AS (
SELECT {', '.join(CELL_KEYS)}, cell_id, n, u1/(u1+u2+u3) AS theta_1, u2/(u1+u2+u3) AS theta_2, u3/(u1+u2+u3) AS theta_3, gk
FROM (SELECT *, {uniform_sql('theta1', 'cell_id')} AS u1, {uniform_sql('theta2', 'cell_id')} AS u2, {uniform_sql('theta3', 'cell_id')} AS u3,
      0.9 + 0.2 * {uniform_sql('gk', 'cell_id')} AS gk FROM census))"""


def epred(spark: SparkSession, d: str, draws: int, cells: DataFrame | None = None, cluster: str | None = None) -> DataFrame:
    """Expected value per draw and cell, a keyed uniform; ``cluster`` names fine groups that will be summed."""
    return long_draws(packed_epred(spark, d, draws, cells, cluster), "value")


def packed_epred(spark: SparkSession, d: str, draws: int, cells: DataFrame | None = None, cluster: str | None = None) -> DataFrame:
    """The rows of :func:`epred` as one row per cell with an array of its draws."""
    c = census(spark, d) if cells is None else cells
    if cluster:
        c = cluster_cells(c, [cluster], "cell_id")
    return c.withColumn("value", uniform_draws("epred", draws, "cell_id"))


def epred_sql(draws: int, source: str = "census") -> str:
    return f"""epred AS (
SELECT *, {uniform_sql('epred', 'draw', 'cell_id')} AS value
FROM (SELECT {source}.*, d.draw FROM {source}, (SELECT unnest(range(1, {draws + 1})) AS draw) d))"""


def draws_table(spark: SparkSession, d: str, converged: bool = True) -> DataFrame:
    """Draws by chain and iteration for five variables: one row per order line, keyed uniforms as values.

    Chain and iteration come from numbering the survey's areas, so the table grows with the data.
    """
    areas = table(spark, d, "part").select("p_partkey")
    grid = areas.select(
        (F.col("p_partkey") % 4 + 1).cast("int").alias("chain"), F.floor((F.col("p_partkey") - 1) / 4 + 1).cast("int").alias("iteration"), F.col("p_partkey").alias("draw")
    )
    offset = F.lit(0.0) if converged else F.col("chain").cast("double")
    names = F.array(*[F.lit(f"beta_{k}") for k in range(1, 6)])
    return grid.withColumn("variable", F.explode(names)).withColumn("value", uniform("draws", "variable", "draw") + offset)


def draws_sql(converged: bool = True) -> str:
    offset = "0" if converged else "chain"
    return f"""draws AS (
SELECT *, {uniform_sql('draws', 'variable', 'draw')} + {offset} AS value
FROM (SELECT CAST(p_partkey % 4 + 1 AS INT) AS chain, CAST(floor((p_partkey - 1) / 4.0 + 1) AS INT) AS iteration, p_partkey AS draw,
             unnest(['beta_1','beta_2','beta_3','beta_4','beta_5']) AS variable FROM part))"""


def pixels(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(
        F.col("l_shipdate").alias("date"),
        F.col("l_returnflag").alias("band"),
        F.col("l_quantity").alias("x"),
        F.round(F.col("l_discount") * 100).alias("y"),
        F.col("l_extendedprice").alias("value"),
    )


PIXELS = """pixels AS (
SELECT l_shipdate AS date, l_returnflag AS band, l_quantity AS x, round(l_discount*100) AS y, l_extendedprice AS value FROM lineitem)"""


def zones(spark: SparkSession, d: str) -> DataFrame:
    """Grid of 10 x 2 rectangles over the range that the pixels span, built from the distinct grid cells of the data."""
    cells = pixels(spark, d).select(F.floor(F.col("x") / 10).alias("i"), F.floor(F.col("y") / 2).alias("j")).distinct()

    def corner(a: int, b: int):
        return F.struct(((F.col("i") + a) * 10).cast("double").alias("x"), ((F.col("j") + b) * 2).cast("double").alias("y"))

    return cells.select(
        F.concat(F.lit("Z"), F.col("i").cast("string"), F.lit("_"), F.col("j").cast("string")).alias("zone"),
        F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1)).alias("vertices"),
    )


ALL = {"survey_raw": SURVEY_RAW, "survey": SURVEY, "census": CENSUS, "covariates": COVARIATES, "covariates_gaps": COVARIATES_GAPS, "theta_cells": THETA, "pixels": PIXELS}
NEEDS = {"survey": ["survey_raw"], "census": ["survey_raw", "survey"], "theta_cells": ["survey_raw", "survey", "census"]}


def ctes(*names: str, extra: str = "") -> str:
    """WITH clause that defines the named tables and what they need."""
    order: list[str] = []
    for n in names:
        order += [m for m in [*NEEDS.get(n, []), n] if m not in order]
    parts = [ALL[n] for n in order]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"
