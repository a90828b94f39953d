import re

import pytest
from pyspark.sql import functions as F

from arealis.operators import cells as ce
from arealis.operators import mrp
from arealis.operators import survey as sv
from arealis.plans import fixtures as fx
from arealis.plans import registry
from arealis.sources import io

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_csv_survey_with_schema(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("k,v\na,1.5\nb,NaN\n")
    df = io.read_survey(spark, str(path), fmt="csv", schema="k string, v double", header=True)
    assert sorted((r["k"], r["v"]) for r in df.collect()) == [("a", 1.5), ("b", None)]


def test_census_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "census")
    df = spark.createDataFrame([("a", 10, 1, 5), ("a", 30, 2, 7)], "segm string, edad int, condact3 int, n int")
    io.write_table(df, path)
    got = io.read_census(spark, path, min_age=13, status=[1, 2], columns=["segm", "n"])
    assert [tuple(r) for r in got.collect()] == [("a", 7)]
    text = plan(got)
    assert re.search(r"PushedFilters: \[.*GreaterThan\(edad,13\)", text)
    assert "ReadSchema: struct<segm:string,edad:int,condact3:int,n:int>" in text


def test_partitioned_write_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    io.write_table(spark.createDataFrame([("a", 1), ("b", 2)], "depto string, n int"), path, partition_by=["depto"])
    got = io.read_zones(spark, path, "depto", "b")
    assert got.count() == 1 and "PartitionFilters: [isnotnull(depto" in plan(got)


def test_zone_and_covariate_codes_are_padded(spark, tmp_path):
    path = str(tmp_path / "z")
    io.write_table(spark.createDataFrame([(7, "x", 1.0)], "code int, region string, v double"), path)
    assert io.read_zones(spark, path, "region", "x", "code", 4).first()["code"] == "0007"
    assert io.read_covariates(spark, path, "code", 3).first()["code"] == "007"


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    a = spark.range(200).select(F.col("id").alias("segm"), (F.col("id") * 2).alias("v"))
    io.write_bucketed(a, "bucket_a", "segm", 4, path=str(tmp_path / "a"))
    io.write_bucketed(a.withColumnRenamed("v", "u"), "bucket_b", "segm", 4, path=str(tmp_path / "b"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("bucket_a").join(spark.table("bucket_b"), "segm")
        assert j.count() == 200 and "Exchange" not in plan(j)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql("DROP TABLE bucket_a")
        spark.sql("DROP TABLE bucket_b")


def test_checkpoint_folder_is_required_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from arealis.session import ensure_checkpoint_dir

    assert ensure_checkpoint_dir(spark)
    conf = SimpleNamespace(get=lambda k, default=None: default)
    cluster = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None, getConf=lambda: conf)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=cluster, conf=conf))


@pytest.mark.parametrize("name", ["crosstab", "label_rates", "survey_mean", "mrp_estimate_by_area", "share_within", "zonal_sum", "complete_grid", "margin_check"])
def test_no_nested_loops(spark, name):
    registry.load_all()
    text = plan(registry.QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_cube_expands_cells_not_rows(spark):
    text = plan(ce.crosstab(fx.survey(spark, DATA), ["mpio", "sexo"]))
    assert text.index("Expand") < text.rindex("Exchange hashpartitioning(mpio")
    assert "l_tax" not in re.search(r"ReadSchema: struct<[^>]*l_partkey[^>]*>", text).group(0)


def test_direct_estimates_read_the_survey_once(spark):
    design = sv.SurveyDesign(fx.survey(spark, DATA), weight="fep", strata="estrato", psu="upm").prepare()
    text = plan(sv.direct_estimates(design, "pobreza", ["segm"], interval="normal"))
    assert text.count("lineitem.parquet") == 1


@pytest.fixture(scope="module")
def skewed(spark):
    """One area holds a third of all rows."""
    base = spark.range(30_000).withColumn("area", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("a"), (F.col("id") % 97).cast("string"))))
    return base.withColumns({"h": (F.col("id") % 4).cast("string"), "i": F.col("id") % 40, "w": 1.0 + F.col("id") % 7, "y": (F.col("id") % 11 < 4).cast("double")})


def test_hot_area_keeps_every_row(spark, skewed):
    got = {r["area"]: r for r in sv.survey_mean(sv.SurveyDesign(skewed, "w", "h", "i"), "y", ["area"]).collect()}
    pdf = skewed.filter("area = 'hot'").toPandas()
    assert got["hot"]["n"] == 10_000
    assert got["hot"]["mean"] == pytest.approx((pdf.w * pdf.y).sum() / pdf.w.sum())


def test_hot_area_is_dealt_over_tasks(spark, skewed):
    cells = skewed.select(F.col("id").cast("string").alias("cell_id"), "area", F.lit(1).alias("n"), (F.col("y") * 0.5).alias("p"))
    spread = ce.cluster_cells(cells, ["area"], "cell_id", limit=1000)
    assert spread.count() == 30_000
    assert spread.filter("area = 'hot'").select(F.spark_partition_id().alias("t")).distinct().count() > 3
    e = spread.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(3)))).withColumn("value", F.col("p"))
    got = {r["area"]: r["mrp_estimate"] for r in mrp.mrp_estimate(e, ["area"]).collect()}
    want = {r["area"]: r["m"] for r in cells.groupBy("area").agg(F.avg("p").alias("m")).collect()}
    assert got == pytest.approx(want)
