import pytest
from pyspark.sql import functions as F

from arealis.operators import cells as ce
from arealis.operators import joins as jn


@pytest.fixture(scope="module")
def people(spark):
    rows = [("a", 1, None), ("a", 1, 5), ("a", 2, 5), ("b", 2, 6), ("b", 2, 6), ("b", 2, None)]
    return spark.createDataFrame(rows, "area string, sexo int, years int")


def test_crosstab_tells_margin_from_missing(people):
    x = ce.crosstab(people, ["area", "years"])
    got = {(r["area_label"], r["years_label"]): r["value"] for r in x.collect()}
    assert got[("__tot__", "__tot__")] == 6
    assert got[("a", "__tot__")] == 3
    assert got[("a", "__na__")] == 1
    assert got[("__tot__", "__na__")] == 2


def test_drop_margins_equals_plain_counts(people):
    a = ce.drop_margins(ce.crosstab(people, ["area", "years"]))
    b = ce.crosstab(people, ["area", "years"], margins=False)
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_margin_check_totals_agree(people):
    cells = ce.collapse(people, ["area", "sexo"])
    rows = ce.margin_check(cells, ["area", "sexo"], "n").collect()
    for v in ("area", "sexo"):
        part = [r for r in rows if r["variable"] == v]
        assert sum(r["n"] for r in part) == 6 and all(r["total"] == 6 for r in part)
        assert sum(r["prop"] for r in part) == pytest.approx(1)


def test_rates_and_missing_conditions(people):
    rate = lambda na_rm: {
        r["area"]: r["rate"] for r in ce.conditional_rate(people, ["area"], F.col("years") == 5, F.lit(True), na_rm=na_rm).collect()
    }
    assert rate(True)["a"] == pytest.approx(2 / 3)
    assert rate(False)["a"] is None
    labels = {r["area"]: r["r"] for r in ce.label_rates(people, ["area"], {"r": ("years", "5")}).collect()}
    assert labels == {"a": 1.0, "b": 0.0}


def test_unemployment_needs_both_classes(spark):
    df = spark.createDataFrame([("a", 2), ("a", 3), ("a", 4), ("b", 2)], "area string, s int")
    got = {r["area"]: r["tasa_desocupacion"] for r in ce.unemployment_rate(df, ["area"], "s").collect()}
    assert got["a"] == pytest.approx(2 / 3) and got["b"] is None


def test_share_profile_fill_and_require_all(spark):
    df = spark.createDataFrame([("a", "1", 3), ("a", "2", 1), ("b", "1", 2)], "area string, v string, n int")
    names = {"1": "one", "2": "two"}
    null = {r["area"]: (r["one"], r["two"]) for r in ce.share_profile(df, ["area"], "v", names).collect()}
    assert null == {"a": (0.75, 0.25), "b": (1.0, None)}
    zero = {r["area"]: r["two"] for r in ce.share_profile(df, ["area"], "v", names, fill=0).collect()}
    assert zero["b"] == 0.0
    strict = {r["area"]: r["one"] for r in ce.share_profile(df, ["area"], "v", names, require_all=True).collect()}
    assert strict == {"a": 0.75, "b": None}


def test_employment_rates(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 1.0), (3, 1.0)], "empleo int, fep double")
    r = ce.employment_rates_survey(df).first()
    assert (r["Nacional"], r["n_sample"]) == ("Nacional", 3)
    assert (r["TD"], r["TO"], r["TP"]) == pytest.approx((100 / 3, 50, 75))
    c = spark.createDataFrame([(4, 0.5, 0.25), (6, 0.5, 0.0)], "n int, theta_1 double, theta_2 double")
    r = ce.employment_rates_census(c).first()
    assert (r["TD"], r["TO"], r["TP"]) == pytest.approx((100 / 6, 50, 60))


def test_employment_rates_missing_weight(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "empleo int, fep double")
    assert ce.employment_rates_survey(df).first()["TO"] is None
    assert ce.employment_rates_survey(df, na_rm=True).first()["TO"] == 100.0


def test_complete_grid_fills_combinations(spark):
    df = spark.createDataFrame([("a", "x", "1", 5), ("b", "y", "2", 6)], "k string, r string, c string, v int")
    out = jn.complete_grid(df, ["k", "r", "c"])
    assert out.count() == 8 and out.filter("v is not null").count() == 2
    many = spark.range(12_000).selectExpr("id", "id % 2 AS k")
    assert jn.complete_grid(many, ["k", "id"]).count() == 24_000


def test_axis_order(spark):
    df = spark.createDataFrame([("a", 1, 1), ("b", 1, 1), ("c", 2, 1)], "x string, y int, z int")
    assert ce.axis_order(df, ["z", "y", "x"]) == ["x", "y", "z"]


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_row_position_does_not_depend_on_partitions(spark, parts):
    df = spark.range(500).withColumn("k", F.col("id") % 25).repartition(parts)
    out = {(r["id"]): r["position"] for r in ce.row_position(df, ["id", "k"]).collect()}
    assert sorted(out.values()) == list(range(1, 501))
    again = {r["id"]: r["position"] for r in ce.row_position(df.coalesce(1), ["id", "k"]).collect()}
    assert out == again


def test_sample_reads_its_rows_once(spark):
    """Positions, bucket sizes and the total share what is computed before the cells' shuffle; picks are the rows at their positions."""
    read = spark.sparkContext.accumulator(0)

    def source(batches):
        for pdf in batches:
            read.add(len(pdf))
            yield pdf

    rows = spark.range(600, numPartitions=3).select((F.col("id") % 200).alias("k"), F.lit(None).cast("string").alias("g")).mapInPandas(source, "k long, g string")
    cells = rows.groupBy("k", "g").agg(F.count(F.lit(1)).alias("n"))
    picked = ce.sample_with_replacement(ce.row_position(cells, ["k", "g"]), 50, "position", ce.row_total(cells, ["k", "g"]), seed=3).select("pick", "position", "k", "n").collect()
    assert read.value == 600
    place = {r["k"]: r["position"] for r in ce.row_position(cells, ["k", "g"]).collect()}
    assert sorted(place.values()) == list(range(1, 201))
    assert sorted(r["pick"] for r in picked) == list(range(1, 51)) and all(r["position"] == place[r["k"]] and r["n"] == 3 for r in picked)
    assert len({r["position"] for r in picked}) > 30
    assert cells.limit(0).select(ce.row_total(cells.where("false"), ["k"])).count() == 0


def test_share_within_null_prefix(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 2)], "g string, n int")
    got = sorted((str(r["g"]), r["share"]) for r in ce.share_within(df, "n", ["g"]).collect())
    assert got == [("None", 0.25), ("None", 0.75), ("a", 1.0)]


def test_samples(spark):
    df = spark.range(100)
    a = sorted(r[0] for r in ce.sample_rows(df, 10, "id").collect())
    assert len(set(a)) == 10 and a == sorted(r[0] for r in ce.sample_rows(df.repartition(13), 10, "id").collect())
    numbered = df.withColumn("position", F.col("id") + 1)
    assert ce.sample_with_replacement(numbered, 250, "position", 100).count() == 250


def test_histogram_last_bin_is_closed(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (2.0,)], "v double")
    got = {r["bin"]: (r["n"], r["density"]) for r in ce.histogram_table(df, "v", 2, 0.0, 1.0).collect()}
    assert got[0] == (1, pytest.approx(2 / 3)) and got[1] == (2, pytest.approx(4 / 3))


def test_split_observed(spark):
    df = spark.createDataFrame([("a", 0.2, 1.0), ("b", 0.0, 1.0), ("c", None, 1.0), ("d", 0.3, None)], "k string, p double, x double")
    seen, rest = jn.split_observed(df, "p", "x")
    assert [r["k"] for r in seen.collect()] == ["a"]
    assert sorted(r["k"] for r in rest.collect()) == ["b", "c"]


def test_correlations_and_tallies(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5)], "y double, x double")
    r = {x["covariate"]: x["r"] for x in ce.correlations(df, "y", {"x": F.col("x"), "minus": -F.col("x")}).collect()}
    assert r["x"] == pytest.approx(-r["minus"]) and r["x"] > 0.99
    freq = {r["y"]: r["n"] for r in ce.frequency_table(spark.createDataFrame([(1,), (1,), (None,)], "y int"), "y").collect()}
    assert freq == {"1": 2, "__na__": 1, "__tot__": 3}
