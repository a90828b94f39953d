import math

import pytest
from pyspark.sql import functions as F

from arealis.functions import codelists as cl
from arealis.functions import recode as rc


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_pad_code_never_truncates(spark):
    got = column(spark, ["7", "0111097", "12345678", None], "string", rc.pad_code("c", 7))
    assert got == ["0000007", "0111097", "12345678", None]


def test_concat_key_prints_missing_as_na(spark):
    assert column(spark, ["a", None], "string", rc.concat_key(F.lit("x"), "c", sep="-")) == ["x-a", "x-NA"]


def test_age_band(spark):
    ages = [0, 14, 15, 29, 30, 44, 45, 64, 65, None]
    assert column(spark, ages, "int", rc.age_band("c")) == ["1", "1", "2", "2", "3", "3", "4", "4", "5", "5"]


def test_schooling_band_variants(spark):
    years = [-1, 0, 6, 7, 12, 13, 88, 99, None]
    age = F.lit(30)
    assert column(spark, years, "int", rc.schooling_band("c", age)) == ["Error", "1", "2", "3", "3", "4", "99", "99", "98"]
    assert column(spark, years, "int", rc.schooling_band("c", age, "late")) == ["98", "1", "2", "3", "3", "4", "4", "4", "Error"]
    assert column(spark, [5], "int", rc.schooling_band("c", F.lit(3))) == ["98"]
    with pytest.raises(ValueError):
        rc.schooling_band("c", age, "other")


def test_codes_take_null_as_default(spark):
    assert column(spark, [1, 2, 3, None], "int", rc.ethnicity_code("c")) == ["1", "2", "3", "3"]
    assert column(spark, [1, 0, None], "int", rc.area_code("c")) == ["1", "0", "0"]


def test_poverty_flag_keeps_missing(spark):
    assert column(spark, [5.0, 10.0, None], "double", rc.poverty_flag("c", F.lit(10.0))) == [1, 0, None]


def test_floors(spark):
    assert column(spark, [0.0, 0.2, None], "double", rc.floor_se("c")) == [1e-5, 0.2, None]
    assert column(spark, [0.0, 2.0, float("nan"), None], "double", rc.floor_deff("c")) == [1.0, 2.0, 1.0, 1.0]


def test_links_are_stable(spark):
    big = column(spark, [-800.0, 0.0, 800.0], "double", rc.inv_logit("c"))
    assert big == [0.0, 0.5, 1.0]
    theta = [column(spark, [900.0, -900.0], "double", t) for t in rc.softmax_ref("c", F.lit(0.0))]
    for i in range(2):
        assert math.isclose(sum(t[i] for t in theta), 1.0)
    assert column(spark, [0.0, 0.5, 1.0], "double", rc.logit("c")) == [None, 0.0, None]


def test_round_half_even(spark):
    assert column(spark, [0.5, 1.5, 2.5, 3.5], "double", rc.round_half_even("c")) == [0.0, 2.0, 2.0, 4.0]


def test_arcsine_round_trip(spark):
    p = [0.0, 0.3, 1.0]
    assert column(spark, p, "double", rc.arcsine_inverse(rc.arcsine("c"))) == pytest.approx(p)


def test_relabel_policies(spark):
    assert column(spark, ["1", "9"], "string", cl.relabel("sexo", "c")) == ["Hombre", "9"]
    assert column(spark, ["01"], "string", cl.relabel("depto", "c")) == ["01"]
    with pytest.raises(KeyError):
        cl.relabel("nada", "c")
    with pytest.warns(UserWarning):
        assert column(spark, ["x"], "string", cl.relabel("nada", "c", missing="warn")) == ["x"]


def test_nan_becomes_null_and_selection(spark):
    df = spark.createDataFrame([(1, float("nan"), "a"), (2, 1.5, "b")], "k int, v double, s string")
    assert [r[0] for r in rc.nan_to_null(df).orderBy("k").select("v").collect()] == [None, 1.5]
    assert rc.select_numeric(df).columns == ["k", "v"]
    assert rc.select_matching(df, "^v", keep=["k"]).columns == ["k", "v"]
    assert rc.filter_all(df, ["s", "k"], lambda c: c.cast("string") != "2").count() == 1


def test_sum_with_missing_values(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "v double")
    assert df.agg(rc.sum_na("v", True)).first()[0] == 1.0
    assert df.agg(rc.sum_na("v", False)).first()[0] is None


def test_per_poverty_line_needs_one_line(spark):
    df = spark.createDataFrame([(10.0, 2.0), (20.0, 2.0)], "y double, lp double")
    assert [r[0] for r in rc.per_poverty_line(df, "y", "lp", df).select("y").collect()] == [5.0, 10.0]
    with pytest.raises(Exception, match="single-valued"):
        rc.per_poverty_line(df, "y", "lp", df.union(spark.createDataFrame([(1.0, 3.0)], df.schema))).collect()
