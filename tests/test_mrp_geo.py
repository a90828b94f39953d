from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealis.functions.rng import normal, normal_draws, uniform, uniform_draws, with_normal_draws
from arealis.operators import geo, mrp


@pytest.fixture(scope="module")
def small(spark):
    cells = spark.createDataFrame(
        [("c1", "a", "1", 2, 1.1), ("c2", "a", "2", 3, 0.9), ("c3", "a", "98", 5, 1.0), ("c4", "b", "1", 4, 1.2)],
        "cell_id string, g string, anoest string, n int, gk double",
    )
    v = np.array([[0.1, 0.2, 0.3, 0.4], [0.2, 0.3, 0.1, 0.6], [0.0, 0.5, 0.2, 0.8]])
    rows = [(d + 1, f"c{c + 1}", float(v[d, c])) for d in range(3) for c in range(4)]
    return cells, spark.createDataFrame(rows, "draw int, cell_id string, value double"), v


def test_mrp_mean_and_sd(small):
    cells, epred, v = small
    got = {r["g"]: (r["mrp_estimate"], r["mrp_estimate_se"]) for r in mrp.mrp_estimate(epred, ["g"], cells=cells).collect()}
    a = v[:, :3] @ np.array([2, 3, 5]) / 10
    assert got["a"] == pytest.approx((a.mean(), a.std(ddof=1)))
    assert got["b"] == pytest.approx((v[:, 3].mean(), v[:, 3].std(ddof=1)))


def test_national_equals_manual(small):
    cells, epred, v = small
    r = mrp.mrp_estimate(epred, None, cells=cells).first()
    t = v @ np.array([2, 3, 5, 4]) / 14
    assert (r["Nacional"], r["mrp_estimate"]) == ("Nacional", pytest.approx(t.mean()))


def test_benchmark_and_negative_guard(small):
    cells, epred, v = small
    got = {r["g"]: r for r in mrp.mrp_benchmarked(epred, ["g"], cells=cells).collect()}
    b = v[:, :3] @ (np.array([2, 3, 5]) * np.array([1.1, 0.9, 1.0])) / 10
    assert got["a"]["Benchmarking_estimate"] == pytest.approx(b.mean()) and got["a"]["N"] == 10
    with pytest.raises(Exception, match="negative estimates"):
        mrp.mrp_benchmarked(epred.withColumn("value", F.col("value") - 1), ["g"], cells=cells).collect()


def test_schooling_gaps_are_left_out(small):
    cells, epred, _ = small
    assert sorted(r["anoest"] for r in mrp.mrp_estimate(epred, ["anoest"], cells=cells).collect()) == ["1", "2"]


def test_levels_equal_single_calls(small):
    cells, epred, _ = small
    all_levels = {(r["level"], r["g"], r["anoest"]): r["mrp_estimate"] for r in mrp.mrp_levels(epred, [[], ["g"], ["g", "anoest"]], cells=cells).collect()}
    assert all_levels[("Nacional", None, None)] == pytest.approx(mrp.mrp_estimate(epred, None, cells=cells).first()["mrp_estimate"])
    for r in mrp.mrp_estimate(epred, ["g"], cells=cells).collect():
        assert all_levels[("g", r["g"], None)] == pytest.approx(r["mrp_estimate"])
    for r in mrp.mrp_estimate(epred, ["g", "anoest"], cells=cells).collect():
        assert all_levels[("g x anoest", r["g"], r["anoest"])] == pytest.approx(r["mrp_estimate"])


def test_poverty_flag_over_all_combinations(spark):
    names = [f"d{i}" for i in range(8)]
    rows = [tuple(c) for c in product((0, 1), repeat=8)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names))
    got = df.withColumn("poor", mrp.multidim_poverty(names[:6], names[6:])).collect()
    assert all(r["poor"] == int(sum(r[n] for n in names[:6]) + 2 * (r["d6"] + r["d7"]) > 4) for r in got)
    assert sum(r["poor"] for r in got) == sum(sum(c[:6]) + 2 * sum(c[6:]) > 4 for c in rows)


def test_bernoulli_draws_do_not_depend_on_partitions(small):
    _, epred, _ = small
    key = lambda df: sorted((r["draw"], r["cell_id"], r["value"]) for r in df.collect())
    assert key(mrp.bernoulli_draws(epred.repartition(1), 3)) == key(mrp.bernoulli_draws(epred.repartition(9), 3))


def test_packed_draws_equal_keyed_long_ones(spark):
    """Arrays of draws hold the numbers of the column expressions, without a digest per long row in the plan."""
    cells = spark.createDataFrame([("c1", "a", 2), ("a longer key " * 9, "a", 3), ("", "b", 4), (None, "b", 5)], "cell_id string, g string, n int")
    packed = cells.withColumns({"value": uniform_draws("epred", 12, "cell_id"), "z": normal_draws("n", 12, "cell_id")})
    long = mrp.long_draws(mrp.bernoulli_draws(packed, "dim", out="hit"), "value", "z", "hit")
    want = long.withColumns({"value": uniform("epred", "draw", "cell_id"), "z": normal("n", "draw", "cell_id")})
    want = mrp.bernoulli_draws(want, "dim", out="hit").select(*long.columns)
    key = lambda df: sorted(df.collect(), key=lambda r: (r["n"], r["draw"]))
    got, expected = key(long), key(want)
    assert len(got) == 48 and [(r["draw"], r["value"], r["hit"]) for r in got] == [(r["draw"], r["value"], r["hit"]) for r in expected]
    assert [r["z"] for r in got] == pytest.approx([r["z"] for r in expected], abs=1e-12)
    assert "md5" not in long._jdf.queryExecution().optimizedPlan().toString()


def test_normal_draws_side_by_side_in_small_slices(spark):
    df = spark.createDataFrame([(i, f"g{i % 3}") for i in range(20)], "i int, g string")
    wide = with_normal_draws(df, 5, {"a": ("s", "g"), "b": ("t", "i")}, limit=40)
    got = sorted(mrp.long_draws(wide, "a", "b").withColumns({"x": normal("s", "draw", "g"), "y": normal("t", "draw", "i")}).collect())
    assert len(got) == 100 and [(r["a"], r["b"]) for r in got] == [pytest.approx((r["x"], r["y"]), abs=1e-12) for r in got]


@pytest.mark.parametrize("query", ["income_poststratified", "poverty_pipeline"])
def test_effects_of_a_group_are_not_drawn_again_for_every_cell(spark, query):
    """Normals of group and draw are made before cells become long, so no cosine is taken per draw and cell."""
    from arealis.plans import registry

    registry.load_all()
    plan = registry.QUERIES[query](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate " in plan and "COS(" not in plan.upper()


def test_bernoulli_arrays_keep_missing_chances(spark):
    df = spark.createDataFrame([("a", [0.0, None, 1.0]), ("b", None), ("c", [1.0])], "cell_id string, value array<double>")
    assert dict(map(tuple, mrp.bernoulli_draws(df, 1).collect())) == {"a": [0, None, 1], "b": None, "c": [1]}


def test_packed_values_join_cells_before_they_are_long(spark, small):
    cells, epred, v = small
    packed = spark.createDataFrame([(f"c{c + 1}", [float(x) for x in v[:, c]]) for c in range(4)], "cell_id string, value array<double>")
    for by in (["g"], None):
        got, want = ([tuple(r)[-2:] for r in mrp.mrp_estimate(e, by, cells=cells).orderBy("mrp_estimate").collect()] for e in (packed, epred))
        assert np.allclose(got, want)
    plan = mrp.mrp_estimate(packed, ["g"], cells=cells)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate posexplode") < plan.index("MapInArrow") < plan.index("Join Inner")


def test_packed_sums_equal_long_ones_with_gaps(spark):
    """Missing keys, weights and values, draws that some cells lack, and a group that the benchmark factor never reaches."""
    rows = [(f"c{i}", None if i % 5 == 0 else f"g{i % 3}", None if i == 4 else i % 4 + 1, None if i % 3 == 1 else 1.0 + i / 10, [None if (i + t) % 6 == 0 else (i * 7 + t) % 11 / 11 for t in range(4 - i % 2)]) for i in range(40)]
    packed = spark.createDataFrame([*rows, ("e", "g0", 2, 1.0, None)], "cell_id string, g string, n int, gk double, value array<double>").repartition(3)
    for by in (["g"], [], ["g", "cell_id"]):
        got, want = ({tuple(r)[: len(by) + 1]: tuple(r)[len(by) + 1 :] for r in mrp._totals(e, by, "n", "value", "gk").collect()} for e in (packed, mrp.long_draws(packed, "value")))
        assert got.keys() == want.keys()
        for k, w in want.items():
            assert [x is None for x in got[k]] == [x is None for x in w] and all(a == pytest.approx(b) for a, b in zip(got[k], w) if b is not None), k


@pytest.mark.parametrize("query", ["mrp_estimate_national", "mrp_estimate_by_area", "mrp_levels", "mrp_benchmarked", "mrp_without_schooling_gaps", "mrp_estimate_joined_cells", "bernoulli_draws", "multidim_poverty_draws", "dimension_estimates"])
def test_draws_of_cells_are_hashed_cell_by_cell(spark, query):
    from arealis.plans import registry

    registry.load_all()
    plan = registry.QUERIES[query](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    above, found, _ = plan.partition("Generate ")
    assert found and "md5" not in above and "ArrowEvalPython" in plan


def polygon(*xy):
    return [(float(x), float(y)) for x, y in xy]


def test_points_in_triangle_and_concave_polygon(spark):
    zones = spark.createDataFrame(
        [("tri", polygon((0, 0), (4, 0), (0, 4))), ("notch", polygon((10, 0), (16, 0), (16, 6), (13, 2), (10, 6)))],
        "zone string, vertices array<struct<x:double,y:double>>",
    )
    pts = [(1.0, 1.0, "tri"), (3.0, 3.0, None), (11.0, 1.0, "notch"), (13.0, 4.0, None), (13.0, 1.0, "notch"), (15.5, 4.5, "notch"), (20.0, 1.0, None)]
    df = spark.createDataFrame([(x, y) for x, y, _ in pts], "x double, y double")
    want = sorted((x, y, z) for x, y, z in pts if z)
    for cell in (1.0, 5.0, 100.0):
        assert sorted(map(tuple, geo.points_in_zones(df, zones, "zone", cell).collect())) == want


def test_shared_edges_go_to_one_zone(spark):
    square = lambda x: polygon((x, 0), (x + 1, 0), (x + 1, 1), (x, 1))
    zones = spark.createDataFrame([("l", square(0)), ("r", square(1))], "zone string, vertices array<struct<x:double,y:double>>")
    df = spark.createDataFrame([(1.0, 0.5), (1.0, 0.0), (0.0, 0.0), (2.0, 0.5), (0.5, 1.0)], "x double, y double")
    got = sorted(map(tuple, geo.points_in_zones(df, zones, "zone", 1.0).collect()))
    assert got == [(0.0, 0.0, "l"), (1.0, 0.0, "r"), (1.0, 0.5, "r")]


def test_crowded_square_keeps_every_point(spark):
    zones = spark.createDataFrame([("z", polygon((0, 0), (2, 0), (2, 2), (0, 2)))], "zone string, vertices array<struct<x:double,y:double>>")
    df = spark.range(3000).select(F.lit(0.5).alias("x"), F.lit(0.5).alias("y"), F.lit("b").alias("band"), F.lit(1.0).alias("value"))
    assert geo.points_in_zones(df, zones, "zone", 1.0).count() == 3000
    assert geo.zonal_sum(df, zones, "zone", ["b"], 1.0).first()["b"] == 3000.0


def test_classes(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.25,), (1.0,), (1.5,), (None,)], "v double")
    got = [r[0] for r in df.select(geo.classify("v", [0, 0.1, 0.4, 1])).collect()]
    assert got == ["[0, 0.1)", "[0.1, 0.4)", "[0.1, 0.4)", "[0.4, 1]", None, None]


def test_facets_need_code_lists(spark):
    df = spark.createDataFrame([("a", "1", "2", 0.5)], "depto string, sexo string, foo string, v double")
    with pytest.raises(KeyError):
        geo.facet_table(df.select("depto"), df, "depto", "sexo", "foo", "v")


def test_levels_of_packed_values_are_summed_in_one_pass(spark):
    """Several levels from packed values with gaps equal those of long rows; draws meet at a group as arrays, never as rows."""
    rows = [(f"c{i}", None if i % 7 == 0 else f"g{i % 3}", f"a{i % 11}", ("1", "2", "99")[i % 3], i % 4 + 1, [None if (i + t) % 6 == 0 else (i * 7 + t) % 11 / 11 for t in range(5)]) for i in range(60)]
    packed = spark.createDataFrame(rows, "cell_id string, mpio string, segm string, anoest string, n int, value array<double>").repartition(4)
    levels = [[], ["mpio"], ["segm"], ["mpio", "anoest"]]
    got, want = ({tuple(r)[:4]: tuple(r)[4:] for r in mrp.mrp_levels(e, levels).collect()} for e in (packed, mrp.long_draws(packed, "value")))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    plan = mrp.mrp_levels(packed, levels[:3])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate posexplode") < plan.index("RepartitionByExpression") and "Expand" not in plan


def test_packed_income_draws_are_the_long_ones(spark):
    from arealis.operators import mixed as mx

    rng = np.random.default_rng(3)
    rows = [(f"g{g}", f"g{g}.{k}", float(k % 2), float(rng.normal() + 0.3 * g)) for g in range(6) for k in range(5)]
    df = spark.createDataFrame(rows, "g string, cell_id string, x double, y double")
    xs = {"1": F.lit(1.0), "x": F.col("x")}
    fit, effects = mx.random_intercept_posterior(df, "y", xs, "g", points=41)
    cells = df.drop("y").union(spark.createDataFrame([("new", "n.0", 1.0), ("g1", "n.1", None)], "g string, cell_id string, x double"))
    packed = {r["cell_id"]: r["value"] for r in mx.packed_posterior_draws(cells, fit, effects, xs, "g", "cell_id", 7, seed=4).collect()}
    long = mx.posterior_epred_draws(cells, fit, effects, xs, "g", "cell_id", 7, seed=4)
    assert long.columns == ["draw", "cell_id", "g", "value"] and len(packed) == 32 and packed["n.1"] == [None] * 7
    assert {(r["cell_id"], r["draw"]): r["value"] for r in long.collect()} == {(c, t + 1): v for c, d in packed.items() for t, v in enumerate(d)}
    z = {r["draw"]: r["z"] for r in spark.range(1, 8).withColumnRenamed("id", "draw").select("draw", normal("u4", "draw", F.lit("new")).alias("z")).collect()}
    gen = np.random.default_rng(4)
    at = gen.choice(len(fit.lam), 7, p=fit.weights)
    s2 = fit.rss[at] / gen.chisquare(fit.free, 7)
    noise = gen.standard_normal((7, 2))
    for t in range(7):
        b = fit.beta[at[t]] + np.linalg.cholesky(s2[t] * fit.inv[at[t]]) @ noise[t]
        assert packed["n.0"][t] == pytest.approx(b.sum() + np.sqrt(s2[t] * fit.lam[at[t]]) * z[t + 1])
