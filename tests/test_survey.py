import numpy as np
import pytest

from arealis.functions.numeric import beta_quantile, digamma, lgamma, t_quantile, trigamma
from arealis.operators import survey as sv


def brute(rows, by, y, lonely="adjust"):
    """Linearised variance from zero-padded PSU totals, straight from the definition."""
    psus = {}
    for r in rows:
        psus.setdefault(r["h"], set()).add(r["i"])
    out = {}
    for d in sorted({r[by] for r in rows}):
        here = [r for r in rows if r[by] == d and r[y] is not None]
        W = sum(r["w"] for r in here)
        p = sum(r["w"] * r[y] for r in here) / W
        var = 0.0
        for h, units in psus.items():
            z = np.array([sum(r["w"] * (r[y] - p) / W for r in here if r["h"] == h and r["i"] == i) for i in sorted(units)])
            n = len(z)
            if n > 1:
                var += n / (n - 1) * ((z - z.mean()) ** 2).sum()
            elif lonely == "adjust":
                var += float(z[0] ** 2)
        out[d] = (p, var)
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    out = []
    for k in range(400):
        h = int(rng.integers(3))
        i = 0 if h == 2 else int(rng.integers(6))
        d = "abc"[int(rng.integers(3))]
        if d == "c" and h == 1:
            continue
        out.append({"d": d, "h": f"h{h}", "i": i, "w": float(rng.uniform(1, 9)), "y": float(rng.integers(2)), "inc": float(rng.lognormal(8, 1))})
    out[5]["y"] = None
    return out


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "d string, h string, i int, w double, y double, inc double").repartition(parts)


@pytest.mark.parametrize("lonely", ["adjust", "remove"])
@pytest.mark.parametrize("y", ["y", "inc"])
def test_mean_and_variance_match_definition(spark, rows, y, lonely):
    design = sv.SurveyDesign(frame(spark, rows), "w", "h", "i", lonely_psu=lonely)
    got = {r["d"]: (r["mean"], r["var"]) for r in sv.survey_mean(design, y, ["d"]).collect()}
    want = brute(rows, "d", y, lonely)
    for d in want:
        assert got[d] == pytest.approx(want[d], rel=1e-9)


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_partition_count_does_not_matter(spark, rows, parts):
    design = sv.SurveyDesign(frame(spark, rows, parts), "w", "h", "i")
    got = {r["d"]: r["var"] for r in sv.survey_mean(design, "y", ["d"]).collect()}
    for d, (_, v) in brute(rows, "d", "y").items():
        assert got[d] == pytest.approx(v, rel=1e-9)


def test_prepared_design_gives_the_same(spark, rows):
    design = sv.SurveyDesign(frame(spark, rows), "w", "h", "i")
    a = sorted(map(tuple, sv.survey_mean(design, "inc", ["d"]).collect()))
    b = sorted(map(tuple, sv.survey_mean(design.prepare(), "inc", ["d"]).collect()))
    assert [x[0] for x in a] == [x[0] for x in b]
    assert [x[3] for x in a] == pytest.approx([x[3] for x in b])


def test_element_sampling(spark, rows):
    each = [dict(r, i=k) for k, r in enumerate(rows)]
    want = brute(each, "d", "inc")
    got = {r["d"]: (r["mean"], r["var"]) for r in sv.survey_mean(sv.SurveyDesign(frame(spark, rows), "w", "h"), "inc", ["d"]).collect()}
    for d in want:
        assert got[d] == pytest.approx(want[d], rel=1e-9)


def test_missing_outcome_with_and_without_removal(spark, rows):
    design = sv.SurveyDesign(frame(spark, rows), "w", "h", "i")
    d = rows[5]["d"]
    kept = {r["d"]: r["mean"] for r in sv.survey_mean(design, "y", ["d"], na_rm=False).collect()}
    assert kept[d] is None and sum(v is None for v in kept.values()) == 1
    var = {r["d"]: r["var"] for r in sv.survey_mean(design, "y", ["d"], na_rm=False).collect()}
    assert var[d] is None


def test_empty_and_all_missing(spark, rows):
    empty = frame(spark, rows).filter("false")
    assert sv.survey_mean(sv.SurveyDesign(empty, "w", "h", "i"), "y", ["d"]).count() == 0
    assert sv.direct_estimates(sv.SurveyDesign(empty, "w", "h", "i"), "y", ["d"]).count() == 0
    nulls = frame(spark, [dict(r, y=None) for r in rows[:20]])
    r = sv.survey_mean(sv.SurveyDesign(nulls, "w", "h", "i"), "y").first()
    assert r["mean"] is None and r["var"] is None


def test_repeated_unit_labels_need_nesting(spark, rows):
    with pytest.raises(Exception, match="nest"):
        sv.survey_mean(sv.SurveyDesign(frame(spark, rows), "w", "h", "i", nest=False), "y").collect()
    with pytest.raises(ValueError):
        sv.SurveyDesign(frame(spark, rows), "w", lonely_psu="other")


def test_quality_flags(spark):
    rows = [{"d": "few", "h": "s", "i": k, "w": 2.0, "y": float(k % 2), "inc": 0.0} for k in range(3)]
    rows += [{"d": "one_df", "h": "s", "i": k % 2, "w": 2.0, "y": float(k % 3 == 0), "inc": 0.0} for k in range(12)]
    rows += [{"d": "fine", "h": "s", "i": k % 8, "w": 1.0 + k % 5, "y": float(k % 8 < 3), "inc": 0.0} for k in range(60)]
    e = sv.direct_estimates(sv.SurveyDesign(frame(spark, rows), "w", "h", "i"), "y", ["d"])
    got = {r["d"]: r for r in e.collect()}
    assert (got["few"]["Exclusion_n"], got["few"]["Exclusion_GL"], got["few"]["Flag"]) == (1, 1, "Excluir")
    assert (got["one_df"]["grados"], got["one_df"]["Flag"]) == (1, "Excluir")
    assert (got["fine"]["grados"], got["fine"]["Flag"]) == (7, "Incluir")
    assert got["fine"]["LI"] < got["fine"]["p"] < got["fine"]["LS"]
    assert got["fine"]["n_eff"] == pytest.approx(got["fine"]["n"] / got["fine"]["deff"])


def test_zero_variance_area(spark):
    rows = [{"d": "z", "h": f"h{k % 2}", "i": k % 4, "w": 1.0 + k, "y": 0.0, "inc": 0.0} for k in range(20)]
    r = sv.direct_estimates(sv.SurveyDesign(frame(spark, rows), "w", "h", "i"), "y", ["d"]).first()
    assert r["p"] == 0.0 and r["ee"] == 0.0 and r["deff"] is None and r["CVl"] is None


def test_zero_weights_give_missing_estimates(spark):
    rows = [{"d": d, "h": "s", "i": k, "w": 0.0 if d == "none" else 2.0, "y": float(k % 2), "inc": 1.0} for d in ("none", "some") for k in range(6)]
    got = {r["d"]: r for r in sv.direct_estimates(sv.SurveyDesign(frame(spark, rows), "w", "h", "i"), "y", ["d"]).collect()}
    assert got["none"]["p"] is None and got["some"]["p"] == 0.5


def test_student_interval(spark):
    df = spark.createDataFrame([(0.2, 0.05, 8)], "p double, se double, df int")
    lo, hi = sv.logit_interval("p", "se", df="df")
    a, b = df.select(lo, hi).first()
    half = 2.306004135204166 * 0.05 / 0.16
    want = [1 / (1 + np.exp(-(np.log(0.25) + s * half))) for s in (-1, 1)]
    assert (a, b) == pytest.approx(want, abs=1e-9)


def test_quantiles_and_special_functions():
    assert t_quantile(0.975, np.array([1, 5, 30.0])) == pytest.approx([12.706204736, 2.570581836, 2.042272456], abs=1e-7)
    assert np.isnan(t_quantile(0.975, np.array([0.0]))[0])
    assert beta_quantile(0.5, np.array([2.0]), np.array([2.0]))[0] == pytest.approx(0.5)
    assert lgamma(np.array([0.5, 1, 5.0])) == pytest.approx([0.5723649429, 0, np.log(24)], abs=1e-9)
    assert digamma(np.array([1.0]))[0] == pytest.approx(-0.5772156649, abs=1e-9)
    assert trigamma(np.array([1.0]))[0] == pytest.approx(np.pi**2 / 6, abs=1e-9)


def test_trim_keeps_the_total(spark):
    df = spark.createDataFrame([(w,) for w in (1.0, 1.0, 1.0, 1.0, 100.0)], "w double")
    t = [r["weight_trim"] for r in sv.potter_trim(df, "w", 2.0).collect()]
    cap = np.sqrt(2 * 10004 / 5)
    assert sum(t) == pytest.approx(104)
    assert max(t) == pytest.approx(cap * 104 / (4 + cap))


def test_trim_grid_matches_separate_designs(spark, rows):
    design = sv.SurveyDesign(frame(spark, rows), "w", "h", "i")
    grid = {r["C"]: r for r in sv.trim_grid(design, "inc", [1.0, 1.1, 50.0]).collect()}
    q = np.mean([r["w"] ** 2 for r in rows])
    base = brute([dict(r, all="x") for r in rows], "all", "inc")["x"]
    for c in (1.0, 1.1):
        cut = [dict(r, all="x", w=min(r["w"], np.sqrt(c * q))) for r in rows]
        p, v = brute(cut, "all", "inc")["x"]
        assert grid[c]["mse"] == pytest.approx(v + (p - base[0]) ** 2, rel=1e-8)
    assert grid[50.0]["mse"] == pytest.approx(base[1], rel=1e-8)
    best = sv.best_trim(sv.trim_grid(design, "inc", [1.0, 1.1, 50.0])).first()
    assert best["mse"] == pytest.approx(min(r["mse"] for r in grid.values()))
