import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealis.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shares(sizes, weights=(5, 2, 1), cap=3):
    """Targets by sharing again and again what lies above the caps; ``sizes`` in source order."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    out, left, free = [0.0] * len(sizes), float(sum(sizes)), set(range(len(sizes)))
    while free:
        level = left / sum(weight[i] for i in free)
        over = [i for i in free if weight[i] * level > cap * sizes[i]]
        if not over:
            for i in free:
                out[i] = weight[i] * level
            break
        for i in over:
            out[i] = float(cap * sizes[i])
            left -= out[i]
            free.discard(i)
    return out


@pytest.mark.parametrize("sizes", [[100, 10, 1, 5000], [7, 7, 7], [0, 0], [1], [3, 100000, 2, 2, 50, 9, 0]])
def test_targets_match_repeated_sharing(spark, sizes):
    table = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = [r["target"] for r in mixing.source_targets(table).orderBy("source").collect()]
    assert got == pytest.approx(shares(sizes))


def test_mix_meets_targets_whatever_the_buckets(spark, prose):
    rng = np.random.default_rng(1)
    rows = [(i, prose(int(rng.integers(0, 60))), "abcde"[int(rng.integers(0, 5)) if i % 3 else 0]) for i in range(400)]
    rows += [(900, "alone here", None), (901, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    a = mixing.plan_mix(df, bucket_rows=20).toPandas().set_index("doc_id").sort_index()
    b = mixing.plan_mix(df.repartition(5), bucket_rows=10**6).toPandas().set_index("doc_id").sort_index()
    assert (a["taken"] == b["taken"]).all()
    names = sorted(a["source"].dropna().unique()) + [None]
    sizes = [int(a["size"][a["source"].eq(n) if n else a["source"].isna()].sum()) for n in names]
    for name, target in zip(names, shares(sizes), strict=True):
        mine = a[a["source"].eq(name) if name else a["source"].isna()]
        assert mine["target"].iloc[0] == pytest.approx(target) and mine["taken"].sum() == int(target)
    assert (a["taken"] <= 3 * a["size"]).all()


def test_readings_follow_the_schedule(spark, prose):
    rows = [(i, prose(20), "abc"[i % 3]) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    planned = mixing.plan_mix(df).cache()
    read = mixing.lay_out(planned).select("doc_id", "source", "text", "time").toPandas()
    assert read["time"].is_monotonic_increasing and read["time"].between(0, 1).all()
    words = read["text"].map(lambda t: len(WORD.findall(t)))
    assert words.sum() == planned.agg(F.sum("taken")).first()[0]
    # the integral of a falling rate 1.5 .. 0.5 at half time is 5/8, of an even one 1/2, of a rising one 3/8
    for name, share in (("a", 0.625), ("b", 0.5), ("c", 0.375)):
        mine = read["source"] == name
        assert words[mine & (read["time"] < 0.5)].sum() / words[mine].sum() == pytest.approx(share, abs=0.02)


def test_awkward_rows(spark, awkward, empty):
    assert mixing.plan_mix(empty).count() == 0 and mixing.lay_out(mixing.plan_mix(empty)).count() == 0
    got = mixing.plan_mix(awkward).toPandas()
    assert len(got) == awkward.count() and got["taken"].notna().all() and (got["taken"] <= 3 * got["size"]).all()
    assert mixing.lay_out(mixing.plan_mix(awkward)).count() > 0


def test_training_order(spark, awkward, empty):
    """Places of first readings are gapless and follow the time; documents that are not read have neither."""
    planned = mixing.plan_mix(awkward, bucket_rows=2)
    out = mixing.training_order(planned, bucket_rows=2)
    assert out.columns == [*[c for c in planned.columns if c != "time"], "time", "position"] and out.count() == awkward.count()
    rows = out.collect()
    read = sorted((r for r in rows if r["position"] is not None), key=lambda r: r["position"])
    assert [r["position"] for r in read] == list(range(len(read))) and [r["time"] for r in read] == sorted(r["time"] for r in read)
    assert all((r["position"] is None) == (r["taken"] == 0) == (r["time"] is None) for r in rows) and any(r["position"] is None for r in rows)
    assert mixing.training_order(mixing.plan_mix(empty)).count() == 0
