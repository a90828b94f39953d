from collections import Counter
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from arealis.llm.common import key_uniform
from arealis.llm.sharding import communication_matrix, hypergeometric, shard_uniformly


def test_hypergeometric_follows_its_law(spark):
    for marked, total, drawn in ((30, 100, 20), (1, 5, 5), (0, 9, 4), (700, 1000, 400)):
        got = spark.range(20000).select(hypergeometric(key_uniform(1, F.col("id"), marked), F.lit(marked), F.lit(total), F.lit(drawn)).alias("x")).toPandas()["x"]
        low, high = max(0, drawn - (total - marked)), min(marked, drawn)
        assert got.min() >= low and got.max() <= high
        mean = drawn * marked / total
        spread = np.sqrt(mean * (1 - marked / total) * (total - drawn) / max(1, total - 1))
        assert abs(got.mean() - mean) < 5 * spread / np.sqrt(20000) + 1e-9
        assert abs(got.std() - spread) < 0.05 * spread + 1e-9


def test_matrix_has_exact_margins(spark):
    sizes = {0: 17, 1: 0, 2: 40, 3: 1, 5: 23, 6: 100}
    counts = spark.createDataFrame(list(sizes.items()), "part long, n long")
    rows = {r["part"]: r["sends"] for r in communication_matrix(counts, 7, sum(sizes.values()), 3, 3).collect()}
    assert all(sum(rows[p]) == n for p, n in sizes.items() if n)
    columns = np.array([r for r in rows.values()]).sum(0)
    assert columns.sum() == sum(sizes.values()) and columns.max() - columns.min() <= 1


def test_every_row_once_in_even_shards(spark, awkward):
    out = shard_uniformly(awkward, 4, seed=2, bucket_rows=2).toPandas()
    counts = Counter(out["shard"])
    assert len(out) == awkward.count() and set(counts) == {0, 1, 2, 3} and max(counts.values()) - min(counts.values()) <= 1
    for _, rows in out.groupby("shard"):
        assert sorted(rows["slot"]) == list(range(len(rows)))
    assert out.drop(columns=["shard", "slot"]).fillna("null").astype(str).value_counts().to_dict() == awkward.drop("shard", "slot").toPandas().fillna("null").astype(str).value_counts().to_dict()


def test_empty_and_few_rows(spark, empty):
    assert shard_uniformly(empty, 3).count() == 0
    out = shard_uniformly(spark.range(2), 5).toPandas()
    assert len(out) == 2 and out["shard"].nunique() == 2 and set(out["slot"]) == {0}


def test_orders_are_uniform(spark):
    base = spark.range(4).repartition(2).cache()
    seen = Counter()
    for seed in range(60):
        rows = shard_uniformly(base, 2, seed=seed).orderBy("shard", "slot").collect()
        seen[tuple(r["id"] for r in rows)] += 1
    assert set(seen) <= set(permutations(range(4))) and len(seen) >= 18 and max(seen.values()) <= 10
