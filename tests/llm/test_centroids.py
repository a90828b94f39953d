import hashlib
import random

import numpy as np
import pytest

from arealis.llm import centroids
from arealis.llm.queries import op13_centroids

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string, id int, v int, centroid string"


def plain(rows, clusters=16, rounds=3, width=64, scale=64.0):
    """Lloyd rounds in Python integers; rows are (id, components)."""
    kept = []
    for i, x in rows:
        if x is not None and len(x) == width and all(c is not None and np.isfinite(c) for c in x):
            kept.append((i, [int(np.floor(scale * float(np.float32(c)))) for c in x]))
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] or 0, r[1]))
    cents = [v for _, v in start[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        got = assign()
        for k in range(len(cents)):
            own = [kept[j][1] for j, (_, c) in enumerate(got) if c == k]
            if own:
                cents[k] = [sum(col) // len(own) for col in zip(*own)]
    got = assign()
    per = {k: sum(d for d, c in got if c == k) for k in range(len(cents))}
    return sorted((str(i), c, d, per[c], sum(per.values()), hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()) for (i, _), (d, c) in zip(kept, got))


def rows_of(df):
    return sorted((str(r["vec_id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in df.collect())


def write(spark, rows, path):
    spark.createDataFrame([(i, x, "a", "b", 1, 2, "c") for i, x in rows], SCHEMA).repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(3)
    centers = rng.integers(-200, 200, (6, 64))
    points = centers[rng.integers(0, 6, 500)] + rng.integers(-10, 10, (500, 64))
    cents = np.vstack([centers, rng.integers(-200, 200, (10, 64))])
    simplex = centroids.base_simplex(cents)
    low, high = simplex.bounds(simplex.apex(points), simplex.apex(cents))
    exact = centroids.squared_distances(points, cents)
    assert (low <= exact + 1e-6 * high).all() and (exact <= high + 1e-6 * high).all()
    cluster, distance, measured = centroids.nearest(points, simplex.apex(points), simplex, cents)
    assert (distance == exact.min(1)).all() and (cluster == exact.argmin(1)).all()
    assert measured < 0.4 * exact.size  # the rest is settled by the bounds


def test_dependent_and_equal_pivots():
    for cents in (np.zeros((5, 64), int), np.outer(np.arange(7), np.ones(64, int)), np.eye(3, 64, dtype=int)[[0, 0, 1, 2, 2]]):
        simplex = centroids.base_simplex(cents)
        points = np.vstack([cents, cents + 1, cents[::-1] - 3])
        cluster, distance, _ = centroids.nearest(points, simplex.apex(points), simplex, cents)
        exact = centroids.squared_distances(points, cents)
        assert (distance == exact.min(1)).all() and (cluster == exact.argmin(1)).all()


def test_query_matches_plain_rounds(spark, tmp_path):
    rng = random.Random(5)
    base = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in base[rng.randrange(5)]]) for i in range(300)]
    assert rows_of(op13_centroids(spark, write(spark, rows, tmp_path))) == plain(rows)


def test_awkward_vectors(spark, tmp_path):
    one = [float(k % 3) for k in range(64)]
    rows = [(1, None), (2, []), (3, one[:-1]), (4, [*one[:-1], None]), (5, [*one[:-1], float("nan")]), (6, [*one[:-1], float("-inf")])]
    rows += [(7, one)] * 4 + [(None, [-x for x in one]), (8, [x / 3 for x in one]), (8, [x / 5 for x in one])]
    got = rows_of(op13_centroids(spark, write(spark, rows, tmp_path)))
    assert got == plain(rows) and len(got) == 7


def test_empty_tables_and_large_components(spark, tmp_path):
    out = op13_centroids(spark, write(spark, [], tmp_path / "none"))
    assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert op13_centroids(spark, write(spark, [(1, None), (2, [1.0])], tmp_path / "unfit")).count() == 0
    with pytest.raises(Exception, match="beyond"):
        op13_centroids(spark, write(spark, [(1, [1e30] * 64)], tmp_path / "large")).collect()
