"""Centroid clustering on integer vectors, with centroids filtered by n-simplex projections."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import quoted, staged

PIVOTS = 8
TILE = 4096  # vectors measured at once in a task
LARGEST = 1 << 27  # components beyond this have squared distances beyond 64 bits


@dataclass(frozen=True)
class Simplex:
    """Base simplex of the pivots: the first one is the origin, ``lower`` holds the coordinates of the others.

    The apex of a point over the base follows from its distances to the pivots alone: its coordinates in the span of the
    pivots by forward substitution, and its altitude above the span.  Two apexes bound the distance of their points: below
    by their own distance, above by the distance with one of them reflected through the span.
    """

    pivots: np.ndarray
    lower: np.ndarray

    def apex(self, points: np.ndarray) -> np.ndarray:
        d = squared_distances(points, self.pivots).astype(float)
        base = squared_distances(self.pivots[1:], self.pivots[:1]).astype(float)[:, 0]
        inner = (d[:, :1] + base - d[:, 1:]) / 2
        flat = np.zeros_like(inner)
        for i in range(inner.shape[1]):
            flat[:, i] = (inner[:, i] - flat[:, :i] @ self.lower[i, :i]) / self.lower[i, i]
        altitude = np.sqrt(np.maximum(d[:, 0] - (flat**2).sum(1), 0.0))
        return np.column_stack([flat, altitude])

    @staticmethod
    def bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the squared distances of all points of ``a`` to those of ``b``, from their apexes."""
        near = ((a[:, None, :-1] - b[None, :, :-1]) ** 2).sum(2)
        return near + (a[:, None, -1] - b[None, :, -1]) ** 2, near + (a[:, None, -1] + b[None, :, -1]) ** 2


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows."""
    return np.stack([((a - row) ** 2).sum(1) for row in b], axis=1) if len(b) else np.zeros((len(a), 0), np.int64)


def base_simplex(candidates: np.ndarray, most: int = PIVOTS) -> Simplex:
    """Up to ``most`` of the candidates as pivots: each the one farthest above the span of those before it.

    Candidates close to the span (equal or dependent ones) are never taken, so the substitution stays well conditioned.
    """
    chosen, points = [0], candidates.astype(float) - candidates[0]
    rest, rows = points.copy(), []
    while len(chosen) < min(most, len(candidates)):
        height = np.sqrt((rest**2).sum(1))
        k = int(height.argmax())
        if height[k] <= 1e-3 * max(1.0, np.sqrt((points**2).sum(1)).max()):
            break
        axis = rest[k] / height[k]
        rest = rest - np.outer(rest @ axis, axis)
        chosen.append(k)
        rows.append(axis)
    lower = points[chosen[1:]] @ np.array(rows).T if rows else np.zeros((0, 0))
    return Simplex(candidates[chosen], lower)


def nearest(points: np.ndarray, apexes: np.ndarray, simplex: Simplex, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each point (ties: smaller number), its squared distance, and how many distances were measured.

    Only centroids whose lower bound is within the least upper bound are measured, in integers.
    """
    low, high = simplex.bounds(apexes, simplex.apex(centroids))
    slack = 1e-6 * (1.0 + high.max(1, initial=0.0, keepdims=True))
    open_ = low <= high.min(1, keepdims=True) + slack
    best, cluster = np.full(len(points), np.iinfo(np.int64).max), np.zeros(len(points), np.int32)
    for k, centroid in enumerate(centroids):
        rows = np.flatnonzero(open_[:, k])
        d = ((points[rows] - centroid) ** 2).sum(1)
        closer = d < best[rows]
        best[rows[closer]], cluster[rows[closer]] = d[closer], k
    return cluster, best, int(open_.sum())


def _matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def _with_apexes(simplex: Simplex, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), TILE):
                part = batch.slice(i, TILE)
                apex = simplex.apex(_matrix(part.column("v"), np.int64, width))
                flat = pa.FixedSizeListArray.from_arrays(pa.array(apex.ravel()), apex.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("v"), flat], ["id", "v", "apex"])

    return run


def _tiles(batches: Iterator[pa.RecordBatch], simplex: Simplex, centroids: np.ndarray):
    width = centroids.shape[1]
    for batch in batches:
        for i in range(0, len(batch), TILE):
            part = batch.slice(i, TILE)
            points = _matrix(part.column("v"), np.int64, width)
            apexes = _matrix(part.column("apex"), float, len(simplex.pivots))
            yield part, points, *nearest(points, apexes, simplex, centroids)


def _sums(simplex: Simplex, centroids: np.ndarray):
    """Per task: count and componentwise sums of each cluster that it meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), 1 + centroids.shape[1]), np.int64)
        for _, points, cluster, _, _ in _tiles(batches, simplex, centroids):
            for k in np.unique(cluster):
                rows = points[cluster == k]
                total[k] += np.concatenate([[len(rows)], rows.sum(0)])
        met = np.flatnonzero(total[:, 0])
        if len(met):
            yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met].tolist(), pa.list_(pa.int64()))], ["cluster", "sums"])

    return run


def _assign(simplex: Simplex, centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, cluster, distance, _ in _tiles(batches, simplex, centroids):
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(cluster), pa.array(distance)], ["id", "cluster", "distance"])

    return run


def integer_vectors(df: DataFrame, key: str, vector: str, width: int, scale: float) -> DataFrame:
    """Rows (``id``, ``v``) of the vectors with ``width`` components, none null or non-finite, as floors of ``scale`` times them."""
    parts = F.transform(quoted(vector), lambda x: x.cast("double"))
    sound = (F.size(parts) == width) & F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # whole numbers of any size within doubles; only those within LARGEST have distances of 64 bits
    scaled = F.transform(parts, lambda x: F.floor(x * scale).cast("double"))
    whole = F.transform(scaled, lambda x: F.when(F.abs(x) <= LARGEST, x.cast("long")).otherwise(F.raise_error(F.lit(f"a component is beyond {LARGEST}")).cast("long")))
    return df.select(quoted(key).cast("long").alias("id"), F.when(sound, whole).alias("v")).where("v is not null")


def start_order(key: str | Column, salt: str = "1") -> Column:
    """Hash that orders the starting centroids; a missing key reads as an empty string."""
    col = F.col(key) if isinstance(key, str) else key
    return F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(col.cast("string"), F.lit(""))), 256)


def cluster_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", clusters: int = 16, rounds: int = 3, width: int = 64, scale: float = 64.0) -> DataFrame:
    """Cluster vectors around centroids: key, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid`` (its components).

    Components become integers, ``floor(scale * x)``.  The centroids start as the vectors of the ``clusters`` smallest
    sha256 of ``1:<key>``; each of ``rounds`` assigns every vector to the nearest one (squared Euclidean distance; ties: the
    smaller number) and replaces non-empty centroids by the floors of their means; a last assignment gives the result.

    The starting centroids give the pivots of a base simplex.  The apex of every vector over it is computed once and written
    beside the vector; each round bounds its distances to all centroids from apexes, and only centroids that the bounds
    leave open are measured, in integers.  Tasks send one row of sums per cluster; only centroids come to the driver.

    Vectors that are null, of another length, or hold null or non-finite components are left out.  Rows that repeat a key
    are vectors of their own (in the start ties go to the smaller components); a null key is kept and hashes as empty.  With
    fewer vectors than clusters there are as many centroids as vectors; an empty table gives an empty result.  Other
    columns are ignored.  A component beyond 2^27 in size raises an error, since its distances do not fit a long.
    """
    vectors = integer_vectors(df, key, vector, width, scale)
    first = vectors.select(start_order("id").alias("h"), "id", "v").orderBy("h", "id", "v").limit(clusters).collect()
    centroids = np.array([r["v"] for r in first], np.int64).reshape(-1, width)
    schema = "id long, cluster int, distance long"
    if not len(centroids):
        assigned = df.sparkSession.createDataFrame([], schema)
        return _result(assigned, key, centroids, {})
    simplex = base_simplex(centroids)
    cached = staged(vectors.mapInArrow(_with_apexes(simplex, width), "id long, v array<long>, apex array<double>"))
    for _ in range(rounds):
        sums = cached.mapInArrow(_sums(simplex, centroids), "cluster int, sums array<long>")
        added = sums.select("cluster", F.posexplode("sums").alias("at", "s")).groupBy("cluster", "at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        table = {(r["cluster"], r["at"]): int(r["s"]) for r in added.collect()}
        means = [[table[k, 1 + i] // table[k, 0] for i in range(width)] if (k, 0) in table else centroids[k].tolist() for k in range(len(centroids))]
        centroids = np.array(means, np.int64)
    assigned = staged(cached.mapInArrow(_assign(simplex, centroids), schema))
    inertia = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    return _result(assigned, key, centroids, inertia)


def _result(assigned: DataFrame, key: str, centroids: np.ndarray, inertia: dict[int, int]) -> DataFrame:
    """Attach sums and components by the cluster's number; there are as many literals as clusters."""
    own = F.array(*[F.lit(inertia.get(k, 0)).cast("long") for k in range(len(centroids))]) if len(centroids) else F.array(F.lit(0).cast("long"))
    parts = [F.array(*[F.lit(int(x)).cast("long") for x in row]) for row in centroids] or [F.array().cast("array<long>")]
    return assigned.select(
        F.col("id").alias(key),
        "cluster",
        "distance",
        F.get(own, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        F.get(F.array(*parts), F.col("cluster")).alias("centroid"),
    )
