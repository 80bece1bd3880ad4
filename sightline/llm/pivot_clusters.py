"""Centroid clustering of vectors, with Ptolemaic lower bounds from pivots.

Ptolemy's inequality holds in Euclidean space: for a vector v, a centroid c and two
pivots p, q, ``d(v,c) * d(p,q) >= |d(v,p) * d(c,q) - d(v,q) * d(c,p)|``. So the distances
to a few fixed pivots bound the distance to every centroid from below.

1. Components become integers, floor(``scale`` * x). All distances between integers are
   exact; only bounds are floating-point, and they are rounded down by more than their
   error, so a bound is never above its distance.
2. The pivots are spread vectors among the first centroids. Every vector's squared
   distances to them are worked out once and kept beside the vector.
3. In each round a vector is measured against the centroid with the lowest bound; then
   only against those whose bound does not exceed that distance. The nearest of the
   survivors is the nearest of all, and ties go to the smaller number.
4. Every task adds its vectors up by cluster, so a round shuffles at most one row per
   task and cluster, however large a cluster is. The driver sees the sums of ``k``
   clusters only.

Left out are rows without exactly ``size`` components or with a null or non-finite one.
Integers are held to +-2**27, so that distances fit 64 bits. Repeated rows count as often
as they come. Fewer vectors than ``k``: as many centroids as vectors; a null vec_id comes
last among equals of the seed order. No vectors: no rows. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.session import materialise

LIMIT = 1 << 27
PIVOTS = 4
SLACK = 1e-13  # far above the relative error of a few double operations
_ROWS = 4096


def whole_vectors(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """(vec_id, x): the components as integers, of the rows that have ``size`` finite ones."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall("x", lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)) & ~F.isnan(v))
    whole = F.transform("x", lambda v: F.floor(F.greatest(F.least(v * scale, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))).cast("int"))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
        .filter(F.coalesce((F.size("x") == size) & finite, F.lit(False))).select("vec_id", whole.alias("x"))
    )


def first_centroids(kept: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``seed`` and vec_id, in that order; equal ids by their components."""
    order = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(order.asc_nulls_last(), "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64)


def choose_pivots(points: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` different points, each as far as can be from those before it."""
    chosen, away = [], np.full(len(points), np.iinfo(np.int64).max)
    at = 0
    while len(points) and len(chosen) < n and away[at] > 0:
        chosen.append(at)
        away = np.minimum(away, squares(points, points[at: at + 1])[:, 0])
        at = int(away.argmax())
    return points[chosen]


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows (a x b)."""
    return np.stack([np.einsum("ij,ij->i", a - row, a - row) for row in b], axis=1)


@dataclass(frozen=True)
class Nearest:
    """Nearest centroid of vectors, by their squared distances to the pivots."""

    centroids: np.ndarray
    pivots: np.ndarray

    def bounds(self, to_pivots: np.ndarray) -> np.ndarray:
        """Squared lower bounds (vector x centroid), none above the exact one."""
        v, c = np.sqrt(to_pivots.astype(float)), np.sqrt(squares(self.centroids, self.pivots).astype(float))
        between = np.sqrt(squares(self.pivots, self.pivots).astype(float))
        best = np.zeros((len(v), len(c)))
        for p in range(len(self.pivots)):
            for q in range(p):
                one, other = np.outer(v[:, p], c[:, q]), np.outer(v[:, q], c[:, p])
                low = (np.abs(one - other) - SLACK * (one + other)) / (between[p, q] * (1 + SLACK))
                np.maximum(best, low, out=best)
        return best * best * (1 - SLACK)

    def assign(self, x: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(cluster, squared distance, distances worked out)."""
        low = self.bounds(to_pivots)
        first = low.argmin(axis=1)
        gap = x - self.centroids[first]
        most = np.einsum("ij,ij->i", gap, gap)
        near = low <= most[:, None]
        exact = np.full(low.shape, np.iinfo(np.int64).max)
        exact[np.arange(len(x)), first] = most
        near[np.arange(len(x)), first] = False
        for c in range(len(self.centroids)):
            rows = np.flatnonzero(near[:, c])
            gap = x[rows] - self.centroids[c]
            exact[rows, c] = np.einsum("ij,ij->i", gap, gap)
        cluster = exact.argmin(axis=1)  # the first of equals
        return cluster, exact[np.arange(len(x)), cluster], int(near.sum()) + len(x)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _measured(pivots: np.ndarray, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = squares(_matrix(batch.column("x"), width), pivots)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, found.size + 1, len(pivots), dtype=np.int32)), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("x"), lists], ["vec_id", "x", "to_pivots"])

    return run


def _blocks(batches: Iterator[pa.RecordBatch], nearest: Nearest):
    """(ids, vectors, cluster, distance) of some thousand rows at a time."""
    width, n = nearest.centroids.shape[1], len(nearest.pivots)
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            x = _matrix(part.column("x"), width)
            cluster, distance, _ = nearest.assign(x, _matrix(part.column("to_pivots"), n))
            yield part.column("vec_id"), x, cluster, distance


def _sums(nearest: Nearest):
    k, width = nearest.centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for _, x, cluster, _ in _blocks(batches, nearest):
            order = np.argsort(cluster, kind="stable")
            found, begin = np.unique(cluster[order], return_index=True)
            total[found] += np.add.reduceat(x[order], begin, axis=0)
            count += np.bincount(cluster, minlength=k)
        met = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met.astype(np.int32)), pa.array(count[met]), *(pa.array(total[met, i]) for i in range(width))],
            ["cluster", "n", *(f"s{i}" for i in range(width))])

    return run


def _assigned(nearest: Nearest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, cluster, distance in _blocks(batches, nearest):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return run


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_vectors(
    vectors: DataFrame, k: int = 40, rounds: int = 5, seed: str = "2:", size: int = 64, scale: int = 256, n_pivots: int = PIVOTS,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per kept vector."""
    spark = vectors.sparkSession
    kept = whole_vectors(vectors, size, scale)
    centroids = first_centroids(kept, k, seed)
    result = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return spark.createDataFrame([], result)
    pivots = choose_pivots(centroids, n_pivots)
    table = materialise(
        kept.mapInArrow(_measured(pivots, size), "vec_id long, x array<int>, to_pivots array<long>"), "pivot-distances")
    names = [f"s{i}" for i in range(size)]
    for _ in range(rounds):
        sums = table.mapInArrow(_sums(Nearest(centroids, pivots)), ", ".join(["cluster int", "n long", *(f"{s} long" for s in names)]))
        moved = centroids.copy()
        for r in sums.groupBy("cluster").agg(F.sum("n"), *[F.sum(s) for s in names]).collect():
            moved[r[0]] = [s // r[1] for s in r[2:]]
        centroids = moved
    last = materialise(table.mapInArrow(_assigned(Nearest(centroids, pivots)), "vec_id long, cluster int, distance long"), "clusters")
    inertia = last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("sum")).collect()
    most, total = (1 << 63) - 1, sum(int(r["sum"]) for r in inertia)
    of_cluster = spark.createDataFrame(
        [(r["cluster"], min(int(r["sum"]), most), min(total, most), digest(centroids[r["cluster"]])) for r in inertia],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return last.join(F.broadcast(of_cluster), "cluster").select(  # k rows at most
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
