"""Operator 11: centroid clustering whose assignments are found by Orchard's search.

Each centroid has a list of the others, nearest first. A vector starts at some
centroid and walks down that centroid's list. A centroid that it finds closer
(or as close, with a smaller number) becomes the current one, and the walk goes
on at the head of its list; centroids once visited are skipped. By the triangle
inequality none that lies strictly beyond twice the current distance from the
current centroid can be as near, so the walk stops there. Everything is counted
in whole numbers, so ties are exact and results do not depend on partitions.

A round of centroids is one job: each task adds up its vectors by cluster and
dimension, and k x dims partial sums a task are shuffled and added. Only
centroids (k x dims numbers) ever come to the driver.

Defined results: vectors that are null, have another length, or hold null or
non-finite components take no part. A row counts as often as it occurs. A null
vec_id has no hash: such a vector starts a centroid only if there are too few
others (ties of hashes go by the vector). With fewer than k vectors there are
fewer centroids; an empty table gives no rows. Any component is scaled exactly,
however large; a squared distance that no long holds is an error, not a wrong
number. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
import math
from decimal import Decimal
from fractions import Fraction
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, staged

DIMS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
#: Below this, squared distances of vectors of up to 128 components stay below 2^63.
SMALL = 1 << 27
#: Vectors in numpy arrays at a time.
BATCH = 4_096
#: Leading components by which a vector's first centroid is guessed; any start gives the same result.
GLANCE = 8


def whole(v: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * v), exactly: 64-bit integers, or Python's where squares of 64 bits could overflow."""
    if not v.size or np.abs(v).max() * scale < SMALL:
        return np.floor(v * scale).astype(np.int64)
    return np.array([[math.floor(Fraction(float(x)) * scale) for x in row] for row in v], dtype=object).reshape(v.shape)


def fitting(rows: list[list[int]]) -> np.ndarray:
    """Centroids as an array of the narrowest exact type."""
    small = all(abs(x) < SMALL for row in rows for x in row)
    return np.array(rows, dtype=np.int64 if small else object)


class Orchard:
    """Centroids, and for each the others by distance."""

    def __init__(self, centroids: np.ndarray):
        self.c, k = centroids, len(centroids)
        self.lists = np.zeros((k, max(k - 1, 0)), np.int64)
        self.gaps = np.zeros((k, max(k - 1, 0)), centroids.dtype)
        for i in range(k):
            off = centroids - centroids[i]
            gap = (off * off).sum(axis=1)
            near = sorted((j for j in range(k) if j != i), key=lambda j: (gap[j], j))
            self.lists[i], self.gaps[i] = near, gap[near]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, squared distance) of each row of x; of centroids as near, the smallest number."""
        n, k = len(x), len(self.c)
        off = x[:, None, :GLANCE] - self.c[None, :, :GLANCE]
        cur = np.argmin((off * off).sum(axis=2), axis=1)
        off = x - self.c[cur]
        best = (off * off).sum(axis=1)
        place = np.zeros(n, np.int64)  # in the current centroid's list
        seen = np.zeros((n, k), bool)
        seen[np.arange(n), cur] = True
        live = np.arange(n)
        while True:
            live = live[place[live] < k - 1]
            if not len(live):
                return cur, best
            at = cur[live], place[live]
            near = self.gaps[at] <= 4 * best[live]  # else strictly beyond twice the distance
            live, to = live[near], self.lists[at][near]
            place[live] += 1
            new = ~seen[live, to]
            rows, to = live[new], to[new]
            seen[rows, to] = True
            off = x[rows] - self.c[to]
            d = (off * off).sum(axis=1)
            closer = (d < best[rows]) | ((d == best[rows]) & (to < cur[rows]))
            rows, to = rows[closer], to[closer]
            cur[rows], best[rows], place[rows] = to, d[closer], 0


def _batches(batches: Iterator[pa.RecordBatch], dims: int, scale: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(vec_id, scaled vectors) of rows (vec_id, v)."""
    for b in batches:
        for at in range(0, b.num_rows, BATCH):
            part = b.slice(at, BATCH)
            v = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            yield part.column(0), whole(v.reshape(part.num_rows, dims), scale)


def _sums(kept: DataFrame, centroids: np.ndarray, dims: int, scale: int) -> tuple[list, list]:
    """Rows, and componentwise sums, of each centroid's vectors."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, total, rows = Orchard(centroids), np.zeros((k, dims), object), np.zeros(k, np.int64)
        for _, x in _batches(batches, dims, scale):
            cluster, _ = search.nearest(x)
            for j in np.unique(cluster):
                of = x[cluster == j]
                total[j] += of.sum(axis=0).astype(object)
                rows[j] += len(of)
        at = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(at, dims).astype(np.int32)), pa.array(np.tile(np.arange(dims, dtype=np.int32), len(at))),
            pa.array(np.repeat(rows[at], dims)), pa.array([Decimal(int(s)) for j in at for s in total[j]], pa.decimal128(38, 0)),
        ], names=["cluster", "dim", "n", "total"])

    parts = kept.mapInArrow(run, "cluster int, dim int, n long, total decimal(38,0)")
    counts, sums = [0] * k, [[0] * dims for _ in range(k)]
    for r in parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():  # k x dims rows
        counts[r.cluster], sums[r.cluster][r.dim] = r.n, int(r.total)
    return counts, sums


def kept_vectors(vectors: DataFrame, dims: int = DIMS) -> DataFrame:
    """vec_id, v: the vectors that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return pick(vectors, "vec_id", "embedding").where(F.col("embedding").isNotNull() & (F.size("embedding") == dims) & finite).select(
        "vec_id", F.col("embedding").alias("v"))


def cluster_vectors(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = 3) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: every vector's cluster after `rounds` rounds."""
    spark = vectors.sparkSession
    kept = staged(kept_vectors(vectors, dims), "orchard-vectors")
    by_hash = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(by_hash.asc_nulls_last(), "v").limit(k).collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = fitting(whole(np.array([r.v for r in first], np.float64), scale).tolist())
    for _ in range(rounds):
        counts, sums = _sums(kept, centroids, dims, scale)
        centroids = fitting([[s // n for s in row] if n else [int(x) for x in old] for n, row, old in zip(counts, sums, centroids)])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(centroids)
        for ids, x in _batches(batches, dims, scale):
            cluster, distance = search.nearest(x)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    found = staged(kept.mapInArrow(assign, "vec_id long, cluster int, distance long"), "orchard-clusters")
    sums = {r.cluster: int(r.total) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}  # k rows
    digest = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]
    of_cluster = F.create_map(*(F.lit(x) for j, total in sums.items() for x in (j, total)))
    names = F.array(*(F.lit(d) for d in digest))
    return found.select("vec_id", "cluster", "distance", of_cluster[F.col("cluster")].cast("long").alias("cluster_inertia"),
                        F.lit(sum(sums.values())).cast("long").alias("inertia"), F.get(names, F.col("cluster")).alias("centroid_sha256"))
