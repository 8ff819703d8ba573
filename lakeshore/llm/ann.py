"""Operator 4: nearest neighbours by stable projections and kd-trees.

Vectors are projected to `DIMS` dimensions by a fixed Gaussian (2-stable)
matrix: for two vectors at distance d, (projected distance / d)^2 follows the
chi-square law with DIMS degrees of freedom. A query takes its neighbours in
the order of projected distance from a kd-tree, verifies each on the original
vectors, and stops at the first projected distance so large that a neighbour
closer than its current k-th would lie beyond it with probability below
1 - `SURE` only (the chi-square stopping test).

The space is cut into cells by the top of a kd-tree whose cuts come from a
bounded sample; every row is indexed in its cell, and large cells are dealt
over several tasks. A query first searches the cell it lies in; the distance of
its k-th neighbour there, with the stopping test, then tells which other cells
it must visit. A part of a cell goes once to every `QUERY_BLOCK` of its visitors,
and a cell without visitors goes nowhere. Only the cells' boxes and numbers of
rows and visitors go to the driver, one row a cell.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part, as query or candidate, nor does a row whose id is
null. Vectors compare with those of the same length only. Of equal vectors
only those with the k + 1 smallest ids can be among the k nearest, so the
others are left out of the index, not of the answer. Equal rows count
once; an id with several vectors is a candidate by each of them. An empty table
gives no rows; extra columns are left out.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_sample, pick, staged

K = 10
EVERY = 100
DIMS = 8
SURE = 0.99
#: Vectors from which the cells' cuts are taken, about, at most.
SAMPLE = 20_000
#: Vectors a cell should hold, and a task index at a time.
CELL_ROWS = 8_192
MAX_CELLS = 4_096
LEAF = 256
#: Queries that visit a part of a cell at a time, about.
QUERY_BLOCK = 16_384


def projection(dim: int, dims: int = DIMS, seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, dims))


def chi_square_cdf(x: float, k: int) -> float:
    """P(chi-square with k degrees of freedom <= x), by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, y = k / 2, x / 2
    term = total = 1 / a
    for i in range(1, 1000):
        term *= y / (a + i)
        total += term
        if term < total * 1e-12:
            break
    return min(1.0, total * math.exp(-y + a * math.log(y) - math.lgamma(a)))


def stop_ratio(sure: float = SURE, dims: int = DIMS) -> float:
    """The chi-square value that `sure` of all (projected distance / distance)^2 lie below."""
    lo, hi = 0.0, 1000.0
    while hi - lo > 1e-9:
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square_cdf(mid, dims) < sure else (lo, mid)
    return hi


class KdTree:
    """Points split at the median of their widest axis; leaves of at most LEAF points, with boxes for all nodes."""

    def __init__(self, points: np.ndarray):
        self.points, self.order = points, np.arange(len(points))
        self.nodes: list[tuple] = []  # (low corner, high corner, left, right) or (low, high, start, -end) for a leaf
        if len(points):
            self._build(0, len(points))

    def _build(self, a: int, b: int) -> int:
        p = self.points[self.order[a:b]]
        low, high = p.min(axis=0), p.max(axis=0)
        here = len(self.nodes)
        self.nodes.append(())
        if b - a <= LEAF or not (high > low).any():
            self.nodes[here] = (low, high, a, -b)
        else:
            mid = (b - a) // 2
            part = np.argpartition(p[:, int(np.argmax(high - low))], mid)
            self.order[a:b] = self.order[a:b][part]
            left = self._build(a, a + mid)
            self.nodes[here] = (low, high, left, self._build(a + mid, b))
        return here

    def incremental(self, q: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """Leaves' points as (least squared projected distance of the rest, positions), nearest leaf first."""
        def gap(node: tuple) -> float:
            d = np.maximum(np.maximum(node[0] - q, q - node[1]), 0)
            return float(d @ d)
        heap = [(gap(self.nodes[0]), 0)] if self.nodes else []
        while heap:
            d, at = heapq.heappop(heap)
            node = self.nodes[at]
            if node[3] < 0:
                yield d, self.order[node[2]:-node[3]]
            else:
                for child in node[2:]:
                    heapq.heappush(heap, (gap(self.nodes[child]), child))


def search(tree: KdTree, vectors: np.ndarray, ids: np.ndarray, q: np.ndarray, qp: np.ndarray, q_id: int,
           k: int, ratio: float, bound: float = math.inf) -> list[tuple[float, int]]:
    """The k nearest found (distance, id), ties to the smaller id; nothing farther than bound."""
    best: list[tuple[float, int]] = []
    limit = bound
    for gap, at in tree.incremental(qp):
        if gap > ratio * limit * limit * (1 + 1e-9):  # the stopping test; equal vectors pass together
            break
        off = tree.points[at] - qp
        at = at[np.einsum("ij,ij->i", off, off) <= ratio * limit * limit * (1 + 1e-9)] if limit < math.inf else at
        if not len(at):
            continue
        diff = vectors[at] - q
        dist = np.sqrt((diff * diff).sum(axis=1))
        closer = np.flatnonzero((dist <= limit) & (ids[at] != q_id))
        if not len(closer):
            continue
        if len(closer) > 4 * k:  # only the k nearest of them, and what ties with those, can matter
            closer = closer[dist[closer] <= np.partition(dist[closer], k)[k]]
        best += zip(dist[closer].tolist(), ids[at[closer]].tolist())
        best = sorted(set(best))[:k]
        if len(best) == k:
            limit = min(limit, best[-1][0])
    return best


# --- cells -----------------------------------------------------------------

class Cells:
    """The top of a kd-tree over projected space: cuts on a sample, one list of boxes for each vector length."""

    def __init__(self, sample: np.ndarray, rows: int):
        self.cuts: list[tuple] = []
        self.n = 0
        depth = max(0, min(int(math.log2(MAX_CELLS)), math.ceil(math.log2(max(1, rows / CELL_ROWS)))))
        self._cut(sample, depth)

    def _cut(self, p: np.ndarray, depth: int) -> int:
        here = len(self.cuts)
        self.cuts.append(())
        axis = int(np.argmax(p.max(axis=0) - p.min(axis=0))) if len(p) else 0
        if depth == 0 or len(p) < 2 or p[:, axis].min() == p[:, axis].max():
            self.cuts[here] = (-1, self.n, 0, 0)
            self.n += 1
            return here
        value = float(np.median(p[:, axis]))
        left = p[:, axis] < value
        if not left.any():
            value = float(p[p[:, axis] > value, axis].min())
            left = p[:, axis] < value
        a = self._cut(p[left], depth - 1)
        self.cuts[here] = (axis, value, a, self._cut(p[~left], depth - 1))
        return here

    def of(self, p: np.ndarray) -> np.ndarray:
        """Cell of each projected vector."""
        out, work = np.zeros(len(p), np.int64), [(0, np.arange(len(p)))]
        while work:
            at, rows = work.pop()
            axis, value, a, b = self.cuts[at]
            if axis < 0:
                out[rows] = value
            elif len(rows):
                left = p[rows, axis] < value
                work += [(a, rows[left]), (b, rows[~left])]
        return out

    def boxes(self, dims: int) -> tuple[np.ndarray, np.ndarray]:
        low, high = np.full((self.n, dims), -np.inf), np.full((self.n, dims), np.inf)

        def walk(at: int, lo: np.ndarray, hi: np.ndarray) -> None:
            axis, value, a, b = self.cuts[at]
            if axis < 0:
                low[value], high[value] = lo, hi
                return
            cut = hi.copy()
            cut[axis] = value
            walk(a, lo, cut)
            cut = lo.copy()
            cut[axis] = value
            walk(b, cut, hi)
        walk(0, low[0].copy(), high[0].copy())
        return low, high


def usable(vectors: DataFrame, k: int | None) -> DataFrame:
    """vec_id, v (array of double), n (its length): the vectors that take part; of equal ones the k + 1 smallest ids (all, if k is None)."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = pick(vectors, "vec_id", "embedding").where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("embedding", lambda x: x != 0))
    rows = rows.select("vec_id", v.alias("v")).distinct()
    if k is None:
        return rows.select("vec_id", "v", F.size("v").alias("n"))
    same = Window.partitionBy("v").orderBy("vec_id")
    # row_number with a limit: Spark keeps at most k + 1 rows of a vector in each task before the shuffle
    return rows.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1).select("vec_id", "v", F.size("v").alias("n"))


def _with_cells(rows: DataFrame, cells: dict[int, Cells], proj: dict[int, np.ndarray]) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for n, g in f.groupby("n"):
                p = np.stack(g["v"].to_numpy()) @ proj[n]
                yield g.assign(cell=cells[n].of(p))
    return rows.mapInPandas(run, "vec_id bigint, v array<double>, n int, cell bigint")


def _search_groups(k: int, ratio: float, proj: dict[int, np.ndarray]):
    """One part of a cell and the queries that visit it: each query's k nearest there."""
    cols = ["n", "query_id", "qv", "vec_id", "score"]

    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(index) and len(queries):
            n = int(index["n"].iloc[0])
            vectors, ids = np.stack(index["v"].to_numpy()), index["vec_id"].to_numpy()
            tree = KdTree(vectors @ proj[n])
            for q_id, v, bound in zip(queries["query_id"], queries["qv"], queries["bound"]):
                q = np.asarray(v)
                for d, i in search(tree, vectors, ids, q, q @ proj[n], q_id, k, ratio, bound):
                    out.append((n, q_id, v, i, d))
        return pd.DataFrame(out, columns=cols)
    return run


def nearest(vectors: DataFrame, k: int = K, every: int = EVERY, dims: int = DIMS, sure: float = SURE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every vector whose id is divisible by `every`."""
    clean = usable(vectors, k)
    index = staged(clean, "ann-vectors")
    # A query is looked up among all rows: the index leaves out ids that are not small among equal vectors.
    queries = pick(vectors, "vec_id", "embedding").where(F.col("vec_id") % every == 0)
    queries = staged(usable(queries, None), "ann-queries")
    totals = {r.n: r["count"] for r in index.groupBy("n").count().collect()}
    empty = "query_id long, rank int, vec_id long, score double"
    if not totals:
        return vectors.sparkSession.createDataFrame([], empty)
    proj = {n: projection(n, dims) for n in totals}
    ratio = stop_ratio(sure, dims)
    cells: dict[int, Cells] = {}
    share = max(1, SAMPLE // len(totals))
    for n, rows in totals.items():
        part = hash_sample(index.where(F.col("n") == n), F.col("vec_id"), share, rows).select("v").toPandas()["v"]
        cells[n] = Cells(np.stack(part.to_numpy()) @ proj[n] if len(part) else np.zeros((0, dims)), rows)
    placed = staged(_with_cells(index, cells, proj), "ann-index")
    size = {(r.n, r.cell): r["count"] for r in placed.groupBy("n", "cell").count().collect()}  # one row a cell
    parts = {c: max(1, -(-rows // (2 * CELL_ROWS))) for c, rows in size.items()}
    spark = vectors.sparkSession

    def cells_of(f: pd.DataFrame, first: bool) -> Iterator[tuple[tuple, list[int]]]:
        """Each query and the cells that it visits: its own first; then the others that the stopping test leaves."""
        boxes = {n: cells[n].boxes(dims) for n in set(f["n"])}
        for q in zip(f["query_id"], f["qv"], f["n"], f["bound"]):
            _, v, n, bound = q
            qp = np.asarray(v) @ proj[n]
            own = int(cells[n].of(qp[None])[0])
            if first:
                yield q, [own]
            else:
                d = np.maximum(np.maximum(boxes[n][0] - qp, qp - boxes[n][1]), 0)
                yield q, [int(c) for c in np.flatnonzero((d * d).sum(axis=1) <= ratio * bound * bound * (1 + 1e-9)) if c != own]

    def look(asked: DataFrame, first: bool) -> DataFrame:
        def visitors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                seen = Counter((q[2], c) for q, to in cells_of(f, first) for c in to)
                yield pd.DataFrame([(*at, m) for at, m in seen.items()], columns=["n", "cell", "m"])

        def visits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                yield pd.DataFrame([(q_id, v, n, c, p, bound) for (q_id, v, n, bound), to in cells_of(f, first) for c in to for p in range(parts.get((n, c), 0))],
                                   columns=["query_id", "qv", "n", "cell", "part", "bound"])

        # A cell meets its visitors block by block, and goes nowhere if it has none.
        met = {(r.n, r.cell): r.m for r in asked.mapInPandas(visitors, "n int, cell long, m long").groupBy("n", "cell").agg(F.sum("m").alias("m")).collect()}  # one row a cell
        dealt = F.broadcast(spark.createDataFrame([(n, c, parts[n, c], -(-m // QUERY_BLOCK)) for (n, c), m in met.items() if (n, c) in parts],
                                                  "n int, cell long, parts int, blocks int"))
        own = placed.join(dealt, ["n", "cell"]).select("n", "cell", "vec_id", "v", F.pmod(F.xxhash64("vec_id"), "parts").cast("int").alias("part"),
                                                       F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        to = (asked.mapInPandas(visits, "query_id long, qv array<double>, n int, cell long, part int, bound double").join(dealt, ["n", "cell"])
              .withColumn("block", F.pmod(F.xxhash64("query_id"), "blocks").cast("int")).drop("parts", "blocks"))
        meet = ["n", "cell", "part", "block"]
        return own.groupBy(*meet).cogroup(to.groupBy(*meet)).applyInPandas(
            _search_groups(k, ratio, proj), "n int, query_id long, qv array<double>, vec_id long, score double")

    asked = queries.where(F.col("n").isin(list(totals))).select(F.col("vec_id").alias("query_id"), F.col("v").alias("qv"), "n")
    near = staged(look(asked.withColumn("bound", F.lit(math.inf)), True), "ann-near")
    order = Window.partitionBy("query_id", "qv").orderBy("score", "vec_id")
    kth = (near.withColumn("nth", F.row_number().over(order)).where(F.col("nth") == k).select("query_id", "qv", F.col("score").alias("bound")))
    asked = asked.join(kth, ["query_id", "qv"], "left").select("query_id", "qv", "n", F.coalesce("bound", F.lit(math.inf)).alias("bound"))
    far = look(asked, False)
    best = near.unionByName(far).select("query_id", "qv", "vec_id", "score").distinct()
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
