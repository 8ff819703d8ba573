"""Operator 13: hard negatives from an inverted multi-index.

Vectors are whole numbers, cut into two halves; each half has a codebook, and a
pair of codes is a cell. For an anchor, a code's half score is at most
anchor half . centroid + |anchor half| x radius, the radius being the largest
distance of a member from its centroid, over all rows. The multi-sequence heap
takes the cells in descending order of the two bounds' sum. An anchor first
visits the best cells until they hold `FIRST` rows. What it finds there
certifies the rest: a cell is visited later only if its bound reaches the score
that would still change the answer, and the heap stops at the first that does
not. So the answers are exact.

The same search runs twice. First for the positives: the nearest other rows of
the anchor's label. Then for the negatives: for each positive, the best rows of
other labels in the window of scores from `low` percent of the positive's score
up to it; cells that lie wholly above the highest window are passed over.

The rows of a first code are dealt over tasks in parts of about `PART_ROWS`;
a visit names a part and the second codes to look at. Anchors come in blocks,
and a part goes only to those blocks of which some anchor visits it. The
codebooks are fitted to a bounded sample (`SAMPLE` rows); every row is indexed.

Defined results: rows whose id, label or vector is null, or whose vector holds
null or non-finite components, take no part. Vectors meet those of their own
length only. Equal rows (id, label, vector) count once. Rows of equal vector
and label score alike, so only the smallest ids among them can be in an answer
and the others are left out of the index (`most` + 1 stay). Rows that share an
id but differ are rows each; as anchors they have answers each, and are never
each other's positives. A positive with a score below zero has no negatives, as
its window is empty. An empty table gives no rows; extra columns are left out.
A scaled component of 2^53 or more, or a score that no long holds, is an error.
"""

from __future__ import annotations

import heapq
import math
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_sample, pick, staged

EVERY = 100
POSITIVES = 5
NEGATIVES = 5
#: Percent of the positive's score at which a window begins.
LOW = 80
SCALE = 256
SAMPLE = 20_000
#: Rows a cell should hold, codes of a half at most, and rows of the cells that are visited first.
CELL_ROWS = 256
MAX_CODES = 256
FIRST = 1_024
PART_ROWS = 8_192
ANCHOR_BLOCK = 16_384


def fit_codes(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """At most k centroids of the sample's rows."""
    points = np.unique(sample, axis=0)
    rng = np.random.default_rng(seed)
    c = points[np.sort(rng.choice(len(points), min(k, len(points)), replace=False))]
    for _ in range(rounds):
        code = nearest_code(sample, c)
        n = np.bincount(code, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, code, sample)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def nearest_code(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(axis=1) - 2 * (x @ c.T), axis=1)


def half_bounds(q: np.ndarray, c: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of q's half with any member of each code, with room for rounding."""
    mid, size = c @ q, math.sqrt(float(q @ q))
    room = size * radius + 1e-9 * size * (radius + np.sqrt((c * c).sum(axis=1))) + 1e-6
    return mid - room, mid + room


def multi_sequence(u1: np.ndarray, u2: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(bound, first code, second code) of all cells, in descending order of u1 + u2."""
    if not len(u1) or not len(u2):
        return
    o1, o2 = np.argsort(-u1, kind="stable"), np.argsort(-u2, kind="stable")
    heap, seen = [(-(u1[o1[0]] + u2[o2[0]]), 0, 0)], {(0, 0)}
    while heap:
        bound, a, b = heapq.heappop(heap)
        yield -bound, int(o1[a]), int(o2[b])
        for i, j in ((a + 1, b), (a, b + 1)):
            if i < len(o1) and j < len(o2) and (i, j) not in seen:
                seen.add((i, j))
                heapq.heappush(heap, (-(u1[o1[i]] + u2[o2[j]]), i, j))


class Cells:
    """Codebooks of vectors of one length, their radii, and the rows of each cell."""

    def __init__(self, sample: np.ndarray, rows: int):
        k = max(1, min(MAX_CODES, round(math.sqrt(rows / CELL_ROWS))))
        self.cut = sample.shape[1] // 2
        self.codes = [fit_codes(h, k) for h in self.halves(sample)]
        self.radius = [np.zeros(len(c)) for c in self.codes]
        self.rows = np.zeros((len(self.codes[0]), len(self.codes[1])), np.int64)

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[..., :self.cut], x[..., self.cut:]

    def place(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """Codes of both halves of each row, and distances from their centroids."""
        code = [nearest_code(h, c) for h, c in zip(self.halves(x), self.codes)]
        off = [np.sqrt(((h - c[a]) ** 2).sum(axis=1)) for h, c, a in zip(self.halves(x), self.codes, code)]
        return *code, *off

    def visits(self, q: np.ndarray, first: bool, least: float, highest: float) -> dict[int, list[int]]:
        """Second codes by first code: the best cells up to FIRST rows, or those after them whose bound is `least` or more."""
        low, high = zip(*(half_bounds(h, c, r) for h, c, r in zip(self.halves(q), self.codes, self.radius)))
        out: dict[int, list[int]] = {}
        met = 0
        for bound, a, b in multi_sequence(*high):
            if bound < least or (first and met >= FIRST):
                break
            rows = int(self.rows[a, b])
            if not rows or low[0][a] + low[1][b] > highest:
                continue
            if first or met >= FIRST:
                out.setdefault(a, []).append(b)
            met += rows
        return out


def usable(vectors: DataFrame, scale: int, most: int) -> DataFrame:
    """vec_id, label, v (whole numbers), n: the rows that take part; of equal vectors of a label the most + 1 smallest ids."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    def scaled(x):
        y = x.cast("double") * scale
        return F.when(F.abs(y) < float(1 << 53), F.floor(y)).otherwise(F.raise_error(F.lit("a scaled component is 2^53 or more")).cast("long"))
    rows = pick(vectors, "vec_id", "label", "embedding").where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    same = Window.partitionBy("v", "label").orderBy("vec_id")
    return (rows.select("vec_id", F.col("label").cast("long").alias("label"), F.transform("embedding", scaled).alias("v")).distinct()
            .withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= most + 1).select("vec_id", "label", "v", F.size("v").alias("n")))


def _matrix(column, n: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), n)


def _exact(x: np.ndarray, largest: float) -> np.ndarray:
    """Vectors in a type in which inner products with components up to `largest` are exact."""
    top = float(np.abs(x).max()) if x.size else 0.0
    return x.astype(np.float64) if max(top, 1.0) * max(largest, 1.0) * max(x.shape[1], 1) < 2 ** 52 else x.astype(object)


def _best(score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Positions of the `most` highest scores, ties by smaller id."""
    at = np.arange(len(score))
    if len(at) > 4 * most:
        least = np.partition(score, len(score) - most)[len(score) - most]
        at = at[score >= least]
    return at[np.lexsort((ids[at], -score[at]))[:most]]


def _look(most: int, low: int):
    """A part of a first code's rows, and the anchors that visit it."""
    names = ["anchor_id", "akey", "target", "vec_id", "score"]
    types = [pa.int64()] * 5

    def run(index: pa.Table, visits: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in names]
        if index.num_rows and visits.num_rows:
            n = index.column("n")[0].as_py()
            index = index.sort_by([("c2", "ascending"), ("vec_id", "ascending")])
            q = _matrix(visits.column("qv"), n)
            x = _exact(_matrix(index.column("v"), n), float(np.abs(q).max()) if q.size else 0.0)
            c2, ids, labels = (index.column(c).to_numpy() for c in ("c2", "vec_id", "label"))
            starts = np.searchsorted(c2, np.arange(c2.max() + 2))
            rows = zip(q, *(visits.column(c).to_pylist() for c in ("anchor_id", "akey", "qlabel", "codes", "targets")))
            for v, anchor, akey, label, codes, targets in rows:
                at = np.concatenate([np.arange(starts[c], starts[c + 1]) for c in codes if c < len(starts) - 1] or [np.zeros(0, int)]).astype(int)
                score = (x[at] @ v.astype(x.dtype)).astype(np.int64)
                alike = labels[at] == label
                if targets is None:
                    keep = alike & (ids[at] != anchor)
                    picked = [(0, _best(score[keep], ids[at[keep]], most), keep)]
                else:
                    picked = []
                    for t in targets:
                        keep = ~alike & (score <= t) & (score >= -(-low * t // 100))
                        picked.append((t, _best(score[keep], ids[at[keep]], most), keep))
                for t, best, keep in picked:
                    for column, values in zip(out, ([anchor] * len(best), [akey] * len(best), [t] * len(best),
                                                    ids[at[keep]][best].tolist(), score[keep][best].tolist())):
                        column += values
        return pa.table([pa.array(c, t) for c, t in zip(out, types)], names=names)
    return run


def hard_negatives(vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, every: int = EVERY,
                   low: int = LOW, scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, for the rows whose id is divisible by `every`."""
    spark, empty = vectors.sparkSession, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    clean = staged(usable(vectors, scale, max(positives, negatives)), "negatives-vectors")
    totals = {r.n: r["count"] for r in clean.groupBy("n").count().collect()}  # one row a length
    if not totals:
        return spark.createDataFrame([], empty)
    cells: dict[int, Cells] = {}
    for n, rows in totals.items():
        sample = hash_sample(clean.where(F.col("n") == n), F.col("vec_id"), max(1, SAMPLE // len(totals)), rows).select("v").toArrow()
        cells[n] = Cells(_matrix(sample.column(0), n).astype(np.float64), rows)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = b.column("n").to_numpy()
            for n in np.unique(lengths):
                part = b.filter(pa.array(lengths == n))
                found = cells[int(n)].place(_matrix(part.column("v"), int(n)).astype(np.float64))
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(f) for f in found)], names=[*part.schema.names, "c1", "c2", "r1", "r2"])

    index = staged(clean.mapInArrow(place, "vec_id long, label long, v array<long>, n int, c1 long, c2 long, r1 double, r2 double"), "negatives-index")
    for r in index.groupBy("n", "c1", "c2").agg(F.count("*").alias("rows"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).collect():  # a row a cell
        c = cells[r.n]
        c.rows[r.c1, r.c2] = r.rows
        c.radius[0][r.c1], c.radius[1][r.c2] = max(c.radius[0][r.c1], r.r1), max(c.radius[1][r.c2], r.r2)
    parts = {(n, a): -(-int(rows) // PART_ROWS) for n, c in cells.items() for a, rows in enumerate(c.rows.sum(axis=1)) if rows}
    dealt = F.broadcast(spark.createDataFrame([(n, a, p) for (n, a), p in parts.items()], "n int, c1 long, parts int"))  # MAX_CODES rows a length
    index = index.join(dealt, ["n", "c1"]).select("n", "c1", F.pmod(F.xxhash64("vec_id"), "parts").cast("int").alias("part"), "c2", "vec_id", "label", "v")

    # Anchors are looked up among all rows: the index leaves out ids that are not small among equal vectors.
    asked = pick(vectors, "vec_id", "label", "embedding").where(F.col("vec_id") % every == 0)
    asked = usable(asked, scale, 1 << 60).select(F.col("vec_id").alias("anchor_id"), F.xxhash64("label", "v").alias("akey"), F.col("label").alias("qlabel"), F.col("v").alias("qv"), "n")
    asked = staged(asked.where(F.col("n").isin(list(totals))), "negatives-anchors")
    blocks = max(1, -(-asked.count() // ANCHOR_BLOCK))
    visit = "n int, c1 long, part int, anchor_id long, akey long, qlabel long, qv array<long>, codes array<long>, targets array<long>"

    def search(anchors: DataFrame, most: int, first: bool, name: str) -> DataFrame:
        """anchors with `targets` (positives' scores, or null) and `least` (the score that a cell must reach)."""
        def to_visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for lo in range(0, b.num_rows, 64):
                    out = []
                    for r in b.slice(lo, 64).to_pylist():
                        targets = r["targets"]
                        highest = max(targets, default=-math.inf) if targets is not None else math.inf
                        least = -math.inf if r["least"] is None else r["least"]
                        chosen = cells[r["n"]].visits(np.array(r["qv"], np.float64), first, least, highest)
                        out += [(r["n"], a, p, r["anchor_id"], r["akey"], r["qlabel"], r["qv"], codes, targets)
                                for a, codes in chosen.items() for p in range(parts[r["n"], a])]
                    cols = list(zip(*out)) or [[]] * 9
                    types = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[x.split()[0] for x in visit.split(", ")])

        visits = anchors.select("anchor_id", "akey", "qlabel", "qv", "n", "targets", "least").mapInArrow(to_visit, visit)
        visits = visits.withColumn("block", F.pmod(F.xxhash64("anchor_id"), F.lit(blocks)).cast("int"))
        meet = ["n", "c1", "part", "block"]
        if blocks == 1:
            wanted = index.withColumn("block", F.lit(0))
        else:
            visits = staged(visits, f"{name}-visits")
            keys = visits.select(*meet[:3], (F.col("block") + 0).alias("block")).distinct()  # a column of its own beside visits'
            wanted = index.join(keys, meet[:3])
        return staged(wanted.groupBy(*meet).cogroup(visits.groupBy(*meet)).applyInArrow(
            _look(most, low), "anchor_id long, akey long, target long, vec_id long, score long"), name)

    def ranked(found: DataFrame, most: int) -> DataFrame:
        order = Window.partitionBy("anchor_id", "akey", "target").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

    who = ["anchor_id", "akey"]
    none = F.lit(None).cast("long")
    start = asked.select("*", F.lit(None).cast("array<long>").alias("targets"), none.alias("least"))
    near = search(start, positives, True, "negatives-near")
    kth = ranked(near, positives).where(F.col("rank") == positives).select(*who, F.col("score").alias("least"))
    rest = search(start.drop("least").join(kth, who, "left"), positives, False, "negatives-rest")
    pos = staged(ranked(near.unionByName(rest), positives).select(*who, F.col("vec_id").alias("positive_id"), F.col("score").alias("target")), "negatives-positives")

    targets = pos.where("target >= 0").groupBy(*who).agg(F.sort_array(F.collect_set("target")).alias("targets"))  # `positives` scores at most

    def begin(score: str) -> Column:
        """Least whole number of `low` percent of a score, which is not negative; without overflow."""
        return F.expr(f"{low} * ({score} div 100) + ({low} * ({score} % 100) + 99) div 100")
    start = asked.join(targets, who).withColumn("least", begin("array_min(targets)"))
    near = search(start, negatives, True, "negatives-near2")
    full = ranked(near, negatives).where(F.col("rank") == negatives).select(*who, "target", F.col("score").alias("kth"))
    # Each window asks for its last score so far or, if it is not full, for its own begin; an anchor for the least of these.
    needs = (start.select(*who, F.explode("targets").alias("target")).join(full, [*who, "target"], "left")
             .groupBy(*who).agg(F.min(F.coalesce(F.col("kth"), begin("target"))).alias("least")))
    rest = search(start.drop("least").join(needs, who), negatives, False, "negatives-rest2")
    neg = ranked(near.unionByName(rest), negatives).select(*who, "target", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return pos.join(neg, [*who, "target"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", F.col("target").alias("positive_score"), "negative_score")
