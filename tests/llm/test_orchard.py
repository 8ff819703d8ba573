import hashlib
import math
from fractions import Fraction

import numpy as np

from lakeshore.llm import orchard

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, k, rounds, dims, scale, seed=3):
    """Lloyd's rounds in Python numbers, every vector against every centroid."""
    kept = [(i, [math.floor(Fraction(x) * scale) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    raw = {id(s): v for (_, s), v in zip(kept, [v for _, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)])}
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", raw[id(r[1])]))
    c = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c)) for _, v in kept]
    for _ in range(rounds):
        got = assign()
        for j in range(len(c)):
            of = [v for (_, v), (_, a) in zip(kept, got) if a == j]
            if of:
                c[j] = [sum(x) // len(of) for x in zip(*of)]
    got = assign()
    inertia = [sum(d for d, a in got if a == j) for j in range(len(c))]
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return sorted(((i, j, d, inertia[j], sum(inertia), digest[j]) for (i, _), (d, j) in zip(kept, got)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_search_finds_the_nearest_with_the_smallest_number():
    rng = np.random.default_rng(4)
    for k, dims in ((1, 3), (2, 1), (9, 2), (40, 5)):
        c = rng.integers(-6, 7, (k, dims))
        c[k // 2] = c[0]  # two centroids at one place
        x = rng.integers(-9, 10, (500, dims))
        d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        for a in (x, x.astype(object)):
            cluster, best = orchard.Orchard(c).nearest(a)
            assert (cluster == d.argmin(axis=1)).all() and (best.astype(np.int64) == d.min(axis=1)).all()


def test_search_passes_over_far_centroids():
    c = np.array([[0, 0], [1000, 0], [2000, 0], [3000, 0]])
    compared = []

    class Counting(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, np.ndarray):
                compared.extend(at.tolist())
            return np.asarray(self)[at]
    search = orchard.Orchard(c)
    search.c = c.view(Counting)
    assert search.nearest(np.array([[3, 4]]))[1][0] == 25
    assert set(compared) == {0}  # the others lie strictly beyond twice the distance


def test_equals_plain_rounds(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(6) * 0.1 + (i % 5)]) for i in range(240)]
    rows += [(300 + i, rows[0][1]) for i in range(60)]  # copies
    rows += [(5, rows[5][1]), (5, rows[9][1])]  # an id twice more
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(7)
    assert found(orchard.cluster_vectors(df, k=8, rounds=4, dims=6)) == plain(rows, 8, 4, 6, 1024)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.5]), (2, None), (3, []), (4, [1.0]), (5, [nan, 0.0]), (6, [inf, 0.0]), (7, [None, 1.0]), (8, [-0.25, 0.125]),
            (None, [3.0, 3.0]), (9, [0.0, 0.0]), (9, [0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    extra = df.selectExpr("'x' AS cluster", "'y' AS distance", "vec_id", "embedding", "'z' AS V", "1 AS Vec_ID")
    for k in (2, 8):
        want = plain(rows, k, 3, 2, 1024)
        assert len(want) == 5
        assert found(orchard.cluster_vectors(df, k=k, rounds=3, dims=2)) == want
        assert found(orchard.cluster_vectors(extra, k=k, rounds=3, dims=2)) == want
    none = orchard.cluster_vectors(df.limit(0))
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_large_components_stay_exact(spark):
    rows = [(i, [float(i * 1_000_003), float(-i)]) for i in range(40)]
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id bigint, embedding array<double>")
    assert found(orchard.cluster_vectors(df, k=4, rounds=3, dims=2, scale=8)) == plain(rows, 4, 3, 2, 8)
