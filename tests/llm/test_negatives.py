import math

import numpy as np
import pytest

from lakeshore.llm import negatives

SCHEMA = "vec_id bigint, label int, embedding array<float>"


def brute(rows, every=100, scale=256):
    ok = sorted({(i, l, tuple(math.floor(scale * x) for x in v)) for i, l, v in rows
                 if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for a, al, av in ok:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(av, v)), i, l) for i, l, v in ok if len(v) == len(av))
        pos = [(i, -s) for s, i, l in scored if l == al and i != a][:5]
        for p, ps in pos:
            hits = [(i, -s) for s, i, l in scored if l != al and 80 * ps <= -100 * s <= 100 * ps][:5]
            out += [(a, p, rank, i, ps, s) for rank, (i, s) in enumerate(hits, 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def clustered(n, dims=8, centres=12, spread=0.25, seed=0):
    rng = np.random.default_rng(seed)
    c = rng.standard_normal((centres, dims))
    return [(i, int(rng.integers(0, 4)), [float(np.float32(x)) for x in c[i % centres] + spread * rng.standard_normal(dims)]) for i in range(n)]


def test_multi_sequence_order():
    rng = np.random.default_rng(1)
    u1, u2 = rng.integers(0, 9, 7).astype(float), rng.integers(0, 9, 5).astype(float)
    seen = list(negatives.multi_sequence(u1, u2))
    assert [s[0] for s in seen] == sorted((float(x + y) for x in u1 for y in u2), reverse=True)
    assert len({s[1:] for s in seen}) == 35
    assert list(negatives.multi_sequence(u1, np.zeros(0))) == []


def test_bounds_hold():
    rng = np.random.default_rng(2)
    x = np.floor(rng.standard_normal((400, 10)) * 256)
    cells = negatives.Cells(x, 400_000)
    a, b, ra, rb = cells.place(x)
    np.maximum.at(cells.radius[0], a, ra)
    np.maximum.at(cells.radius[1], b, rb)
    for q in x[:20]:
        (l1, h1), (l2, h2) = (negatives.half_bounds(h, c, r) for h, c, r in zip(cells.halves(q), cells.codes, cells.radius))
        s = x @ q
        assert (l1[a] + l2[b] <= s).all() and (s <= h1[a] + h2[b]).all()


@pytest.mark.parametrize("first,part,block", [(1024, 8192, 16384), (20, 40, 3)])
def test_equals_brute_force(spark, monkeypatch, first, part, block):
    monkeypatch.setattr(negatives, "FIRST", first)
    monkeypatch.setattr(negatives, "PART_ROWS", part)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", block)
    monkeypatch.setattr(negatives, "CELL_ROWS", 6)
    rows = clustered(700)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute(rows, every=50)
    assert len(want) > 100
    assert found(negatives.hard_negatives(df, every=50)) == want


def test_most_cells_are_not_visited():
    rows = np.floor(np.array([v for _, _, v in clustered(4000, dims=16, centres=40, spread=0.05)]) * 256)
    cells = negatives.Cells(rows, 256 * 400)
    a, b, ra, rb = cells.place(rows)
    np.maximum.at(cells.radius[0], a, ra)
    np.maximum.at(cells.radius[1], b, rb)
    np.add.at(cells.rows, (a, b), 1)
    q = rows[0]
    kth = np.sort(rows @ q)[-6]
    near = cells.visits(q, False, kth, math.inf) if negatives.FIRST == 0 else cells.visits(q, True, kth, math.inf)
    assert sum(len(c) for c in near.values()) < (cells.rows > 0).sum() / 4


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(negatives, "CELL_ROWS", 4)
    nan, inf = float("nan"), float("inf")
    one, two = [1.0, 0.5, 0.25], [0.75, 0.5, 0.25]
    rows = [(0, 1, one), (1, 1, one), (2, 2, two), (3, None, one), (4, 1, None), (5, 1, [nan, 1.0, 1.0]), (6, 2, [1.0, inf, 0.0]),
            (7, 2, [None, 1.0, 1.0]), (8, 2, []), (None, 1, one), (9, 2, two), (9, 2, two), (10, 2, [-1.0, 0.0, 0.0]), (100, 2, [0.0, 0.0, 0.0]),
            (200, 3, [1.0, 1.0]), (201, 3, [1.0, 0.5]), (202, 4, [0.9, 0.9]), (300, 5, one), (400, 1, [-2.0, 0.0, 0.0])]
    rows += [(1000 + i, 1, one) for i in range(40)] + [(2000 + i, 2, two) for i in range(40)]  # copies
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    got = negatives.hard_negatives(df)
    assert found(got) == want and len(want) > 20
    extra = df.selectExpr("'x' AS n", "'y' AS score", "vec_id", "label", "embedding", "1 AS part", "2 AS Label")
    assert found(negatives.hard_negatives(extra)) == want
    assert negatives.hard_negatives(df.limit(0)).columns == got.columns
    assert found(negatives.hard_negatives(df.limit(0))) == []
    assert found(negatives.hard_negatives(df.where("vec_id % 100 <> 0"))) == []


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, i % 3, [float(x) for x in rng.integers(2 ** 20, 2 ** 20 + 9, 4)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    assert found(negatives.hard_negatives(df, every=40)) == brute(rows, every=40)
