import math

import numpy as np

from lakeshore.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k, every):
    ok = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, qv in ok:
        if q % every == 0:
            d = sorted({(float(np.sqrt(((qv - v) ** 2).sum())), i) for i, v in ok if i != q and len(v) == len(qv)})
            out[q] = d[:k]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
    return out


def test_chi_square_law():
    rng = np.random.default_rng(2)
    ratio = ann.stop_ratio(0.9, 6)
    assert abs(ann.chi_square_cdf(ratio, 6) - 0.9) < 1e-6
    x = rng.standard_normal((4000, 20))
    inside = ((x @ ann.projection(20, 6)) ** 2).sum(axis=1) <= ratio * (x ** 2).sum(axis=1)
    assert abs(inside.mean() - 0.9) < 0.1


def test_recall_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL_ROWS", 100)
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((30, 24))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 30] + 0.4 * rng.standard_normal(24)], 0) for i in range(900)]
    want, got = brute(rows, 10, 20), found(ann.nearest(spark.createDataFrame(rows, SCHEMA), every=20))
    assert got.keys() == want.keys() and all(len(g) == 10 for g in got.values())
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    exact = {(q, i): s for q, w in brute(rows, 10**6, 20).items() for s, i in w}
    assert all(abs(exact[q, i] - s) < 1e-9 for q, g in got.items() for s, i in g)


def test_blocks_of_visitors_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL_ROWS", 40)
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(6)], 0) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    one = found(ann.nearest(df, every=5))
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    assert found(ann.nearest(df, every=5)) == one and len(one) == 120


def test_ties_copies_and_unusable_vectors(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same, 0) for i in range(50)] + [(100, None, 0), (200, [0.0, 0.0, 0.0], 0), (300, [1.0, None, 2.0], 0), (400, [float("nan"), 1.0, 1.0], 0),
                                                (500, [1.0, 2.0], 0), (600, [1.0, float("inf"), 0.0], 0), (None, same, 0), (700, [1.0, 2.0, 4.0], 0), (0, same, 0)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as rank", "2 as score", "3 as cell")
    got = found(ann.nearest(df))
    assert got[0] == [(0.0, i) for i in range(1, 11)]
    assert got[700] == [(1.0, i) for i in range(10)]
    assert set(got) == {0, 700}  # 500 has no other vector of its length


def test_fewer_candidates_and_empty(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0)]
    assert found(ann.nearest(spark.createDataFrame(rows, SCHEMA))) == {0: [(math.sqrt(2), 1)]}
    assert ann.nearest(spark.createDataFrame([], SCHEMA)).count() == 0
