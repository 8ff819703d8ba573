import random
import re

import numpy as np
import xxhash

from lakeshore.llm import simhash as S

from .helpers import documents


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps):
    comp = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2 and comp[i] != comp[j]:
                a, b = comp[i], comp[j]
                comp = [b if c == a else c for c in comp]
    least = {}
    for i, c in zip(ids, comp):
        least[c] = min(least.get(c, i), i)
    return [least[c] for c in comp]


def texts():
    rng = random.Random(6)
    base = [" ".join(rng.choice(["Ab", "be", "ça", "De", "e,"]) + str(rng.randrange(50)) for _ in range(rng.randrange(400, 600))) for _ in range(6)]
    out = [None, "", "one", "One", "two words", " \t\n"] + base + base[:2] + [base[0].upper()]
    for b in base:
        w = b.split(" ")
        for _ in range(12):
            x = list(w)
            x[rng.randrange(len(x))] = "new"
            out.append("  ".join(x))
    return out


def test_fingerprints_and_components(spark):
    rows = texts()
    got = {r.doc_id: r for r in S.near_duplicates(documents(spark, rows, extra=True)).collect()}
    fps = [brute_fingerprint(t) for t in rows]
    assert [got[i].fingerprint for i in range(len(rows))] == [f"{f:016x}" for f in fps]
    assert [got[i].component_id for i in range(len(rows))] == brute_components(range(len(rows)), fps)


def test_links_share_a_key():
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 2**64, 300, dtype=np.uint64)
    for x in fp:
        a, b = rng.integers(0, 64, 2)
        y = x ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b) if a != b else 0)
        assert set(S.link_keys(np.array([x]))[1].tolist()) & set(S.link_keys(np.array([y]))[1].tolist())


def test_links_share_a_divided_key():
    rng = np.random.default_rng(2)
    def divided(x):
        at, keys = S.link_keys(np.array([x]))
        return set(S.divided_keys(keys, np.full(len(keys), x))[1].tolist())
    for x in rng.integers(0, 2**64, 300, dtype=np.uint64):
        a, b = rng.integers(0, 64, 2)
        assert divided(x) & divided(x ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b) if a != b else 0))


def test_hot_keys_are_divided_and_lose_no_link(spark, monkeypatch):
    S.pick(spark.range(1), "id")  # ships the library
    rng = np.random.default_rng(5)
    base = np.uint64(0x2A << 42) | rng.integers(0, 1 << 21, 250, dtype=np.uint64)  # one value of the first segment and of the second
    flips = np.uint64(1) << rng.integers(0, 42, (2, 250)).astype(np.uint64)
    fps = np.unique(np.concatenate([base, base ^ flips[0], base ^ flips[0] ^ flips[1], rng.integers(0, 2**64, 50, dtype=np.uint64)]))
    rows = spark.createDataFrame([(i, int(f)) for i, f in enumerate(fps.view(np.int64))], "doc_id bigint, fp bigint")
    keyed = rows.select("fp").mapInArrow(S._emit_keys, "key bigint, fp bigint")
    largest = keyed.groupBy("key").count().agg({"count": "max"}).first()[0]
    monkeypatch.setattr(S, "HOT", 8)
    assert S.divide_hot(keyed).groupBy("key").count().agg({"count": "max"}).first()[0] < largest / 2
    got = {r.fp: r.component_id for r in S.classes(rows).collect()}
    assert [got[int(f)] for f in fps.view(np.int64)] == brute_components(range(len(fps)), [int(f) for f in fps])


def test_very_long_and_repeated_texts(spark):
    long = " ".join(f"w{i % 977}" for i in range(120_000))  # more shingles than are counted at a time
    docs = documents(spark, [long, long + " end", long, None])
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in S.near_duplicates(docs.union(docs)).collect())
    fps = [f"{brute_fingerprint(t):016x}" for t in (long, long + " end", long, None)]
    ids = brute_components(range(4), [int(f, 16) for f in fps])
    assert got == sorted(2 * list(zip(range(4), fps, ids)))


def test_codewords_are_three_apart_at_most():
    w = np.arange(0, 1 << 23, 997, dtype=np.uint32)
    low, high, errors = S._golay()
    assert np.bitwise_count(errors[low[w & 0xFFF] ^ high[w >> 12]]).max() <= 3
    assert len(errors) == 2048 and (np.bitwise_count(errors) == 0).sum() == 1


def test_long_runs_link_like_short_ones(monkeypatch):
    rng = np.random.default_rng(3)
    fp = np.unique(np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 20, (400, 3)).astype(np.uint64), axis=1))
    def parts(links):
        comp = {int(f): int(f) for f in fp}
        for a, b in ((int(x), int(y)) for p, q in links for x, y in zip(p, q)):
            old, new = comp[a], comp[b]
            comp = {k: new if v == old else v for k, v in comp.items()}
        groups = {}
        for k, v in comp.items():
            groups.setdefault(v, set()).add(k)
        return sorted(map(sorted, groups.values()))
    near = parts(S._run_links(fp, 2))
    monkeypatch.setattr(S, "LONG_RUN", 1)
    assert parts(S._run_links(fp, 2)) == near


def test_keep_one_of_each_group(spark):
    rows = texts()
    docs = documents(spark, rows)
    kept = sorted(r.doc_id for r in S.keep_one(docs.union(docs)).collect())
    assert kept == sorted(set(brute_components(range(len(rows)), [brute_fingerprint(t) for t in rows])))
    nulls = documents(spark, ["same text here", "same text here", "other words of it"]).selectExpr("cast(null as bigint) as doc_id", "text", "lang", "source", "n_chars")
    assert S.keep_one(nulls).count() == 2


def test_empty_table(spark):
    assert S.near_duplicates(documents(spark, ["x"]).limit(0)).count() == 0
