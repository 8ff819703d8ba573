import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from lakeshore.llm import substrings as S

from .helpers import documents


def brute(texts):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    n = Counter(tuple(w[i:i + 35]) for w in words for i in range(len(w) - 34))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - 34) if n[tuple(w[i:i + 35])] > 1 for j in range(i, i + 35)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def made_texts():
    rng = random.Random(4)
    say = lambda n: " ".join(rng.choice("abcdefghijklmnop") + rng.choice("xyz ") for _ in range(n))
    passage, line = say(60), say(34)
    out = [None, "", "one two", passage, passage, f"{say(50)}  {passage}\n{say(40)}", f"{say(7)}\t{passage}", line, line, f"{line} x", f"{line} x",
           "a " * 500, "b " * 35, "b " * 36, f"{say(200)} {passage} {say(3)} {passage}", say(3000)]
    out.append(out[-1][:4000] + " end")
    return out + [say(rng.randrange(100)) for _ in range(20)]


def test_the_cover_brings_any_two_positions_onto_it():
    for d in range(S.PERIOD):
        assert any((c + d) % S.PERIOD in S.COVER for c in S.COVER)


def test_against_brute_force(spark):
    texts = made_texts()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in S.remove_repeats(documents(spark, texts, extra=True).repartition(4)).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_from_files_with_repeated_ids(spark, scratch):
    texts = made_texts()
    df = documents(spark, texts).selectExpr("doc_id % 5 as doc_id", "text")
    df.union(df.limit(3)).repartition(3).write.parquet(f"{scratch}/d")
    got = Counter((r.n_words, r.n_removed, r.kept_sha256) for r in S.remove_repeats(spark.read.parquet(f"{scratch}/d")).collect())
    every = [r.text for r in spark.read.parquet(f"{scratch}/d").collect()]
    assert got == Counter(brute(every))


def test_pooled_rows_settle_repeats_of_the_batch():
    h = np.array([5, 7, 5, 9], np.uint64)
    z = np.zeros(4, np.int32)
    known, h1, _, _, row, _ = S.pooled(h, z, np.zeros(4, np.int64), np.arange(4), z)
    assert sorted(row[known].tolist()) == [0, 2] and sorted(h1[~known].tolist()) == [5, 7, 9]


def test_empty_table(spark):
    assert S.remove_repeats(documents(spark, ["x"]).limit(0)).count() == 0


def test_hashes_cross_the_shuffle_packed():
    """Two files' scans: a row a bucket, not a row a hash; what repeats is found wherever batches end, also at far rows and positions."""
    rng = np.random.default_rng(5)
    h = rng.integers(0, 1 << 64, 9000, np.uint64)
    far = np.arange(9000) * 30  # positions beyond 16 bits
    twice = np.concatenate([h[:500], h[:4]])
    scans = [[(-7, 60_000, h, np.zeros(9000, np.int32), far)],
             [(8, 5, h[8000:], np.zeros(1000, np.int32), np.arange(1000)), (8, 5 + S.SPAN - 1, twice + np.uint64(1), np.zeros(504, np.int32), np.arange(504))],
             [(9, 0, h[:10], np.ones(10, np.int32), np.arange(10))]]  # the other half of the hash differs
    batches = [b for held in scans for b in S.packed(held, 16)]
    assert sum(b.num_rows for b in batches) < 60
    table = pa.Table.from_batches(batches).sort_by("bucket")
    want = {(-7, 60_000, p) for p in far[8000:].tolist()} | {(8, 5, p) for p in range(1000)} | {(8, 5 + S.SPAN - 1, p) for p in (0, 1, 2, 3, 500, 501, 502, 503)}
    for size in (1, 7, 1000):
        got = set()
        for b in S._runs(iter(table.to_batches(max_chunksize=size))):
            for file, block, *cols in zip(*(c.to_pylist() for c in b.columns)):
                row, low, high = (np.frombuffer(c, np.uint16).astype(int) for c in cols)
                got |= {(file, r, p) for r, p in zip((block * S.BLOCK + row).tolist(), (high << 16 | low).tolist())}
        assert got == want


def test_packs_end_anywhere(spark, monkeypatch):
    texts = made_texts() * 2 + ["x y"] + made_texts()[:9]
    monkeypatch.setattr(S, "PACK", 40)
    monkeypatch.setattr(S, "SPAN", 5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in S.remove_repeats(documents(spark, texts).coalesce(2)).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)
