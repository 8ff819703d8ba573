import hashlib
import re

import numpy as np
import pytest
import xxhash

from lakeshore.llm import scaled_sketch as S

from .helpers import DOCS, by_id, documents


def hashes(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    shingles = {" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    return {xxhash.xxh64_intdigest(s.encode()) for s in shingles}


def plain(text):
    h = hashes(text)
    return {x for x in h if x < 1 << 61} or ({min(h)} if h else set())


def alike(a, b):
    return float(len(a) == len(b)) if not a or not b else len(a & b) / min(len(a), len(b))


def expected(rows):
    """rows (doc_id, text): every result, from the whole list in order."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    out = []
    for at, (i, t) in enumerate(rows):
        n = rows[(at + 1) % len(rows)][1]
        cut = len(t) // 2
        e = t[:len(t) - cut] + n[:cut]
        a, b, c = plain(t), plain(e), plain(n)
        text = lambda s: "".join(f"{x:016x}" for x in sorted(s))
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), text(a), text(b), alike(a, b), alike(a, c)))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("range_rows", [4096, 5])
def test_equals_plain_reckoning(spark, monkeypatch, range_rows):
    monkeypatch.setattr(S, "RANGE_ROWS", range_rows)
    rng = np.random.default_rng(3)
    words = ["alpha", "bête", "漢字", "delta", "e", "zeta x", "n m"]
    texts = [" \t\n".join(rng.choice(words, rng.integers(0, 90))) for _ in range(70)]
    texts += [None, "", " ", "one", "one two three four", texts[3], "x", "😀" * 9, " ".join(rng.choice(words, 30_000))]
    ids = list(rng.permutation(len(texts)) * 1_000_000_007)
    rows = [(int(i), t) for i, t in zip(ids, texts)]
    rows += [(rows[4][0], "the same id again"), rows[6], rows[6], (None, "no id"), (None, None)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS).repartition(6)
    assert found(S.fingerprint_documents(df)) == expected(rows)


def test_edges(spark):
    assert S.fingerprint_documents(documents(spark, ["x"]).limit(0)).count() == 0
    (one,) = found(S.fingerprint_documents(documents(spark, ["a lone document of some words"])))
    assert one[6] == 1.0 and one[1] == 29
    plain_rows = found(S.fingerprint_documents(documents(spark, ["a b c d e f g", "h"])))
    assert plain_rows == found(S.fingerprint_documents(documents(spark, ["a b c d e f g", "h"], extra=True)))
    same = found(S.fingerprint_documents(spark.createDataFrame([(7, "copy of one text", None, None, None)] * 30, DOCS)))
    assert len(same) == 30 and {r[6] for r in same} == {1.0}


def test_equal_texts_have_equal_fingerprints_and_others_differ(spark):
    got = by_id(S.fingerprint_documents(documents(spark, ["a b", "c d", "a b", "", None])))
    assert got[0].fingerprint == got[2].fingerprint != got[1].fingerprint
    assert got[3].fingerprint == got[4].fingerprint == ""
    assert got[4].near_next == 1.0 and got[3].near_next == 0.0


def test_sketches_merge_and_estimate_containment(spark):
    rng = np.random.default_rng(8)
    vocabulary = np.array([f"w{i}" for i in range(5000)])
    texts = [" ".join(rng.choice(vocabulary, 2000)) for _ in range(12)]
    long = " ".join(texts[:6])
    parts = S.sketches(documents(spark, texts), "doc_id")
    whole = S.sketches(documents(spark, [long]))
    # the union of parts' sketches is that of the whole, but for the shingles across the seams
    one = {r.hash for r in S.merged(parts.where("doc_id < 6")).collect()}
    two = {r.hash for r in whole.collect()}
    assert one <= two and len(two - one) <= 5 * 4
    found = {r.doc_id: r for r in S.containment_in(parts, whole, "doc_id").collect()}
    assert all((r.contained == 1.0) == (i < 6) for i, r in found.items()) and len(found) == 12
    half = " ".join([*texts[0].split()[:1000], *rng.choice(vocabulary, 1000)])
    (r,) = S.containment_in(S.sketches(documents(spark, [half]), "doc_id"), whole, "doc_id").collect()
    assert abs(r.contained - 0.5) < 0.12  # 250 kept hashes
