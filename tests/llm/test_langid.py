from collections import Counter
from zlib import crc32

import numpy as np

from lakeshore.llm import langid as L

from ..conftest import SF001
from .helpers import by_id, documents


def brute_ngrams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    c = Counter()
    for w in words:
        c.update(w)
        for n in (2, 3):
            c.update(f"_{w}_"[i:i + n] for i in range(len(w) + 3 - n))
    # the mark between two words is one character, so pairs and triples end there as they do here
    return c


def spelt(key):
    out = ""
    while key:
        out, key = chr(key & 0x1FFFFF) + out, key >> 21
    return out


def test_ngrams_are_those_of_padded_words():
    for text in ("Hello, wörld 42 a", "x", "ab ab  ab", "日本 語"):
        assert Counter(map(spelt, L.ngrams(text).tolist())) == brute_ngrams(text)
    assert not len(L.ngrams("42 !")) and not len(L.ngrams(""))


def brute_predictions(ids, texts, langs):
    train = {}
    for i, t, lang in zip(ids, texts, langs):
        if t and lang is not None and crc32(str(i).encode()) % 5:
            train.setdefault(lang, Counter()).update(brute_ngrams(t))
    top = lambda c: sorted(c, key=lambda g: (-c[g], len(g), g))[:L.TOP]
    profiles = {lang: {g: r for r, g in enumerate(top(c))} for lang, c in train.items()}
    out = []
    for t in texts:
        own = top(brute_ngrams(t or ""))
        if not own:
            out.append("und")
            continue
        d = {lang: sum(abs(p[g] - r) if g in p else L.TOP for r, g in enumerate(own)) for lang, p in profiles.items()}
        out.append(min(sorted(d), key=d.get))
    return out


def test_against_brute_force_and_held_out(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = docs.collect()
    got = by_id(L.predict_language(docs))
    want = brute_predictions([r.doc_id for r in rows], [r.text for r in rows], [r.lang for r in rows])
    assert [got[r.doc_id].lang_pred for r in rows] == want
    held = [r for r in rows if got[r.doc_id].held_out]
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in held]) > 0.95
    assert all(0 <= g.score <= 1 and g.held_out == (crc32(str(g.doc_id).encode()) % 5 == 0) for g in got.values())


def test_nulls_letters_and_long_texts(spark):
    texts = [None, "", "1234 !!", "the cat and the dog and the house " * 5000] + ["the cat and the dog"] * 8
    got = by_id(L.predict_language(documents(spark, texts, extra=True)))
    assert [got[i].lang_pred for i in range(4)] == ["und", "und", "und", "en"] and got[0].score == 0
    nothing = L.predict_language(documents(spark, texts, lang=None)).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert L.predict_language(documents(spark, ["x"]).limit(0)).count() == 0
