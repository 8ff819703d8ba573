import random
from zlib import crc32

import numpy as np

from lakeshore.llm import toxicity as T

from ..conftest import SF01
from .helpers import by_id, documents

LABELS = "doc_id bigint, quality int, toxic int"


def made(spark, n=400, seed=1):
    """Insults make a text toxic; groups are named far more often in toxic ones."""
    rng = random.Random(seed)
    texts, toxic = [], []
    for _ in range(n):
        bad = rng.random() < 0.4
        words = [rng.choice("harbour river stone window letter garden copper morning silver road".split()) for _ in range(30)]
        if bad:
            words[rng.randrange(30)] = rng.choice(["moronic", "worthless", "vermin"])
        if rng.random() < (0.8 if bad else 0.05):
            words[rng.randrange(30)] = "muslim"
        texts.append(" ".join(words))
        toxic.append(int(bad))
    return documents(spark, texts), spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], LABELS), toxic


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    got = by_id(T.score_toxicity(docs, labels))
    held = [(r.toxic, got[r.doc_id]) for r in labels.collect() if crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(g.held_out and 0 <= g.score <= 1 and g.predicted == int(g.score >= 0.5) for _, g in held)
    assert np.mean([t == g.predicted for t, g in held]) > 0.9
    toxic = [g.predicted for t, g in held if t == 1]
    print(f"held-out recall {np.mean(toxic):.2f} of {len(toxic)}")
    assert np.mean(toxic) >= 0.5  # learnt from about 40 toxic documents
    assert len(got) == docs.count()


def test_naming_a_group_counts_little(spark, monkeypatch):
    docs, labels, _ = made(spark)
    plain, group = "harbour river stone window letter garden " * 3, "harbour river muslim window letter garden " * 3

    def gap():
        m = T.train(docs, labels)
        return abs(np.log(m.score(group) / (1 - m.score(group))) - np.log(m.score(plain) / (1 - m.score(plain)))), m
    fair, model = gap()
    monkeypatch.setattr(T, "FAIRNESS", 0.0)
    unfair, _ = gap()
    assert fair < 0.7 * unfair
    assert model.score("river stone vermin window road " * 3) > 0.5 > model.score(group)


def test_counterfactuals_stay_in_the_family():
    made = T.Swaps().counterfactuals("A Muslim and a gay man")
    assert "a jewish and a gay man" in made and "a muslim and a lesbian man" in made and "a muslim and a gay woman" in made
    words = {w for t in made for w in t.split()}
    english = {w for f in T.FAMILIES[:9] for w in f}
    assert words <= english | {"a", "and"} and len(made) == len(set(made)) == 7 + 7 + 3
    assert T.Swaps().counterfactuals("nothing here") == []
    # a word of two languages goes with the text's other terms
    assert all("femmes" not in t and "women" not in t for t in T.Swaps().counterfactuals("negro y blanco"))


def test_every_member_of_a_family_scores_alike(spark):
    docs, labels, _ = made(spark)
    m = T.train(docs, labels)
    odds = lambda t: np.log(m.score(t) / (1 - m.score(t)))
    for group in ("muslim", "jewish", "christian", "hindu", "women", "gay", "refugees", "disabled", "mujeres", "juif", "jüdisch"):
        text = f"harbour river {group} window letter garden " * 3
        assert m.score(text) < 0.5
        assert abs(odds(text) - odds(text.replace(group, "stone"))) < 1.5


def test_families_grow_by_shared_contexts(spark):
    rows = [(f"the {w} people of the town {x}", i % 2, 1.0) for x in range(6) for w in ("muslim", "jewish", "yazidi", "tall") for i in range(2)]
    rows += [(f"our {w} friends {x}", i % 2, 1.0) for x in range(6) for w in ("muslim", "yazidi") for i in range(2)]
    rows += [("our rude friends and the rude people", 1, 1.0)] * 9  # in one label only
    grown = T.grown_families(spark.createDataFrame(rows, "text string, toxic int, weight double"))
    family = next(f for f in grown if "muslim" in f)
    assert "yazidi" in family and "tall" not in family and "rude" not in family
    assert sum(map(len, grown)) == sum(map(len, T.FAMILIES)) + 1


def test_fit_is_the_least_of_its_objective():
    """The fitted weights against plain dense arrays: no direction lowers the penalised loss."""
    rng = np.random.default_rng(3)
    n, d, k = 90, 7, 25
    x = (rng.random((n, d)) < 0.4).astype(float)
    y, weight = (rng.random(n) < 0.2 + 0.6 * x[:, 0]).astype(float), rng.uniform(0.5, 3, n)
    a, b, share = (rng.random((k, d)) < 0.3).astype(float), (rng.random((k, d)) < 0.3).astype(float), rng.uniform(0.1, 1, k)

    def held(m):
        at = [np.flatnonzero(r) for r in m]
        return T.Held(np.concatenate([[0], np.cumsum([len(i) for i in at])]), np.concatenate(at), m.shape[1])

    def loss(w, bias):
        z = x @ w + bias
        return ((weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * T.RIDGE * (w ** 2).sum() + 0.5e-6 * bias ** 2
                + T.FAIRNESS * (share * ((a - b) @ w) ** 2).sum())
    block = T.BLOCK
    try:
        T.BLOCK = 16
        w, bias = T.fit(held(x), y, weight, held(a), held(b), share)
    finally:
        T.BLOCK = block
    at = loss(w, bias)
    for _ in range(200):
        step = rng.standard_normal(d + 1) * 10.0 ** rng.uniform(-3, 0)
        assert loss(w + step[:d], bias + step[d]) > at - 1e-7


def test_nulls_long_texts_and_missing_labels(spark):
    docs = documents(spark, [None, "", "x" * 200_000, "river moronic stone"], extra=True)
    _, labels, _ = made(spark)
    none = T.score_toxicity(docs, labels.limit(0)).collect()
    assert [r.score < 1e-9 and r.predicted == 0 for r in none] == [True] * 4
    one = spark.createDataFrame([(i, None, 1) for i in range(4)] + [(2, 0, None)], LABELS)
    assert {r.predicted for r in T.score_toxicity(docs, one).collect()} == {1}
    assert T.score_toxicity(docs.limit(0), labels).count() == 0


def test_toxic_documents_go(spark):
    docs, labels, toxic = made(spark)
    kept = {r.doc_id for r in T.keep_clean(docs, labels).collect()}
    assert np.mean([(i in kept) != bool(t) for i, t in enumerate(toxic)]) > 0.95
