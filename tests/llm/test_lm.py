import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa

from lakeshore.llm import lm

from ..conftest import SF001
from .helpers import by_id, documents


def brute(ids, texts):
    toks = [[w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())] + [b" "] for t in texts]
    c = Counter(w for i, ws in zip(ids, toks) if crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    return n, [(len(ws), sum(c[w] > 0 for w in ws), sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for ws in toks]


def check(rows, ids, texts):
    n, want = brute(ids, texts)
    got = {r.doc_id: r for r in rows}
    for i, (size, known, base) in zip(ids, want):
        g = got[i]
        assert (g.n_tokens, g.n_known, g.train_tokens, g.held_out) == (size, known, n, crc32(str(i).encode()) % 7 == 2)
        assert abs(g.base_score - base) < 1e-6 * max(1, abs(base)) and g.score < 0
    return got


def test_base_and_held_out_likelihood(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = check(lm.score_documents(docs).collect(), [r.doc_id for r in rows], [r.text for r in rows])
    held = [g for g in got.values() if g.held_out]
    assert held and sum(g.score for g in held) > sum(g.base_score for g in held)


def test_words_beyond_the_cache_are_joined(spark, monkeypatch):
    monkeypatch.setattr(lm, "CACHE", 5)
    texts = [None, "", "a b A B\tc", "a b unseen" + "x" * 100, "é É é", "zz " * 300] + [f"w{i % 7} the w{i % 3}" for i in range(40)]
    check(lm.score_documents(documents(spark, texts, extra=True)).collect(), list(range(len(texts))), texts)


def plain_log10(model, lexicon, counts, text):
    """log10 probability of a text, symbol by symbol, in plain double arithmetic."""
    e, u, c, cb, w, wb = (getattr(model, k).astype(float) for k in model.NAMES)
    index = {x: i for i, x in enumerate(lexicon.words[:lexicon.vocab])}
    symbol = lambda x: index.get(x, lm.VOCAB + lm.shape(x))
    h, last, total, size = np.zeros(lm.HIDDEN), symbol(b" "), 0.0, lm.HIDDEN
    for x in [*text.encode().lower().split(), b" "]:
        a, g = h @ u, e[last]
        z, r = (1 / (1 + np.exp(-(g[i:i + size] + a[i:i + size]))) for i in (0, size))
        n = np.tanh(g[2 * size:] + r * a[2 * size:])
        h = (1 - z) * n + z * h
        last = symbol(x)
        k = last // lm.PER_CLASS if last < lm.VOCAB else lm.WORD_CLASSES + last - lm.VOCAB
        p = np.exp(h @ c + cb)
        total += math.log10(p[k] / p.sum())
        if last < lm.VOCAB:
            p = np.exp(h @ w[k] + wb[k])
            total += math.log10(p[last % lm.PER_CLASS] / p.sum())
        else:
            rest = [v for x2, v in counts.items() if x2 not in index and lm.shape(x2) == last - lm.VOCAB]
            total += math.log10((counts.get(x, 0) + 1) / (sum(rest) + len(rest) + 1))
    return total


def test_scores_symbol_by_symbol_and_the_network_beats_its_start(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    learn, kept = lm.learn, {}

    def watched(train, lexicon, shared=None):
        kept["lexicon"], kept["model"] = lexicon, learn(train, lexicon, shared)
        return kept["model"]
    monkeypatch.setattr(lm, "learn", watched)
    got, texts = by_id(lm.score_documents(docs)), {r.doc_id: r.text or "" for r in docs.collect()}
    counts = Counter(w for i, t in texts.items() if crc32(str(i).encode()) % 7 != 2 for w in [*t.encode().lower().split(), b" "])
    some = sorted(texts, key=lambda i: (len(texts[i]), i))[:120:12]
    assert len(some) == 10
    for i in some:
        want = plain_log10(kept["model"], kept["lexicon"], counts, texts[i])
        assert abs(got[i].score - want) < 1e-4 * max(1, abs(want))
    lexicon, start = kept["lexicon"], lm.Gru(kept["lexicon"])
    held = [lexicon.symbols(lm.tokens(texts[i].encode()))[0] for i in texts if got[i].held_out]
    end = int(lexicon.symbols([lm.END])[0][0])
    assert kept["model"].score(held, end).sum() > start.score(held, end).sum() + 0.02 * sum(map(len, held))


def test_symbols_are_made_once_for_every_text(spark):
    texts = [None, "", "a b A", "zz a"]
    rows = documents(spark, texts).selectExpr("cast(text as binary) text", "doc_id", "false held_out")
    counts = lm.count_words(rows.select("text"))
    lexicon = lm.Lexicon(counts)
    table = {r.doc_id: r for r in lm.as_symbols(rows, spark.sparkContext.broadcast(lexicon)).collect()}
    for i, t in enumerate(texts):
        assert np.frombuffer(table[i].sym, lm.SYMBOL).tolist() == lexicon.symbols(lm.tokens((t or "").encode()))[0].tolist()


class Tiny:
    vocab, n, mass = 200, np.arange(400, 200, -1), np.arange(lm.SHAPES) + 5


def test_probabilities_sum_to_one():
    g = lm.Gru(Tiny)
    g.c += np.random.default_rng(0).standard_normal(g.c.shape).astype(np.float32)
    h = np.random.default_rng(1).standard_normal((1, lm.HIDDEN)).astype(np.float32)
    every = np.arange(lm.VOCAB + lm.SHAPES)
    assert abs(np.exp(g.log_probs(np.repeat(h, len(every), 0), every)).sum() - 1) < 1e-3


def test_gradients_by_differences(monkeypatch):
    rng, grads = np.random.default_rng(2), {}
    g = lm.Gru(Tiny)
    for k in ("c", "w"):
        setattr(g, k, (getattr(g, k) + 0.3 * rng.standard_normal(getattr(g, k).shape)).astype(np.float64))
    for k in ("e", "u", "cb", "wb"):
        setattr(g, k, getattr(g, k).astype(np.float64))
    x = rng.integers(0, 200, (3, 7))
    x[0, 3] = lm.VOCAB + 2
    monkeypatch.setattr(lm.Gru, "_update", lambda self, name, grad, rows=slice(None): grads.setdefault(name, []).append((rows, grad)))
    g.train(x, np.zeros((3, lm.HIDDEN)))

    def loss():
        h, total = np.zeros((3, lm.HIDDEN)), 0.0
        for t in range(6):
            h = g.step(h, x[:, t])
            total -= g.log_probs(h, x[:, t + 1]).sum()
        return total / (3 * lm.STEPS)
    for name in ("u", "c", "e", "w"):
        full = np.zeros_like(getattr(g, name))
        for rows, grad in grads[name]:
            full[rows] += grad
        at = np.unravel_index(np.argsort(-np.abs(full).ravel())[3], full.shape)
        a = getattr(g, name)
        a[at] += 1e-5
        up = loss()
        a[at] -= 2e-5
        slope = (up - loss()) / 2e-5
        a[at] += 1e-5
        assert abs(slope - full[at]) < 1e-4 * max(1e-3, abs(slope)) + 1e-7, name


class Wide:
    vocab, n, mass = 4096, np.arange(9000, 4904, -1), np.arange(lm.SHAPES) + 5


def test_words_up_to_rank_4096_are_learnt_by_themselves():
    g, last = lm.Gru(Wide), 4095
    assert np.unique(lm.class_of(np.arange(4096)), return_counts=True)[1].tolist() == [64] * 64
    h = np.zeros((2, lm.HIDDEN), np.float32)
    before, e = g.log_probs(h, np.array([last, last - 1])), g.e.copy()
    for _ in range(20):
        g.train(np.full((2, 9), last), h)
    after = g.log_probs(h, np.array([last, last - 1]))
    assert after[0] - before[0] > max(0, after[1] - before[1])
    assert np.flatnonzero((g.e != e).any(axis=1)).tolist() == [last]


def test_a_full_slice_gives_an_update_for_every_128_windows(monkeypatch):
    sizes = []
    monkeypatch.setattr(lm.Gru, "train", lambda self, x, h: (sizes.append(x.shape), h)[1])
    lm.Gru(Tiny).fit(np.zeros(614_400, np.int64))
    assert len(sizes) >= 150 and {b for b, _ in sizes} == {128}


def test_every_token_of_a_slice_is_learnt_once(monkeypatch):
    for size in (1, 2, 33, 5_000, 204_800 + 127, 300_001):
        seen = []
        monkeypatch.setattr(lm.Gru, "train", lambda self, x, h: (seen.append(x[:, 1:]), h)[1])
        stream = np.arange(size)
        assert lm.Gru(Tiny).fit(stream) == size
        learnt = np.concatenate([x.ravel() for x in seen])
        assert np.array_equal(np.sort(learnt[learnt >= 0]), stream)


def test_symbols_that_fill_up_give_no_gradient():
    def gradients(x):
        g = lm.Gru(Tiny)
        rng, full = np.random.default_rng(6), {k: np.zeros(getattr(g, k).shape) for k in g.NAMES}
        g.c, g.w = (g.c + rng.standard_normal(g.c.shape)).astype(np.float32), (g.w + rng.standard_normal(g.w.shape)).astype(np.float32)

        def add(name, grad, rows=slice(None)):
            full[name][rows] += grad * len(x)  # the loss is a mean over the streams
        g._update = add
        g.train(x, np.zeros((len(x), lm.HIDDEN), np.float32))
        return full
    x = np.random.default_rng(5).integers(0, 200, (2, 9))
    padded = x.copy()
    padded[1, 4:] = -1
    got, one, two = gradients(padded), gradients(x[:1]), gradients(x[1:, :4])
    assert all(np.allclose(got[k], one[k] + two[k], atol=1e-5) for k in got)


def test_state_is_carried_across_windows():
    g, rng = lm.Gru(Tiny), np.random.default_rng(4)
    g.c += rng.standard_normal(g.c.shape).astype(np.float32)
    seqs = [rng.integers(0, 200, n) for n in (300, 0, 5, 64, 65, 1)]
    whole = g.score(seqs, 0, width=1000)
    assert np.allclose(g.score(seqs, 0, width=7, group=2), whole, rtol=1e-4) and whole[1] == 0


def test_empty_table(spark):
    assert lm.score_documents(documents(spark, ["x"]).limit(0)).count() == 0
    only_held = documents(spark, ["a"] * 30).where("crc32(cast(cast(doc_id as string) as binary)) % 7 = 2")
    assert {(r.train_tokens, r.n_known) for r in lm.score_documents(only_held).collect()} == {(0, 0)}


def test_gates_of_a_step_are_contiguous_and_right():
    """Side by side, each operation of the gates went through strided rows of 16 numbers."""
    rng = np.random.default_rng(4)
    g = lm.Gru(Tiny)
    h, x = rng.standard_normal((5, lm.HIDDEN)).astype(np.float32), np.array([0, 7, 199, lm.VOCAB, lm.VOCAB + lm.SHAPES - 1], np.int16)
    after, zr, n, a = g.gates(h, g.given(x), g.recurrent())
    assert zr.shape == (2, 5, lm.HIDDEN) and all(y.flags.c_contiguous for y in (after, zr, n, a))
    part = lambda y, i: y[:, i * lm.HIDDEN:(i + 1) * lm.HIDDEN].astype(np.float64)
    e, u = g.e[x], h.astype(np.float64) @ g.u.astype(np.float64)
    z, r = (1 / (1 + np.exp(-(part(e, i) + part(u, i)))) for i in range(2))
    want = np.tanh(part(e, 2) + r * part(u, 2))
    assert np.allclose(zr, [z, r], atol=1e-5) and np.allclose(n, want, atol=1e-5)
    assert np.allclose(g.step(h, x), z * h + (1 - z) * want, atol=1e-5)


def test_large_groups_of_a_class_are_scored_in_parts(monkeypatch):
    rng = np.random.default_rng(6)
    g = lm.Gru(Tiny)
    g.w += rng.standard_normal(g.w.shape).astype(np.float32)
    h, y = rng.standard_normal((500, lm.HIDDEN)).astype(np.float32), rng.integers(0, 70, 500)
    whole, sizes, share = g.log_probs(h, y), [], lm._log_share
    monkeypatch.setattr(lm, "ROWS", 7)
    monkeypatch.setattr(lm, "_log_share", lambda h, *a: (sizes.append(len(h)), share(h, *a))[1])
    assert np.allclose(g.log_probs(h, y), whole, atol=1e-5) and max(sizes) == 7 and sum(sizes) == 1000


def test_rare_words_of_each_text(spark, monkeypatch):
    monkeypatch.setattr(lm, "CACHE", 2)
    monkeypatch.setattr(lm, "BATCH", 2)
    texts = ["a a a b b b c", None, "", "c d a d", "e"]
    rows = documents(spark, texts).selectExpr("cast(text as binary) text", "doc_id", "false held_out")
    lexicon = lm.Lexicon(lm.count_words(rows.select("text")))
    table = {r.doc_id: {bytes(w.word): w.m for w in r.rare} for r in lm.as_symbols(rows, spark.sparkContext.broadcast(lexicon)).collect()}
    for i, t in enumerate(texts):
        assert table[i] == {w: n for w, n in Counter(lm.tokens((t or "").encode())).items() if w not in lexicon.words}
    assert any(table.values())


def test_texts_become_words_many_at_a_time(monkeypatch):
    """Word by word in Python, counting and numbering took a quarter of the query's time."""
    rng = np.random.default_rng(8)
    odd = [bytes(rng.choice([0, 9, 11, 13, 28, 32, 32, 46, 65, 97, 133, 160, 195, 255], n).astype(np.uint8)) for n in rng.integers(0, 30, 400)]
    texts = [b"left out", None, b"", b" ", b" A b\t\x0b\x0c\r\n\xc3\x89 ", b"A.B a,"] + odd
    want = [lm.tokens(t) for t in texts[1:]]
    kinds = {w: lm.shape(w) for ws in want for w in ws}
    calls = []
    monkeypatch.setattr(lm, "tokens", lambda t: calls.append(t))
    monkeypatch.setattr(lm, "shape", lambda w: (calls.append(w), kinds[w])[1])
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(range(len(texts)))], names=["text", "doc_id"]).slice(1)
    got, every = Counter(), Counter(w for ws in want for w in ws)
    for b in lm._count(iter([batch])):
        for r in b.to_pylist():
            assert r["shape"] == kinds[r["word"]]
            got[r["word"]] += r["n"]
    assert got == every and len(calls) <= 1  # the end token, once a batch

    lex = lm.Lexicon.__new__(lm.Lexicon)
    lex.words = sorted(every, key=lambda w: (-every[w], w))[:20]
    lex.n, lex.vocab, lex.log_share, lex._known = np.array([every[w] for w in lex.words]), 8, np.arange(lm.SHAPES) + 0.5, None
    shared = type("Shared", (), {"value": lex})
    rows = [r for b in lm._symbol_tasks(shared)(iter([batch])) for r in b.to_pylist()]
    assert [r["doc_id"] for r in rows] == list(range(1, len(texts))) and len(calls) <= 1
    for r, ws in zip(rows, want):
        rank = [lex.words.index(w) if w in lex.words else -1 for w in ws]
        assert np.frombuffer(r["sym"], lm.SYMBOL).tolist() == [i if 0 <= i < 8 else lm.VOCAB + kinds[w] for i, w in zip(rank, ws)]
        logs = [math.log10(lex.n[i] + 1) if i >= 0 else 0 for i in rank]
        assert (r["n_tokens"], r["n_known"]) == (len(ws), sum(i >= 0 for i in rank)) and abs(r["log_counts"] - sum(logs)) < 1e-9
        assert abs(r["in_shape"] - sum((x if i >= 8 else 0) - kinds[w] - 0.5 for x, i, w in zip(logs, rank, ws) if not 0 <= i < 8)) < 1e-9
        assert {p["word"]: p["m"] for p in r["rare"]} == Counter(w for i, w in zip(rank, ws) if i < 0)


def test_sums_of_segments_and_products_in_parts(monkeypatch):
    rng = np.random.default_rng(9)
    size = np.array([1, 2, 3, 1, lm.SHORT, lm.SHORT + 1, 40, 1, 2, 5])
    rows, first = rng.standard_normal((size.sum(), 48)).astype(np.float32), np.cumsum(size) - size
    for some in (slice(None), slice(0, 4), slice(5, 7)):
        part, at = rows[first[some][0]:(first + size)[some][-1]], first[some] - first[some][0]
        assert np.allclose(lm._segment_sums(part, at), np.add.reduceat(part, at, axis=0), atol=1e-5)
    h, w, bias = (rng.standard_normal(n).astype(np.float32) for n in ((50, lm.HIDDEN), (lm.HIDDEN, 9), 9))
    monkeypatch.setattr(lm, "ROWS", 7)
    assert np.allclose(lm._product(lm._with_ones(h), lm._with_bias(w, bias)), h @ w + bias, atol=1e-5)
