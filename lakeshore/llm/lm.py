"""Operator 8: document log-likelihood under a gated recurrent language model.

Counts: all training words are counted exactly (combined in the tasks, then by
shuffle). Then every text is turned into symbols once, in a table that training
and scoring read. The `VOCAB` most frequent of the cached ones (below) are the model's words, in classes of
`PER_CLASS`; every other word belongs to one of a few shape classes (last byte
and ASCII or not) in which add-one counts share the mass, unseen words
included. So the model gives every text a probability.

Model: a GRU in numpy with a class-factored softmax, P(class | state) *
P(word | class, state), the latter from add-one counts in a shape class. It
starts as the unigram model (the biases hold the counts), warms up on about
`WARM_DOCS` documents on the driver, then every task goes on with truncated
back-propagation through all its training documents, and the weights are
averaged by tokens, chunk by chunk, in a shuffle. To the driver come the
weights and the most frequent words only, both of fixed size.

Scoring carries the state through windows to the end of each whole document.
Counts of the most frequent words, `CACHE` at most, travel with the tasks; other words'
counts are joined.

Defined results: null texts count as empty and have the end token only; a null
doc_id counts as empty text for the fold; repeated rows are scored, and learnt
from, each. With nothing to learn from every token is unseen, N = V = 0. An
empty table gives no rows; extra columns are left out.
"""

from __future__ import annotations

from collections import Counter
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frequent, hash_sample, pick, remainder, staged

FOLDS, HELD = 7, 2
#: The end token; no word can hold a space.
END = b" "
HIDDEN = 16
PER_CLASS, WORD_CLASSES = 64, 64
VOCAB = PER_CLASS * WORD_CLASSES
SHAPES = 12
CLASSES = WORD_CLASSES + SHAPES
#: Words whose counts travel with the tasks: so many, of so many bytes at most.
CACHE, CACHE_BYTES = 1 << 18, 64
WARM_DOCS, WARM_EPOCHS = 1_000, 2
STREAMS, STEPS = 128, 32
RATE = 0.1
#: Updates that a training sequence should give at least.
UPDATES = 50
BATCH = 2048
#: Texts whose words are counted at a time, before they are sent on.
COUNTED = 1 << 14
#: Rows that a product takes at a time: so few need no repacking in BLAS (under 10^6 multiplications).
ROWS = 768
#: Symbols met up to so often in a window get their gradient by adding rows; the others by segments.
SHORT = 6
CHUNK = 1 << 14
F32, SYMBOL = np.float32, np.dtype("<i2")


def tokens(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text, A-Z in lower case, and the end: the rule that `split` applies to many texts at once."""
    return [*text.lower().split(), END] if text else [END]


def shape(word: bytes) -> int:
    """Class of a word outside the model's: whether it is ASCII, and its last byte's kind."""
    return KIND[word[-1]] + (0 if word.isascii() else 6)


def _kind(c: int) -> int:
    return 0 if 97 <= c <= 122 or c >= 128 else 1 if c == 46 else 2 if c == 44 else 3 if 48 <= c <= 57 else 4 if c in b"#$%&*" else 5


KIND = [_kind(c) for c in range(256)]


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all UTF-8 texts (binary), A-Z in lower case, one after the other, and where each text's begin and end."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string(), safe=False).fill_null("")))  # no check of the UTF-8
    words, ends = lists.values.cast(pa.binary()), lists.offsets.to_numpy()
    full = pc.greater(pc.binary_length(words), 0)  # beside white space at a text's ends stand empty words
    return words.filter(full), np.append(0, np.cumsum(full))[ends]


def shapes(words: pa.Array) -> np.ndarray:
    """`shape` of each word (binary)."""
    if not len(words):
        return np.zeros(0, np.int64)
    _, ends, data = words.buffers()
    last = np.frombuffer(ends, np.int32)[words.offset + 1:words.offset + len(words) + 1] - 1
    plain = pc.string_is_ascii(words.cast(pa.string(), safe=False)).to_numpy(zero_copy_only=False)
    return np.array(KIND)[np.frombuffer(data, np.uint8)[last]] + np.where(plain, 0, 6)


# --- counts ----------------------------------------------------------------

def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["word", "shape", "n"]
    for b in batches:
        for lo in range(0, b.num_rows, COUNTED):
            part = b.column(0).slice(lo, COUNTED)
            words, n = split(part)[0].value_counts().flatten()
            yield pa.RecordBatch.from_arrays([words, pa.array(shapes(words), pa.int32()), n], names=names)
            yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([shape(END)], pa.int32()), pa.array([len(part)], pa.int64())], names=names)


def count_words(train: DataFrame) -> DataFrame:
    """(word, shape, n) over all rows of train (text)."""
    return staged(train.mapInArrow(_count, "word binary, shape int, n bigint").groupBy("word", "shape").agg(F.sum("n").alias("n")), "lm-counts")


class Lexicon:
    """What a token is to the model: frequent words by rank, and the mass of the shape classes."""

    def __init__(self, counts: DataFrame):
        top = frequent(counts.where(F.length("word") <= CACHE_BYTES).select("word", "n"), CACHE, "lm-words").toArrow()
        rows = sorted(zip(top["n"].to_pylist(), top["word"].to_pylist()), key=lambda r: (-r[0], r[1]))
        self.words = [w for _, w in rows]
        self.n = np.array([n for n, _ in rows], np.int64)
        self.vocab = min(VOCAB, len(self.words))
        by_shape = {r["shape"]: r for r in counts.groupBy("shape").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
        mass = np.array([by_shape[s]["n"] if s in by_shape else 0 for s in range(SHAPES)], np.int64)
        types = np.array([by_shape[s]["v"] if s in by_shape else 0 for s in range(SHAPES)], np.int64)
        self.total, self.types = int(mass.sum()), int(types.sum())
        for w, n in zip(self.words[:self.vocab], self.n):  # what the model's own words take from the shape classes
            mass[shape(w)] -= n
            types[shape(w)] -= 1
        self.mass, self.log_share = mass, np.log10(mass + types + 1.0)
        self._known: tuple | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_known": None}

    def symbols(self, toks: pa.Array | list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Model symbol of each token, its rank among the cached words or -1, and the positions of those of -1."""
        if self._known is None:
            words = pa.array(self.words, pa.binary())
            by_rank = VOCAB + shapes(words)
            by_rank[:self.vocab] = np.arange(self.vocab)
            self._known = words, np.append(by_rank, 0).astype(SYMBOL)
        words, by_rank = self._known
        toks = toks if isinstance(toks, pa.Array) else pa.array(toks, pa.binary())
        rank = pc.index_in(toks, value_set=words).fill_null(-1).to_numpy()
        sym, rare = by_rank[rank], np.flatnonzero(rank < 0)
        sym[rare] = VOCAB + shapes(toks.take(pa.array(rare)))
        return sym, rank, rare


# --- the network -----------------------------------------------------------

#: Class of each symbol; the last entry, for symbols of -1, is below all others.
CLASS_OF = np.concatenate([np.arange(VOCAB) // PER_CLASS, np.arange(WORD_CLASSES, CLASSES), [-1]]).astype(np.int16)


def class_of(sym: np.ndarray) -> np.ndarray:
    return CLASS_OF[sym]


def _with_ones(h: np.ndarray) -> np.ndarray:
    """The states with a column of ones, so that a product with `_with_bias` adds the bias."""
    out = np.empty((len(h), h.shape[1] + 1), h.dtype)
    out[:, :-1], out[:, -1] = h, 1
    return out


def _with_bias(w: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Weights (..., HIDDEN, n) with the biases (..., n) as their last row."""
    return np.concatenate([w, bias[..., None, :]], axis=-2)


def _product(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """h @ w, `ROWS` rows at a time."""
    out = np.empty((len(h), w.shape[1]), h.dtype)
    for lo in range(0, len(h), ROWS):
        np.matmul(h[lo:lo + ROWS], w, out=out[lo:lo + ROWS])
    return out


def _exp_sum(x: np.ndarray) -> np.ndarray:
    """Turns logits into their exponentials, in place; the sum of each row. (Logits start as log shares; 60 is out of reach.)"""
    if not x.max(initial=0) <= 60:
        np.minimum(x, 60, out=x)
    np.exp(x, out=x)
    return x @ np.ones(x.shape[1], x.dtype)


def _entries(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where, in a contiguous x laid out flat, the entry `at` of each row is."""
    return np.arange(0, x.size, x.shape[1]) + at


def _log_share(h: np.ndarray, w: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log softmax of one entry of each row of the logits h @ w."""
    x = h @ w
    picked = np.minimum(x.reshape(-1)[_entries(x, at)], 60)
    return picked - np.log(_exp_sum(x))


def _softmax_less_one(x: np.ndarray, at: np.ndarray, scale: float) -> np.ndarray:
    """Gradient of the loss by the logits: softmax less 1 at the right entry, times scale; in place."""
    x *= (scale / _exp_sum(x))[:, None]
    x.reshape(-1)[_entries(x, at)] -= scale
    return x


def _segment_sums(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of rows from each of `first` up to the next; most segments are short, and `reduceat` goes through each of their columns."""
    size, out = np.diff(first, append=len(rows)), rows.take(first, axis=0)
    for n in range(2, SHORT + 1):
        at = np.flatnonzero(size == n)
        tail = rows.take(first[at] + 1, axis=0)
        for j in range(2, n):
            tail += rows.take(first[at] + j, axis=0)
        out[at] += tail
    at = np.flatnonzero(size > SHORT)
    if len(at):
        long = rows.take(np.flatnonzero(np.repeat(size > SHORT, size)), axis=0)
        out[at] = np.add.reduceat(long, np.cumsum(size[at]) - size[at], axis=0)
    return out


def _by_class(cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the word classes' symbols, class by class, and where each class begins among them."""
    order = np.argsort(cls, kind="stable")
    bounds = np.searchsorted(cls[order], np.arange(WORD_CLASSES + 1, dtype=cls.dtype))
    return order[bounds[0]:bounds[-1]], bounds - bounds[0]


class Gru:
    """The weights: input table e (one row a symbol, gates z, r, n), recurrent u, class output, word outputs by class."""

    NAMES = ("e", "u", "c", "cb", "w", "wb")

    def __init__(self, lexicon: Lexicon, seed: int = 7):
        rng, h = np.random.default_rng(seed), HIDDEN
        self.e = (rng.standard_normal((VOCAB + SHAPES, 3 * h)) * 0.3).astype(F32)
        self.u = (rng.standard_normal((h, 3 * h)) / np.sqrt(h)).astype(F32)
        self.c, self.w = np.zeros((h, CLASSES), F32), np.zeros((WORD_CLASSES, h, PER_CLASS), F32)
        n = np.zeros(VOCAB)
        n[:lexicon.vocab] = lexicon.n[:lexicon.vocab]
        by_class = np.concatenate([n.reshape(WORD_CLASSES, PER_CLASS).sum(axis=1), lexicon.mass])
        self.cb = np.log((by_class + 1) / (by_class + 1).sum()).astype(F32)
        n = n.reshape(WORD_CLASSES, PER_CLASS)
        self.wb = np.where(n > 0, np.log(np.maximum(n, 1) / np.maximum(n.sum(axis=1, keepdims=True), 1)), -30).astype(F32)
        self.squares: dict | None = None

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in self.NAMES])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k in self.NAMES:
            a = getattr(self, k)
            setattr(self, k, flat[at:at + a.size].reshape(a.shape).astype(F32))
            at += a.size

    def given(self, x: np.ndarray) -> np.ndarray:
        """Rows of the input table for symbols (..., b), gate by gate: (..., 3, b, HIDDEN)."""
        return self.e.reshape(-1, HIDDEN).take(3 * x[..., None, :] + np.arange(3)[:, None], axis=0)

    def recurrent(self) -> np.ndarray:
        """u, gate by gate."""
        return np.ascontiguousarray(self.u.reshape(HIDDEN, 3, HIDDEN).swapaxes(0, 1))

    def gates(self, h: np.ndarray, g: np.ndarray, u: np.ndarray, out: tuple | None = None) -> tuple:
        """Next state, gates (z, r), n, and the recurrent part of each gate, from a state, `given` and `recurrent`; into `out`."""
        after, zr, n, a = out or (np.empty_like(h), np.empty_like(g[:2]), np.empty_like(h), np.empty_like(g))
        np.matmul(h, u, out=a)
        np.add(g[:2], a[:2], out=zr)
        np.exp(np.negative(zr, out=zr), out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        np.multiply(zr[1], a[2], out=n)
        n += g[2]
        np.tanh(n, out=n)
        np.subtract(h, n, out=after)
        after *= zr[0]
        after += n
        return after, zr, n, a

    def step(self, h: np.ndarray, x: np.ndarray, u: np.ndarray | None = None) -> np.ndarray:
        return self.gates(h, self.given(x), self.recurrent() if u is None else u)[0]

    def log_probs(self, h: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural log of P(y | h), up to a shape class for other words; row by row."""
        cls, out, h, c = class_of(y), np.empty(len(y), h.dtype), _with_ones(h), _with_bias(self.c, self.cb)
        for lo in range(0, len(y), ROWS):
            out[lo:lo + ROWS] = _log_share(h[lo:lo + ROWS], c, cls[lo:lo + ROWS])
        words, bounds = _by_class(cls)
        hw, w, at, more = h.take(words, axis=0), _with_bias(self.w, self.wb), y[words] % PER_CLASS, np.empty(len(words), h.dtype)
        for k, (begin, end) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
            for lo in range(begin, end, ROWS):
                hi = min(lo + ROWS, end)
                more[lo:hi] = _log_share(hw[lo:hi], w[k], at[lo:hi])
        out[words] += more
        return out

    def _update(self, name: str, grad: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        weights, squares = getattr(self, name), self.squares[name]
        s = squares[rows]
        s += grad * grad
        if not isinstance(rows, slice):
            squares[rows] = s
        weights[rows] -= RATE * grad / np.sqrt(s + 1e-8)

    def train(self, x: np.ndarray, h: np.ndarray) -> np.ndarray:
        """One update from a window of symbols (streams, steps + 1); the state behind it. Symbols of -1 fill a stream up: they are not learnt."""
        if self.squares is None:
            self.squares = {k: np.full_like(getattr(self, k), 1e-4) for k in self.NAMES}
        b, t, k = len(x), x.shape[1] - 1, HIDDEN
        given = np.maximum(x[:, :-1], 0).T
        table, u = self.given(given), self.recurrent()
        hs, zr = np.empty((t + 1, b, k), table.dtype), np.empty((t, 2, b, k), table.dtype)
        n, a = np.empty((t, b, k), table.dtype), np.empty((t, 3, b, k), table.dtype)
        hs[0] = h
        for i in range(t):
            self.gates(hs[i], table[i], u, (hs[i + 1], zr[i], n[i], a[i]))
        out, y = hs[1:].reshape(t * b, k), x[:, 1:].T.ravel()
        cls, scale = class_of(y), F32(1 / (STEPS * b))
        ones = _with_ones(out)
        d = _softmax_less_one(_product(ones, _with_bias(self.c, self.cb)), np.maximum(cls, 0), scale)
        d[y < 0] = 0  # their class is below all others, so they are no words either
        dh = d @ self.c.T
        grads = [("c", out.T @ d, slice(None)), ("cb", d.sum(axis=0), slice(None))]
        # Words, class by class: products a class, everything else for all of them at once.
        words, bounds = _by_class(cls)
        hw, dw, back = ones.take(words, axis=0), np.empty((len(words), PER_CLASS), out.dtype), np.empty((len(words), k), out.dtype)
        spans = [(j, lo, hi) for j, (lo, hi) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())) if lo < hi]
        biased = _with_bias(self.w, self.wb)
        for j, lo, hi in spans:
            np.dot(hw[lo:hi], biased[j], out=dw[lo:hi])
        _softmax_less_one(dw, y[words] % PER_CLASS, scale)
        gw, gwb = np.zeros_like(self.w), np.zeros_like(self.wb)
        for j, lo, hi in spans:
            part = dw[lo:hi]
            np.dot(hw[lo:hi, :k].T, part, out=gw[j])
            np.dot(part, self.w[j].T, out=back[lo:hi])
            np.add.reduce(part, axis=0, out=gwb[j])
        back += dh.take(words, axis=0)
        dh[words] = back
        grads += [("w", gw, slice(None)), ("wb", gwb, slice(None))]
        # Back through time: what a state's gradient does to the gates is known for all steps beforehand.
        dh, z, r, before = dh.reshape(t, b, k), zr[:, 0], zr[:, 1], hs[:-1]
        less_z, gate = 1 - z, np.empty((t, 3, b, k), table.dtype)
        to_n = less_z * (1 - n * n)
        np.multiply((before - n) * z, less_z, out=gate[:, 0])
        np.multiply(to_n * a[:, 2] * r, 1 - r, out=gate[:, 1])
        np.multiply(to_n, r, out=gate[:, 2])
        recurrent = np.empty((t, b, 3 * k), table.dtype)  # the gates side by side, for the products
        carry, ut = np.zeros((b, k), table.dtype), self.u.T.copy()
        for i in reversed(range(t)):
            g = dh[i]
            g += carry
            carry = g * z[i]
            gate[i] *= g
            np.concatenate(gate[i], axis=1, out=recurrent[i])
            carry += recurrent[i] @ ut
        inputs = recurrent.copy()  # the two differ in n
        np.multiply(to_n, dh, out=inputs[:, :, 2 * k:])
        du = before.reshape(t * b, k).T @ recurrent.reshape(t * b, 3 * k)
        xs, dg, h = given.ravel().astype(np.int16), inputs.reshape(t * b, 3 * k), hs[-1]
        order = np.argsort(xs, kind="stable")
        xs = xs[order]
        first = np.append(0, np.flatnonzero(xs[1:] != xs[:-1]) + 1)
        grads += [("u", du, slice(None)), ("e", _segment_sums(dg.take(order, axis=0), first), xs[first])]
        for name, grad, at in grads:
            self._update(name, grad, at)
        return h

    def fit(self, stream: np.ndarray) -> int:
        """Train on all of a sequence of symbols that ends with the end token, cut into parallel streams; the tokens used.

        Every symbol is learnt once: a stream starts behind the symbol before
        it, the first one behind the end token, and the last is filled up.
        """
        size = len(stream)
        if not size:
            return 0
        b = max(1, min(STREAMS, size // (UPDATES * STEPS)))  # short sequences: fewer streams, not fewer updates
        n = -(-size // b)
        whole = np.concatenate([stream[-1:], stream, np.full(b * n - size, -1)])
        x, h = whole[np.arange(b)[:, None] * n + np.arange(n + 1)], np.zeros((b, HIDDEN), F32)
        for at in range(0, n, STEPS):
            h = self.train(x[:, at:at + STEPS + 1], h)
        return size

    def score(self, seqs: list[np.ndarray], start: int, width: int = 128, group: int = 2048) -> np.ndarray:
        """Natural log-likelihood of each symbol sequence; the state goes through windows of `width` to the end."""
        out, sizes = np.zeros(len(seqs)), np.array([len(x) for x in seqs], np.int64)
        order = np.argsort(-sizes, kind="stable")
        for lo in range(0, len(order), group):
            ids = order[lo:lo + group]
            size, some = sizes[ids], [seqs[i] for i in ids.tolist()]
            h, last, u = np.zeros((len(ids), HIDDEN), F32), np.full(len(ids), start, SYMBOL), self.recurrent()
            for at in range(0, int(size.max(initial=0)), width):
                on = int(np.searchsorted(-size, -at, side="left"))  # sorted by length: the first `on` go on
                h, last = h[:on], last[:on]
                steps = int(min(width, size[0] - at))
                x = np.full((on, steps), start, SYMBOL)
                for row, seq in zip(x, some[:on]):
                    part = seq[at:at + steps]
                    row[:len(part)] = part
                x = np.ascontiguousarray(x.T)
                states, room = np.empty((steps, on, HIDDEN), F32), [np.empty((*n, on, HIDDEN), F32) for n in ((2,), (), (3,))]
                for s in range(steps):
                    h = self.gates(h, self.given(last if s == 0 else x[s - 1]), u, (states[s], *room))[0]
                h, last = h.copy(), x[-1]
                valid = (at + np.arange(steps))[:, None] < size[:on]
                full = np.flatnonzero(valid)
                lp = np.zeros((steps, on))
                lp.reshape(-1)[full] = self.log_probs(states.reshape(-1, HIDDEN).take(full, axis=0), x.reshape(-1)[full])
                out[ids[:on]] += lp.sum(axis=0)
        return out


# --- texts as symbols ------------------------------------------------------


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum between each two of bounds."""
    at = bounds.tolist()
    return np.array([np.add.reduce(values[i:j]) for i, j in zip(at, at[1:])], float)


def _symbol_tasks(lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = lexicon.value
        logs = np.log10(lex.n + 1.0)
        for b in batches:
            for lo in range(0, b.num_rows, 2 * BATCH):  # a lookup of all cached words is made for each part
                part = b.slice(lo, 2 * BATCH)
                words, begin = split(part.column(0))
                words = pa.concat_arrays([words, pa.array([END], pa.binary())])
                # The tokens of all texts, one text after the other: which word each is, the end behind the words of each text.
                bounds = begin + np.arange(part.num_rows + 1)
                is_end = np.zeros(bounds[-1], bool)
                is_end[bounds[1:] - 1] = True
                word = np.full(len(is_end), len(words) - 1, np.int32)
                word[~is_end] = np.arange(len(words) - 1, dtype=np.int32)
                sym, rank, _ = lex.symbols(words)
                sym, rank = sym[word], rank[word]
                rare, known, in_shape, other = (np.flatnonzero(x) for x in (rank < 0, rank >= 0, rank >= lex.vocab, sym >= VOCAB))
                n_known = np.diff(np.searchsorted(known, bounds))
                log_counts = _sums(logs[rank[known]], np.searchsorted(known, bounds))
                in_shapes = (_sums(logs[rank[in_shape]], np.searchsorted(in_shape, bounds))
                             - _sums(lex.log_share[sym[other] - VOCAB], np.searchsorted(other, bounds)))
                unknown, cut = words.take(pa.array(word[rare])).to_pylist(), np.searchsorted(rare, bounds).tolist()
                ends, rare_words, times = [0], [], []
                for i, j in zip(cut, cut[1:]):
                    of_text = Counter(unknown[i:j])
                    rare_words += of_text
                    times += of_text.values()
                    ends.append(len(times))
                syms = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, *map(pa.py_buffer, (
                    (bounds * SYMBOL.itemsize).astype(np.int32), sym))])
                pairs = pa.StructArray.from_arrays([pa.array(rare_words, pa.binary()), pa.array(times, pa.int64())], names=["word", "m"])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], syms, pa.array(np.diff(bounds)), pa.array(n_known), pa.array(log_counts), pa.array(in_shapes),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)],
                    names=[*b.schema.names[1:], "sym", "n_tokens", "n_known", "log_counts", "in_shape", "rare"])
    return run


def as_symbols(rows: DataFrame, lexicon) -> DataFrame:
    """rows (text, doc_id, held_out) as a table of symbols: id, doc_id, held_out, sym (16-bit symbols), n_tokens, n_known,
    log_counts (of the cached words), in_shape (log share of the cached words within their shape class), rare (word, m)."""
    kind = dict(rows.dtypes)["doc_id"]
    made = rows.select("text", "doc_id", "held_out").mapInArrow(
        _symbol_tasks(lexicon), f"doc_id {kind}, held_out boolean, sym binary, n_tokens bigint, n_known bigint, log_counts double, in_shape double, "
        "rare array<struct<word:binary,m:bigint>>")
    return staged(made.withColumn("id", F.monotonically_increasing_id()), "lm-symbols")


def sequences(column: pa.Array) -> list[np.ndarray]:
    """Symbol sequences of a column `sym`."""
    return [np.frombuffer(x, SYMBOL) for x in column.to_pylist()]


# --- training --------------------------------------------------------------

def _train_tasks(lexicon, start: Gru):
    lex = lexicon

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, used = Gru(lex.value), 0
        model.load(start.value)
        for b in batches:
            for lo in range(0, b.num_rows, BATCH):
                used += model.fit(np.concatenate(sequences(b.column(0).slice(lo, BATCH))).astype(np.int64))
        if used:
            flat = model.flat()
            for k in range(0, len(flat), CHUNK):
                yield pa.RecordBatch.from_arrays([pa.array([k // CHUNK], pa.int32()), pa.array([flat[k:k + CHUNK].tobytes()], pa.binary()),
                                                  pa.array([used], pa.int64())], names=["chunk", "part", "used"])
    return run


def _mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token-weighted mean of each chunk; one running sum a chunk."""
    sums: dict[int, np.ndarray] = {}
    used: Counter = Counter()
    for b in batches:
        for k, part, n in zip(*(c.to_pylist() for c in b.columns)):
            sums[k] = sums.get(k, 0) + np.frombuffer(part, F32).astype(np.float64) * n
            used[k] += n
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([(s / used[k]).astype(F32).tobytes() for k, s in sums.items()], pa.binary())],
                                     names=["chunk", "part"])


def learn(train: DataFrame, lexicon: Lexicon, shared=None) -> Gru:
    """The model of all rows of train (sym, doc_id); `shared`: the lexicon as a broadcast variable."""
    model, sc = Gru(lexicon), train.sparkSession.sparkContext
    warm = [r.sym for r in hash_sample(train, F.col("doc_id"), WARM_DOCS, train.count()).select("sym").collect()]
    if not warm:
        return model
    stream = np.concatenate([np.frombuffer(x, SYMBOL) for x in warm]).astype(np.int64)
    for _ in range(WARM_EPOCHS):
        model.fit(stream)
    parts = train.select("sym").mapInArrow(_train_tasks(shared or sc.broadcast(lexicon), sc.broadcast(model.flat())), "chunk int, part binary, used bigint")
    mean = parts.repartition("chunk").mapInArrow(_mean, "chunk int, part binary").toArrow().to_pylist()
    if mean:
        model.load(np.concatenate([np.frombuffer(r["part"], F32) for r in sorted(mean, key=lambda r: r["chunk"])]))
    return model


# --- scoring ---------------------------------------------------------------

def _score_tasks(model, start: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gru = model.value
        for b in batches:
            for lo in range(0, b.num_rows, 2 * BATCH):
                part = b.slice(lo, 2 * BATCH)
                log = gru.score(sequences(part.column(0)), start) / np.log(10)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(log, pa.float64())], names=[*b.schema.names[1:], "log"])
    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    fold = remainder(F.col("doc_id"), FOLDS)
    rows = pick(docs, "doc_id", "text").select(F.col("text").cast("binary").alias("text"), "doc_id", (fold == HELD).alias("held_out"))
    counts = count_words(rows.where(~F.col("held_out")).select("text"))
    lexicon = Lexicon(counts)
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(lexicon)
    symbols = as_symbols(rows, shared)
    model = learn(symbols.where(~F.col("held_out")).select("sym", "doc_id"), lexicon, shared)
    start = int(lexicon.symbols([END])[0][0])
    kept = symbols.select("sym", "id", "doc_id", "held_out", "n_tokens", "n_known", "log_counts", "in_shape")
    schema = ", ".join(f"{c} {t}" for c, t in kept.dtypes[1:])
    scored = staged(kept.mapInArrow(_score_tasks(sc.broadcast(model), start), f"{schema}, log double"), "lm-scored")
    rare = symbols.select("id", F.explode("rare").alias("r")).select("id", "r.word", "r.m")
    found = (rare.join(counts.select("word", "n"), "word").groupBy("id")
             .agg(F.sum(F.col("m") * F.log10(F.col("n") + 1)).alias("more"), F.sum("m").alias("seen")))
    n, v = lexicon.total, lexicon.types
    more = F.coalesce("more", F.lit(0.0))
    return scored.join(found, "id", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"), F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("log_counts") + more - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))).alias("base_score"),
        (F.col("log") + F.col("in_shape") + more).alias("score"))
