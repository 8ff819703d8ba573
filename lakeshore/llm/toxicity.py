"""Operator 7: counterfactually regularised toxicity classifier.

Features are the character n-grams (with word marks) that a text holds. A
bounded sample of labelled training rows (`SAMPLE` of each label) selects the
`FEATURES` n-grams with the largest chi-square and fits a logistic regression.
Besides the likelihood and a ridge, the fit penalises score changes: where a
sampled text names a group, the group's name is swapped for every other one of
its family (of one language), and the mean of (score - swapped score)^2 is
added with weight `FAIRNESS`. So a group's name alone says little about
toxicity. Families are fixed lists, grown by the words that the labelled texts
of both labels use in the same places (`grown_families`).

Defined results: null text counts as empty; an empty text gets the score of
no feature; very long texts are read whole, one at a time. An empty table gives
no rows; extra columns are left out. Rows whose label is null teach nothing; without labels every score
is 0, with one label only it is that label. Repeated rows are scored (and may
be sampled) each. A null doc_id counts as empty text for the fold.
"""

from __future__ import annotations

import re
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_sample, map_text, pick, remainder, staged
from .langid import PAD, letters

FOLDS = 5
#: Labelled rows of either label that the classifier is fitted on, about, at most.
SAMPLE = 8_000
FEATURES = 1024
ORDER = 5
LEAST_DOCS = 4
RIDGE = 1.0
FAIRNESS = 4.0
_MIX = np.uint64(0x9E3779B97F4A7C15)

#: Rows that are dense at a time while fitting.
BLOCK = 1024
#: Words that the labelled texts may add to a family, and contexts that such a word must share with the family's terms.
ADDED, SHARED = 8, 2

#: Families of identity terms, by language; a swap stays within the family.
IDENTITY = (
    "women men girls boys", "woman man girl boy", "muslim jewish christian hindu buddhist atheist catholic sikh", "muslims jews christians hindus buddhists atheists catholics sikhs",
    "black white asian latino african european arab", "gay lesbian straight bisexual transgender queer heterosexual homosexual",
    "immigrants refugees natives foreigners", "disabled deaf blind autistic", "old young elderly",
    "mujeres hombres niñas niños", "musulmán judío cristiano budista ateo católico", "negro blanco latino asiático árabe", "inmigrantes refugiados extranjeros nativos",
    "femmes hommes filles garçons", "musulman juif chrétien bouddhiste athée catholique", "noir blanc asiatique arabe", "immigrés réfugiés étrangers",
    "frauen männer mädchen jungen", "muslimisch jüdisch christlich buddhistisch katholisch", "migranten flüchtlinge ausländer einheimische",
)
FAMILIES = tuple(tuple(f.split()) for f in IDENTITY)
_WORD = re.compile(r"\w+")


class Swaps:
    """Which words stand in for which: families of words, a word may be in several."""

    def __init__(self, families: tuple[tuple[str, ...], ...] = FAMILIES):
        self.families = families
        self.of: dict[str, list[int]] = {}
        for i, f in enumerate(families):
            for w in f:
                self.of.setdefault(w, []).append(i)

    def counterfactuals(self, text: str) -> list[str]:
        """The lower-cased text once for each other member of each family it names, with that family's terms replaced by the member.

        A word of several families counts to the one that has most of the text's terms (the first of these).
        """
        text = text.lower()
        named = [self.of[w] for w in _WORD.findall(text) if w in self.of]
        votes = {i: sum(i in o for o in named) for o in named for i in o}
        best = {w: max(o, key=lambda i: (votes.get(i, 0), -i)) for w, o in self.of.items()}
        out = []
        for i in sorted({best[w] for w in _WORD.findall(text) if w in best}):
            terms = {w for w in self.families[i] if best[w] == i}
            present = terms & set(_WORD.findall(text))
            out += [_WORD.sub(lambda m, to=to: to if m[0] in terms else m[0], text) for to in self.families[i] if present != {to}]
        return out


def grams(text: str | None) -> np.ndarray:
    """Hashes of the n-grams of ORDER characters of a text; all but letters become one mark."""
    if not text:
        return np.zeros(0, np.uint64)
    cp = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    is_letter = letters()[cp]
    s = np.concatenate([[PAD], np.where(is_letter, cp, PAD), [PAD]]).astype(np.uint64)
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != PAD) | (s[:-1] != PAD)
    s = s[keep]
    if len(s) < ORDER:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(s) - ORDER + 1, np.uint64)
    for i in range(ORDER):
        h = (h ^ s[i:len(s) - ORDER + 1 + i]) * _MIX
        h ^= h >> np.uint64(29)
    return h


def _held(text: str | None, keys: np.ndarray) -> np.ndarray:
    """Which of the sorted feature hashes a text holds, as indices."""
    g = grams(text)
    if not len(g) or not len(keys):
        return np.zeros(0, np.int64)
    i = np.minimum(np.searchsorted(keys, g), len(keys) - 1)
    return np.unique(i[keys[i] == g])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, docs, toxic docs), combined within each batch."""
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            sets = [np.unique(grams(t)) for t in part.column(0).to_pylist()]
            tox = part.column(1).to_pylist()
            every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            keys, inv = np.unique(every, return_inverse=True)
            n = np.bincount(inv, minlength=len(keys))
            p = np.bincount(inv, np.repeat(np.array(tox, float), [len(s) for s in sets]), minlength=len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(p.astype(np.int64))],
                                             names=["gram", "n", "p"])


def sample_rows(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE) -> DataFrame:
    """(text, toxic, weight): about per_label training rows of either label (all, if there are fewer), chosen by a hash of doc_id.

    weight is the label's number of rows over the number sampled, so that the
    sample stands for all rows. The chosen ids (about 2 * per_label) are
    few enough to broadcast, so texts are not shuffled.
    """
    train = pick(labels, "doc_id", "toxic").where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()
                                                  & (remainder(F.col("doc_id"), FOLDS) != 0))
    totals = {r.toxic: r["count"] for r in train.groupBy("toxic").count().collect()}
    ids = None
    for label in (0, 1):
        part = hash_sample(train.where(F.col("toxic") == label), F.col("doc_id"), per_label, totals.get(label, 0))
        part = part.withColumn("weight", F.lit(max(1.0, totals.get(label, 0) / per_label)))
        ids = part if ids is None else ids.unionByName(part)
    chosen = pick(docs, "doc_id", "text").join(F.broadcast(ids), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), "toxic", "weight")
    return staged(chosen, "toxicity-sample")


class Held:
    """The features that each row holds, as flat indices: row i holds at[cuts[i]:cuts[i + 1]]."""

    def __init__(self, cuts: np.ndarray, at: np.ndarray, features: int):
        self.cuts, self.at, self.features = cuts, at, features

    @classmethod
    def of(cls, lists: pa.ListArray, features: int) -> Held:
        return cls(lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten().to_numpy(zero_copy_only=False), features)

    def __len__(self) -> int:
        return len(self.cuts) - 1

    def dense(self, lo: int, hi: int) -> np.ndarray:
        """Rows lo to hi as 0/1, with a last column of 1."""
        x = np.zeros((hi - lo, self.features + 1), np.float32)
        x[:, -1] = 1
        x[np.repeat(np.arange(hi - lo), np.diff(self.cuts[lo:hi + 1])), self.at[self.cuts[lo]:self.cuts[hi]]] = 1
        return x


def fit(x: Held, y: np.ndarray, weight: np.ndarray, plain: Held, swapped: Held, share: np.ndarray) -> tuple[np.ndarray, float]:
    """Newton's method on the penalised likelihood; swapped holds counterfactuals of the rows in plain, share their weights. Dense rows exist BLOCK at a time."""
    d = x.features
    pen = RIDGE * np.eye(d + 1)
    pen[d, d] = 1e-6
    for lo in range(0, len(plain), BLOCK):
        hi = min(len(plain), lo + BLOCK)
        diff = plain.dense(lo, hi) - swapped.dense(lo, hi)
        pen += 2 * FAIRNESS * ((diff * share[lo:hi, None].astype(np.float32)).T @ diff)
    w = np.zeros(d + 1)
    for _ in range(25):
        grad, curve = pen @ w, pen.copy()
        for lo in range(0, len(x), BLOCK):
            part = x.dense(lo, min(len(x), lo + BLOCK))
            p = 1 / (1 + np.exp(-np.clip(part @ w, -30, 30)))
            of = weight[lo:lo + BLOCK]
            grad += part.T @ (of * (p - y[lo:lo + BLOCK]))
            s = (of * np.maximum(p * (1 - p), 1e-6)).astype(np.float32)
            curve += (part * s[:, None]).T @ part
        step = np.linalg.solve(curve, grad)
        w -= step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-4:
            break
    return w[:d], float(w[d])


class Model:
    """Sorted n-gram hashes, their weights and the intercept (a log odds)."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float):
        self.keys, self.weights, self.bias = keys, weights, bias

    def score(self, text: str | None) -> float:
        z = self.bias + float(self.weights[_held(text, self.keys)].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def grown_families(rows: DataFrame) -> tuple[tuple[str, ...], ...]:
    """FAMILIES with the words that the labelled texts put in the same places: between the same two words as a family's
    terms, in at least SHARED different contexts and LEAST_DOCS texts of either label; ADDED words a family at most."""
    member = {w: i for i, f in reversed(list(enumerate(FAMILIES))) for w in f}

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part, out = b.slice(at, 256), []
                for t, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    w = _WORD.findall(t.lower())
                    out += [(*x, toxic) for x in {(a, c, m, member.get(m)) for a, m, c in zip(w, w[1:], w[2:])}]
                cols = list(zip(*out)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32()))],
                                                 names=["before", "after", "word", "family", "toxic"])

    seen = rows.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(places, "before string, after string, word string, family int, toxic int")
    where = seen.where(F.col("family").isNotNull()).select("before", "after", "family").distinct()
    added = (seen.where(F.col("family").isNull()).drop("family").join(where, ["before", "after"]).groupBy("family", "word")
             .agg(F.count_distinct("before", "after").alias("contexts"), F.count_if(F.col("toxic") == 1).alias("p"), F.count_if(F.col("toxic") == 0).alias("n"))
             .where((F.col("contexts") >= SHARED) & (F.least("p", "n") >= LEAST_DOCS)))
    best = Window.partitionBy("family").orderBy(F.desc("contexts"), "word")
    grown = [list(f) for f in FAMILIES]
    for r in added.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= ADDED).orderBy("family", "nth").collect():  # ADDED a family
        grown[r.family].append(r.word)
    return tuple(map(tuple, grown))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled rows outside the held-out fold."""
    rows = sample_rows(docs, labels)
    none = np.zeros(0, np.uint64), np.zeros(0)
    sizes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return Model(*none, 40.0 if sizes.get(1) else -np.inf)
    pos, neg = sizes[1], sizes[0]
    a, b = F.col("p"), F.col("n") - F.col("p")
    counts = rows.select("text", "toxic").mapInArrow(_count, "gram bigint, n bigint, p bigint").groupBy("gram").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    chi = F.pow(a * (neg - b) - b * (pos - a), F.lit(2.0)) / (F.col("n") * (pos + neg - F.col("n")) + 1)
    best = counts.where(F.col("n") >= LEAST_DOCS).select("gram", chi.alias("chi")).orderBy(F.desc("chi"), "gram").limit(FEATURES).collect()
    keys = np.sort(np.array([r.gram for r in best], np.int64).view(np.uint64))

    swaps = Swaps(grown_families(rows))

    def design(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Features held by each row, and by each of its counterfactuals those it lacks and those it has beyond the row's."""
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                own, lost, gained = [], [], []
                for t in part.column(0).to_pylist():
                    h = _held(t, keys)
                    other = [_held(s, keys) for s in swaps.counterfactuals(t)]
                    own.append(h)
                    lost.append([np.setdiff1d(h, o) for o in other])
                    gained.append([np.setdiff1d(o, h) for o in other])
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(2), pa.array(own, pa.list_(pa.int32())), *(pa.array(c, pa.list_(pa.list_(pa.int32()))) for c in (lost, gained))],
                    names=["toxic", "weight", "held", "lost", "gained"])

    found = rows.mapInArrow(design, f"toxic {dict(rows.dtypes)['toxic']}, weight double, held array<int>, lost array<array<int>>, gained array<array<int>>").toArrow().combine_chunks()
    held, lost, gained = (found[c].combine_chunks() for c in ("held", "lost", "gained"))
    times = np.diff(lost.offsets.to_numpy())  # a text's counterfactuals weigh as much as one
    w, bias = fit(Held.of(held, len(keys)), found["toxic"].to_numpy().astype(float), found["weight"].to_numpy(), Held.of(lost.flatten(), len(keys)),
                  Held.of(gained.flatten(), len(keys)), np.repeat(1 / np.maximum(times, 1), times))
    return Model(keys, w, bias)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    model = train(docs, labels)
    rows = pick(docs, "doc_id", "text").select("doc_id", "text", (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"))
    scored = map_text(rows, lambda texts: [[model.score(t) for t in texts]], [("score", "double", pa.float64())])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those that the classifier calls toxic."""
    model = train(docs, labels)
    cols = ["doc_id", "text", "lang", "source", "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                yield part.filter(pa.array([model.score(t) < 0.5 for t in part.column(1).to_pylist()], pa.bool_()))

    docs = pick(docs, *cols)
    return docs.mapInArrow(run, docs.schema)
