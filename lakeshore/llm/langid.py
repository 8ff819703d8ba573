"""Operator 10: language identification by rank-order n-gram profiles.

A profile is the `TOP` most frequent letter n-grams (orders 1 to 3, words
padded by a mark) in order of frequency. A document goes to the language whose
profile has the least out-of-place distance from the document's own profile:
the sum of rank differences, `TOP` for an n-gram that the language lacks.

Defined results: null text or text without a letter gives `und`, score 0, and
so does everything if nothing can be learned from. Ties between n-grams go to
the smaller code points, between languages to the smaller name. A null doc_id
counts as empty text for the fold. Repeated rows are learnt from and predicted
each; texts of any length are read whole. An empty table gives no rows; extra
columns are left out.
"""

from __future__ import annotations

from functools import lru_cache
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_text, pick, remainder

TOP = 300
FOLDS = 5
PAD = ord("_")
#: A task merges the n-grams of this many characters at a time.
CHUNK = 1 << 20


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngrams(text: str) -> np.ndarray:
    """All n-grams of a text as integers of 21 bits a character; empty if it has no letter."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    is_letter = letters()[cp]
    if not is_letter.any():
        return np.zeros(0, np.uint64)
    s = np.concatenate([[PAD], np.where(is_letter, cp, PAD), [PAD]]).astype(np.uint64)
    pad = np.concatenate([[True], ~is_letter, [True]])
    keep = np.ones(len(s), bool)
    keep[1:] = ~(pad[1:] & pad[:-1])
    s, pad = s[keep], pad[keep]
    two = (s[:-1] << np.uint64(21)) | s[1:]
    three = ((two[:-1] << np.uint64(21)) | s[2:])[~pad[1:-1]]
    return np.concatenate([s[~pad], two, three])


def ranked(grams: np.ndarray) -> np.ndarray:
    """The TOP most frequent n-grams, most frequent first, ties to the smaller."""
    keys, n = np.unique(grams, return_counts=True)
    return keys[np.argsort(-n, kind="stable")[:TOP]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, ngram, n), combined within the task."""
    held: dict[str, list] = {}
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def merge(lang: str) -> None:
        keys, n = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
        if lang in sums:
            k0, n0 = sums[lang]
            keys, inv = np.unique(np.concatenate([k0, keys]), return_inverse=True)
            n = np.bincount(inv, np.concatenate([n0, n])).astype(np.int64)
        sums[lang] = keys, n

    def out() -> Iterator[pa.RecordBatch]:
        for lang, (keys, n) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)),
                                              pa.array(n.astype(np.int64))], names=["lang", "ngram", "n"])

    size: dict[str, int] = {}
    for b in batches:
        for i in range(b.num_rows):
            lang, grams = b.column(1)[i].as_py(), ngrams(b.column(0)[i].as_py())
            held.setdefault(lang, []).append(grams)
            size[lang] = size.get(lang, 0) + len(grams)
            if size[lang] > CHUNK:
                merge(lang)
                size[lang] = 0
                if sum(len(k) for k, _ in sums.values()) > 2 * CHUNK:  # odd texts: send what there is
                    yield from out()
                    sums.clear()
    for lang in list(held):
        merge(lang)
    yield from out()


def learn(docs: DataFrame) -> DataFrame:
    """(lang, ngram, rank): TOP rows for each language seen in the training folds of all of docs."""
    train = pick(docs, "doc_id", "text", "lang").where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & (remainder(F.col("doc_id"), FOLDS) != 0)).select("text", "lang")
    counts = (train.mapInArrow(_count, "lang string, ngram bigint, n bigint")
              .groupBy("lang", "ngram").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "ngram")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP).select("lang", "ngram", "rank")


def distances(own: np.ndarray, profiles: list[tuple[str, np.ndarray, np.ndarray]]) -> list[float]:
    """Out-of-place distance of a ranked document to each (lang, sorted n-grams, their ranks), over the largest possible."""
    out, at = [], np.arange(len(own))
    for _, keys, ranks in profiles:
        i = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        d = np.where(keys[i] == own, np.abs(ranks[i] - at), TOP)
        out.append(float(d.sum()) / (TOP * len(own)))
    return out


def predict_language(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score (1 less the distance as a share of the largest possible)."""
    found: dict[str, list] = {}
    for r in learn(docs).collect():  # TOP rows for each language
        found.setdefault(r.lang, []).append((r.ngram, r.rank - 1))
    profiles = []
    for lang in sorted(found):
        pairs = sorted(found[lang])
        profiles.append((lang, np.array([k for k, _ in pairs], np.uint64), np.array([r for _, r in pairs], np.int64)))

    def one(text: str | None) -> tuple[str, float]:
        own = ranked(ngrams(text)) if text and profiles else []
        if not len(own):
            return "und", 0.0
        d = distances(own, profiles)
        k = int(np.argmin(d))
        return profiles[k][0], 1.0 - d[k]

    def fn(texts: list) -> list:
        return [list(x) for x in zip(*map(one, texts), strict=True)]

    rows = pick(docs, "doc_id", "text").select("doc_id", "text", (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"))
    return map_text(rows, fn, [("lang_pred", "string", pa.string()), ("score", "double", pa.float64())])
