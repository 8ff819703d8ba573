"""Operator 12: document fingerprints by threshold-scaled sketches.

A sketch keeps every shingle hash (XXH64 of `SIZE` words joined by one space)
that lies below a fixed fraction of the 64-bit range. The same hashes are kept
whatever the length of the document, so a sketch grows with its text, the
sketch of several texts together is the union of theirs (`merged`), and the
share of a small text's sketch that is found in a large one's estimates how
much of the small text the large one holds (`containment_in`). Two documents'
likeness is the share of the smaller sketch that is in the other.

`fingerprint_documents` sets each document against the next in descending
order of doc_id and against a text edited with that. Texts are dealt once, by
ranges of ids whose cuts come from a bounded sample of ids, sorted in their
range, and read in one pass with the next row in hand; a range's first
document goes to the end of the range before as well (the very first one to
the end of the last range).

Defined results: null text counts as empty. Words are `[^\\x20\\x09-\\x0D]+`; a
text of fewer than SIZE words is one shingle, a text without words has the
empty sketch. A text none of whose hashes lies below the fraction keeps its
least hash, so that short texts differ; two empty sketches are alike (1.0), an
empty one and another are not (0.0). Rows of equal doc_id follow each other by
text, null ids come last; a lone document is its own next. Repeated rows count
each. Very long texts are held one at a time, with the one after. Extra columns
are left out; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, pick

SIZE = 5
#: One in so many hashes is kept.
ONE_IN = 8
#: Documents a range should hold, ranges at most, and ids sampled for each range.
RANGE_ROWS = 4_096
MAX_RANGES = 65_536
SAMPLED = 8
#: Documents, and characters, of results at a time.
OUT_ROWS = 512
OUT_CHARS = 1 << 24


def sketch(text: str, size: int = SIZE, one_in: int = ONE_IN) -> np.ndarray:
    """Kept shingle hashes of a text, ascending."""
    words = text.encode("utf-8", "surrogatepass").split()  # of bytes: at ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - size + 1)
    h = np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[i:i + size])) for i in range(n)), np.uint64, n)
    low = np.unique(h[h < np.uint64((1 << 64) // one_in)]) if one_in > 1 else np.unique(h)
    return low if len(low) else h.min(keepdims=True)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the smaller sketch's hashes that are in the other."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def as_text(kept: np.ndarray) -> str:
    """16 lowercase hex digits a hash, ascending."""
    return kept.astype(">u8").tobytes().hex()


def edited_text(text: str, following: str) -> str:
    """The text whose last half gives way to as much of the following one's beginning."""
    cut = len(text) // 2
    return text[:len(text) - cut] + following[:cut]


# --- sketches as tables, merged and compared ---------------------------------

def sketches(docs: DataFrame, *keep: str, size: int = SIZE, one_in: int = ONE_IN) -> DataFrame:
    """The kept columns and `hash`, one row for each kept hash of each document, as a signed long."""
    rows = pick(docs, "text", *keep).select(F.coalesce("text", F.lit("")).cast("binary").alias("text"), *keep)
    types = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, OUT_ROWS):
                part = b.slice(at, OUT_ROWS)
                found = [sketch(t.as_py().decode("utf-8", "replace"), size, one_in) for t in part.column(0)]
                of = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i + 1).take(of) for i in range(len(keep))), pa.array(np.concatenate(found).view(np.int64))], names=[*keep, "hash"])
    return rows.mapInArrow(run, ", ".join([*(f"`{c}` {types[c]}" for c in keep), "hash long"]))


def merged(hashes: DataFrame, *keys: str) -> DataFrame:
    """The sketch of each group of documents together: distinct (keys, hash). A large group's stays a table."""
    return hashes.select(*keys, "hash").distinct()


def containment_in(hashes: DataFrame, whole: DataFrame, key: str) -> DataFrame:
    """key, n_kept, contained: the estimated share of each document (key) that the merged sketch `whole` (hash) holds."""
    known = whole.select("hash").distinct().withColumn("known", F.lit(1))
    pairs = hashes.select(key, "hash").distinct().join(known, "hash", "left")
    return pairs.groupBy(key).agg(F.count("*").alias("n_kept"), (F.count("known") / F.count("*")).alias("contained"))


# --- each document against the next ------------------------------------------

def _ranges(rows: DataFrame) -> DataFrame:
    """rows (doc_id, text) with `range` (ascending as ids descend) and `after`: whether a row stands there only as the next one."""
    spark, n = rows.sparkSession, rows.count()
    want = max(1, min(MAX_RANGES, -(-n // RANGE_ROWS)))
    number = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))  # not decreasing in the id: enough for ranges
    sample = hash_sample(rows.select(number.alias("x"), "doc_id"), F.col("doc_id"), SAMPLED * want, n).collect() if want > 1 else []
    ids = sorted(r.x for r in sample)
    cuts = sorted({ids[i * len(ids) // want] for i in range(1, want)} - {float("-inf")}) if ids else []
    if cuts:
        split = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="x", outputCol="b")
        placed = split.transform(rows.withColumn("x", number)).select("doc_id", "text", (F.lit(len(cuts)) - F.col("b").cast("int")).alias("range"))
    else:
        placed = rows.withColumn("range", F.lit(0))
    first = sorted((r.range, r.doc_id) for r in placed.groupBy("range").agg(F.max("doc_id").alias("doc_id")).collect())  # MAX_RANGES rows at most
    if not first:
        return placed.withColumn("after", F.lit(False)).limit(0)
    before = [(r, i, first[at - 1][0]) for at, (r, i) in enumerate(first)]  # the first document's place is behind the last range
    heads = F.broadcast(spark.createDataFrame(before, "r int, head long, before int"))
    placed = placed.join(heads, (F.col("range") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("head")), "left")
    own, other = F.struct("range", F.lit(False).alias("after")), F.struct(F.col("before").alias("range"), F.lit(True).alias("after"))
    places = F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, other)))
    return placed.select("doc_id", "text", places.alias("p")).select("p.range", "p.after", "doc_id", "text").repartitionById(first[-1][0] + 1, F.col("range"))


def fingerprint_documents(docs: DataFrame, size: int = SIZE, one_in: int = ONE_IN) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document."""
    rows = pick(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    in_order = _ranges(rows).sortWithinPartitions("range", "after", F.desc_nulls_last("doc_id"), "text")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, chars, last = [], 0, None  # last: (range, doc_id, text, sketch) that waits for its next document

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

        for b in batches:
            where, after, ids = (b.column(i).to_pylist() for i in range(3))
            for i in range(b.num_rows):
                if after[i] and (last is None or last[0] != where[i]):
                    continue  # a further copy of the next document's id
                text = b.column(3)[i].as_py().decode("utf-8", "replace")
                kept = sketch(text, size, one_in)
                if last is not None and last[0] == where[i]:
                    _, doc_id, before, own = last
                    edited = edited_text(before, text)
                    other = sketch(edited, size, one_in)
                    out.append((doc_id, len(before), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                                as_text(own), as_text(other), likeness(own, other), likeness(own, kept)))
                    chars += len(before)
                    if len(out) >= OUT_ROWS or chars >= OUT_CHARS:
                        yield done()
                        out, chars = [], 0
                last = None if after[i] else (where[i], ids[i], text, kept)
        if out:
            yield done()

    return in_order.select("range", "after", "doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
