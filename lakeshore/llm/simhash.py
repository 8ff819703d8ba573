"""Operator 6: SimHash near-duplicates by fuzzy hashing with the Golay code.

A 64-bit fingerprint is cut into three segments of at most 22 bits. Of two
fingerprints that differ in two bits or fewer, at least one segment is equal,
and each other one differs in two bits or fewer. The binary Golay code of
length 23 is perfect: every word lies within three bits of exactly one
codeword. A segment's fuzzy keys are the indices of the codewords to which it
and its 23 neighbours decode, one or six of them, and two words that differ in
two bits or fewer share one. So every link shares a key (which segment is
equal, its value, a fuzzy key of the next segment); rows meet by key, and links
are verified on whole fingerprints.

Only distinct fingerprints meet, so exact copies cost nothing; within a key a
spanning forest of the links comes out, never all pairs. A key of `HOT`
fingerprints or more is divided by the fuzzy keys of the third segment: it too
differs in two bits or fewer, so no link is lost. A group then has one value of
a segment, and two segments that lie within four bits of a codeword each, so
its size has a bound that no input exceeds. Links then go through connected
components (graph.py).

Defined results: null text counts as empty; texts without words have
fingerprint zero and link like any other. Rows are kept as they are, also
repeated ones; null doc_ids are never the smallest. Texts of any length are
read whole, their shingles hashed in parts. An empty table gives no rows; extra
columns are left out.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import repeat
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, staged
from .graph import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: First bit and width of each segment.
SEGMENTS = ((42, 22), (21, 21), (0, 21))
#: Generator polynomial of the Golay code of length 23 (fixed value).
GOLAY = 0xC75
#: From so many fingerprints on, a key is divided by the third segment.
HOT = 1 << 16
#: Runs of equal keys up to this length are compared pair by pair, longer ones by search.
SHORT_RUN = 32
#: From this length on, a run's neighbours are looked up rather than compared with all.
LONG_RUN = 40_000


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """SimHash of the text's word shingles (UTF-8; A-Z in lower case)."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < size:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        shingles, n = map(b" ".join, zip(*(words[i:] for i in range(size)))), len(words) - size + 1
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        part = h[at:at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(b.column(0)[i].as_py(), size) for i in range(b.num_rows)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(fp.view(np.int64))], names=[*b.schema.names[1:], "fp"])
    return run


def fingerprints(docs: DataFrame, *keep: str, size: int = SHINGLE) -> DataFrame:
    """The kept columns and `fp`, the fingerprint as a signed long, for every row of docs."""
    rows = docs.select(F.col("text").cast("binary").alias("text"), *keep)
    types = dict(rows.dtypes)
    return rows.mapInArrow(_fingerprints(size), ", ".join([*(f"{c} {types[c]}" for c in keep), "fp bigint"]))


# --- fuzzy keys ------------------------------------------------------------

@lru_cache(maxsize=1)
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and high 11 bits of a word, and the error pattern of each syndrome."""
    def rem(w: int) -> int:
        for i in range(22, 10, -1):
            if w >> i & 1:
                w ^= GOLAY << (i - 11)
        return w
    unit = [rem(1 << i) for i in range(23)]

    def table(first: int, bits: int) -> np.ndarray:
        t = np.zeros(1 << bits, np.uint32)
        for i in range(bits):
            t[1 << i:2 << i] = t[:1 << i] ^ unit[first + i]
        return t
    errors = np.zeros(2048, np.uint32)
    for i in range(23):
        errors[unit[i]] = 1 << i
        for j in range(i):
            errors[unit[i] ^ unit[j]] = 1 << i | 1 << j
            for k in range(j):
                errors[unit[i] ^ unit[j] ^ unit[k]] = 1 << i | 1 << j | 1 << k
    return table(0, 12), table(12, 11), errors


def codeword_index(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword nearest to each word of 23 bits."""
    low, high, errors = _golay()
    words = words.astype(np.uint32)
    return (words ^ errors[low[words & 0xFFF] ^ high[words >> 12]]) >> 11


def fuzzy_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, index) of the distinct codewords to which each word and its 23 neighbours decode."""
    flips = np.array([0, *(1 << i for i in range(23))], np.uint32)
    idx = np.sort(codeword_index(words.astype(np.uint32)[:, None] ^ flips), axis=1)
    new = np.ones(idx.shape, bool)
    new[:, 1:] = idx[:, 1:] != idx[:, :-1]
    return np.nonzero(new)[0], idx[new]


def segments(fp: np.ndarray) -> list[np.ndarray]:
    return [(fp >> np.uint64(b)) & np.uint64((1 << w) - 1) for b, w in SEGMENTS]


def link_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, key): any two fingerprints within MAX_BITS share a key."""
    at, keys = [], []
    segs = segments(fp)
    for s in range(3):
        i, idx = fuzzy_keys(segs[(s + 1) % 3])
        at.append(i)
        keys.append(np.uint64(s << 34) | segs[s][i] << np.uint64(12) | idx.astype(np.uint64))
    return np.concatenate(at), np.concatenate(keys)


def divided_keys(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, key): the keys of link_keys with a fuzzy key of the segment that they leave out."""
    at, keys = [], []
    of = (key >> np.uint64(34)).astype(np.int64)
    segs = segments(fp)
    for s in range(3):
        rows = np.flatnonzero(of == s)
        i, idx = fuzzy_keys(segs[(s + 2) % 3][rows])
        at.append(rows[i])
        keys.append(key[rows[i]] | idx.astype(np.uint64) << np.uint64(36))
    return np.concatenate(at), np.concatenate(keys)


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, 1 << 14):
            fp = b.column(0).slice(lo, 1 << 14).to_numpy(zero_copy_only=False).view(np.uint64)
            at, keys = link_keys(fp)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(fp[at].view(np.int64))], names=["key", "fp"])


def _divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, 1 << 14):
            key, fp = (c.slice(lo, 1 << 14).to_numpy(zero_copy_only=False).view(np.uint64) for c in b.columns)
            at, keys = divided_keys(key, fp)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(fp[at].view(np.int64))], names=["key", "fp"])


def _near(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= most


def _run_links(fp: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links within one long run of equal keys."""
    fp = np.unique(fp)
    masks = None
    if len(fp) >= LONG_RUN:
        bits = [np.uint64(1 << i) for i in range(64)]
        masks = np.array(bits + ([x | y for i, x in enumerate(bits) for y in bits[:i]] if most > 1 else []), np.uint64)
    left, out = np.ones(len(fp), bool), []
    rest = fp
    for seed in range(len(fp)):
        if not left[seed]:
            continue
        left[seed], front = False, [seed]
        while front:
            x = fp[front.pop()]
            if masks is not None:
                near = x ^ masks
                at = np.minimum(np.searchsorted(fp, near), len(fp) - 1)
                found = at[(fp[at] == near) & left[at]]
            else:
                rest = np.flatnonzero(left)
                found = rest[_near(fp[rest], x, most)]
            if len(found):
                left[found] = False
                front.extend(found.tolist())
                out.append((np.full(len(found), x), fp[found]))
    return out


def _links(most: int):
    """Rows sorted by key in; verified links (a, b) out."""
    def of(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.concatenate([starts, [len(key)]]))
        found = []
        for s, n in zip(starts[size > SHORT_RUN], size[size > SHORT_RUN]):
            found += _run_links(fp[s:s + n], most)
        length = np.repeat(size, size)
        short = length <= SHORT_RUN
        for d in range(1, min(SHORT_RUN, int(size.max(initial=1)))):
            i = np.flatnonzero((key[d:] == key[:-d]) & short[d:])
            i = i[_near(fp[i], fp[i + d], most)]
            found.append((fp[i], fp[i + d]))
        if found:
            a, b = (np.concatenate(x) for x in zip(*found))
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0].view(np.int64)), pa.array(pairs[1].view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0
        for b in batches:
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in b.columns))
            rows += b.num_rows
            if rows >= 1 << 19:  # all but the last, maybe unfinished run
                key, fp = (np.concatenate(x) for x in zip(*held))
                cut = int(np.searchsorted(key, key[-1]))
                if cut:
                    yield from of(key[:cut], fp[:cut].view(np.uint64))
                held, rows = [(key[cut:], fp[cut:])], len(key) - cut
        if rows:
            key, fp = (np.concatenate(x) for x in zip(*held))
            yield from of(key, fp.view(np.uint64))

    return run


def divide_hot(keyed: DataFrame) -> DataFrame:
    """The rows (key, fp), those of hot keys under divided ones, so that they never meet in one task.

    Keys are counted in the tasks before the shuffle. The hot ones are a
    written table: Spark knows its size and broadcasts it only while small.
    """
    hot = staged(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= HOT).select("key"), "simhash-hot")
    of_hot = keyed.join(hot, "key", "left_semi").select("key", "fp").mapInArrow(_divide, "key bigint, fp bigint")
    return keyed.join(hot, "key", "left_anti").select("key", "fp").unionByName(of_hot)


def classes(rows: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """(fp, root, component_id) for the distinct fingerprints of rows (doc_id, fp).

    root is the smallest fingerprint of the component, component_id the
    smallest doc_id reachable by links.
    """
    if not 0 <= most <= MAX_BITS:
        raise ValueError(f"the code covers up to {MAX_BITS} differing bits, not {most}")
    least = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-fp")
    keyed = divide_hot(least.select("fp").mapInArrow(_emit_keys, "key bigint, fp bigint"))
    edges = keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_links(most), "a bigint, b bigint")
    root = components(edges, "simhash-links")
    member = root.select(F.col("a").alias("fp"), F.col("b").alias("root")).unionByName(
        root.select(F.col("b").alias("fp"), F.col("b").alias("root")).distinct())
    linked = least.join(member, "fp")
    lowest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    of_linked = linked.join(lowest, "root").select("fp", "root", "component_id")
    return least.join(of_linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNotNull(), F.col("component_id")).otherwise(F.col("least")).alias("component_id"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    rows = staged(fingerprints(pick(docs, "doc_id", "text"), "doc_id", size=size), "simhash-rows")
    return (rows.join(staged(classes(rows, most), "simhash-classes"), "fp")  # two plain tables: AQE can split a hot fingerprint
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, size: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """The columns of documents; of each group of near copies one row stays, that of the smallest doc_id.

    Rows that share even the doc_id are told apart by a hash of the row, the
    smallest stays; of equal rows one does.
    """
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = pick(docs, *cols).withColumn("row_hash", F.xxhash64("text", "lang", "source", "n_chars"))
    rows = staged(fingerprints(docs, "doc_id", "row_hash", size=size), "simhash-rows")
    grouped = rows.join(staged(classes(rows, most), "simhash-classes"), "fp")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_hash")).alias("first")
    stay = grouped.groupBy("root").agg(first).select("first.doc_id", "first.row_hash").distinct()
    d = docs.alias("d").join(stay.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.row_hash") == F.col("s.row_hash")), "left_semi")
    return d.dropDuplicates(["doc_id", "row_hash"]).select(*cols)
