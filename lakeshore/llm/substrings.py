"""Operator 5: exact removal of long repeated word sequences, by difference-cover anchors.

A word goes if a window of `WINDOW` words that holds it also starts anywhere
else. Instead of all windows, shorter ones (anchors, WINDOW - PERIOD + 1
words) are hashed, and these only where the position modulo PERIOD lies in a
perfect difference cover: for any two positions there is one shift below PERIOD
that brings both onto the cover. So two equal windows hold equal anchors at the
same place. Windows around a repeated anchor (the extension) are hashed whole,
with 96 bits, and those found again are repeated.

Texts never move. A row is known by its file and its number in the file, hashes
meet by shuffle with that locator, and what they tell about a row goes to side
tables laid out by file and block of rows, from where the next scan of the same
file takes it. Whole copies are settled first; of each group only one takes
part in what follows. A scan collects the hashes of many rows of a file; those
that repeat there are settled there, the others are dealt into buckets by range
of hash and cross the shuffle as packed arrays, one row a bucket, so neither
the shuffle nor its sort handles hashes one by one.

Defined results: null and empty texts have no words; texts shorter than the
window lose nothing; repeated rows are occurrences of their own and remove each
other. A frame that is not read from files is written once first. An empty
table gives no rows; extra columns are left out.
"""

from __future__ import annotations

import hashlib
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, stage_dir, staged

WINDOW = 35
#: A perfect difference cover: every difference modulo PERIOD is one of two of its members (fixed values).
PERIOD, COVER = 21, (0, 1, 6, 8, 18)
ANCHOR = WINDOW - PERIOD + 1
#: Rows of a file whose side information lies in one folder.
BLOCK = 4096
BATCH = 2048
#: Hashes that a scan collects before it packs them (a text's are not divided), and rows of a file that they may span.
PACK, SPAN = 1 << 19, 1 << 16
_M = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def words(text: bytes | None) -> list[bytes]:
    r"""[^\x20\x09-\x0D]+ of a UTF-8 text."""
    return text.split() if text else []


def word_hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, ws), np.uint64, len(ws))


def _powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        size, m = max(n, 1 << 14), _M[which]
        _POWERS[which] = have = (np.cumprod(np.full(size, m, np.uint64)), np.cumprod(np.full(size, pow(m, -1, 1 << 64), np.uint64)))
    return have


def window_hashes(w: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Polynomial hash modulo 2^64 of every window of `size` word hashes."""
    n = len(w) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(w), which)
    sums = np.zeros(len(w) + 1, np.uint64)
    np.cumsum((w ^ (w >> np.uint64(31)) if which else w) * up[:len(w)], out=sums[1:])
    h = (sums[size:] - sums[:-size]) * down[:n]
    return h ^ (h >> np.uint64(32))


def cover_positions(n: int) -> np.ndarray:
    """Positions below n that lie on the difference cover."""
    at = (np.arange(0, n + PERIOD, PERIOD)[:, None] + np.array(COVER)).ravel()
    return at[at < n]


def candidate_windows(n_words: int, anchors: np.ndarray) -> np.ndarray:
    """Starts of the windows that hold one of the given anchors."""
    n = n_words - WINDOW + 1
    edge = np.zeros(n_words + 2, np.int64)
    np.add.at(edge, np.maximum(anchors - (PERIOD - 1), 0), 1)
    np.add.at(edge, anchors + 1, -1)
    return np.flatnonzero(np.cumsum(edge)[:max(n, 0)] > 0)


def covered(n_words: int, starts: np.ndarray) -> np.ndarray:
    """Which words lie in a window that starts at one of `starts`."""
    edge = np.zeros(n_words + 1, np.int64)
    edge[starts] += 1
    np.add.at(edge, starts + WINDOW, -1)
    return np.cumsum(edge)[:n_words] > 0


# --- rows by file and number -----------------------------------------------

def located(docs: DataFrame) -> DataFrame:
    """file (hash of its path), row, text (UTF-8) and doc_id."""
    try:
        where = docs.metadataColumn("_metadata")
        found = docs.withColumn("_file", F.xxhash64(where["file_path"])).withColumn("_row", where["row_index"])
        cols = pick(found, "_file", "_row", "text", "doc_id")
    except AnalysisException:  # not read from files
        return located(staged(pick(docs, "doc_id", "text"), "substrings-docs"))
    return cols.select(F.col("_file").alias("file"), F.col("_row").alias("row"), F.col("text").cast("binary").alias("text"), "doc_id")


def _cut(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """values as binary, one for each stretch between two of the bounds."""
    ends = np.asarray(bounds * values.dtype.itemsize, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def _flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows of a binary column, and how many each row has."""
    column = column.cast(pa.binary())
    if not len(column):
        return np.zeros(0, kind), np.zeros(0, np.int64)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    size, data = np.dtype(kind).itemsize, column.buffers()[2]
    n = (ends[-1] - ends[0]) // size
    return np.frombuffer(data, kind, n, ends[0]) if n else np.zeros(0, kind), np.diff(ends) // size


def _halves(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lower and the upper 16 bits; the upper ones are nearly always 0, and alike ones compress well."""
    return (value & 0xFFFF).astype(np.uint16), (value >> 16).astype(np.uint16)


SIDE = "file bigint, block bigint, row binary, low binary, high binary"


def _by_block(file: np.ndarray, row: np.ndarray, value: np.ndarray) -> list[pa.Array]:
    """SIDE rows: of each file and block its rows (counted in the block) and values, packed."""
    order = np.lexsort((value, row, file))
    file, row, value = file[order], row[order], value[order]
    block = row // BLOCK
    first = np.flatnonzero(np.concatenate([[True] * bool(len(row)), (file[1:] != file[:-1]) | (block[1:] != block[:-1])]))
    bounds = np.append(first, len(row))
    return [pa.array(file[first]), pa.array(block[first]), _cut((row % BLOCK).astype(np.uint16), bounds), *(_cut(h, bounds) for h in _halves(value))]


def write_packed(rows: DataFrame, name: str) -> str:
    """Write SIDE rows where scans find them by file and block of rows."""
    path = f"{stage_dir(rows.sparkSession, name)}/side"
    rows.repartition("file", "block").sortWithinPartitions("file", "block").write.option("compression", "zstd").partitionBy("file", "block").parquet(path)
    return path


def write_side(rows: DataFrame, name: str) -> str:
    """Write rows (file, row, value) where scans find them by file and block of rows."""
    path = f"{stage_dir(rows.sparkSession, name)}/side"
    (rows.withColumn("block", F.floor(F.col("row") / BLOCK)).repartition("file", "block")
     .sortWithinPartitions("file", "block", "row", "value").write.partitionBy("file", "block").parquet(path))
    return path


class Side:
    """Reads what a side table says about rows."""

    def __init__(self, path: str):
        self.fs, self.root = pyarrow.fs.FileSystem.from_uri(path)
        self.key, self.rows, self.values = None, None, None

    def get(self, file: int, row: int) -> np.ndarray:
        """The values of one row, in order."""
        key = (file, row // BLOCK)
        if key != self.key:
            folder = pyarrow.fs.FileSelector(f"{self.root}/file={file}/block={key[1]}", allow_not_found=True)
            found = [self._read(i.path) for i in self.fs.get_file_info(folder) if i.path.endswith(".parquet")]
            both = np.sort(np.concatenate([np.zeros(0, np.int64), *found]))  # the row in its block above, the value below
            self.key, self.rows, self.values = key, both >> 32, both & 0xFFFFFFFF
        a, b = np.searchsorted(self.rows, [row % BLOCK, row % BLOCK + 1])
        return np.unique(self.values[a:b])

    def _read(self, path: str) -> np.ndarray:
        with self.fs.open_input_file(path) as f:
            t = pq.ParquetFile(f).read(use_threads=False)
        if "value" in t.column_names:  # one row each
            row, value = (t.column(c).to_numpy().astype(np.int64) for c in ("row", "value"))
            return row % BLOCK << 32 | value
        row, low, high = (np.concatenate([np.zeros(0, np.uint16), *(_flat(x, np.uint16)[0] for x in t.column(c).chunks)]).astype(np.int64) for c in ("row", "low", "high"))
        return row << 32 | high << 16 | low


def _scan(fn: Callable[[Iterator[tuple[int, int, bytes | None]]], Iterator[tuple]], names: list[str]):
    """A mapInArrow function: fn gets (file, row, text) of some rows and yields arrays for `names`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BATCH):
                part = b.slice(at, BATCH)
                for arrays in fn(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist())):
                    yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=names)
    return run


# --- hashes that occur more than once --------------------------------------

PACKS = "bucket int, known boolean, file bigint, base bigint, h1 binary, h2 binary, row binary, low binary, high binary"


def pooled(h1: np.ndarray, h2: np.ndarray, file: np.ndarray, row: np.ndarray, value: np.ndarray) -> tuple:
    """Whether a hash repeats among those given, and its locator: all that do are known to, and only the first of them asks further. The asking ones are in order."""
    order = np.lexsort((h2, h1))
    a, b = h1[order], h2[order]
    same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    before, after = np.concatenate([[False], same]), np.concatenate([same, [False]])
    ask, known = order[~before], order[before | after]
    every = np.concatenate([ask, known])
    flag = np.zeros(len(every), bool)
    flag[len(ask):] = True
    return flag, h1[every], h2[every], file[every], row[every], value[every]


def packed(held: list[tuple], buckets: int) -> Iterator[pa.RecordBatch]:
    """PACKS rows of some texts (file, row, h1, h2, positions) of one file: hashes that ask by range of hash, known ones by block."""
    file, base = held[0][:2]
    h1, h2, at = (np.concatenate([t[i] for t in held]) for i in (2, 3, 4))
    row = np.repeat(np.array([t[1] for t in held], np.int64), [len(t[4]) for t in held])
    known, h1, h2, _, row, at = pooled(h1, h2, np.broadcast_to(np.int64(file), len(at)), row, at)
    n = int(np.count_nonzero(~known))
    names = [c.split()[0] for c in PACKS.split(", ")]
    bucket = ((h1[:n] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    bounds, k = np.append(first, n), len(first)
    yield pa.RecordBatch.from_arrays(
        [pa.array(bucket[first]), pa.array(np.zeros(k, bool)), pa.array(np.full(k, file, np.int64)), pa.array(np.full(k, base, np.int64)),
         _cut(h1[:n], bounds), _cut(h2[:n], bounds), _cut((row[:n] - base).astype(np.uint16), bounds), *(_cut(h, bounds) for h in _halves(at[:n]))], names=names)
    if n < len(known):  # these meet nobody: any bucket will do
        files, block, *rest = _by_block(np.full(len(known) - n, file, np.int64), row[n:], at[n:])
        number, k = block.to_numpy(), len(block)
        none = pa.array([b""] * k, pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(((number * 0x9E3779B1 ^ file) % buckets).astype(np.int32)), pa.array(np.ones(k, bool)), files, pa.array(number * BLOCK), none, none, *rest], names=names)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """PACKS rows sorted by bucket in; SIDE rows of the known hashes and of those that occur twice or more out."""
    names = [c.split()[0] for c in SIDE.split(", ")]

    def settled(h1: np.ndarray, h2: np.ndarray, file: np.ndarray, row: np.ndarray, value: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((h2, h1))
        a, b = h1[order], h2[order]
        same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        hit = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])] if len(order) else order
        if len(hit):
            yield pa.RecordBatch.from_arrays(_by_block(file[hit], row[hit], value[hit]), names=names)

    held = None  # all of the last bucket, which may go on
    for b in batches:
        told, b = b.filter(b.column(1)), b.filter(pc.invert(b.column(1)))
        if told.num_rows:
            yield pa.RecordBatch.from_arrays([told.column(2), pa.array(told.column(3).to_numpy() // BLOCK), *told.columns[6:]], names=names)
        if not b.num_rows:
            continue
        h1, n = _flat(b.column(4), np.uint64)
        bucket, file, base = (np.repeat(b.column(i).to_numpy(), n) for i in (0, 2, 3))
        row, low, high = (_flat(b.column(i), np.uint16)[0] for i in (6, 7, 8))
        cols = [bucket, h1, _flat(b.column(5), np.int32)[0], file, base + row, low | high.astype(np.int64) << 16]
        if held is not None:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
        end = int(np.searchsorted(cols[0], cols[0][-1]))
        yield from settled(*(c[:end] for c in cols[1:]))
        held = [c[end:].copy() for c in cols]
    if held is not None:
        yield from settled(*held[1:])


def repeated(packs: DataFrame) -> DataFrame:
    """SIDE rows of the hashes of PACKS rows that occur again; a few may come twice."""
    return packs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_runs, SIDE)


# --- the rounds ------------------------------------------------------------

def _whole(rows: Iterator) -> Iterator[tuple]:
    """Hash of the whole word sequence of texts that have a window."""
    out = []
    for file, row, text in rows:
        ws = words(text)
        if len(ws) >= WINDOW:
            h = xxhash.xxh3_128_intdigest(b" ".join(ws))
            out.append((h >> 64, h & (1 << 64) - 1, file, row))
    a, b, f, r = zip(*out) if out else ((), (), (), ())
    yield (np.array(a, np.uint64).view(np.int64), np.array(b, np.uint64).view(np.int64), np.array(f, np.int64), np.array(r, np.int64))


def copies(rows: DataFrame) -> tuple[DataFrame, int]:
    """(file, row, value) of the texts whose whole word sequence occurs again; value 0 for one of them, 1 for the others. Also the number of texts that have a window."""
    h = staged(rows.select("file", "row", "text").mapInArrow(_scan(_whole, ["h1", "h2", "file", "row"]), "h1 bigint, h2 bigint, file bigint, row bigint"), "substrings-whole")
    groups = staged(h.groupBy("h1", "h2").agg(F.min(F.struct("file", "row")).alias("first"), F.count("*").alias("n"))
                    .where("n > 1").select("h1", "h2", "first"), "substrings-copies")
    first = (F.col("file") == F.col("first.file")) & (F.col("row") == F.col("first.row"))
    return h.join(groups, ["h1", "h2"]).select("file", "row", F.when(first, 0).otherwise(1).alias("value")), h.count()


def _hashed(side_paths: list[str], hashes_of: Callable, buckets: int) -> Callable:
    """A mapInArrow function that packs hashes of the texts, but for all but one of whole copies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = [Side(p) for p in side_paths]
        held, n = [], 0
        for b in batches:
            for lo in range(0, b.num_rows, BATCH):
                part = b.slice(lo, BATCH)
                for file, row, text in zip(*(part.column(i).to_pylist() for i in range(3))):
                    if (sides[0].get(file, row) == 1).any():
                        continue
                    h1, h2, at = hashes_of(text, *(s.get(file, row) for s in sides[1:]))
                    if not len(at):
                        continue
                    if held and (n >= PACK or file != held[0][0] or not 0 <= row - held[0][1] < SPAN):
                        yield from packed(held, buckets)
                        held, n = [], 0
                    held.append((file, row, h1, h2, at))
                    n += len(at)
        if held:
            yield from packed(held, buckets)
    return run


def _anchors(text: bytes | None) -> tuple:
    ws = words(text)
    if len(ws) < WINDOW:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.int32), none
    h = window_hashes(word_hashes(ws), ANCHOR)
    at = cover_positions(len(h))
    return h[at], np.zeros(len(at), np.int32), at


def _windows(text: bytes | None, anchors: np.ndarray) -> tuple:
    if not len(anchors):
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64)
    w = word_hashes(words(text))
    at = candidate_windows(len(w), anchors)
    return window_hashes(w, WINDOW)[at], window_hashes(w, WINDOW, 1)[at].astype(np.uint32).view(np.int32), at


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the kept text of every row."""
    rows = located(docs)
    where = rows.select("file", "row", "text")
    found, n = copies(rows)
    copied = write_side(found, "substrings-copied")
    buckets = max(16, n // 512)  # some hundred thousand windows in one, of texts of some hundred words
    anchors = write_packed(repeated(where.mapInArrow(_hashed([copied], _anchors, buckets), PACKS)), "substrings-anchors")
    starts = write_packed(repeated(where.mapInArrow(_hashed([copied, anchors], _windows, buckets), PACKS)), "substrings-starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copy, start = Side(copied), Side(starts)
        for b in batches:
            for lo in range(0, b.num_rows, BATCH):
                part = b.slice(lo, BATCH)
                out = []
                for file, row, text in zip(*(part.column(i).to_pylist() for i in range(3))):
                    ws = words(text)
                    n = len(ws)
                    if len(copy.get(file, row)):
                        kept = []
                    elif len(s := start.get(file, row)):
                        kept = [w for w, gone in zip(ws, covered(n, s).tolist()) if not gone]
                    else:
                        kept = ws
                    kept_text = b" ".join(kept)
                    out.append((n, n - len(kept), hashlib.sha256(kept_text).hexdigest(), kept_text))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(3), *(pa.array([o[i] for o in out], t) for i, t in enumerate(kinds))],
                                                 names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    kind = dict(rows.dtypes)["doc_id"]
    done = rows.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string, kept binary")
    return done.select("doc_id", "n_words", "n_removed", "kept_sha256", F.col("kept").cast("string").alias("kept"))
