"""Operator 9: benchmark decontamination by pigeonhole edit matching.

A benchmark item may occur in a document with up to k edits, k being
`ERROR_RATE` of its length. Cut into k + 1 pieces, at least one piece of such
an occurrence is intact: an Aho-Corasick automaton finds the exact piece hits,
and Myers' bit-parallel algorithm gives the least edit distance within the
window that the hit implies. Both sides are lower-cased and white space runs
become one space.

The items are the query set. They are written as a table in blocks of bounded
size below the shared folder and read from there by the tasks, one automaton
after another; none of them comes to the driver. Documents are scanned and
normalised once. Defined results: null or empty documents and
items (also those of white space only) match nothing; repeated rows give
repeated results; a document and an item give one row, with the least distance
and the leftmost end that has it. An empty table, of documents or items, gives no
matches; extra columns are left out. Very long texts are searched whole.
"""

from __future__ import annotations

from typing import Iterator

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, stage_dir, staged

ERROR_RATE = 0.05
#: Characters of benchmark text in an automaton, about.
BLOCK_CHARS = 4_000_000
#: Characters of documents that a task normalises and then takes through all automata (or one document, if longer).
GROUP_CHARS = 16_000_000
BATCH = 512


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def budget(m: int, rate: float = ERROR_RATE) -> int:
    """Edits that an item of m characters may have."""
    return int(m * rate)


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """item cut into k + 1 pieces of nearly equal length, with their offsets."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance of pattern to any part of text, and the leftmost end of a part that has it."""
    m, peq = len(pattern), {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv) & full, pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full  # the text may start anywhere: row 0 stays 0
        mh = mh << 1 & full
        pv, mv = mh | ~(xv | ph) & full, ph & xv
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """Finds a block of items in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = [(i, t, budget(len(t), rate)) for i, t in items]
        self.find = ahocorasick.Automaton()
        where: dict[str, list[tuple[int, int]]] = {}
        for n, (_, t, k) in enumerate(self.items):
            for at, piece in pieces(t, k):
                where.setdefault(piece, []).append((n, at))
        for piece, uses in where.items():
            self.find.add_word(piece, (len(piece), uses))
        if where:
            self.find.make_automaton()
        self.empty = not where

    def match(self, text: str) -> list[tuple[int, int, int]]:
        """(item_id, distance, end in the normalised text) for each item within its budget."""
        if self.empty or not text:
            return []
        hits: dict[int, list[int]] = {}
        for end, (size, uses) in self.find.iter(text):
            for n, at in uses:
                hits.setdefault(n, []).append(end + 1 - size - at)
        out = []
        for n, starts in hits.items():
            item_id, item, k = self.items[n]
            best = (k + 1, 0)
            lo, hi = None, None
            for s in sorted(set(starts)):  # windows that overlap are verified together
                if hi is not None and s - k <= hi:
                    hi = s + len(item) + k
                    continue
                if hi is not None:
                    best = min(best, self._verify(item, text, lo, hi))
                lo, hi = max(0, s - k), s + len(item) + k
            best = min(best, self._verify(item, text, lo, hi))
            if best[0] <= k:
                out.append((item_id, *best))
        return out

    @staticmethod
    def _verify(item: str, text: str, lo: int, hi: int) -> tuple[int, int]:
        d, end = myers(item, text[lo:hi])
        return d, lo + end


# --- the items as a table, read by the tasks ---------------------------------

def stage_items(benchmark: DataFrame) -> tuple[str, int]:
    """The normalised items that can occur, written in blocks of about BLOCK_CHARS: (folder, number of blocks)."""
    kind = dict(benchmark.dtypes)["item_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.array([normal(t) for t in b.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), texts], names=["item_id", "text"]).filter(pc.greater(pc.utf8_length(texts), 0))

    items = staged(pick(benchmark, "item_id", "text").mapInArrow(run, f"item_id {kind}, text string").select(
        "*", F.monotonically_increasing_id().alias("row")), "decontam-items")  # numbered, so that repeated rows are dealt evenly too
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS)
    path = f"{stage_dir(benchmark.sparkSession, 'decontam-blocks')}/blocks"
    if blocks:
        (items.select("item_id", "text", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"))
         .repartition("block").write.partitionBy("block").parquet(path))
    return path, blocks


def read_block(path: str, block: int) -> list[tuple[int, str]]:
    fs, root = pyarrow.fs.FileSystem.from_uri(path)
    folder = pyarrow.fs.FileSelector(f"{root}/block={block}", allow_not_found=True)
    files = sorted(i.path for i in fs.get_file_info(folder) if i.path.endswith(".parquet"))
    return [(r["item_id"], r["text"]) for f in files for r in pq.read_table(fs.open_input_file(f), columns=["item_id", "text"]).to_pylist()]


_MATCHER: list = [None, None]


def _matcher(path: str, block: int, rate: float) -> Matcher:
    """The block's automaton; a worker holds one at a time."""
    key = (path, block, rate)
    if _MATCHER[0] != key:
        _MATCHER[:] = [None, None]
        _MATCHER[:] = [key, Matcher(read_block(path, block), rate)]
    return _MATCHER[1]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], list[str]]]:
    """Batches of documents, with their normalised texts, until they hold GROUP_CHARS."""
    held, texts, chars = [], [], 0
    for b in batches:
        for at in range(0, b.num_rows, BATCH):
            part = b.slice(at, BATCH)
            held.append(part)
            texts += [normal(t) for t in part.column(1).to_pylist()]
            chars += sum(map(len, texts[len(texts) - part.num_rows:]))
            if chars >= GROUP_CHARS:
                yield held, texts
                held, texts, chars = [], [], 0
    if held:
        yield held, texts


def _order(blocks: int) -> list[int]:
    """Blocks in the order to visit them: the one whose automaton the worker holds comes first."""
    held = _MATCHER[0][1] if _MATCHER[0] else 0
    return sorted(range(blocks), key=lambda i: (i != held, i))


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """doc_id, item_id, distance and end_at (in the normalised text) of every item that a document holds."""
    path, blocks = stage_items(benchmark)
    docs = pick(docs, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, texts in _groups(batches):
            ids = pa.concat_arrays([b.column(0) for b in held])
            for block in _order(blocks):
                matcher, at, rows = _matcher(path, block, rate), [], []
                for i, t in enumerate(texts):
                    for r in matcher.match(t):
                        at.append(i)
                        rows.append(r)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at, pa.int64())), *(pa.array([r[c] for r in rows], pa.int64()) for c in range(3))],
                    names=["doc_id", "item_id", "distance", "end_at"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id bigint, distance bigint, end_at bigint")


def keep_clean(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """docs (the columns of documents) without those that hold a benchmark item.

    Decided row by row while the texts are scanned, once, so no join and no
    shuffle follows; a document that one block of items rejects meets no other.
    """
    path, blocks = stage_items(benchmark)
    docs = pick(docs, "doc_id", "text", "lang", "source", "n_chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, texts in _groups(batches):
            clean = [True] * len(texts)
            for block in _order(blocks):
                matcher = _matcher(path, block, rate)
                for i, t in enumerate(texts):
                    clean[i] = clean[i] and not matcher.match(t)
            at = 0
            for b in held:
                yield b.filter(pa.array(clean[at:at + b.num_rows], pa.bool_()))
                at += b.num_rows

    return docs.mapInArrow(run, docs.schema)
