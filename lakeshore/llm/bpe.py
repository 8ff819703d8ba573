"""Operator 3: byte-level BPE encoding and decoding against a public rank file.

Texts are split by the tokenizer's pattern; every distinct piece of text (word)
is encoded by Spark's higher-order functions: a fold over the word's bytes
merges, step by step, the leftmost adjacent pair of lowest rank, looked up in a
rank map (`rank_map`: the ranks of pairs of ids in one array, found by
position, since a map's lookup is linear), which comes as a broadcast row: many
words share a row of their own, so it is copied seldom. Bytes are carried as
ISO-8859-1 characters.

The most frequent words of the input, `CACHE` at most, are folded once and
travel with the tasks (a bound on memory; it changes no result); of the others
each bundle of documents folds its distinct ones. So nothing but word counts
is shuffled; the bundles are written once, as numbers of words and ids. The fold's cost is quadratic in the word; words over `LONG` bytes
are merged by a heap in Python instead, with the same result in n log n steps.

Decoding concatenates the binary pieces of the ids.

Defined results: null text counts as empty and has no ids; rows are
independent, repeated ones are encoded each. Equal ranks cannot occur; of equal
pairs the leftmost merges first. Texts of any length are encoded whole. Special
tokens do not exist: their strings are ordinary text. An empty table gives no
rows; extra columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from functools import lru_cache
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frequent, pick, staged

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Bits of a rank and of a piece's place in its word, in the fold's state; the rank that stands for none.
RANK_BITS, PLACE_BITS = 20, 20
NO_RANK = (1 << RANK_BITS) - 1
#: Words that travel with the tasks: so many, of so many bytes at most.
CACHE, CACHE_BYTES = 1 << 19, 64
#: Bytes from which on a word is merged by a heap.
LONG = 256
#: A bundle of documents: so many rows or so many characters; split so many characters at a time.
BUNDLE_ROWS, BUNDLE_CHARS, SPLIT_CHARS = 4096, 8_000_000, 500_000
#: Documents of a bundle get their ids so many words at a time (or one document).
PIECE_WORDS = 1 << 17
#: A bundle is a large row: a row group of its own, so neither writer nor reader holds many.
ONE_A_GROUP = {"parquet.block.row.count.limit": "1"}
#: Words whose code points are compared at a time; words that are hashed at a time on the driver.
COMPARED, HASHED = 1 << 14, 1 << 15
#: Rows that the words folded beforehand are put in.
WORD_ROWS = 512


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


# --- splitting -------------------------------------------------------------

SPACE, LETTER, NUMBER, OTHER = range(4)
#: The pattern that `split` carries out: contractions, then runs of one class with one space before, then white space.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """Class of each code point as the tokenizer's library sees it.

    Unicode versions differ between libraries, so it is asked itself, by
    encoding all characters with a pattern of one class.
    """
    bytes_only = {bytes([i]): i for i in range(256)}
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        e = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=bytes_only, special_tokens={})
        for lo in [*range(0, 0xD800, 0x800), *range(0xE000, 0x110000, 0x2000)]:
            every = "".join(map(chr, range(lo, lo + (0x800 if lo < 0xD800 else 0x2000))))
            out[np.frombuffer(bytes(e.encode_ordinary(every)).decode().encode("utf-32-le"), np.uint32)] = kind
    return out


def split(cp: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Starts of the words of several texts, end to end: cp are their code points, first tells where a text begins.

    A run of letters, numbers or others is a word, with a single space before
    it if there is one. Of white space before such a run the last character
    stands apart (it is that space, or a word); at a text's end it does not.
    """
    n = len(cp)
    kind = classes[cp]
    run = first.copy()
    run[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    before = np.zeros(n, bool)  # the character before, in the same text, is a space
    before[1:] = (cp[:-1] == 32) & ~first[1:]
    start = run & (space | ~before)
    start[:-1] |= space[:-1] & ~space[1:] & ~first[1:]
    # Contractions: an apostrophe that is a word by itself, and the letters behind it.
    at = np.flatnonzero(start[:-1] & (cp[:-1] == 39) & (kind[1:] == LETTER) & ~first[1:])
    if len(at):
        nxt = cp[at + 1]
        short = np.isin(nxt, [ord(c) for c in "stmd"])
        two = np.zeros(len(at), bool)
        inside = at + 2 < n
        j = at[inside]
        pair = nxt[inside].astype(np.int64) * 65536 + np.where(first[j + 2], 0, cp[j + 2])
        two[inside] = np.isin(pair, [ord(a) * 65536 + ord(b) for a, b in ("re", "ve", "ll")])
        at, size = at[short | two], np.where(two[short | two], 3, 2)
        start[at + 1] = False
        rest = at + size
        ok = rest < n
        rest = rest[ok]
        start[rest[~first[rest] & (kind[rest] == LETTER)]] = True
    return np.flatnonzero(start)


def word_hashes(cp: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A polynomial hash modulo 2^64 of each word, by prefix sums. Words can share one (such as Thue-Morse words): where it is used, code points are compared."""
    x = (cp.astype(np.uint64) + np.uint64(1)) * _MIX
    x ^= x >> np.uint64(29)
    odd = int(_MIX) | 1
    x *= np.cumprod(np.full(len(cp), odd, np.uint64))
    sums = np.zeros(len(cp) + 1, np.uint64)
    np.cumsum(x, out=sums[1:])
    h = (sums[stops] - sums[starts]) * np.cumprod(np.full(len(cp) + 1, pow(odd, -1, 1 << 64), np.uint64))[starts]
    return h ^ (h >> np.uint64(32)) ^ (stops - starts).astype(np.uint64) * _MIX


def same_words(cp: np.ndarray, starts: np.ndarray, sizes: np.ndarray, others: np.ndarray, other_starts: np.ndarray) -> np.ndarray:
    """Whether the code points cp[starts:starts + sizes] of each word equal those of another one of that size."""
    out = np.ones(len(sizes), bool)
    for lo in range(0, len(sizes), COMPARED):
        size = sizes[lo:lo + COMPARED].astype(np.int64)
        ends = np.cumsum(size)
        place = np.arange(int(ends[-1])) - np.repeat(ends - size, size)
        unlike = cp[np.repeat(starts[lo:lo + COMPARED], size) + place] != others[np.repeat(other_starts[lo:lo + COMPARED], size) + place]
        count = np.concatenate([[0], np.cumsum(unlike)])
        out[lo:lo + COMPARED] = count[ends] == count[ends - size]
    return out


class Words:
    """The distinct words of several texts, each text's number of words, and each word's number among the distinct ones."""

    def __init__(self, texts: list[str | None], classes: np.ndarray):
        self.whole = "".join(t for t in texts if t)
        cp = np.frombuffer(self.whole.encode("utf-32-le", "replace"), np.uint32)
        lengths = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts))
        ends = np.cumsum(lengths)
        first = np.zeros(len(cp), bool)
        first[(ends - lengths)[lengths > 0]] = True
        starts = split(cp, first, classes)
        self.sizes = np.diff(np.searchsorted(starts, np.concatenate([[0], ends])))
        stops = np.concatenate([starts[1:], [len(cp)]]) if len(starts) else starts
        sizes = stops - starts
        h = word_hashes(cp, starts, stops)
        _, at, self.number, self.counts = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        twin = at[self.number]  # the first word with that hash
        if len(starts) and ((sizes[twin] != sizes).any() or not same_words(cp, starts, sizes, cp, starts[twin]).all()):
            known: dict[str, int] = {}  # different words share a hash: number them by themselves
            first_at: list[int] = []
            self.number = np.zeros(len(starts), np.int64)
            for i, (a, b) in enumerate(zip(starts.tolist(), stops.tolist())):
                self.number[i] = k = known.setdefault(self.whole[a:b], len(known))
                if k == len(first_at):
                    first_at.append(i)
            at, self.counts = np.array(first_at), np.bincount(self.number)
        self.cp, self.h, self.starts, self.stops = cp, h[at], starts[at], stops[at]

    def word(self, i: int) -> str:
        return self.whole[self.starts[i]:self.stops[i]]

    def utf8(self) -> pa.Array:
        """The distinct words in UTF-8, cut out of the texts' bytes all at once."""
        size = np.ones(len(self.cp), np.int8)
        for least in (0x80, 0x800, 0x10000):
            size += self.cp >= least
        at = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=at[1:])
        begin, length = at[self.starts], at[self.stops] - at[self.starts]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        out = np.frombuffer(self.whole.encode("utf-8", "replace"), np.uint8)[np.repeat(begin - (ends - length), length) + np.arange(total)]
        return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(out)])


# --- encoding words --------------------------------------------------------

def pair_ranks(table: dict[bytes, int]) -> dict[int, dict[int, int]]:
    """Ids of two tokens, left then right, to the id (its rank too) of the token that they make side by side."""
    pairs: dict[int, dict[int, int]] = {}
    for token, rank in table.items():
        for i in range(1, len(token)):
            if (a := table.get(token[:i])) is not None and (b := table.get(token[i:])) is not None:
                pairs.setdefault(a, {})[b] = rank
    return pairs


def merge(ids: list[int], pairs: dict[int, dict[int, int]]) -> list[int]:
    """The merges of a few ids, step by step."""
    while True:
        found = [(r, i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if a in pairs and (r := pairs[a].get(b)) is not None]
        if not found:
            return ids
        rank, at = min(found)
        ids = [*ids[:at], rank, *ids[at + 2:]]


def displaced(rows: dict[int, dict[int, int]]) -> tuple[list[int], list[int]]:
    """Rows of a sparse matrix, laid over each other without a clash.

    Row a's value at b is in slots[base[a] + b], below the row's number; another row's number there means no value.
    """
    width = 1 + max((b for row in rows.values() for b in row), default=0)
    places = 1 + 3 * sum(map(len, rows.values()))
    base, slots, taken = [0] * (1 + max(rows, default=0)), [NO_RANK << RANK_BITS] * (places + width), bytearray(places + width)
    at = 0
    for a, row in sorted(rows.items(), key=lambda r: -len(r[1])):
        for _ in range(places):
            if not any(taken[at + b] for b in row):
                break
            at = (at + 1) % places
        else:
            raise ValueError("no place for a row of the rank table")
        base[a] = at
        for b, value in row.items():
            taken[at + b], slots[at + b] = 1, a << RANK_BITS | value
        at = (at + 7919) % places
    return base, slots


RANK_MAP = "single array<bigint>, base array<bigint>, slots array<bigint>, whole map<string,int>"


def _rank_text(table: dict[bytes, int]) -> str:
    """What the fold looks up, as JSON: the bytes' ids, the ranks of pairs of ids (`displaced`), tokens that their bytes' merges do not give."""
    if max(table.values()) >= NO_RANK:
        raise ValueError(f"ranks of {NO_RANK} and more do not fit the fold's state")
    single, pairs = [table[bytes([i])] for i in range(256)], pair_ranks(table)
    base, slots = displaced(pairs)
    whole = {t.decode("latin-1"): r for t, r in table.items() if merge([single[x] for x in t], pairs) != [r]}
    return json.dumps({"single": single, "base": base, "slots": slots, "whole": whole})


def rank_map(table: dict[bytes, int]) -> Column:
    """What the fold looks up, as one literal."""
    return F.from_json(F.lit(_rank_text(table)), RANK_MAP)  # constant: folded into one literal when planned


def with_rank_map(rows: DataFrame, maps: DataFrame) -> DataFrame:
    """rows with `maps`, what the fold looks up, beside each: it is copied for each row."""
    return rows.crossJoin(F.broadcast(maps))


def rank_row(spark: SparkSession, table: dict[bytes, int]) -> DataFrame:
    """`rank_map` as a table of one row. As a literal it stands, 5 MB long, in each text of a plan, of which the driver holds many."""
    return spark.createDataFrame([(_rank_text(table),)], "maps string").select(F.from_json("maps", RANK_MAP).alias("maps"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once (a one-element transform names it)."""
    return F.get(F.transform(F.array(value), body), 0)


def fold_word(word: Column, maps: Column) -> Column:
    """Ids of a word (bytes as ISO-8859-1 characters): the lowest-ranked, leftmost pair merges first.

    The rank map stands in the plan once, by a name that all look-ups use.
    """
    def fold(named: Column) -> Column:
        merged = _let(named["slots"], lambda slots: _let(named["base"], lambda base: _fold(word, named["single"], base, slots)))
        return _let(F.try_element_at(named["whole"], word), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(merged))

    return _let(maps, fold)


def _fold(word: Column, single: Column, base: Column, slots: Column) -> Column:
    """The state: a number for each piece (from the high bits on the rank of the pair that it begins, its place in the
    word, its id), a bit for each place where a piece begins, the least number, and its position.

    The least number is the pair to merge. A merge removes the number of the pair's right piece and writes two anew,
    those of the merged piece and of the one before.
    """
    above = PLACE_BITS + RANK_BITS

    def ranked(left: Column, right: Column) -> Column:
        """The rank of a pair, NO_RANK without one, in a number's high bits; no id on the right has none."""
        slot = F.get(slots, F.get(base, left) + right)
        return F.shiftleft(F.least(slot.bitwiseXOR(F.shiftleft(left, RANK_BITS)), F.lit(NO_RANK).cast("bigint")), above)

    def piece(number: Column) -> Column:
        return number.bitwiseAND(NO_RANK)

    def bit(number: Column) -> Column:
        """The bit of a number's place."""
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(number, RANK_BITS).bitwiseAND((1 << PLACE_BITS) - 1).cast("int"))

    def state(numbers: Column, begun: Column) -> Column:
        """The position counts from 0, by the pieces that begin before (array_position, which is slow, where a word has more places than bits)."""
        def position(least: Column, s: Column) -> Column:
            return F.when(F.length(word) < 64, F.bit_count(s["begun"].bitwiseAND(bit(least) - 1))).otherwise(F.array_position(s["numbers"], least).cast("int") - 1)

        return _let(F.struct(numbers.alias("numbers"), begun.alias("begun")), lambda s: F.struct(
            s["numbers"].alias("numbers"), s["begun"].alias("begun"), _let(F.array_min(s["numbers"]), lambda least: F.struct(
                least.alias("number"), position(least, s).alias("at"))).alias("least")))

    def merged(s: Column) -> Column:
        numbers, least, at = s["numbers"], s["least"]["number"], s["least"]["at"]
        rank, right = F.shiftright(least, above), F.get(numbers, at + 1)
        token = ranked(rank, piece(F.get(numbers, at + 2))).bitwiseOR(least.bitwiseAND(((1 << PLACE_BITS) - 1) << RANK_BITS)).bitwiseOR(rank)
        return state(F.transform(F.array_remove(numbers, right), lambda x, i: F.when(i == at, token).when(
            i == at - 1, ranked(piece(x), rank).bitwiseOR(x.bitwiseAND((1 << above) - 1))).otherwise(x)), s["begun"].bitwiseXOR(bit(right)))

    first = _let(F.transform(F.split(word, ""), lambda c: F.get(single, F.ascii(c))), lambda p: F.transform(p, lambda a, i: ranked(a, F.get(p, i + 1)).bitwiseOR(
        F.shiftleft(i.cast("bigint"), RANK_BITS)).bitwiseOR(a)))
    done = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(word) - 1, F.lit(1))), state(first, F.lit(-1).cast("bigint")),
                       lambda s, _: F.when(s["least"]["number"] < NO_RANK << above, merged(s)).otherwise(s))
    return F.transform(done["numbers"], lambda x: piece(x).cast("int"))


def merge_long(word: bytes, table: dict[bytes, int]) -> list[int]:
    """The same merges for a long word: a heap of pair ranks over a linked list of pieces."""
    if (whole := table.get(word)) is not None:
        return [whole]
    n = len(word)
    end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := table.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i] if end[i] else n
        if not end[i] or j >= n or end[j] != stop:  # one of the two has merged meanwhile
            continue
        end[i], after[i], end[j] = stop, after[j], 0
        if after[i] < n:
            before[after[i]] = i
            k = after[i]
            if (r := table.get(word[i:end[k]])) is not None:
                heapq.heappush(heap, (r, i, end[k]))
        if (k := before[i]) >= 0 and (r := table.get(word[k:stop])) is not None:
            heapq.heappush(heap, (r, k, stop))
    out, i = [], 0
    while i < n:
        out.append(table[word[i:end[i]]])
        i = after[i]
    return out


# --- encoding documents ----------------------------------------------------

def _groups(lengths: list[int], rows: int, most: int) -> Iterator[tuple[int, int]]:
    """(from, to) of consecutive texts of these lengths, up to so many rows or just over so many characters."""
    lo, chars = 0, 0
    for i, n in enumerate(lengths):
        chars += n
        if i + 1 - lo >= rows or chars >= most:
            yield lo, i + 1
            lo, chars = i + 1, 0
    if lo < len(lengths):
        yield lo, len(lengths)


def _parts(b: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of bounded text, so that few texts are held as strings at a time."""
    lengths = pc.fill_null(pc.utf8_length(b.column(0)), 0).to_pylist()
    for lo, hi in _groups(lengths, BUNDLE_ROWS, most):
        yield b.slice(lo, hi - lo)


def _count_words(classes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _parts(b, 2 * SPLIT_CHARS):
                w = Words(part.column(0).to_pylist(), classes.value)
                yield pa.RecordBatch.from_arrays([w.utf8(), pa.array(w.counts.astype(np.int64))], names=["word", "n"])
    return run


class Known:
    """Words in order of their hashes, for look-ups. Hashed group by group: it takes some 8-byte numbers for each character."""

    def __init__(self, words: pa.StringArray):
        length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(length)
        h, points = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint16)]
        for lo in range(0, len(words), HASHED):
            cp = np.frombuffer("".join(words.slice(lo, HASHED).to_pylist()).encode("utf-32-le"), np.uint32)
            stops = np.cumsum(length[lo:lo + HASHED])
            h.append(word_hashes(cp, stops - length[lo:lo + HASHED], stops))
            points.append(cp.astype(np.uint16) if not len(cp) or cp.max() < 1 << 16 else cp)
        h, self.cp = np.concatenate(h), np.concatenate(points)
        self.order = np.argsort(h, kind="stable")
        self.h, self.length, self.at = h[self.order], length[self.order].astype(np.uint16), (ends - length)[self.order].astype(np.int32)

    def find(self, w: Words) -> np.ndarray:
        """Number of each distinct word, -1 if it is not there: of words that share a hash only one is found."""
        out = np.full(len(w.h), -1)
        if len(self.h):
            at = np.minimum(np.searchsorted(self.h, w.h), len(self.h) - 1)
            hit = np.flatnonzero((self.h[at] == w.h) & (self.length[at] == w.stops - w.starts))
            same = same_words(w.cp, w.starts[hit], self.length[at[hit]], self.cp, self.at[at[hit]])
            out[hit[same]] = at[hit[same]]
        return out


class Ids:
    """Ids of the known words, in the same order: word i has values[starts[i]:starts[i] + sizes[i]]."""

    def __init__(self, ids: pa.ListArray, order: np.ndarray):
        sizes = np.diff(ids.offsets.to_numpy()).astype(np.int64)
        self.values = ragged(ids.values.to_numpy(zero_copy_only=False)[ids.offsets[0].as_py():], sizes, order).astype(np.int32)
        self.sizes = sizes[order].astype(np.int32)


def ragged(values: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """values, cut into parts of `sizes`: the parts numbered `at`, end to end."""
    starts, size = np.cumsum(sizes) - sizes, sizes[at]
    ends = np.cumsum(size)
    return values[np.repeat(starts[at] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]


def _bundles(classes, cache, keep: list[str]):
    """Rows of documents in, bundles out: word numbers of all documents, and the distinct words that the cache lacks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cached = cache.value
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        for b in batches:
            for part in _parts(b, BUNDLE_CHARS):
                rare: dict[str, int] = {}
                sizes, codes = [], []
                for some in _parts(part, SPLIT_CHARS):
                    w = Words(some.column(0).to_pylist(), classes.value)
                    code = cached.find(w)
                    for i in np.flatnonzero(code < 0).tolist():
                        code[i] = len(cached.h) + rare.setdefault(w.word(i), len(rare))
                    sizes.append(w.sizes.astype(np.int32))
                    codes.append(code[w.number].astype(np.int32))
                kept = pa.StructArray.from_arrays([part.column(i) for i in range(1, part.num_columns)], names=keep)
                yield pa.RecordBatch.from_arrays(
                    [one(kept), one(pa.array(np.concatenate(sizes))), one(pa.array(np.concatenate(codes))),
                     one(pa.array([x.encode("utf-8", "replace").decode("latin-1") for x in rare], pa.string()))],
                    names=["kept", "sizes", "codes", "rare"])
    return run


def _unbundle(cache, path: str, kinds: pa.Schema, finish: Callable):
    """Bundles with the ids of their rare words and the long ones among these in, what `finish` makes of each document's ids out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks(path)
        made = finish(path)
        cached = cache.value
        for b in batches:
            for i in range(b.num_rows):
                kept, sizes, codes, words, ids = (b.column(c)[i].values for c in range(5))
                lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                codes, sizes = codes.to_numpy(zero_copy_only=False), sizes.to_numpy(zero_copy_only=False)
                more = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
                all_values, all_sizes = [cached.values, more], [cached.sizes, lengths]
                if ids.null_count:  # long words: numbered after all others
                    long = np.flatnonzero(ids.is_null().to_numpy(zero_copy_only=False))
                    merged = [np.array(merge_long(x.encode("latin-1"), table), np.int32) for x in words.to_pylist()]
                    all_values += merged
                    all_sizes.append(np.array([len(x) for x in merged]))
                    number = np.arange(len(cached.sizes) + len(lengths))
                    number[len(cached.sizes) + long] = len(number) + np.arange(len(long))
                    codes = number[codes]
                all_values, all_sizes = np.concatenate(all_values), np.concatenate(all_sizes)
                ends = np.cumsum(sizes)
                for lo, hi in _groups(sizes.tolist(), BUNDLE_ROWS, PIECE_WORDS):
                    some = codes[ends[lo] - sizes[lo]:ends[hi - 1]]
                    n = np.zeros(len(some) + 1, np.int64)
                    np.cumsum(all_sizes[some], out=n[1:])
                    cuts = n[np.concatenate([[0], np.cumsum(sizes[lo:hi])])]
                    columns = made(ragged(all_values, all_sizes, some), cuts)
                    yield pa.RecordBatch.from_arrays([c.slice(lo, hi - lo).cast(t) for c, t in zip(kept.flatten(), kinds.types)] + list(columns.values()),
                                                     names=[*kinds.names, *columns])
    return run


def _folded(top: DataFrame, maps: DataFrame) -> DataFrame:
    """The words of top (word) and their ids, in `WORD_ROWS` rows: words, ids."""
    row, parts = F.pmod(F.xxhash64("word"), F.lit(WORD_ROWS)), int(top.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = top.select("word", row.alias("row")).repartition(parts, "row").groupBy("row").agg(F.collect_list("word").alias("words"))
    return with_rank_map(rows.select("words"), maps).select("words", F.transform(
        "words", lambda w: fold_word(F.decode(w, "ISO-8859-1"), F.col("maps"))).alias("ids"))


def _encoded(docs: DataFrame, keep: list[str], path: str, finish: Callable, schema: str) -> DataFrame:
    """The kept columns and what finish(path)(values, cuts) gives: row i's ids are values[cuts[i]:cuts[i + 1]]."""
    if public_tokenizers.PATTERN != SPLIT_PATTERN:
        raise ValueError("the tokenizer's pattern is not the one that split() carries out")
    rows = pick(docs, "text", *keep)
    spark = docs.sparkSession
    classes, maps = spark.sparkContext.broadcast(character_classes()), rank_row(spark, ranks(path))
    counts = rows.select("text").mapInArrow(_count_words(classes), "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    top = frequent(counts.where(F.length("word") <= CACHE_BYTES), CACHE, "bpe-words")
    # At most CACHE words and their ids come back to the driver.
    folded = _folded(top, maps).toArrow()
    words = Known(folded["words"].combine_chunks().flatten().cast(pa.string()))
    known_ids = spark.sparkContext.broadcast(Ids(folded["ids"].combine_chunks().flatten(), words.order))
    del folded, words.order
    known = spark.sparkContext.broadcast(words)  # each side of the fold has only what it needs
    del words
    types = dict(rows.dtypes)
    kinds = ", ".join(f"{c}:{types[c]}" for c in keep)
    bundles = rows.mapInArrow(_bundles(classes, known, keep), f"kept array<struct<{kinds}>>, sizes array<int>, codes array<int>, rare array<string>")
    # Written between the two Python steps: a task then has one worker at a time. Of the words only the long ones go on.
    done = staged(with_rank_map(bundles, maps).select("kept", "sizes", "codes", F.filter("rare", lambda w: F.length(w) > LONG).alias("long"), F.transform(
        "rare", lambda w: F.when(F.length(w) <= LONG, fold_word(w, F.col("maps")))).alias("ids")), "bpe-bundles", **ONE_A_GROUP)
    for used in (classes, known):  # only the bundles, which are written now, needed them
        used.destroy()
    arrow = spark.createDataFrame([], rows.select(*keep).schema).toArrow().schema
    return done.mapInArrow(_unbundle(known_ids, path, arrow, finish), ", ".join(f"{c} {types[c]}" for c in keep) + ", " + schema)


def _as_list(path: str) -> Callable:
    return lambda values, cuts: {"ids": pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values, pa.int32()))}


def encode(docs: DataFrame, *keep: str, path: str | None = None) -> DataFrame:
    """The kept columns (doc_id if none is named) and `ids`, the token ids of text, for every row of docs."""
    return _encoded(docs, list(keep) or ["doc_id"], path or public_tokenizers.path(VOCABULARY), _as_list, "ids array<int>")


# --- decoding --------------------------------------------------------------

class Decoder:
    """Concatenates the bytes of ids."""

    def __init__(self, path: str):
        table = ranks(path)
        pieces = [b""] * (max(table.values()) + 1)
        for token, i in table.items():
            pieces[i] = token
        self.sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)

    def __call__(self, ids: np.ndarray) -> bytes:
        return ragged(self.bytes, self.sizes, ids).tobytes()

    def parts(self, ids: np.ndarray, cuts: np.ndarray) -> Iterator[memoryview]:
        """The bytes of ids[a:b] for neighbouring cuts a and b, so many bytes at a time (or one text)."""
        at = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.sizes[ids], out=at[1:])
        ends = at[cuts]
        for lo, hi in _groups(np.diff(ends).tolist(), BUNDLE_ROWS, SPLIT_CHARS):
            some, own = memoryview(self(ids[cuts[lo]:cuts[hi]])), (ends[lo:hi + 1] - ends[lo]).tolist()
            yield from (some[x:y] for x, y in zip(own, own[1:]))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """encoded with `decoded` (binary) beside its column `ids`; null for null ids."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(path)
        for b in batches:
            ids = b.column(b.schema.names.index("ids"))
            out = [decoder(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else None for x in ids]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=[*b.schema.names, "decoded"])

    types = ", ".join(f"{c} {t}" for c, t in encoded.dtypes)
    return encoded.mapInArrow(run, f"{types}, decoded binary")


def _as_list_and_bytes(path: str) -> Callable:
    """The ids, and the bytes that they decode to, in the task that has them."""
    decoder, ids = Decoder(path), _as_list(path)
    return lambda values, cuts: ids(values, cuts) | {"decoded": pa.array([bytes(x) for x in decoder.parts(values, cuts)], pa.binary())}


def encode_and_decode(docs: DataFrame, *keep: str, path: str | None = None) -> DataFrame:
    """`encode`, with `decoded` (binary) beside `ids`: what decoding the ids gives."""
    return _encoded(docs, list(keep) or ["doc_id"], path or public_tokenizers.path(VOCABULARY), _as_list_and_bytes, "ids array<int>, decoded binary")


def _as_digest(path: str) -> Callable:
    """Number and digest of the ids, and digest of what they decode to, in the task that has them."""
    decoder = Decoder(path)

    def digest(values: np.ndarray, cuts: np.ndarray) -> dict[str, pa.Array]:
        parts = [values[a:b] for a, b in zip(cuts, cuts[1:])]
        return {"n_tokens": pa.array(np.diff(cuts)),
                "ids_sha256": pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in parts], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in decoder.parts(values, cuts)], pa.string())}
    return digest


def token_digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (little-endian unsigned 32-bit) and decoded_sha256."""
    return _encoded(docs, ["doc_id"], path or public_tokenizers.path(VOCABULARY), _as_digest,
                    "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
