"""Operator 1: secret scan with a password guess-cost model.

Three fixed patterns find assignments, access keys and hex strings. Besides,
every value in a credential context (`password: ...`, `login = ...`) is given
the least number of guesses that an informed attacker needs: dynamic
programming over its positions picks the cheapest segmentation into common
words, dates, repeats, sequences, keyboard walks and brute-force spans. Values
that cost at least `MIN_LOG10_GUESSES` become spans of kind `guess`.

Common words are a fixed list of password words and the input's own: words of
letters, counted over all its documents outside of credential values and base
spans (a secret cannot make itself common), that occur `SEEN` times at least;
the `KEPT` most frequent ones, a bound on memory, ranked by count.

Defined results: null text counts as empty; rows depend on each other by the
common words only, repeated rows count and are scanned each; values of any
length are costed in linear time. An empty table gives no rows; extra columns
are left out.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from functools import lru_cache
from typing import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frequent, map_text, pick

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: The hex pattern with its length condition inside: a match of HEX is a whole run, so both find the same.
LONG_HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "guess")
LEAST = {"assign": 8, "access": 16, "hex": 32}

#: What makes the value behind it a credential; wider than ASSIGN.
CONTEXT = re.compile(
    r"(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|login|api[_-]?key|access[_-]?key|private[_-]?key)"
    r"""["']?[ \t]*(?:[:=]|=>|:=)[ \t]*["']?([^\s"'<>,;]+)""", re.I | re.A)
#: One scan for any of them, to skip texts without; RE2 syntax.
ANY = r"(?i:passw|pass_?phrase|passcode|pass[\"']?[ \t]*[:=]|pwd|secret|token|credential|login|api[_-]?key|access[_-]?key|private[_-]?key)|AKIA[A-Z0-9]{12}|[0-9a-f]{32}"

MIN_LOG10_GUESSES = 10.0
#: Choosing one more segment costs the attacker this factor (log10).
SEGMENT_LOG10 = 0.5

#: Frequent passwords and password words, most frequent first.
WORDS = (
    "password 123456 qwerty letmein welcome admin monkey dragon master login princess sunshine football baseball "
    "iloveyou shadow michael superman batman trustno hello freedom whatever secret pass root test guest user default "
    "changeme summer winter spring autumn love god star money cheese computer internet server access token key api "
    "company office home house dog cat horse tiger eagle flower orange apple banana cookie chocolate pepper ginger "
    "january february march april june july august september october november december monday friday sunday "
    "london paris berlin madrid america england france germany spain blue red green black white silver gold"
).split()
#: The input's own words: at most so many, each seen so often at least.
KEPT, SEEN = 1 << 16, 5
WORD = re.compile(r"\b[^\W\d_]{3,24}\b")
LEET = str.maketrans("@431!05$7", "aaeiiosst")
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")


class Common:
    """Ranks of common words: the fixed ones, and others in order of frequency, whichever is lower."""

    def __init__(self, others: list[str] = ()):
        self.rank = {w: i + 1 for i, w in enumerate(others)}
        self.rank |= {w: min(i + 1, self.rank.get(w, i + 1)) for i, w in enumerate(WORDS)}
        self.longest = max(map(len, self.rank))


FIXED = Common()


@lru_cache(maxsize=1)
def _adjacent() -> frozenset:
    """Pairs of keys that touch on a keyboard whose rows are shifted by half a key."""
    at = {c: (2 * x + y, y) for y, row in enumerate(ROWS) for x, c in enumerate(row)}
    return frozenset((a, b) for a, (xa, ya) in at.items() for b, (xb, yb) in at.items()
                     if a != b and (abs(xa - xb), abs(ya - yb)) in ((2, 0), (1, 1)))


_DATE = re.compile(r"(?:19|20)\d\d(?:([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?"
                   r"|(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d")


def _segments(v: str, common: Common = FIXED) -> list[tuple[int, int, float]]:
    """(start, end, log10 guesses) of every word, date, repeat, sequence and keyboard walk in v."""
    low, out = v.lower(), []
    plain = low.translate(LEET)
    for i in range(len(v)):
        for j in range(i + 3, min(len(v), i + common.longest) + 1):
            for form, extra in ((low, 0.0), (plain, 0.6)):
                if (rank := common.rank.get(form[i:j])) is not None:
                    upper = sum(c.isupper() for c in v[i:j])
                    case = 0.0 if not upper else 0.3 if upper in (1, j - i) else math.log10(math.comb(j - i, upper) + 1)
                    out.append((i, j, math.log10(rank + 1) + case + extra))
                    break
        if m := _DATE.match(v, i):
            out.append((i, m.end(), math.log10(120.0 * (366 if m.end() - i > 4 else 1)) + (0.6 if m.end() - i in (10,) else 0)))
    near = _adjacent()
    for kind, cost in (("repeat", 1.0), ("sequence", 1.3), ("walk", 1.7)):
        start = 0
        for i in range(1, len(v) + 1):
            if i < len(v):
                a, b = low[i - 1], low[i]
                if kind == "repeat":
                    on = a == b
                elif kind == "sequence":
                    step = ord(b) - ord(a)
                    on = abs(step) == 1 and a.isalnum() and b.isalnum() and (i - start < 2 or ord(a) - ord(low[i - 2]) == step)
                else:
                    on = (a, b) in near
                if on:
                    continue
            if i - start >= 3:
                turns = math.log10(3) * 0.5 * (i - start - 2) if kind == "walk" else 0.0
                out.append((start, i, cost + math.log10(i - start) + turns))
            start = i
    for m in re.finditer(r"(.{2,12}?)\1+", low):  # a longer unit repeated: its brute-force cost, times the count
        unit = len(m[1])
        out.append((m.start(), m.end(), unit * 1.2 + math.log10((m.end() - m.start()) // unit)))
    return out


def _char_cost(c: str) -> float:
    """log10 of the alphabet that a brute-force attack on c's kind tries."""
    return math.log10(10 if "0" <= c <= "9" else 26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 500)


def log10_guesses(value: str, common: Common = FIXED) -> float:
    """log10 of the least guesses over all segmentations of value (0 for the empty one)."""
    n = len(value)
    if not n:
        return 0.0
    ends: dict[int, list[tuple[int, float]]] = {}
    for i, j, cost in _segments(value, common):
        ends.setdefault(j, []).append((i, cost))
    best, brute = [0.0] * (n + 1), math.inf  # best cost of a prefix; of one that ends inside a brute-force span
    for j in range(1, n + 1):
        brute = min(brute, best[j - 1] + SEGMENT_LOG10) + _char_cost(value[j - 1])
        best[j] = min([brute, *(best[i] + SEGMENT_LOG10 + cost for i, cost in ends.get(j, ()))])
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, ordered by start, then kind as listed; whole matches."""
    out = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    out += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    out += [(*m.span(), "hex") for m in LONG_HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def guess_spans(text: str, least: float = MIN_LOG10_GUESSES, common: Common = FIXED) -> list[tuple[int, int, str]]:
    """Credential-context values whose guess cost reaches `least`; closing punctuation is not part of one."""
    out = []
    for m in CONTEXT.finditer(text):
        value = m[1].rstrip(".:!?)]}")
        if value and log10_guesses(value, common) >= least:
            out.append((m.start(1), m.start(1) + len(value), "guess"))
    return out


def find_secrets(text: str | None, common: Common = FIXED) -> list[tuple[int, int, str]]:
    """All spans of one text: the base ones and those that the guess-cost model adds."""
    if not text:
        return []
    return sorted(base_spans(text) + guess_spans(text, common=common), key=lambda s: (s[0], KINDS.index(s[2])))


def _may_have(texts: list) -> list[bool]:
    return pc.match_substring_regex(pa.array(texts, pa.string()), ANY).to_pylist()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, 2048):
            texts, c = b.column(0).slice(lo, 2048).to_pylist(), Counter()
            for t, may in zip(texts, _may_have(texts)):
                for pattern in (CONTEXT, ASSIGN, ACCESS, LONG_HEX) if may else ():
                    t = pattern.sub(" ", t)
                c.update(WORD.findall(t.lower()) if t else ())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["word", "n"])


def common_words(docs: DataFrame) -> Common:
    """The fixed words and the most frequent ones of docs (text); at most KEPT come to the driver."""
    counts = docs.select("text").mapInArrow(_count_words, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= SEEN)
    rows = frequent(counts, KEPT, "secrets-words").toArrow().to_pylist()
    return Common([r["word"] for r in sorted(rows, key=lambda r: (-r["n"], r["word"]))])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and the array `spans` of (start, end, kind), code points, end exclusive."""
    rows = pick(docs, "doc_id", "text")
    common = docs.sparkSession.sparkContext.broadcast(common_words(rows))

    def fn(texts: list) -> list:
        return [[[{"start": a, "end": b, "kind": k} for a, b, k in find_secrets(t, common.value)] if may else []
                 for t, may in zip(texts, _may_have(texts))]]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
    return map_text(rows, fn, [("spans", "array<struct<start:bigint,end:bigint,kind:string>>", kind)])


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs, with every span's characters in text replaced by `mark` (overlapping spans by one) and n_chars set anew."""
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = pick(docs, *cols)
    common = docs.sparkSession.sparkContext.broadcast(common_words(rows))

    def hide(text: str | None) -> str | None:
        spans = find_secrets(text, common.value)
        if not spans:
            return text
        out, done = [], 0
        for a, b, _ in spans:
            if a >= done:
                out += [text[done:a], mark]
            done = max(done, b)
        return "".join([*out, text[done:]])

    def fn(texts: list) -> list:
        return [[hide(t) if may else t for t, may in zip(texts, _may_have(texts))]]
    hidden = map_text(rows, fn, [("hidden", "string", pa.string())])
    return hidden.select("doc_id", F.col("hidden").alias("text"), "lang", "source",
                         F.when(F.col("hidden").isNull(), F.col("n_chars")).otherwise(F.length("hidden").cast("bigint")).alias("n_chars"))


def secret_digest(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, the digest of the base spans, all spans as text."""
    say = lambda arr: F.array_join(F.transform(arr, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return scan(docs).select(
        "doc_id", *(n(k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(say(base).cast("binary"), 256).alias("base_sha256"), say(F.col("spans")).alias("spans"))
