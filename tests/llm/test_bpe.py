import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import tiktoken

from lakeshore.llm import bpe, common

from .helpers import by_id, documents

RANKS = bpe.ranks(public_tokenizers.path(bpe.VOCABULARY))
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def texts():
    rng = random.Random(3)
    out = [None, "", "a", " \n\n  x", "it's we'll 12,000 ﬁ", "ab" * 1500, " " * 700, "<|endoftext|>", "日本語テキスト🎉 é",
           "x" + chr(0x558) * 5 + " " + chr(0x10D40) * 3, "".join(rng.choice("abcdefgh") for _ in range(2000)), "same", "same", "don't I'll we're you've I'm he'd it's 'llama 's's ''s --'s 'S can'' '", "'", "'r", "x've", " 's", "a  b\n\n c\u3000d\t\u00a0e  ", " ", "  "]
    for _ in range(25):
        out.append("".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x3000), rng.randrange(0xE000, 0x20000)]))
                           if rng.random() < .6 else rng.choice(" \n\t'asd1") for _ in range(200)))
    return out


def test_ids_and_decoding_match_the_library(spark):
    rows = texts()
    got = by_id(bpe.token_digest(documents(spark, rows, extra=True).repartition(3)))
    for i, t in enumerate(rows):
        ids = REFERENCE.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_a_bundle_of_many_words_and_long_ones(spark):
    rows = ["first", "a bc " * 70_000, None, "x" * 700 + "7" * 300, "", "zz yy " * 40_000 + "q" * 301, "last one"]
    got = {r.doc_id: r for r in bpe.encode_and_decode(documents(spark, rows).coalesce(1), "doc_id").collect()}
    assert len(got) == len(rows)
    for i, t in enumerate(rows):
        assert list(got[i].ids) == REFERENCE.encode_ordinary(t or "") and bytes(got[i].decoded) == (t or "").encode()


def thue_morse(n, a, b):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def test_words_that_share_a_hash(spark, monkeypatch):
    pair = [thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")]
    cp = np.frombuffer("".join(pair).encode("utf-32-le"), np.uint32)
    a, b = bpe.word_hashes(cp, np.array([0, 1024]), np.array([1024, 2048]))
    assert a == b  # else this test needs another pair
    rows = [*pair, " ".join(pair), pair[1] + " and " + pair[0], "plain words"]

    def right():
        got = by_id(bpe.token_digest(documents(spark, rows).repartition(2)))
        for i, t in enumerate(rows):
            assert got[i].ids_sha256 == hashlib.sha256(np.array(REFERENCE.encode_ordinary(t), "<u4").tobytes()).hexdigest()
            assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    right()
    monkeypatch.setattr(bpe, "CACHE_BYTES", 4096)  # the pair among the words known beforehand
    monkeypatch.setattr(bpe, "LONG", 64)
    right()


def test_the_rank_map_stands_in_a_plan_once(spark):
    folded = spark.range(1).select(bpe.fold_word(bpe.F.lit("word"), bpe.rank_map(RANKS)).alias("ids"))
    assert folded._jdf.queryExecution().analyzed().toString().count("from_json") == 1


def test_heap_merges_like_the_fold():
    rng = random.Random(5)
    for n in (1, 2, 3, 50, 400):
        word = bytes(rng.choice(b"abcdeinst ") for _ in range(n))
        assert bpe.merge_long(word, RANKS) == [t for t in tiktoken.Encoding("one", pat_str=r"(?s).+", mergeable_ranks=RANKS, special_tokens={}).encode_ordinary(word.decode())]


def test_empty_table_and_kept_columns(spark):
    assert bpe.token_digest(documents(spark, ["x"]).limit(0)).count() == 0
    r = bpe.encode(documents(spark, ["hello world"]), "doc_id", "lang").collect()
    assert r[0].lang == "en" and list(r[0].ids) == REFERENCE.encode_ordinary("hello world")


def test_the_fold_merges_like_the_library(spark):
    """By positions of pieces up to 63 bytes, and beyond; and tokens that their bytes' merges do not give."""
    rng = random.Random(8)
    words = [" " * n for n in (1, 2, 63, 64, 65, 200)] + ["aaaa" * 20, "ab" * 31 + "c", "é" * 31 + "a", "é" * 32, "The"]
    words += ["".join(rng.choice("abcdeinst") for _ in range(n)) for n in (1, 2, 3, 9, 62, 63, 64, 65, 120, 256)]
    maps = bpe.rank_map(RANKS)
    folded = spark.createDataFrame([(w, w.encode().decode("latin-1")) for w in words], "word string, bytes string").select("word", bpe.fold_word(bpe.F.col("bytes"), maps).alias("ids"))
    whole = tiktoken.Encoding("one", pat_str=r"(?s).+", mergeable_ranks=RANKS, special_tokens={})
    assert {r.word: list(r.ids) for r in folded.collect()} == {w: whole.encode_ordinary(w) for w in words}
    table = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"bc": 257, b"abcd": 300}
    few = spark.createDataFrame([("abcd",), ("abc",), ("xabcd",)], "word string").select("word", bpe.fold_word(bpe.F.col("word"), bpe.rank_map(table)).alias("ids"))
    assert {r.word: list(r.ids) for r in few.collect()} == {"abcd": [300], "abc": [256, 99], "xabcd": [120, 256, 99, 100]}


def test_the_rank_map_is_small_arrays(spark):
    """Look-ups go by position: a map's is linear, and a merge that makes texts is slow."""
    plan = spark.range(1).select(bpe.fold_word(bpe.F.lit("word"), bpe.rank_map(RANKS)).alias("ids"))._jdf.queryExecution().analyzed().toString()
    assert "crc32" not in plan and "array<map<" not in plan


def test_a_task_has_one_python_step_at_a_time(spark):
    """Two Python steps in one stage would have two workers for each task."""
    plan = bpe.encode_and_decode(documents(spark, ["some words", None]), "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_a_bundle_is_a_row_group(spark, monkeypatch):
    written = []
    monkeypatch.setattr(bpe, "staged", lambda *a, **b: written.append(common.staged(*a, **b)) or written[-1])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")  # a bundle is of one Arrow batch
    try:
        assert bpe.token_digest(documents(spark, ["a text"] * 6).coalesce(1)).count() == 6
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    files = [pq.ParquetFile(f.removeprefix("file:")) for f in written[-1].inputFiles()]
    assert sum(f.num_row_groups for f in files) == sum(f.metadata.num_rows for f in files) == 3


def test_no_plan_spells_out_the_rank_map(spark, monkeypatch):
    """The driver keeps plans as texts, several for each run."""
    seen = []
    plan = lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or df
    monkeypatch.setattr(bpe, "staged", lambda df, *a, **b: common.staged(plan(df), *a, **b))
    folded = bpe._folded
    monkeypatch.setattr(bpe, "_folded", lambda *a: plan(folded(*a)))
    rows = ["some words", "and some more", "x" * 300]
    got = by_id(bpe.token_digest(plan(documents(spark, rows))))
    assert [got[i].n_tokens for i in range(3)] == [len(REFERENCE.encode_ordinary(t)) for t in rows]
    assert len(seen) == 3 and "aggregate" in seen[1] and "aggregate" in seen[2] and max(map(len, seen)) < 100_000


def test_known_words_are_hashed_in_bounded_memory(monkeypatch):
    many = [f"word{i:07d}é" for i in range(200_000)]
    words = pa.array(many)
    tracemalloc.start()
    known = bpe.Known(words)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60e6  # all at once: some arrays of 8 bytes for each of 2.4M characters, more than 100 MB
    monkeypatch.setattr(bpe, "HASHED", 3)  # and the groups do not show
    few = ["".join(chr(97 + int(d)) for d in str(i)) for i in range(10)]
    for words in (few, few[:4] + ["", "🎉", "日本"], []):
        known, w = bpe.Known(pa.array(words, pa.string())), bpe.Words([x for x in words if x] + ["unknown"], bpe.character_classes())
        found = {w.word(i): k for i, k in enumerate(known.find(w).tolist())}
        assert [known.order[k] for k in found.values() if k >= 0] == [words.index(x) for x, k in found.items() if k >= 0]
        assert {x for x, k in found.items() if k < 0} == {"unknown"} and len(found) == 1 + len([x for x in words if x])


def test_words_and_decoded_texts_are_cut_out_all_at_once(monkeypatch):
    rows = texts()
    w = bpe.Words(rows, bpe.character_classes())
    assert w.utf8().to_pylist() == [w.word(i).encode() for i in range(len(w.h))] and len(w.h) > 100
    assert bpe.Words([None, ""], bpe.character_classes()).utf8().to_pylist() == []
    ids = [REFERENCE.encode_ordinary(t or "") for t in rows]
    cuts = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    for most in (bpe.SPLIT_CHARS, 300):
        monkeypatch.setattr(bpe, "SPLIT_CHARS", most)
        parts = bpe.Decoder(public_tokenizers.path(bpe.VOCABULARY)).parts(np.array(sum(ids, []), np.int32), cuts)
        assert [bytes(x) for x in parts] == [(t or "").encode() for t in rows]
