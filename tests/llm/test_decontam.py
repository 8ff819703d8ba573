import random

from lakeshore.llm import decontam as D

from .helpers import documents


def distance(item, text):
    """Least edit distance of item to any part of text, by dynamic programming."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return min(row)


def test_myers_matches_dynamic_programming():
    rng = random.Random(1)
    for _ in range(150):
        item = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 80)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randrange(0, 120)))
        d, end = D.myers(item, text)
        assert d == distance(item, text)
        assert distance(item, text[:end]) == d and (not end or distance(item, text[:end - 1]) > d)


def test_all_occurrences_within_the_budget_and_no_others(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abdeinorst") for _ in range(rng.randrange(2, 8)))
    say = lambda n: " ".join(word() for _ in range(n))
    items = [(i, say(rng.randrange(12, 40))) for i in range(12)] + [(90, None), (91, ""), (92, "  "), (93, "abc")]
    texts = [None, "", "no match"]
    for i, t in items[:12]:
        for edits in (0, 1, D.budget(len(t)), D.budget(len(t)) + 1, D.budget(len(t)) + 6):
            x = list(t.upper() if edits == 1 else t)
            for p in rng.sample(range(len(x)), edits):
                x[p] = rng.choice(["#", "", x[p] + "#"])
            texts.append(f"{say(20)}\n {''.join(x)}  {say(30)} abc" if edits % 2 else "".join(x).replace(" ", "\n\t"))
    got = {(r.doc_id, r.item_id): r.distance for r in
           D.contaminated(documents(spark, texts, extra=True), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    want = {}
    for d, t in enumerate(texts):
        for i, item in items:
            n = D.normal(item)
            if n and (k := distance(n, D.normal(t))) <= D.budget(len(n)):
                want[d, i] = k
    assert got == want and len(want) > 40


def test_items_in_blocks_and_repeated_rows(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"benchmark question number {i} of this small set") for i in range(9)], "item_id bigint, text string")
    docs = documents(spark, ["x benchmark question number 4 of this small set y", "clean"])
    one = sorted(tuple(r) for r in D.contaminated(docs.union(docs), items, rate=0.0).collect())
    monkeypatch.setattr(D, "BLOCK_CHARS", 50)
    assert sorted(tuple(r) for r in D.contaminated(docs.union(docs), items, rate=0.0).collect()) == one and len(one) == 2
    assert [r.doc_id for r in D.keep_clean(docs, items).collect()] == [1]
    path, blocks = D.stage_items(items.union(items))  # repeated items in blocks of their own as well
    read = [r for b in range(blocks) for r in D.read_block(path, b)]
    assert blocks > 5 and sorted(read) == sorted((r.item_id, r.text) for r in items.union(items).collect())
    assert len(D.contaminated(docs, items.union(items), rate=0.0).collect()) == 2


def test_very_long_texts_go_through_every_block(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_CHARS", 40)
    items = spark.createDataFrame([(i, f"question {'abcdefgh'[i] * 5} of the long text") for i in range(8)], "item_id bigint, text string")
    filler = "some other words " * 30_000
    texts = [filler + "question aaaaa of the long text " + filler + "question hhhhh of the  LONG text", filler, "question ccccc of the long text"]
    got = {(r.doc_id, r.item_id, r.distance) for r in D.contaminated(documents(spark, texts), items, rate=0.0).collect()}
    assert got == {(0, 0, 0), (0, 7, 0), (2, 2, 0)}
    assert [r.doc_id for r in D.keep_clean(documents(spark, texts), items, rate=0.0).collect()] == [1]


def test_empty_tables(spark):
    items, docs = spark.createDataFrame([(1, "abc")], "item_id bigint, text string"), documents(spark, ["abc"])
    assert D.contaminated(docs, items.limit(0)).count() == 0 and D.contaminated(docs.limit(0), items).count() == 0
    assert D.keep_clean(docs, items.limit(0)).count() == 1
