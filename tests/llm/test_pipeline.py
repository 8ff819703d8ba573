import importlib

import corpus_pipeline
from pyspark.sql import functions as F

from lakeshore.llm import decontam, secrets, toxicity

from ..conftest import SF001
from .helpers import documents
from .test_bpe import REFERENCE
from .test_simhash import brute_components, brute_fingerprint


def test_stages_in_order_and_their_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "SimHash near-dedup", "benchmark decontamination", "secret scans", "byte-level BPE encoding and decoding"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF001)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
    rows = [r for r in docs.orderBy("doc_id").collect() if model.score(r.text) < 0.5]
    comp = brute_components([r.doc_id for r in rows], [brute_fingerprint(r.text) for r in rows])
    rows = [r for r, c in zip(rows, comp) if r.doc_id == c]
    items = [decontam.normal(r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    rows = [r for r in rows if not any(i in decontam.normal(r.text) for i in items)]
    want = {}
    for r in rows:
        text, at = r.text, 0
        out = ""
        for a, b, _ in secrets.find_secrets(r.text):
            if a >= at:
                out += text[at:a] + "[SECRET]"
            at = max(at, b)
        want[r.doc_id] = REFERENCE.encode_ordinary(out + text[at:])
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, SF001).collect()}
    assert got == want


def test_last_stage_decodes_its_ids_to_the_text(spark):
    docs = corpus_pipeline.redact_secrets(spark, spark.read.parquet(f"{SF001}/documents.parquet"), SF001).unionByName(
        documents(spark, [None, "", "Ünï  çødé \n\t 漢字 🙂", "x" * 1000 + "'ll 12"]).withColumn("doc_id", F.col("doc_id") - 10))
    want = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    got = corpus_pipeline.encode_texts(spark, docs, SF001)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "ids", "decoded"]
    rows = got.collect()
    assert {r.doc_id: bytes(r.decoded) for r in rows} == want
    assert all(REFERENCE.decode_bytes(list(r.ids)) == bytes(r.decoded) for r in rows)


def test_empty_and_null_documents_pass_through(spark, scratch):
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF001}/{t}.parquet").write.parquet(f"{scratch}/{t}.parquet")
    empty = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    nulls = spark.createDataFrame([(None, None, None, None, None), (5, "plain words of text", None, None, None)], empty.schema)
    for docs, n in ((empty, 0), (nulls, 2)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, scratch)
        assert docs.count() == n


def test_entry_registers_the_pipeline():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert "pipeline" in names and sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))
