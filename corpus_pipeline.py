"""Corpus preparation: the documents table through five of the operators, in order."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeshore.llm import bpe, decontam, secrets, simhash, toxicity
from lakeshore.llm.common import staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays: shingles of 3 words, up to 2 differing bits."""
    return simhash.keep_one(docs, size=3, most=2)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts give way to a mark; every document stays."""
    return secrets.redact(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and `decoded`, the bytes that the ids decode to: the text's."""
    return bpe.encode_and_decode(docs, "doc_id", "lang", "source", "n_chars")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("SimHash near-dedup", drop_copies),
    ("benchmark decontamination", drop_leaked),
    ("secret scans", redact_secrets),
    ("byte-level BPE encoding and decoding", encode_texts),
]

#: No SQL: the classifier, the edit matching and the guess-cost model are beyond it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
