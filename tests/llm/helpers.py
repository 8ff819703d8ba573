"""Small frames with the awkward cases that every operator has to take."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, lang="en", extra=False):
    """One row a text, ids from 0; with `extra`, columns whose names clash with the operators' own."""
    rows = [(i, t, lang, "src", None if t is None else len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        from pyspark.sql import functions as F
        for c in ("score", "spans", "fp", "ids", "file", "row", "word", "rank", "key", "held_out", "Text", "_metadata"):
            df = df.withColumn(c, F.lit(c)) if c != "Text" else df.toDF(*df.columns).select("*", F.lit("no").alias("Text"))
    return df


def by_id(df):
    return {r.doc_id: r for r in df.collect()}
