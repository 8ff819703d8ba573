"""Helpers shared by the operators of this package."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
import zipfile
from pathlib import Path
from typing import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

_STAGED: list[tuple[SparkSession, str]] = []


_SHIPPED: set[str] = set()

#: Bytes of an Arrow batch at most: the JVM and each worker of a task hold some of them at a time.
BATCH_BYTES = 16 << 20


def ship(spark: SparkSession) -> None:
    """Send this library to the tasks, which run functions of it, once for each application; their batches stay small."""
    sc, bound = spark.sparkContext, "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound) in ("64MB", "67108864b", "-1"):  # what Spark sets by itself; a caller's choice stays
        spark.conf.set(bound, str(BATCH_BYTES))
    if sc.applicationId not in _SHIPPED:
        _SHIPPED.add(sc.applicationId)
        package = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="lakeshore-")) / f"lakeshore-{uuid.uuid4().hex}.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(target))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, in that order, found by exact name. Every operator begins with it, so it ships the library.

    Extra columns (also such that differ from a wanted name in case only, or
    that repeat a wanted name) cannot clash with an operator's own columns:
    they go before anything else happens. Of repeated names the first counts.
    """
    ship(df.sparkSession)
    if [c.lower() for c in df.columns].count(names[0].lower()) == 1 and len({c.lower() for c in df.columns}) == len(df.columns):
        return df.select(*names)
    flat = df.toDF(*(f"_c{i}" for i in range(len(df.columns))))
    return flat.select(*(F.col(f"_c{df.columns.index(n)}").alias(n) for n in names))


def stage_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder, deleted at the end of the application."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    if not _STAGED:
        atexit.register(_clean)
    _STAGED.append((spark, path))
    return path


def _clean() -> None:
    for spark, path in _STAGED:
        with contextlib.suppress(Exception):  # the session may be gone; the folder is scratch
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """df written as Parquet (with the writer's options) into the shared checkpoint folder and read again.

    Cuts the lineage at storage that every executor sees, so a lost executor
    costs tasks of one step only, and a later step never recomputes this one.
    """
    path = f"{stage_dir(df.sparkSession, name)}/data"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def frequent(counts: DataFrame, most: int, name: str) -> DataFrame:
    """The rows of counts (with a count n) of the largest n, at most `most` of them; written once.

    A histogram of n on a fine logarithmic scale (some thousand steps, on the
    driver) gives the least n that keeps the bound, and a filter the rows. So
    no task and no driver gets more than `most` rows, as a sort with a limit
    would: that takes so many from every task. Rows that tie at the limit stay
    out together.
    """
    counts = staged(counts, name)
    step = F.floor(F.log2("n") * 64)
    left, least = most, None
    for r in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        if r["count"] > left:
            break
        left, least = left - r["count"], r.step
    return counts.where(F.lit(False) if least is None else step >= least)


def hash_sample(df: DataFrame, key: Column, most: int, rows: int) -> DataFrame:
    """About `most` of df's rows (all, if they are no more), those whose key hashes low; twice as many at most.

    A filter: unlike with a sort and a limit, a task sends no more than its
    share. The limit holds where a key repeats often; null keys stay out.
    """
    low = F.pmod(F.xxhash64(key), F.lit(1 << 40)) < int((1 << 40) * most / max(rows, 1))
    return df if rows <= most else df.where(key.isNotNull() & low).limit(2 * most)


def remainder(doc_id: Column, by: int) -> Column:
    """crc32(doc_id as text) mod `by`; a null id counts as the empty text (remainder 0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by


def map_text(df: DataFrame, fn: Callable[[list], list], fields: Iterable[tuple[str, str, pa.DataType]]) -> DataFrame:
    """Apply fn to the texts of each Arrow batch of df (id, text, passed columns...).

    fn takes the list of texts (None for null) and returns one list per
    field; the id and the passed columns go through unchanged.
    """
    fields = list(fields)
    keep = [c for i, c in enumerate(df.columns) if i != 1]
    types = dict(df.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + [f"`{n}` {t}" for n, t, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                cols = fn(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(part.num_columns) if i != 1]
                    + [pa.array(c, t) for c, (_, _, t) in zip(cols, fields, strict=True)],
                    names=keep + [n for n, _, _ in fields])

    return df.mapInArrow(run, schema)
