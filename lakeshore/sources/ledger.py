"""Append-only run ledgers (ingestion, Silver transform, Gold build).

Ledger rows are tiny, one for each source file or Gold table of a run. Each run
adds a file; a ledger of many files is compacted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from .tables import Warehouse

INGESTION_LOG_SCHEMA = StructType([
    StructField("source_file", StringType(), False),
    StructField("target_table", StringType(), False),
    StructField("status", StringType(), False),
    StructField("row_count", LongType(), False),
    StructField("file_size_bytes", LongType(), False),
    StructField("snapshot_id", LongType(), True),
    StructField("started_at", TimestampType(), False),
    StructField("finished_at", TimestampType(), False),
    StructField("error_message", StringType(), True),
])

TRANSFORM_LOG_SCHEMA = StructType([
    StructField("source_table", StringType(), False),
    StructField("source_file", StringType(), False),
    StructField("target_table", StringType(), False),
    StructField("status", StringType(), False),
    StructField("rows_read", LongType(), False),
    StructField("rows_rejected", LongType(), False),
    StructField("rows_written", LongType(), False),
    StructField("snapshot_id", LongType(), True),
    StructField("started_at", TimestampType(), False),
    StructField("finished_at", TimestampType(), False),
    StructField("error_message", StringType(), True),
])

GOLD_LOG_SCHEMA = StructType([
    StructField("source_table", StringType(), False),
    StructField("target_table", StringType(), False),
    StructField("status", StringType(), False),
    StructField("rows_read", LongType(), False),
    StructField("rows_written", LongType(), False),
    StructField("snapshot_id", LongType(), True),
    StructField("started_at", TimestampType(), False),
    StructField("finished_at", TimestampType(), False),
    StructField("error_message", StringType(), True),
])


#: Data files from which on a ledger is compacted.
COMPACT_FILES = 32


def append_rows(spark: SparkSession, wh: Warehouse, table: str, schema: StructType, rows: list[dict]) -> None:
    """Append literal ledger rows (a handful per run: failures, Gold targets)."""
    if not rows:
        return
    df = spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)
    wh.append(df.coalesce(1), table)
    if wh.data_files(table) >= COMPACT_FILES:
        compact(wh, table, schema)


def compact(wh: Warehouse, table: str, schema: StructType) -> None:
    """Rewrite a ledger as one file, with the latest row of each source file, target and status.

    So a file's status stays what it was: it has its last success, if it ever
    had one, beside its last failure.
    """
    keys = [c for c in ("source_table", "source_file", "target_table", "status") if c in schema.names]
    rest = [c for c in schema.names if c not in keys]
    last = wh.read(table).groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("finished_at", "snapshot_id")).alias("last"))
    rows = last.select(*keys, "last.*").select(*schema.names)
    wh.publish(rows.coalesce(1), table)


def read(wh: Warehouse, table: str, schema: StructType) -> DataFrame:
    return wh.read(table, schema)
