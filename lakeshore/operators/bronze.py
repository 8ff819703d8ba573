"""Raw files -> Bronze: discovery, lineage columns, incremental selection."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import spec

# The raw file's own name ends so, either as the file itself or as the
# directory a writer produced for it (`<name>.parquet/part-*.parquet`).
FILE_SUFFIX = ".parquet"

FILES_SCHEMA = "path string, source_file string, file_size_bytes bigint, modified_at timestamp"


def source_file_name(path: Column) -> Column:
    """The source file of a row's `_metadata.file_path`, which is URL-encoded
    (a literal `+` is not, so it must not be taken for a space).

    This runs for every row: the path is cut at its slashes, and only a name
    that holds a `%` is decoded. A regular expression over the whole decoded
    path takes more time than all else in the ingestion.
    """
    named = lambda c: c.endswith(FILE_SUFFIX) & (F.length(c) > len(FILE_SUFFIX))
    last, folder = F.substring_index(path, "/", -1), F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    name = F.when(named(folder), folder).when(named(last), last).otherwise(F.substring(path, 1, 0))
    return F.when(name.contains("%"), F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))).otherwise(name)


def discover_files(spark: SparkSession, raw_dir: str) -> DataFrame:
    """(path, source_file, file_size_bytes, modified_at): one row for each
    `*.parquet` entry directly in the raw folder, a file or the folder of part
    files that a writer made of it. A listing only; nested folders are not
    searched and no part-file paths are gathered.
    """
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(raw_dir)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    rows = []
    if fs.exists(root):
        for st in fs.listStatus(root):
            p = st.getPath()
            if p.getName().endswith(".parquet") and not p.getName().startswith((".", "_")):
                size = fs.getContentSummary(p).getLength() if st.isDirectory() else st.getLen()
                rows.append((p.toString(), p.getName(), size, datetime.fromtimestamp(st.getModificationTime() / 1000, timezone.utc)))
    return spark.createDataFrame(rows, FILES_SCHEMA)


def add_lineage(df: DataFrame, source_file: Column | None = None, ingested_at: Column | None = None) -> DataFrame:
    """Append the non-null source-file name and the ingest time (UTC)."""
    sf = source_file if source_file is not None else source_file_name(F.col("_metadata.file_path"))
    return df.withColumns({
        spec.SOURCE_FILE_COLUMN: sf,
        spec.INGESTED_AT_COLUMN: ingested_at if ingested_at is not None else F.current_timestamp(),
    })


def successful(ledger: DataFrame, target_table: str | None = None) -> DataFrame:
    """Distinct source files with a success entry (optionally per target)."""
    ok = ledger.filter(F.col("status") == "success")
    if target_table is not None:
        ok = ok.filter(F.col("target_table") == target_table)
    return ok.select("source_file").distinct()


def pending_files(files: DataFrame, ledger: DataFrame, target_table: str | None = None) -> DataFrame:
    """Files without a success entry: an anti-join against the ledger.

    The ledger side is one row per file ever processed, so Spark may
    broadcast it when its measured size is under the broadcast threshold
    (AQE decides at run time); otherwise it is a shuffled anti-join.
    """
    return files.join(successful(ledger, target_table), "source_file", "left_anti")


def file_status(files: DataFrame, ledger: DataFrame, target_table: str | None = None) -> DataFrame:
    """Every file with a flag telling whether it was already processed."""
    done = successful(ledger, target_table).withColumn("already_processed", F.lit(True))
    return files.join(done, "source_file", "left_outer").withColumn(
        "already_processed", F.coalesce(F.col("already_processed"), F.lit(False)))


def rows_of(bronze: DataFrame, files: DataFrame) -> DataFrame:
    """Bronze's rows of the files in a frame (source_file), such as the pending ones.

    Bronze is partitioned by source file, so Spark runs the (small) frame first
    and reads only the partitions it names: dynamic partition pruning, with
    nothing passing through the driver.
    """
    names = files.select(F.col("source_file").alias(spec.SOURCE_FILE_COLUMN)).distinct()
    return bronze.join(names, spec.SOURCE_FILE_COLUMN, "left_semi")


def ingestion_summary(bronze: DataFrame, target_table: str = spec.BRONZE_TABLE) -> DataFrame:
    """Per source file: rows landed in Bronze (the ingestion ledger's view)."""
    return bronze.groupBy(F.col(spec.SOURCE_FILE_COLUMN).alias("source_file")).agg(
        F.count(F.lit(1)).alias("row_count")).select(
        "source_file", F.lit(target_table).alias("target_table"), F.lit("success").alias("status"), "row_count")
