"""Duplicate trips over all months, without reading the earlier months again.

A stored table holds, for each source file, the 128-bit hashes of its rows (two
64-bit hashes of the source columns) and how often each occurs. A new month is
read once, to add its hashes. Duplicates among all rows come from the hashes
alone; a month's rows that are there in earlier months come from a join of its
hashes with the earlier ones. That join is on 16-byte keys, and Spark puts a
Bloom filter of the (small, filtered) month before the shuffle of the earlier
hashes where that pays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import spec
from ..operators.profile import RUN_STAMP_COLUMNS
from ..sources.tables import Warehouse

TABLE = "metadata.row_hashes"
FILE = spec.SOURCE_FILE_COLUMN


def row_hashes(bronze: DataFrame) -> DataFrame:
    """(source file, h1, h2, n): rows by the hashes of their source columns (NULLs equal), combined in each task first."""
    cols = [F.struct(F.col(c).isNull(), F.col(c)) for c in bronze.columns if c not in (FILE, *RUN_STAMP_COLUMNS)]
    return bronze.groupBy(FILE, F.xxhash64(*cols).alias("h1"), F.xxhash64(F.lit("second"), *reversed(cols)).alias("h2")).agg(F.count("*").alias("n"))


def add_files(wh: Warehouse, bronze: DataFrame, files: list[str]) -> None:
    """Store the hashes of the files' rows in place of what is stored of them; reads those files alone."""
    rows = row_hashes(bronze.filter(F.col(FILE).isin(files)))
    wh.publish(rows, TABLE, [FILE], replace=files)
    wh.declare(TABLE, rows.schema)


def duplicate_summary(wh: Warehouse) -> DataFrame:
    """One row: groups of equal rows over all stored files, and the rows beyond the first of each."""
    groups = wh.read(TABLE, required=True).groupBy("h1", "h2").agg(F.sum("n").alias("n")).filter("n > 1")
    return groups.agg(F.count("*").alias("duplicate_groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def seen_before(wh: Warehouse, files: list[str]) -> DataFrame:
    """Per file of `files`: its rows, and those of them that files not in `files` hold as well."""
    stored = wh.read(TABLE, required=True)
    new, old = stored.filter(F.col(FILE).isin(files)), stored.filter(~F.col(FILE).isin(files)).select("h1", "h2", F.lit(True).alias("seen")).distinct()
    return new.join(old, ["h1", "h2"], "left").groupBy(FILE).agg(
        F.sum("n").cast("bigint").alias("rows"), F.coalesce(F.sum(F.when(F.col("seen"), F.col("n"))), F.lit(0)).cast("bigint").alias("rows_seen_before"))
