"""The medallion run: raw files -> Bronze -> Silver + quarantine -> Gold.

Each step is a handful of distributed jobs, not a per-file loop:

* Bronze: list raw files (no data read), anti-join the ingestion ledger,
  compare each pending file's schema (a file that does not fit is logged as
  failed and left out), read the others in one job and write them partitioned
  by source file; a rerun of a file replaces only that file's partition.
* Silver: anti-join Bronze's successful files against the transform ledger,
  read those partitions (partition pruning), validate once and write clean and
  rejected rows in one job, by outcome, source file and pickup month.
  Files whose name carries no month are logged as failed, without failing
  the others.
* Gold: source files that are new or written again are reduced to stored
  partial states (see partials.py); each table is one job that merges all
  states, and replaces the table whole; a failing table is logged and the rest still build. The table
  jobs are independent and are submitted a few at a time from driver
  threads, so Spark's scheduler fills idle executors with the next table
  while one table's last tasks finish.

Everything is written beside the live table and put in place by renames once
the write has succeeded; renames that a crash cut short are finished by the
next step (`Warehouse.recover`).

Only when a whole batch job fails does a step fall back to one job per file,
to isolate the failing file (the original's per-file failure semantics).
The driver only ever holds file lists, counts and ledger rows.
"""

from __future__ import annotations

import argparse
import sys
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType, TimestampNTZType

from .. import spec
from ..operators import bronze as bronze_ops
from ..operators import gold, quality, silver
from ..sources import ledger
from .partials import Partials
from ..sources.tables import STORED_AS, Warehouse, check_schema, differences, unsorted_writes

QUARANTINE_MIN_SCHEMA = StructType([
    StructField("pickup_datetime", TimestampNTZType()),
    StructField("dropoff_datetime", TimestampNTZType()),
    StructField("trip_distance", DoubleType()),
    StructField("fare_amount", DoubleType()),
    StructField("total_amount", DoubleType()),
    StructField(spec.SOURCE_FILE_COLUMN, StringType()),
    *[StructField(f, BooleanType()) for f in spec.REJECTION_FLAGS],
])


@dataclass
class StepResult:
    step: str
    processed: int = 0
    skipped: int = 0
    failed: int = 0
    exit_code: int = 0
    messages: list[str] = field(default_factory=list)


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _run_id() -> int:
    return int(time.time() * 1000)


def _log(msg: str) -> None:
    print(msg, file=sys.stderr)


# ---------------------------------------------------------------------------
# Bronze
# ---------------------------------------------------------------------------

def _raw_schema(wh: Warehouse, schemas: list[StructType]) -> StructType:
    """Bronze's raw column set: the existing table's, else the first file's."""
    existing = wh.schema(wh.tables.bronze)
    src = existing if existing is not None else schemas[0]
    lineage = (spec.SOURCE_FILE_COLUMN, spec.INGESTED_AT_COLUMN)
    return StructType([f for f in src.fields if f.name not in lineage])


def _file_schemas(spark: SparkSession, pending: list) -> dict[str, StructType | str]:
    """Each pending file's schema (one footer a file), or why it cannot be read."""
    def one(path: str) -> StructType | str:
        try:
            return spark.read.parquet(path).schema
        except Exception as e:
            return str(e).splitlines()[0][:1000]
    with ThreadPoolExecutor(max_workers=8) as pool:
        return dict(zip([r.source_file for r in pending], pool.map(one, [r.path for r in pending])))


def _ingest(spark: SparkSession, wh: Warehouse, pending: list, schema: StructType, ingested_at) -> dict[str, int]:
    """Land the files (one root path each) and count what landed of each."""
    raw = spark.read.schema(schema).parquet(*[r.path for r in pending])
    batch = bronze_ops.add_lineage(raw, ingested_at=F.lit(ingested_at).cast("timestamp"))
    names = [r.source_file for r in pending]
    wh.publish(batch, wh.tables.bronze, partition_by=[spec.SOURCE_FILE_COLUMN], replace=names)
    landed = wh.read(wh.tables.bronze, batch.schema).filter(F.col(spec.SOURCE_FILE_COLUMN).isin(names))
    found = {r[0]: r[1] for r in landed.groupBy(spec.SOURCE_FILE_COLUMN).count().collect()}  # one row a file
    return {n: found.get(n, 0) for n in names}


def _lost(spark: SparkSession, pending: list, counts: dict[str, int]) -> dict[str, str]:
    """Files of which nothing landed although they hold rows."""
    return {r.source_file: f"no row of {r.source_file} landed" for r in pending
            if not counts.get(r.source_file) and spark.read.parquet(r.path).count()}


def ingest_bronze(spark: SparkSession, cfg: spec.PipelineConfig) -> StepResult:
    res = StepResult("bronze")
    wh = Warehouse(spark, cfg.warehouse, cfg.tables)
    wh.recover()
    files = bronze_ops.discover_files(spark, cfg.raw_dir)
    log = ledger.read(wh, wh.tables.ingestion_log, ledger.INGESTION_LOG_SCHEMA)
    status = bronze_ops.file_status(files, log)
    # One row per raw file: a listing, bounded by the number of files.
    rows = status.orderBy("source_file").collect()
    if not rows:
        res.exit_code = 1
        res.messages.append(f"No parquet files found in {cfg.raw_dir}")
        return res
    pending = [r for r in rows if not r.already_processed]
    res.skipped = len(rows) - len(pending)
    if not pending:
        return res
    run_id, started = _run_id(), _now()
    sizes = {r.source_file: r.file_size_bytes for r in pending}
    schemas = _file_schemas(spark, pending)
    failed = {n: x for n, x in schemas.items() if isinstance(x, str)}
    schema = None
    if readable := [x for x in schemas.values() if not isinstance(x, str)]:
        schema = _raw_schema(wh, readable)
        failed |= {n: f"schema differs from {wh.tables.bronze}: {why}" for n, x in schemas.items()
                   if n not in failed and (why := differences(x, schema))}
    fitting = [r for r in pending if r.source_file not in failed]

    def ledger_rows(counts: dict[str, int], failed: dict[str, str]) -> list[dict]:
        finished = _now()
        out = []
        for name in sizes:
            ok = name not in failed
            out.append({"source_file": name, "target_table": wh.tables.bronze,
                        "status": "success" if ok else "failed", "row_count": counts.get(name, 0),
                        "file_size_bytes": sizes[name], "snapshot_id": run_id if ok else None,
                        "started_at": started, "finished_at": finished,
                        "error_message": None if ok else failed[name]})
        return out

    counts: dict[str, int] = {}
    try:
        if fitting:
            counts = _ingest(spark, wh, fitting, schema, started)
    except Exception as batch_error:  # isolate the failing file(s)
        _log(f"bronze batch failed ({batch_error.__class__.__name__}); retrying file by file")
        for r in fitting:
            try:
                counts |= _ingest(spark, wh, [r], schema, started)
            except Exception as e:
                failed[r.source_file] = str(e).splitlines()[0][:1000]
    failed |= _lost(spark, [r for r in fitting if r.source_file not in failed], counts)
    ledger.append_rows(spark, wh, wh.tables.ingestion_log, ledger.INGESTION_LOG_SCHEMA,
                       ledger_rows(counts, failed))
    res.processed = len(sizes) - len(failed)
    res.failed = len(failed)
    res.exit_code = 1 if failed else 0
    for name in sorted(sizes):
        res.messages.append(f"{'failed' if name in failed else 'append'} {name}: {counts.get(name, 0):,} rows")
    return res


# ---------------------------------------------------------------------------
# Silver
# ---------------------------------------------------------------------------

def _file_name_status(spark: SparkSession, files: list[str]) -> dict[str, bool]:
    """Whether each file name carries a valid month (same rule as Silver)."""
    from ..functions import rules
    names = spark.createDataFrame([(f,) for f in files], "name string")
    return {r.name: r.ok for r in names.select(
        "name", rules.source_file_valid(F.col("name")).alias("ok")).collect()}


#: Files that one job validates: their counts are aggregates of its plan.
FILES_PER_JOB = 12


def _transform(wh: Warehouse, files: list[str], cfg: spec.PipelineConfig) -> list[dict]:
    """Validate and write the files' rows; return their per-file breakdown.

    One scan of Bronze: a single job writes clean and rejected rows by outcome
    into a staging folder and observes the counts. Then each file's folders
    take the place of its old ones in Silver and quarantine, in one swap; a
    write that fails leaves both tables as they were.
    """
    out = []
    for lo in range(0, len(files), FILES_PER_JOB):
        some = files[lo:lo + FILES_PER_JOB]
        batch = wh.read(wh.tables.bronze).filter(F.col(spec.SOURCE_FILE_COLUMN).isin(some))
        flagged = silver.flag_rules(batch, cfg.min_pickup, cfg.max_pickup)
        rows = silver.outcome_rows(flagged, F.lit(_now()).cast("timestamp"))
        counted = Observation()
        staged = wh.staging("outcome")
        with unsorted_writes(wh.spark):
            (rows.observe(counted, *silver.outcome_metrics(rows, some)).write
             .partitionBy(silver.OUTCOME, spec.SOURCE_FILE_COLUMN, "pickup_month").parquet(staged))
        clean = silver.silver_rows(flagged).withColumn("pickup_month", F.lit("").cast("string")).schema
        wh.declare(wh.tables.silver, clean)
        wh.declare(wh.tables.quarantine, StructType([
            StructField(f.name, f.dataType, f.nullable, {STORED_AS: silver.FLAG_TEXT} if f.name == "store_and_fwd_flag" else {})
            for f in silver.quarantine_rows(flagged).schema]))
        moves = []
        for table, outcome in ((wh.tables.silver, silver.CLEAN), (wh.tables.quarantine, silver.REJECTED)):
            live = [wh.partition(table, spec.SOURCE_FILE_COLUMN, n) for n in some]
            moves += [(f"{staged}/{silver.OUTCOME}={outcome}/{p.rsplit('/', 1)[1]}", p) for p in live]
        wh.swap(moves, staged)
        ok = _file_name_status(wh.spark, some)
        out += [r | {"file_ok": ok[r["source_file"]]} for r in silver.breakdown_of_metrics(counted.get, some)]
    return out


def transform_silver(spark: SparkSession, cfg: spec.PipelineConfig) -> StepResult:
    res = StepResult("silver")
    wh = Warehouse(spark, cfg.warehouse, cfg.tables)
    wh.recover()
    if not wh.exists(wh.tables.bronze):
        res.exit_code = 1
        res.messages.append(f"Bronze table {wh.tables.bronze} does not exist. Run the Bronze step first.")
        return res
    ing = ledger.read(wh, wh.tables.ingestion_log, ledger.INGESTION_LOG_SCHEMA)
    bronze_files = bronze_ops.successful(ing, wh.tables.bronze)
    tlog = ledger.read(wh, wh.tables.transform_log, ledger.TRANSFORM_LOG_SCHEMA)
    status = bronze_ops.file_status(bronze_files, tlog, wh.tables.silver).orderBy("source_file").collect()
    if not status:
        res.exit_code = 1
        res.messages.append("No successfully ingested bronze files found in the ingestion log.")
        return res
    pending = [r.source_file for r in status if not r.already_processed]
    res.skipped = len(status) - len(pending)
    if not pending:
        return res
    run_id, started = _run_id(), _now()

    def stats_rows(stats: list, failed: dict[str, str]) -> list[dict]:
        finished = _now()
        by_file = {s["source_file"]: s for s in stats}
        out = []
        for name in pending:
            s = by_file.get(name)
            ok = s is not None and s["file_ok"] and name not in failed
            err = failed.get(name) or (None if ok else f"Cannot determine month from source filename: {name}")
            out.append({"source_table": wh.tables.bronze, "source_file": name, "target_table": wh.tables.silver,
                        "status": "success" if ok else "failed",
                        **{k: s[k] if ok else 0 for k in ("rows_read", "rows_rejected", "rows_written")},
                        "snapshot_id": run_id if ok else None, "started_at": started, "finished_at": finished,
                        "error_message": None if ok else err})
        return out

    try:
        stats = _transform(wh, pending, cfg)
        failed: dict[str, str] = {}
    except Exception as batch_error:
        _log(f"silver batch failed ({batch_error.__class__.__name__}); retrying file by file")
        stats, failed = [], {}
        for name in pending:
            try:
                stats += _transform(wh, [name], cfg)
            except Exception as e:
                failed[name] = str(e).splitlines()[0][:1000]
    rows = stats_rows(stats, failed)
    ledger.append_rows(spark, wh, wh.tables.transform_log, ledger.TRANSFORM_LOG_SCHEMA, rows)
    n_failed = sum(r["status"] == "failed" for r in rows)
    res.processed, res.failed = len(rows) - n_failed, n_failed
    res.exit_code = 1 if n_failed else 0
    for s in stats:
        breakdown = ", ".join(f"{k}={v:,}" for k, v in s.items() if k not in ("source_file", "file_ok"))
        res.messages.append(f"process {s['source_file']}: {breakdown}")
    return res


# ---------------------------------------------------------------------------
# Gold
# ---------------------------------------------------------------------------

def gold_targets(parts: Partials, bronze_rows: DataFrame, transform_log: DataFrame,
                 tables: spec.TableNames = spec.TableNames()) -> list[tuple[str, str, Callable[[], DataFrame]]]:
    """(table, source, builder) for the 11 Gold tables, each merged from stored partial states."""
    def builder(n: str) -> Callable[[], DataFrame]:
        if n in gold.MONTHLY_TABLES:
            return lambda: gold.build_from_shared(parts.get("monthly"), n)
        return {
            "daily_trip_summary": lambda: gold.daily_from_shared(parts.get("daily")),
            "payment_null_profile": lambda: gold.null_profile_from_shared(parts.get("daily")),
            "data_quality_summary": lambda: quality.summary_of_profiles(
                parts.get("quality").withColumnRenamed(spec.SOURCE_FILE_COLUMN, "file"), parts.get("rejected"), bronze_rows, transform_log),
        }[n]

    both = f"{tables.silver}+{tables.quarantine}"
    return [(n, both if n == "data_quality_summary" else tables.silver, builder(n)) for n in spec.GOLD_TABLES]


def build_gold(spark: SparkSession, cfg: spec.PipelineConfig, only: list[str] | None = None) -> StepResult:
    res = StepResult("gold")
    wh = Warehouse(spark, cfg.warehouse, cfg.tables)
    wh.recover()
    if not wh.exists(wh.tables.silver):
        res.exit_code = 1
        res.messages.append(f"Silver table {wh.tables.silver} does not exist. Run the Silver step first.")
        return res
    silver_df = wh.read(wh.tables.silver)
    quarantine_df = wh.read(wh.tables.quarantine, QUARANTINE_MIN_SCHEMA)
    bronze_n = wh.row_count(wh.tables.bronze)
    bronze_rows = spark.range(1).select(F.lit(bronze_n).cast("bigint").alias("bronze_rows"))
    tlog = (ledger.read(wh, wh.tables.transform_log, ledger.TRANSFORM_LOG_SCHEMA)
            .filter((F.col("status") == "success") & (F.col("target_table") == wh.tables.silver))
            .select("source_file", "rows_read", "rows_rejected", "rows_written"))
    silver_n, quarantine_n = silver_df.count(), quarantine_df.count()
    if bronze_n and silver_n + quarantine_n != bronze_n:
        _log(f"Warning: current table counts are not balanced: bronze={bronze_n:,}, silver={silver_n:,}, "
             f"quarantine={quarantine_n:,}, accounted={silver_n + quarantine_n:,}.")
    parts = Partials(wh, silver_df, quarantine_df)

    def build_one(name: str, source: str, builder: Callable[[], DataFrame]) -> tuple[dict, str, bool]:
        table = f"{wh.tables.gold_namespace}.{name}"
        rows_read = silver_n + (quarantine_n if name == "data_quality_summary" else 0)
        started = _now()
        try:
            df = builder()
            check_schema(wh, table, df.schema)
            obs = Observation(f"rows_{name}")
            wh.publish(df.observe(obs, F.count(F.lit(1)).alias("rows")), table,
                       partition_by=gold_partitioning(name, df.columns), schema=df.schema)
            written = obs.get["rows"]
            status, err, snap = "success", None, _run_id()
            msg = f"build {table}: {written:,} rows"
        except Exception as e:
            written, status, err, snap = 0, "failed", str(e).splitlines()[0][:1000], None
            msg = f"Failed to build {table}: {err}"
        row = {"source_table": source, "target_table": table, "status": status, "rows_read": rows_read,
               "rows_written": written, "snapshot_id": snap, "started_at": started,
               "finished_at": _now(), "error_message": err}
        return row, msg, status == "success"

    targets = [t for t in gold_targets(parts, bronze_rows, tlog, wh.tables)
               if not only or t[0] in only]
    with ThreadPoolExecutor(max_workers=max(1, cfg.gold_concurrency)) as pool:
        # Results are taken in table order, so the ledger and the messages
        # do not depend on which job finished first.
        results = [f.result() for f in [pool.submit(build_one, *t) for t in targets]]
    log_rows = []
    for row, msg, ok in results:
        log_rows.append(row)
        res.messages.append(msg)
        if ok:
            res.processed += 1
        else:
            res.failed += 1
    ledger.append_rows(spark, wh, wh.tables.gold_log, ledger.GOLD_LOG_SCHEMA, log_rows)
    res.exit_code = 1 if res.failed else 0
    return res


GOLD_PARTITION_COLUMNS = ("data_variant", "month_basis")


def gold_partitioning(name: str, columns: list[str]) -> list[str]:
    """Gold tables are stored partitioned by (data_variant, month_basis):
    every report filters on both, so reads prune to one directory in eight.
    The small quality table stays unpartitioned."""
    if name == "data_quality_summary":
        return []
    return [c for c in GOLD_PARTITION_COLUMNS if c in columns]


def load_gold(spark: SparkSession, warehouse: str, name: str, namespace: str = spec.GOLD_NAMESPACE) -> DataFrame:
    """A Gold table for reporting, with its leading dimension columns back
    in front (partition columns read back last). A table built without rows
    is an empty frame; one that was never built is an error."""
    df = Warehouse(spark, warehouse).read(f"{namespace}.{name}", required=True)
    lead = [c for c in GOLD_PARTITION_COLUMNS if c in gold_partitioning(name, df.columns)]
    return df.select(*lead, *[c for c in df.columns if c not in lead])


def run_all(spark: SparkSession, cfg: spec.PipelineConfig) -> int:
    """Bronze, Silver, Gold in order; stop at the first failing step."""
    for step in (ingest_bronze, transform_silver, build_gold):
        res = step(spark, cfg)
        for m in res.messages:
            print(m)
        print(f"{res.step}: {res.processed} processed, {res.skipped} skipped, {res.failed} failed")
        if res.exit_code:
            return res.exit_code
    return 0


def main(argv: list[str] | None = None) -> int:
    from ..session import get_session

    ap = argparse.ArgumentParser(description="Run the trip medallion pipeline on Spark.")
    ap.add_argument("--config", default=None, help="TOML file with the settings below and table names")
    ap.add_argument("--raw-dir", default=None)
    ap.add_argument("--warehouse", default=None)
    ap.add_argument("--min-pickup", default=None, help="first pickup time that is valid")
    ap.add_argument("--max-pickup", default=None, help="last pickup time that is valid")
    ap.add_argument("--master", default=None)
    ap.add_argument("--step", choices=["all", "bronze", "silver", "gold"], default="all")
    ap.add_argument("--gold-concurrency", type=int, default=None, help="Gold tables built at the same time")
    args = ap.parse_args(argv)
    given = {"warehouse": args.warehouse, "raw_dir": args.raw_dir, "min_pickup": args.min_pickup, "max_pickup": args.max_pickup,
             "gold_concurrency": args.gold_concurrency}
    if args.config:
        cfg = spec.load_config(args.config, **given)
    elif args.warehouse:
        cfg = spec.PipelineConfig(**{k: v for k, v in given.items() if v is not None})
    else:
        ap.error("--warehouse or --config is needed")
    spark = get_session(args.master)
    if args.step == "all":
        return run_all(spark, cfg)
    step = {"bronze": ingest_bronze, "silver": transform_silver, "gold": build_gold}[args.step]
    res = step(spark, cfg)
    for m in res.messages:
        print(m)
    return res.exit_code


if __name__ == "__main__":
    raise SystemExit(main())
