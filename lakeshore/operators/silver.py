"""Bronze -> Silver + quarantine: rename, validate, split, flag, derive.

One lazy plan: the five rules are computed once in a single projection
(`flag_rules`), then two filters over that plan give the clean and the
rejected rows. The file pipeline writes both in one job, by outcome
(`outcome_rows`), and counts them on the way (`outcome_metrics`). Rows of files whose name carries no valid month cannot be
processed at all; they are split off as failed files (the per-file failure
isolation of the original, without failing the whole job).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import spec
from ..functions import rules
from ..functions.common import count_true
from ..session import compiled

RULE_PREFIX = "_rule_"
# Working columns of the validated frame, never part of Silver or quarantine.
INTERNAL = ("_valid", "_file_ok", "_file_ym")
# How the outcome write tells clean rows from rejected ones, and where it keeps a rejected row's flag as it came.
OUTCOME, CLEAN, REJECTED = "_outcome", "clean", "rejected"
FLAG_TEXT = "_bronze_store_and_fwd_flag"


def rename_columns(bronze: DataFrame) -> DataFrame:
    present = {k: v for k, v in spec.COLUMN_RENAMES.items() if k in bronze.columns}
    return bronze.withColumnsRenamed(present)


def flag_rules(bronze: DataFrame, min_pickup: str = spec.MIN_PICKUP,
               max_pickup: str = spec.MAX_PICKUP) -> DataFrame:
    """Renamed Bronze plus one boolean per rule, `_valid` and `_file_ok`."""
    compiled(bronze.sparkSession)
    renamed = rename_columns(bronze)
    rule_cols = rules.rule_columns(renamed.schema, min_pickup, max_pickup)
    flagged = renamed.withColumns({RULE_PREFIX + k: v for k, v in rule_cols.items()})
    valid = reduce(lambda a, b: a & b, [F.col(RULE_PREFIX + k) for k in rule_cols])
    flagged = flagged.withColumns({
        "_valid": valid,
        "_file_ym": rules.file_month_label(F.col(spec.SOURCE_FILE_COLUMN)),
    })
    return flagged.withColumn("_file_ok", rules.file_label_valid(F.col("_file_ym")))


def _rule_names() -> list[str]:
    return ["timestamp_order", "pickup_range", "distance", "amounts", "passengers"]


def _base_columns(flagged: DataFrame) -> list[str]:
    return [c for c in flagged.columns if not c.startswith(RULE_PREFIX) and c not in INTERNAL]


def _derive(rows: DataFrame, processed_at: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Silver's columns in their order (and those of `keep`) for every given row, clean or not."""
    selected = [rules.encode_flag().alias("store_and_fwd_flag") if c == "store_and_fwd_flag" else F.col(c)
                for c in _base_columns(rows)]
    out = rows.select(
        *selected,
        rules.source_month_offset(F.col("pickup_datetime"), F.col("_file_ym")).alias(spec.OFFSET_COLUMN),
        *[c.alias(name) for name, c in rules.warning_columns().items()],
        (F.col("dropoff_datetime") - F.col("pickup_datetime")).alias("_interval"),
        *[F.col(c) if c != "store_and_fwd_flag" else F.col(c).alias(FLAG_TEXT) for c in keep],
    )
    out = out.withColumn("trip_duration_min", rules.duration_minutes(F.col("_interval"))).drop("_interval")
    out = out.withColumn("avg_speed_mph", rules.avg_speed_mph(F.col("trip_duration_min")))
    return out.withColumn(spec.PROCESSED_AT_COLUMN, processed_at)


def silver_rows(flagged: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Clean rows with Silver's derived columns, in the Silver column order."""
    clean = flagged.filter(F.col("_valid") & F.col("_file_ok"))
    return _derive(clean, processed_at if processed_at is not None else F.current_timestamp())


def quarantine_rows(flagged: DataFrame, rejected_at: Column | None = None) -> DataFrame:
    """Rejected rows: renamed Bronze (flag still text) + 5 reason flags + stamp."""
    base_cols = _base_columns(flagged)
    rejected = flagged.filter(~F.col("_valid") & F.col("_file_ok"))
    reasons = [(~F.col(RULE_PREFIX + rule)).alias(flag) for flag, rule in spec.REJECTION_FLAGS.items()]
    return rejected.select(
        *base_cols, *reasons,
        (rejected_at if rejected_at is not None else F.current_timestamp()).alias(spec.REJECTED_AT_COLUMN),
    )


def rule_breakdown(flagged: DataFrame) -> DataFrame:
    """Per source file: rows read/written/rejected and failures per rule.

    Rows may fail several rules. One aggregate pass; the file is the key,
    so the shuffle carries one partial row per file per task.
    """
    amount_fail = {
        f"invalid_{c}": count_true(~rules.amount_valid(c, flagged.schema)) for c in spec.AMOUNT_COLUMNS
    }
    rule_fail = {r: count_true(~F.col(RULE_PREFIX + r)) for r in _rule_names()}
    return flagged.groupBy(F.col(spec.SOURCE_FILE_COLUMN).alias("source_file")).agg(
        F.count(F.lit(1)).alias("rows_read"),
        count_true(F.col("_valid")).alias("rows_written"),
        count_true(~F.col("_valid")).alias("rows_rejected"),
        F.lit(0).cast("bigint").alias("rows_rejected_duplicate"),
        count_true(~F.col("_valid")).alias("rows_quarantined"),
        rule_fail["timestamp_order"].alias("timestamp_order"),
        count_true(rules.zero_duration_warning()).alias("zero_duration_warning"),
        rule_fail["pickup_range"].alias("pickup_range"),
        rule_fail["distance"].alias("distance"),
        rule_fail["amounts"].alias("amounts"),
        rule_fail["passengers"].alias("passengers"),
        *[v.alias(k) for k, v in amount_fail.items()],
        F.bool_and(F.col("_file_ok")).alias("file_ok"),
    )


def outcome_rows(flagged: DataFrame, at: Column) -> DataFrame:
    """Every row of a usable file once, with its outcome, as Silver or as quarantine stores it.

    The columns are those of both tables; what belongs to the other outcome is
    NULL. The text flag of rejected rows has a column of its own (FLAG_TEXT),
    since Silver's flag is a number.
    """
    rule_cols = [RULE_PREFIX + r for r in spec.REJECTION_FLAGS.values()]
    rows = _derive(flagged.filter(F.col("_file_ok")), at, keep=("store_and_fwd_flag", "_valid", *rule_cols))
    both = [c for c in _base_columns(flagged) if c != "store_and_fwd_flag"]
    clean_only = [c for c in rows.columns if c not in (*both, "_valid", FLAG_TEXT, *rule_cols)]
    valid = F.col("_valid")
    return rows.select(
        *both, *[F.when(valid, F.col(c)).alias(c) for c in clean_only],
        F.when(~valid, F.col(FLAG_TEXT)).alias(FLAG_TEXT),
        *[F.when(~valid, ~F.col(RULE_PREFIX + rule)).alias(flag) for flag, rule in spec.REJECTION_FLAGS.items()],
        F.when(~valid, at).alias(spec.REJECTED_AT_COLUMN),
        F.when(valid, F.date_format("pickup_datetime", "yyyy-MM")).alias("pickup_month"),
        F.when(valid, F.lit(CLEAN)).otherwise(F.lit(REJECTED)).alias(OUTCOME),
    )


def outcome_metrics(rows: DataFrame, files: list[str]) -> list[Column]:
    """What `rule_breakdown` counts, of outcome rows, as one aggregate for each file and count (for an Observation)."""
    rejected = F.col(OUTCOME) == REJECTED
    counts = {
        "rows_written": ~rejected, "rows_rejected": rejected,
        "zero_duration_warning": rules.zero_duration_warning(),
        **{rule: F.coalesce(F.col(flag), F.lit(False)) for flag, rule in spec.REJECTION_FLAGS.items()},
        **{f"invalid_{c}": rejected & ~rules.amount_valid(c, rows.schema) for c in spec.AMOUNT_COLUMNS},
    }
    return [F.count_if((F.col(spec.SOURCE_FILE_COLUMN) == name) & cond).alias(f"{i}:{k}")
            for i, name in enumerate(files) for k, cond in counts.items()]


def breakdown_of_metrics(metrics: dict[str, int], files: list[str]) -> list[dict]:
    """One `rule_breakdown` row a file, from observed metrics."""
    out = []
    for i, name in enumerate(files):
        n = {k.split(":", 1)[1]: v for k, v in metrics.items() if k.startswith(f"{i}:")}
        out.append({"source_file": name, "rows_read": n["rows_written"] + n["rows_rejected"], "rows_written": n.pop("rows_written"),
                    "rows_rejected": n["rows_rejected"], "rows_rejected_duplicate": 0, "rows_quarantined": n.pop("rows_rejected"), **n})
    return out


@dataclass
class SilverResult:
    flagged: DataFrame
    silver: DataFrame
    quarantine: DataFrame


def clean(bronze: DataFrame, min_pickup: str = spec.MIN_PICKUP,
          max_pickup: str = spec.MAX_PICKUP) -> SilverResult:
    flagged = flag_rules(bronze, min_pickup, max_pickup)
    return SilverResult(flagged, silver_rows(flagged), quarantine_rows(flagged))
