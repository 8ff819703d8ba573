"""Registered queries: name -> Spark builder, DuckDB twin, float columns.

Every builder takes (spark, sf_dir) and derives everything from the given
tables (trips come from `lineitem`, see sources/fixture.py), so its work grows
with them. Run-time stamps (processed/rejected/generated-at) are dropped from
the checked outputs because they differ per run.

Float sums depend on summation order (Spark and DuckDB add in different
orders), so for the cross-engine check every DOUBLE output column is passed
through `round(x * 2^20) / 2^20 + 0.0` on both sides. Scaling by a power of two
is exact, so both engines round the same double the same way, and a tie needs
a value that is an odd multiple of 2^-21, which averages of cent amounts or
whole seconds over fewer than 2^19 rows cannot be (decimal scales such as 1e-6
hit ties constantly on such data). The library itself keeps full precision.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from . import oracle, spec
from .operators import gold, quality, silver
from .sources.fixture import raw_trips

STABLE_SCALE = 1048576.0  # 2^20


def stable(df: DataFrame) -> DataFrame:
    """Round DOUBLE columns identically to the oracle side (check only)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append((F.round(F.col(f.name) * STABLE_SCALE, 0) / STABLE_SCALE + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def stable_sql(sql: str, double_cols: list[str]) -> str:
    if not double_cols:
        return sql
    repl = ", ".join(f"round(\"{c}\" * {STABLE_SCALE}) / {STABLE_SCALE} + 0.0 AS \"{c}\"" for c in double_cols)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS q"


@dataclass
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: list[str] = field(default_factory=list)


# ---------------------------------------------------------------------------
# Shared derivations (lazy; each query re-plans from the given tables).
# ---------------------------------------------------------------------------

def bronze_frame(spark: SparkSession, sf_dir: str, edge: bool = False) -> DataFrame:
    return raw_trips(spark, sf_dir, edge)


def flagged_table(spark: SparkSession, sf_dir: str, edge: bool = False) -> DataFrame:
    """Validated Bronze (raw rows + rule columns): lazy, so every query's own
    columns and filters reach the scan of the given table."""
    return silver.flag_rules(bronze_frame(spark, sf_dir, edge))


def silver_result(spark: SparkSession, sf_dir: str, edge: bool = False) -> silver.SilverResult:
    return split_trips(flagged_table(spark, sf_dir, edge))


def split_trips(flagged: DataFrame) -> silver.SilverResult:
    return silver.SilverResult(flagged, silver.silver_rows(flagged), silver.quarantine_rows(flagged))


def success_log(flagged: DataFrame) -> DataFrame:
    """Transform-ledger rows of a Silver run over the given Bronze rows."""
    stats = silver.rule_breakdown(flagged).filter(F.col("file_ok"))
    return stats.select("source_file", "rows_read", "rows_rejected", "rows_written")


def _silver_clean(spark, sf):
    return silver_result(spark, sf).silver.drop(spec.PROCESSED_AT_COLUMN)


def _quarantine(spark, sf):
    return silver_result(spark, sf).quarantine.drop(spec.REJECTED_AT_COLUMN)


def _rule_breakdown(spark, sf):
    return silver.rule_breakdown(silver_result(spark, sf).flagged)


def _gold(table):
    def run(spark, sf):
        return gold.build(silver_result(spark, sf).silver, table)
    return run


def _null_profile(spark, sf):
    return gold.payment_null_profile(silver_result(spark, sf).silver)


def quality_of(r: silver.SilverResult) -> DataFrame:
    bronze_rows = r.flagged.agg(F.count(F.lit(1)).alias("bronze_rows"))
    return quality.data_quality_summary(r.silver, r.quarantine, bronze_rows, success_log(r.flagged),
                                        with_run_columns=False)


def _dq(spark, sf):
    return quality_of(silver_result(spark, sf))


def _gold_doubles(table: str) -> list[str]:
    return [n for n, (kind, _) in gold.GOLD_DEFS[table].measures if kind in ("sum", "mean", "ratio")]


def core_queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "silver_clean": Query(_silver_clean, oracle.silver_sql(), oracle.SILVER_DOUBLES),
        "quarantine_flags": Query(_quarantine, oracle.quarantine_sql(), ["trip_distance", *spec.AMOUNT_COLUMNS]),
        "rule_breakdown": Query(_rule_breakdown, oracle.rule_breakdown_sql(), []),
    }
    aliases = {"payment_zone_flow": "payment_zone_flow_monthly", "vendor_zone_flow": "vendor_zone_flow_monthly"}
    for table in gold.GOLD_DEFS:
        name = {v: k for k, v in aliases.items()}.get(table, table)
        q[name] = Query(_gold(table), oracle.gold_sql(table), _gold_doubles(table))
    q["payment_null_profile"] = Query(_null_profile, oracle.payment_null_profile_sql(),
                                      ["null_percent", "all_profile_fields_null_percent"])
    q["data_quality_summary"] = Query(_dq, oracle.data_quality_sql(), ["metric_value", "metric_percent"])
    return q


def all_queries() -> dict[str, Query]:
    from .registry_more import more_queries  # it imports this module
    return core_queries() | more_queries()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda q: (lambda spark, sf: stable(q.build(spark, sf))))(q) for name, q in all_queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: stable_sql(q.sql, q.doubles) for name, q in all_queries().items() if q.sql}
