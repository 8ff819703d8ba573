"""Declarative description of the trip tables: names, rules, dimensions.

Everything the operators need to know about a trip-like table lives here,
so the same functions run on any table that follows this spec.
"""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field, fields

# ---------------------------------------------------------------------------
# These must equal the original pipeline's for identical output
# (column names, rule bounds, file-name pattern, dimension and metric labels).
# ---------------------------------------------------------------------------

COLUMN_RENAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "RatecodeID": "ratecode_id",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
    "Airport_fee": "airport_fee",
}

REQUIRED_AMOUNT_COLUMNS = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "cbd_congestion_fee",
)
OPTIONAL_AMOUNT_COLUMNS = ("congestion_surcharge", "airport_fee")
AMOUNT_COLUMNS = REQUIRED_AMOUNT_COLUMNS + OPTIONAL_AMOUNT_COLUMNS

MIN_PICKUP = "2025-12-31 23:00:00"
MAX_PICKUP = "2026-04-01 01:00:00"

# Month of the raw file, taken from its name: `<anything>_YYYY-MM.parquet`.
SOURCE_MONTH_LABEL_REGEX = r"_(\d{4}-\d{2})\.parquet$"

SOURCE_FILE_COLUMN = "_bronze_source_file"
INGESTED_AT_COLUMN = "_bronze_ingested_at"
PROCESSED_AT_COLUMN = "_silver_processed_at"
REJECTED_AT_COLUMN = "_silver_rejected_at"
OFFSET_COLUMN = "_silver_source_month_offset"

# Quarantine flag column -> validity rule it inverts.
REJECTION_FLAGS = {
    "_invalid_timestamp_order": "timestamp_order",
    "_outside_pickup_range": "pickup_range",
    "_invalid_distance": "distance",
    "_invalid_amount": "amounts",
    "_invalid_passenger_count": "passengers",
}

WARNING_FLAGS = (
    "_silver_zero_duration",
    "_silver_zero_distance",
    "_silver_zero_fare",
    "_silver_zero_total",
    "_silver_total_less_than_fare",
)

PAYMENT_NULL_PROFILE_FIELDS = (
    "passenger_count",
    "ratecode_id",
    "airport_fee",
    "store_and_fwd_flag",
    "congestion_surcharge",
)

DATA_VARIANTS = (
    "all",
    "exclude_zero_duration",
    "exclude_zero_distance",
    "exclude_both",
)

MONTH_BASES = ("pickup_month", "source_month")
OVERALL_BASIS = "overall"

REJECTION_REASON_NAMES = {
    "_invalid_timestamp_order": "dropoff_before_pickup_or_invalid_timestamp",
    "_outside_pickup_range": "pickup_outside_project_range",
    "_invalid_distance": "negative_or_null_distance",
    "_invalid_amount": "negative_or_null_required_amount",
    "_invalid_passenger_count": "nonpositive_passenger_count",
}

WARNING_NAMES = {
    "_silver_zero_duration": "zero_duration",
    "_silver_zero_distance": "zero_distance",
    "_silver_zero_fare": "zero_fare_amount",
    "_silver_zero_total": "zero_total_amount",
    "_silver_total_less_than_fare": "total_less_than_fare",
}

ZERO_IMPACT_NAMES = (
    "zero_duration",
    "zero_distance",
    "zero_duration_or_distance",
    "zero_duration_and_distance",
)

# Fields whose joint absence marks a flex-fare trip (payment_type 0), in raw names.
FLEX_FARE_FIELDS_RAW = (
    "passenger_count",
    "RatecodeID",
    "congestion_surcharge",
    "store_and_fwd_flag",
    "Airport_fee",
)

# Table names (namespace, table) in the warehouse.
BRONZE_TABLE = "bronze.yellow_trips"
SILVER_TABLE = "silver.yellow_trips"
QUARANTINE_TABLE = "quarantine.yellow_trips_rejected"
INGESTION_LOG_TABLE = "metadata.ingestion_log"
TRANSFORM_LOG_TABLE = "metadata.transform_log"
GOLD_LOG_TABLE = "metadata.gold_transform_log"
GOLD_NAMESPACE = "gold"

GOLD_TABLES = (
    "daily_trip_summary",
    "monthly_kpi",
    "pickup_zone_monthly",
    "dropoff_zone_monthly",
    "zone_flow_monthly",
    "payment_monthly",
    "payment_zone_flow_monthly",
    "vendor_monthly",
    "vendor_zone_flow_monthly",
    "payment_null_profile",
    "data_quality_summary",
)


@dataclass(frozen=True)
class TableNames:
    """Where the tables lie in the warehouse, as namespace.table."""

    bronze: str = BRONZE_TABLE
    silver: str = SILVER_TABLE
    quarantine: str = QUARANTINE_TABLE
    ingestion_log: str = INGESTION_LOG_TABLE
    transform_log: str = TRANSFORM_LOG_TABLE
    gold_log: str = GOLD_LOG_TABLE
    gold_namespace: str = GOLD_NAMESPACE


@dataclass(frozen=True)
class PipelineConfig:
    """Run-time settings; the defaults mirror the original project config."""

    warehouse: str
    raw_dir: str | None = None
    min_pickup: str = MIN_PICKUP
    max_pickup: str = MAX_PICKUP
    # Gold tables are independent jobs; this many are submitted at once so
    # small tables do not leave the cluster idle while one table finishes.
    gold_concurrency: int = 4
    tables: TableNames = field(default_factory=TableNames)


def load_config(path: str, **given) -> PipelineConfig:
    """Settings from a TOML file: `warehouse`, `raw_dir`, `min_pickup`, `max_pickup`,
    `gold_concurrency` and a table `[tables]`; what is given otherwise (not None) goes first."""
    with open(path, "rb") as f:
        found = tomllib.load(f)
    tables = found.pop("tables", {})
    for where, have, known in (("settings", found, PipelineConfig), ("[tables]", tables, TableNames)):
        if unknown := set(have) - {f.name for f in fields(known)}:
            raise ValueError(f"{path}: unknown {where}: {', '.join(sorted(unknown))}")
    found |= {k: v for k, v in given.items() if v is not None}
    if not found.get("warehouse"):
        raise ValueError(f"{path}: warehouse is not set")
    return PipelineConfig(tables=TableNames(**tables), **{k: str(v) if k.endswith("_pickup") else v for k, v in found.items()})
