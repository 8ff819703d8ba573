"""DuckDB twins of the registered queries (the correctness oracle).

Each text runs on DuckDB with the driver's tables registered as views. The
trips are derived from `lineitem` with the same fixture SQL; everything after
that is written independently in plain SQL, in the literal form of the
original semantics (filter per variant, group per month basis, UNION ALL),
so agreement also checks the pre-aggregate + fan-out plans on the Spark side.
"""

from __future__ import annotations

from . import spec
from .sources.fixture import trips_sql

D = "::DOUBLE"
RX = r"_(\d{4})-(\d{2})\.parquet$"
RX_LABEL = r"_(\d{4}-\d{2})\.parquet$"


def _amount_rule(c: str) -> str:
    default = "true" if c in spec.OPTIONAL_AMOUNT_COLUMNS else "false"
    return f"coalesce({c} >= 0 AND NOT isnan({c}), {default})"


def base_ctes(edge: bool = False) -> str:
    """bronze, flagged (rules), silver, quarantine CTE bodies (no WITH)."""
    renamed = ", ".join(
        f"{k} AS {v}" for k, v in spec.COLUMN_RENAMES.items())
    amounts = " AND ".join(_amount_rule(c) for c in spec.AMOUNT_COLUMNS)
    return f"""
bronze AS ({trips_sql('duckdb', edge)}),
renamed AS (
  SELECT * EXCLUDE ({', '.join(spec.COLUMN_RENAMES)}), {renamed} FROM bronze),
flagged AS (
  SELECT *,
    coalesce(dropoff_datetime >= pickup_datetime, false) AS r_timestamp_order,
    coalesce(pickup_datetime >= TIMESTAMP '{spec.MIN_PICKUP}' AND pickup_datetime <= TIMESTAMP '{spec.MAX_PICKUP}', false) AS r_pickup_range,
    coalesce(trip_distance >= 0 AND NOT isnan(trip_distance), false) AS r_distance,
    ({amounts}) AS r_amounts,
    coalesce(passenger_count > 0, true) AS r_passengers,
    coalesce(regexp_matches(_bronze_source_file, '{RX}')
             AND TRY_CAST(regexp_extract(_bronze_source_file, '{RX}', 2) AS INTEGER) BETWEEN 1 AND 12, false) AS file_ok
  FROM renamed),
flagged2 AS (
  SELECT *, r_timestamp_order AND r_pickup_range AND r_distance AND r_amounts AND r_passengers AS is_valid
  FROM flagged),
silver0 AS (
  SELECT * EXCLUDE (store_and_fwd_flag),
    CAST(store_and_fwd_flag = 'Y' AS TINYINT) AS store_and_fwd_flag,
    CAST((year(pickup_datetime) * 12 + month(pickup_datetime))
      - (CAST(regexp_extract(_bronze_source_file, '{RX}', 1) AS INTEGER) * 12
         + CAST(regexp_extract(_bronze_source_file, '{RX}', 2) AS INTEGER)) AS INTEGER) AS _silver_source_month_offset,
    coalesce(dropoff_datetime = pickup_datetime, false) AS _silver_zero_duration,
    coalesce(trip_distance = 0, false) AS _silver_zero_distance,
    coalesce(fare_amount = 0, false) AS _silver_zero_fare,
    coalesce(total_amount = 0, false) AS _silver_zero_total,
    coalesce(total_amount < fare_amount, false) AS _silver_total_less_than_fare,
    CAST(epoch_us(dropoff_datetime) - epoch_us(pickup_datetime) AS DOUBLE) / 60000000.0{D} AS trip_duration_min
  FROM flagged2 WHERE is_valid AND file_ok),
silver AS (
  SELECT * EXCLUDE (r_timestamp_order, r_pickup_range, r_distance, r_amounts, r_passengers, file_ok, is_valid),
    CASE WHEN trip_duration_min > 0 THEN trip_distance * 60.0{D} / trip_duration_min END AS avg_speed_mph
  FROM silver0),
gsilver AS (
  SELECT *,
    CAST(pickup_datetime AS DATE) AS trip_date,
    strftime(pickup_datetime, '%Y-%m') AS pickup_month,
    nullif(regexp_extract(_bronze_source_file, '{RX_LABEL}', 1), '') AS source_month,
    CASE WHEN abs(avg_speed_mph) < 'inf'{D} THEN avg_speed_mph END AS finite_speed_mph
  FROM silver),
quarantine AS (
  SELECT * EXCLUDE (r_timestamp_order, r_pickup_range, r_distance, r_amounts, r_passengers, file_ok, is_valid),
    NOT r_timestamp_order AS _invalid_timestamp_order,
    NOT r_pickup_range AS _outside_pickup_range,
    NOT r_distance AS _invalid_distance,
    NOT r_amounts AS _invalid_amount,
    NOT r_passengers AS _invalid_passenger_count
  FROM flagged2 WHERE NOT is_valid AND file_ok)
"""


def with_base(body: str, edge: bool = False) -> str:
    return "WITH " + base_ctes(edge) + body


VARIANT_FILTERS = {
    "all": "true",
    "exclude_zero_duration": "NOT _silver_zero_duration",
    "exclude_zero_distance": "NOT _silver_zero_distance",
    "exclude_both": "NOT _silver_zero_duration AND NOT _silver_zero_distance",
}



def _mean(c: str, name: str | None = None) -> str:
    return f"avg({c}) AS avg_{name or c}"


def _sum(c: str, name: str | None = None) -> str:
    return f"CAST(sum({c}) AS DOUBLE) AS total_{name or c}"


_TRIPS = "count(*) AS trip_count"
_PASSENGERS = "CAST(coalesce(sum(passenger_count), 0) AS BIGINT) AS passenger_count_total"
_SPEED = _mean("finite_speed_mph", "speed_mph")
_KPI = [_TRIPS, _PASSENGERS, _sum("trip_distance"), _sum("fare_amount"), _sum("tip_amount"), _sum("total_amount", "revenue"),
        _mean("trip_distance"), _mean("trip_duration_min"), _SPEED, _mean("fare_amount"), _mean("total_amount")]
_ZONE = [_TRIPS, _sum("total_amount", "revenue"), _mean("total_amount"), _mean("fare_amount"), _mean("tip_amount"),
         _mean("trip_distance"), _mean("trip_duration_min"), _SPEED]
_PAYMENT = [_TRIPS, _sum("total_amount", "revenue"), _sum("fare_amount"), _sum("tip_amount"), _mean("total_amount"), _mean("fare_amount"),
            _mean("tip_amount"), "CASE WHEN sum(fare_amount) <> 0 THEN sum(tip_amount) / sum(fare_amount) END AS recorded_tip_to_fare_rate",
            _mean("trip_distance"), _mean("trip_duration_min")]
_PICKUP, _DROPOFF = "CAST(pickup_location_id AS INTEGER)", "CAST(dropoff_location_id AS INTEGER)"

#: Table -> (key column -> its expression, measures, whether it has months); written out here, apart from the Spark side.
GOLD = {
    "daily_trip_summary": ({"trip_date": "trip_date"}, _KPI, False),
    "monthly_kpi": ({}, _KPI, True),
    "pickup_zone_monthly": ({"pickup_location_id": _PICKUP}, _ZONE, True),
    "dropoff_zone_monthly": ({"dropoff_location_id": _DROPOFF}, _ZONE, True),
    "zone_flow_monthly": ({"pickup_location_id": _PICKUP, "dropoff_location_id": _DROPOFF}, _ZONE, True),
    "payment_monthly": ({"payment_type": "CAST(payment_type AS BIGINT)"}, _PAYMENT, True),
    "payment_zone_flow_monthly": (
        {"payment_type": "CAST(payment_type AS BIGINT)", "pickup_location_id": _PICKUP, "dropoff_location_id": _DROPOFF}, _ZONE, True),
    "vendor_monthly": ({"vendor_id": "CAST(vendor_id AS INTEGER)"}, _ZONE, True),
    "vendor_zone_flow_monthly": (
        {"vendor_id": "CAST(vendor_id AS INTEGER)", "pickup_location_id": _PICKUP, "dropoff_location_id": _DROPOFF}, _ZONE, True),
}


def gold_sql(table: str) -> str:
    return with_base("\n" + gold_body(table))


def gold_body(table: str) -> str:
    """Literal form: 4 filtered copies x (1 or 2) bases, UNION ALL."""
    keys, measures, monthly = GOLD[table]
    parts = []
    for variant, cond in VARIANT_FILTERS.items():
        for basis in ("pickup_month", "source_month") if monthly else (None,):
            lead = [f"'{variant}' AS data_variant"] + ([f"'{basis}' AS month_basis", f"{basis} AS year_month"] if basis else [])
            by = [*([basis] if basis else []), *keys]
            parts.append(f"SELECT {', '.join([*lead, *(f'{e} AS {k}' for k, e in keys.items()), *measures])} FROM gsilver WHERE {cond}"
                         + (f" GROUP BY {', '.join(by)}" if by else ""))
    return "\nUNION ALL\n".join(parts)


def payment_null_profile_sql() -> str:
    return with_base("\nSELECT * FROM (" + payment_null_profile_body() + ") AS pnp")


def payment_null_profile_body() -> str:
    fields = spec.PAYMENT_NULL_PROFILE_FIELDS
    all_null = " AND ".join(f"{f} IS NULL" for f in fields)
    per_variant = []
    for variant, cond in VARIANT_FILTERS.items():
        per_variant.append(
            f"SELECT '{variant}' AS data_variant, payment_type, count(*) AS row_count, "
            + ", ".join(f"count(*) FILTER (WHERE {f} IS NULL) AS n_{f}" for f in fields)
            + f", count(*) FILTER (WHERE {all_null}) AS all_null FROM silver WHERE {cond} GROUP BY payment_type")
    grouped = "\nUNION ALL\n".join(per_variant)
    longs = "\nUNION ALL\n".join(
        f"SELECT data_variant, payment_type, '{f}' AS field_name, row_count, n_{f} AS null_count, all_null FROM g"
        for f in fields)
    return (f"""WITH
g AS ({grouped}),
l AS ({longs})
SELECT data_variant, CAST(payment_type AS BIGINT) AS payment_type, field_name,
  CAST(row_count AS BIGINT) AS row_count, CAST(null_count AS BIGINT) AS null_count,
  CASE WHEN row_count <> 0 THEN null_count{D} / row_count{D} * 100.0{D} END AS null_percent,
  CAST(all_null AS BIGINT) AS all_profile_fields_null_count,
  CASE WHEN row_count <> 0 THEN all_null{D} / row_count{D} * 100.0{D} END AS all_profile_fields_null_percent
FROM l""")


SILVER_DOUBLES = ["trip_distance", *spec.AMOUNT_COLUMNS, "trip_duration_min", "avg_speed_mph"]


def silver_sql() -> str:
    return with_base("SELECT * FROM silver")


def quarantine_sql() -> str:
    return with_base("SELECT * FROM quarantine")


def rule_breakdown_sql() -> str:
    amount_fail = ",\n  ".join(
        f"count(*) FILTER (WHERE NOT {_amount_rule(c)}) AS invalid_{c}" for c in spec.AMOUNT_COLUMNS)
    return with_base(f"""
SELECT _bronze_source_file AS source_file,
  count(*) AS rows_read,
  count(*) FILTER (WHERE is_valid) AS rows_written,
  count(*) FILTER (WHERE NOT is_valid) AS rows_rejected,
  CAST(0 AS BIGINT) AS rows_rejected_duplicate,
  count(*) FILTER (WHERE NOT is_valid) AS rows_quarantined,
  count(*) FILTER (WHERE NOT r_timestamp_order) AS timestamp_order,
  count(*) FILTER (WHERE coalesce(dropoff_datetime = pickup_datetime, false)) AS zero_duration_warning,
  count(*) FILTER (WHERE NOT r_pickup_range) AS pickup_range,
  count(*) FILTER (WHERE NOT r_distance) AS distance,
  count(*) FILTER (WHERE NOT r_amounts) AS amounts,
  count(*) FILTER (WHERE NOT r_passengers) AS passengers,
  {amount_fail},
  bool_and(file_ok) AS file_ok
FROM flagged2 GROUP BY _bronze_source_file""")


def pct(part: str, whole: str) -> str:
    return f"CASE WHEN ({whole}) <> 0 THEN ({part}){D} / ({whole}){D} * 100.0{D} END"


def _label(col: str) -> str:
    return f"nullif(regexp_extract({col}, '{RX_LABEL}', 1), '')"


def _metric(basis: str, source_file: str, source_month: str, category: str, name: str, value: str,
            percent: str, denominator: str, src: str) -> str:
    return (f"SELECT {basis} AS month_basis, {source_file} AS source_file, {source_month} AS source_month, "
            f"'{category}' AS metric_category, {name} AS metric_name, CAST({value} AS DOUBLE) AS metric_value, "
            f"CAST({percent} AS DOUBLE) AS metric_percent, '{denominator}' AS percent_denominator FROM {src}")


def data_quality_sql() -> str:
    return with_base("\nSELECT * FROM (" + data_quality_body() + ") AS dq")


def data_quality_body() -> str:
    ov = "'overall'"
    nul = "CAST(NULL AS VARCHAR)"
    parts = []
    # pipeline
    for name, value in (("bronze_rows", "b.bronze_rows"), ("silver_rows", "s.silver_rows"),
                        ("rows_rejected_unique", "q.rejected"),
                        ("rows_accounted_for", "s.silver_rows + q.rejected")):
        percent = "100.0" if name == "bronze_rows" else pct(value, "b.bronze_rows")
        parts.append(_metric(ov, nul, nul, "pipeline", f"'{name}'", value, percent, "bronze_rows",
                             "b, s, q"))
    # pipeline_file
    for name in ("rows_read", "rows_written", "rows_rejected"):
        percent = "100.0" if name == "rows_read" else pct(name, "rows_read")
        parts.append(_metric(ov, "source_file", _label("source_file"), "pipeline_file", f"'{name}'", name,
                             percent, "file_rows_read", "tlog"))
    # rejection_reason / rejection_detail
    for flag, name in spec.REJECTION_REASON_NAMES.items():
        parts.append(_metric(ov, nul, nul, "rejection_reason", f"'{name}'", f"q.{flag}",
                             pct(f"q.{flag}", "q.rejected"), "rejected_rows", "q"))
    for name in ("negative_trip_distance", "negative_fare_amount", "negative_total_amount",
                 "dropoff_before_pickup"):
        parts.append(_metric(ov, nul, nul, "rejection_detail", f"'{name}'", f"q.{name}",
                             pct(f"q.{name}", "q.rejected"), "rejected_rows", "q"))
    # silver_warning
    for flag, name in spec.WARNING_NAMES.items():
        parts.append(_metric(ov, nul, nul, "silver_warning", f"'{name}'", f"w.{name}",
                             pct(f"w.{name}", "w.rows"), "silver_rows", "w"))
    # month_offset, month_offset_file
    parts.append(_metric(ov, nul, nul, "month_offset", "'offset_' || CAST(off AS VARCHAR)", "n",
                         pct("n", "(SELECT silver_rows FROM s)"), "silver_rows", "offs"))
    parts.append(_metric(ov, "f", _label("f"), "month_offset_file", "'offset_' || CAST(off AS VARCHAR)", "n",
                         pct("n", "file_rows"), "silver_rows_in_source_file", "offf"))
    # zero filters overall and per month
    for name in spec.ZERO_IMPACT_NAMES:
        parts.append(_metric(ov, nul, nul, "zero_filter_impact", f"'{name}'", f"w.{name}",
                             pct(f"w.{name}", "w.rows"), "silver_rows", "w"))
    for variant in spec.DATA_VARIANTS:
        parts.append(_metric(ov, nul, nul, "zero_filter_remaining", f"'{variant}'", f"w.v_{variant}",
                             pct(f"w.v_{variant}", "w.rows"), "silver_rows", "w"))
    for name in spec.ZERO_IMPACT_NAMES:
        parts.append(_metric("basis", nul, "month", "zero_filter_impact_month", f"'{name}'", name,
                             pct(name, "rows"), "silver_rows_in_month", "mw"))
    for variant in spec.DATA_VARIANTS:
        parts.append(_metric("basis", nul, "month", "zero_filter_remaining_month", f"'{variant}'",
                             f"v_{variant}", pct(f"v_{variant}", "rows"), "silver_rows_in_month", "mw"))
    zero_cols = """count(*) AS rows,
    count(*) FILTER (WHERE _silver_zero_duration) AS zero_duration,
    count(*) FILTER (WHERE _silver_zero_distance) AS zero_distance,
    count(*) FILTER (WHERE _silver_zero_duration OR _silver_zero_distance) AS zero_duration_or_distance,
    count(*) FILTER (WHERE _silver_zero_duration AND _silver_zero_distance) AS zero_duration_and_distance,
    count(*) FILTER (WHERE _silver_zero_fare) AS zero_fare_amount,
    count(*) FILTER (WHERE _silver_zero_total) AS zero_total_amount,
    count(*) FILTER (WHERE _silver_total_less_than_fare) AS total_less_than_fare,
    count(*) AS v_all,
    count(*) FILTER (WHERE NOT _silver_zero_duration) AS v_exclude_zero_duration,
    count(*) FILTER (WHERE NOT _silver_zero_distance) AS v_exclude_zero_distance,
    count(*) FILTER (WHERE NOT _silver_zero_duration AND NOT _silver_zero_distance) AS v_exclude_both"""
    return (f"""WITH
tlog AS (
  SELECT _bronze_source_file AS source_file, count(*) AS rows_read,
    count(*) FILTER (WHERE is_valid) AS rows_written, count(*) FILTER (WHERE NOT is_valid) AS rows_rejected
  FROM flagged2 WHERE file_ok GROUP BY 1),
b AS (SELECT count(*) AS bronze_rows FROM bronze),
s AS (SELECT count(*) AS silver_rows FROM silver),
q AS (SELECT count(*) AS rejected,
    count(*) FILTER (WHERE _invalid_timestamp_order) AS _invalid_timestamp_order,
    count(*) FILTER (WHERE _outside_pickup_range) AS _outside_pickup_range,
    count(*) FILTER (WHERE _invalid_distance) AS _invalid_distance,
    count(*) FILTER (WHERE _invalid_amount) AS _invalid_amount,
    count(*) FILTER (WHERE _invalid_passenger_count) AS _invalid_passenger_count,
    count(*) FILTER (WHERE trip_distance < 0) AS negative_trip_distance,
    count(*) FILTER (WHERE fare_amount < 0) AS negative_fare_amount,
    count(*) FILTER (WHERE total_amount < 0) AS negative_total_amount,
    count(*) FILTER (WHERE dropoff_datetime < pickup_datetime) AS dropoff_before_pickup
  FROM quarantine),
w AS (SELECT {zero_cols} FROM silver),
mw AS (
  SELECT 'pickup_month' AS basis, pickup_month AS month, {zero_cols} FROM gsilver
  WHERE pickup_month IS NOT NULL GROUP BY pickup_month
  UNION ALL
  SELECT 'source_month' AS basis, source_month AS month, {zero_cols} FROM gsilver
  WHERE source_month IS NOT NULL GROUP BY source_month),
offs AS (SELECT _silver_source_month_offset AS off, count(*) AS n FROM silver GROUP BY 1),
offf AS (
  SELECT _bronze_source_file AS f, _silver_source_month_offset AS off, count(*) AS n,
    sum(count(*)) OVER (PARTITION BY _bronze_source_file) AS file_rows
  FROM silver GROUP BY 1, 2)
""" + "\nUNION ALL\n".join(parts))


def with_tables(tables: dict[str, str], body: str, edge: bool = False) -> str:
    """Base CTEs plus named derived tables (name -> SQL body), then `body`."""
    extra = "".join(f",\n{name} AS (\n{sql}\n)" for name, sql in tables.items())
    return with_base(extra + "\n" + body, edge)


def gold_tables(*names: str) -> dict[str, str]:
    out = {}
    for n in names:
        if n == "payment_null_profile":
            out[n] = payment_null_profile_body()
        elif n == "data_quality_summary":
            out[n] = data_quality_body()
        else:
            out[n] = gold_body(n)
    return out
