"""Registered queries beyond the core tables: incremental selection,
profiling/validation jobs, reports and dashboard operators, Gold checks, and
runs of the file-based pipeline.

Each entry pairs the Spark builder with its DuckDB twin, which is written by
itself. Where the plain trips would leave a check at zero, the edge trips
(sources/fixture.py) or deliberately broken tables give it something to find.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import oracle as O
from . import spec
from .operators import bronze as B
from .operators import checks, gold, profile, quality, relations, reports
from .plans import duplicates, pipeline
from .registry import Query, flagged_table, quality_of, silver_result, split_trips, success_log
from .session import scratch_dir
from .sources.fixture import RAW_COLUMNS, RAW_NUMERIC_COLUMNS, raw_trips

WB = O.with_base
WT = O.with_tables


def WE(body: str) -> str:
    """A twin over the edge trips."""
    return O.with_base(body, edge=True)


# ---------------------------------------------------------------------------
# Shared Spark derivations
# ---------------------------------------------------------------------------

def _bronze(spark, sf) -> DataFrame:
    return raw_trips(spark, sf)


def _transform_log(flagged: DataFrame) -> DataFrame:
    return success_log(flagged).select(
        F.lit(spec.BRONZE_TABLE).alias("source_table"), "source_file",
        F.lit(spec.SILVER_TABLE).alias("target_table"), F.lit("success").alias("status"),
        "rows_read", "rows_rejected", "rows_written")


def _gold_frames(spark, sf, names, variant: str | None = None, basis: str | None = None) -> dict[str, DataFrame]:
    """Gold tables by name; given a variant and a basis, only that slice is built."""
    r = silver_result(spark, sf)
    variants, bases = (variant,) if variant else None, (basis,) if basis else None
    out = {}
    for n in names:
        if n == "payment_null_profile":
            out[n] = gold.payment_null_profile(r.silver)
        elif n == "data_quality_summary":
            out[n] = quality_of(r)
        else:
            out[n] = gold.build(r.silver, n, variants, bases)
    return out


def _report(report: str, params: dict, row_limit: int | None, extra_order: tuple[str, ...]):
    r = reports.REPORTS[report]

    def run(spark, sf):
        frame = _gold_frames(spark, sf, [r.table], params.get("data_variant"), params.get("month_basis"))[r.table]
        rows = reports.run_report(report, frame, params, row_limit, extra_order)
        return reports.numbered(rows, [reports.order_key(k) for k in (*r.order, *extra_order)])
    return run


GOLD_DOUBLES = {t: [n for n, (k, _) in gold.GOLD_DEFS[t].measures if k in ("sum", "mean", "ratio")]
                for t in gold.GOLD_DEFS}
GOLD_DOUBLES["payment_null_profile"] = ["null_percent", "all_profile_fields_null_percent"]
GOLD_DOUBLES["data_quality_summary"] = ["metric_value", "metric_percent"]

#: Query -> (report, parameters, row limit, order of ties, and the twin's table, condition and order).
REPORT_QUERIES = {
    "report_daily": ("daily_metrics", {"data_variant": "all"}, None, (), "data_variant = 'all'", "trip_date"),
    "report_monthly": ("monthly_kpi", {"data_variant": "all", "month_basis": "pickup_month"}, None, (),
                       "data_variant = 'all' AND month_basis = 'pickup_month'", "year_month"),
    "report_monthly_source": ("monthly_kpi", {"data_variant": "all", "month_basis": "source_month"}, None, (),
                              "data_variant = 'all' AND month_basis = 'source_month'", "year_month"),
    "report_zone_topk": ("zone_analysis", {"data_variant": "all", "month_basis": "pickup_month", "pickup_location_id": 132}, 25, (),
                         "data_variant = 'all' AND month_basis = 'pickup_month' AND pickup_location_id = 132",
                         "trip_count DESC, year_month, pickup_location_id, dropoff_location_id"),
    "report_payment": ("payment_analysis", {"data_variant": "all", "month_basis": "source_month"}, None, (),
                       "data_variant = 'all' AND month_basis = 'source_month'", "year_month, payment_type"),
    "report_vendor": ("vendor_analysis", {"data_variant": "all", "month_basis": "pickup_month", "vendor_id": None}, None, (),
                      "data_variant = 'all' AND month_basis = 'pickup_month'", "year_month, vendor_id"),
    "report_vendor_one": ("vendor_analysis", {"data_variant": "all", "month_basis": "pickup_month", "vendor_id": 2}, None, (),
                          "data_variant = 'all' AND month_basis = 'pickup_month' AND vendor_id = 2", "year_month, vendor_id"),
    "report_quality": ("data_quality", {"month_basis": "overall", "metric_category": "silver_warning"}, None, (),
                       "month_basis = 'overall' AND metric_category = 'silver_warning'", "metric_name"),
    "report_quality_month": ("data_quality", {"month_basis": "pickup_month", "metric_category": "zero_filter_impact_month"}, None, (),
                             "month_basis = 'pickup_month' AND metric_category = 'zero_filter_impact_month'", "source_month, metric_name"),
    "report_quality_all": ("data_quality", {}, None, ("source_file",), "true",
                           "month_basis ASC, source_month ASC NULLS FIRST, metric_category, metric_name, source_file ASC NULLS LAST"),
    "report_null_profile": ("payment_null_profile", {"data_variant": "all", "payment_type": 0}, None, (),
                            "data_variant = 'all' AND payment_type = 0", "payment_type, field_name"),
}


def _report_sql(report: str, row_limit: int | None, where: str, order: str) -> str:
    table = reports.REPORTS[report].table
    limit = f" WHERE row_no <= {row_limit}" if row_limit else ""
    return WT(O.gold_tables(table), f"SELECT * FROM (SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS row_no "
                                    f"FROM {table} WHERE {where}) t{limit}")


# ---------------------------------------------------------------------------
# Bronze / incremental
# ---------------------------------------------------------------------------

def bronze_queries() -> dict[str, Query]:
    q = {}
    q["bronze_lineage"] = Query(
        lambda s, sf: B.ingestion_summary(_bronze(s, sf)),
        WB(f"""SELECT _bronze_source_file AS source_file, '{spec.BRONZE_TABLE}' AS target_table,
  'success' AS status, count(*) AS row_count FROM bronze GROUP BY 1"""))

    def _files(s, sf):
        return B.ingestion_summary(raw_trips(s, sf, edge=True)).select("source_file", "row_count")

    def _ledger(s, sf):
        """The first two months succeeded, the third failed, the fourth is new."""
        log = _transform_log(silver_result(s, sf).flagged)
        return log.withColumn("status", F.when(F.col("source_file") == "demo_tripdata_2026-03.parquet", "failed").otherwise(F.col("status")))

    def _pending(s, sf):
        return B.pending_files(_files(s, sf), _ledger(s, sf), spec.SILVER_TABLE)

    def _status(s, sf):
        return B.file_status(_files(s, sf), _ledger(s, sf), spec.SILVER_TABLE)

    files_sql = "SELECT _bronze_source_file AS source_file, count(*) AS row_count FROM bronze GROUP BY 1"
    done_sql = "SELECT unnest(['demo_tripdata_2026-01.parquet', 'demo_tripdata_2026-02.parquet'])"
    q["incremental_pending_files"] = Query(_pending, WE(
        f"SELECT f.* FROM ({files_sql}) f WHERE f.source_file NOT IN ({done_sql})"))
    q["incremental_file_status"] = Query(_status, WE(
        f"SELECT f.*, f.source_file IN ({done_sql}) AS already_processed FROM ({files_sql}) f"))
    return q


# ---------------------------------------------------------------------------
# Silver validation
# ---------------------------------------------------------------------------

def _offset_expr() -> str:
    return (f"CAST((year(pickup_datetime) * 12 + month(pickup_datetime)) - "
            f"(CAST(regexp_extract(_bronze_source_file, '{O.RX}', 1) AS INTEGER) * 12 + "
            f"CAST(regexp_extract(_bronze_source_file, '{O.RX}', 2) AS INTEGER)) AS INTEGER)")


#: Faults put into Silver: column -> expression (the same text in Spark and DuckDB).
BROKEN_SILVER = {
    "pickup_datetime": "CASE WHEN pickup_location_id % 31 = 1 THEN pickup_datetime + INTERVAL '400' DAY WHEN pickup_location_id % 31 = 2 "
                       "THEN pickup_datetime - INTERVAL '400' DAY WHEN pickup_location_id % 31 = 3 THEN NULL ELSE pickup_datetime END",
    "dropoff_datetime": "CASE WHEN pickup_location_id % 29 = 1 THEN NULL WHEN pickup_location_id % 29 = 2 "
                        "THEN dropoff_datetime - INTERVAL '3' DAY ELSE dropoff_datetime END",
    "trip_distance": "CASE WHEN pickup_location_id % 37 = 1 THEN -1 - trip_distance ELSE trip_distance END",
    "passenger_count": "CASE WHEN pickup_location_id % 37 = 2 THEN passenger_count - passenger_count ELSE passenger_count END",
    **{c: f"CASE WHEN pickup_location_id % 37 = {5 + i} THEN {c} - 1000 WHEN pickup_location_id % 37 = {17 + i} THEN NULL ELSE {c} END"
       for i, c in enumerate(spec.AMOUNT_COLUMNS)},
    "trip_duration_min": "CASE WHEN pickup_location_id % 41 = 1 THEN trip_duration_min + 1 WHEN pickup_location_id % 41 = 2 "
                         "THEN -1 - trip_duration_min WHEN pickup_location_id % 41 = 3 THEN NULL ELSE trip_duration_min END",
    "avg_speed_mph": "CASE WHEN pickup_location_id % 41 = 4 THEN NULL WHEN pickup_location_id % 41 = 5 THEN -1 - avg_speed_mph "
                     "WHEN pickup_location_id % 41 = 6 THEN avg_speed_mph + 1000 ELSE avg_speed_mph END",
    "_silver_source_month_offset": "CASE WHEN pickup_location_id % 43 = 1 THEN _silver_source_month_offset + 1 ELSE _silver_source_month_offset END",
}


def _broken_silver(s, sf) -> DataFrame:
    return silver_result(s, sf).silver.withColumns({c: F.expr(e) for c, e in BROKEN_SILVER.items()})


def silver_queries() -> dict[str, Query]:
    q = {}
    q["month_offset_hist"] = Query(
        lambda s, sf: profile.month_offset_hist(silver_result(s, sf).silver),
        WB("SELECT _silver_source_month_offset, count(*) AS count FROM silver GROUP BY 1"))

    expected = {
        "_silver_zero_duration": "coalesce(dropoff_datetime = pickup_datetime, false)",
        "_silver_zero_distance": "coalesce(trip_distance = 0, false)",
        "_silver_zero_fare": "coalesce(fare_amount = 0, false)",
        "_silver_zero_total": "coalesce(total_amount = 0, false)",
        "_silver_total_less_than_fare": "coalesce(total_amount < fare_amount, false)",
    }
    cols = [f"count(*) FILTER (WHERE {f}) AS {f.removeprefix('_silver_')}" for f in spec.WARNING_FLAGS]
    cols.append(f"count(*) FILTER (WHERE _silver_source_month_offset <> {_offset_expr()}) "
                "AS source_month_offset_mismatch")
    cols += [f"count(*) FILTER (WHERE {f} <> {e}) AS {f.removeprefix('_silver_')}_mismatch"
             for f, e in expected.items()]
    q["warning_totals"] = Query(lambda s, sf: profile.warning_totals(silver_result(s, sf).silver),
                                WB("SELECT " + ",\n  ".join(cols) + " FROM silver"))

    amt = [f"count(*) FILTER (WHERE {c} IS NULL OR {c} < 0) AS {c}" for c in spec.REQUIRED_AMOUNT_COLUMNS]
    amt += [f"count(*) FILTER (WHERE {c} IS NOT NULL AND {c} < 0) AS {c}" for c in spec.OPTIONAL_AMOUNT_COLUMNS]
    reval = f"""SELECT
  count(*) FILTER (WHERE pickup_datetime IS NULL) AS missing_pickup,
  count(*) FILTER (WHERE dropoff_datetime IS NULL) AS missing_dropoff,
  count(*) FILTER (WHERE dropoff_datetime < pickup_datetime) AS dropoff_before_pickup,
  count(*) FILTER (WHERE pickup_datetime < TIMESTAMP '{spec.MIN_PICKUP}') AS pickup_before_window,
  count(*) FILTER (WHERE pickup_datetime > TIMESTAMP '{spec.MAX_PICKUP}') AS pickup_after_window,
  count(*) FILTER (WHERE trip_distance IS NULL OR trip_distance < 0) AS negative_or_null_distance,
  count(*) FILTER (WHERE passenger_count IS NOT NULL AND passenger_count <= 0) AS nonpositive_passenger_count,
  {', '.join(amt)},
  count(*) FILTER (WHERE trip_duration_min IS NULL OR trip_duration_min < 0) AS negative_or_null_duration,
  count(*) FILTER (WHERE trip_duration_min = 0) AS zero_duration,
  count(*) FILTER (WHERE abs(trip_duration_min - (epoch(dropoff_datetime) - epoch(pickup_datetime)) / 60.0)
                   > 1e-6) AS duration_mismatch,
  count(*) FILTER (WHERE (avg_speed_mph IS NULL) <> (trip_duration_min = 0)) AS speed_null_mismatch,
  count(*) FILTER (WHERE avg_speed_mph < 0) AS negative_speed,
  count(*) FILTER (WHERE avg_speed_mph = 0) AS zero_speed,
  count(*) FILTER (WHERE avg_speed_mph > 100) AS speed_above_100_mph
FROM silver"""
    q["silver_revalidation"] = Query(lambda s, sf: profile.silver_revalidation(silver_result(s, sf).silver),
                                     WB(reval))
    # The same checks over a Silver with every kind of fault in it.
    replaced = ", ".join(f"{e} AS {c}" for c, e in BROKEN_SILVER.items())
    q["silver_revalidation_broken"] = Query(
        lambda s, sf: profile.silver_revalidation(_broken_silver(s, sf)),
        WB(f", broken AS (SELECT * REPLACE ({replaced}) FROM silver)\n" + reval.replace("FROM silver", "FROM broken")))
    q["warning_totals_broken"] = Query(
        lambda s, sf: profile.warning_totals(_broken_silver(s, sf)),
        WB(f", broken AS (SELECT * REPLACE ({replaced}) FROM silver)\nSELECT " + ",\n  ".join(cols) + " FROM broken"))
    q["month_by_file"] = Query(
        lambda s, sf: profile.month_by_file(silver_result(s, sf).silver),
        WB("""SELECT strftime(pickup_datetime, '%Y-%m') AS pickup_month, _bronze_source_file, count(*) AS rows,
  count(*) FILTER (WHERE _silver_source_month_offset <> 0) AS off_month FROM silver GROUP BY 1, 2"""))
    q["freq_store_flag"] = Query(
        lambda s, sf: profile.frequency(silver_result(s, sf).silver, "store_and_fwd_flag"),
        WB("SELECT store_and_fwd_flag, count(*) AS count FROM silver GROUP BY 1"))
    flags = ", ".join(spec.REJECTION_FLAGS)
    q["rejection_combos"] = Query(
        lambda s, sf: profile.rejection_combos(silver_result(s, sf).quarantine),
        WB(f"SELECT {flags}, count(*) AS count FROM quarantine GROUP BY {flags}"))
    none = " AND ".join(f"NOT {f}" for f in spec.REJECTION_FLAGS)
    q["quarantine_no_reason"] = Query(
        lambda s, sf: profile.quarantine_no_reason(silver_result(s, sf).quarantine),
        WB(f"SELECT count(*) AS quarantined_rows, count(*) FILTER (WHERE {none}) AS rows_without_reason "
           "FROM quarantine"))
    cleared = ", ".join(f"({f} AND pickup_location_id % 10 <> 0) AS {f}" for f in spec.REJECTION_FLAGS)
    q["quarantine_no_reason_broken"] = Query(
        lambda s, sf: profile.quarantine_no_reason(silver_result(s, sf).quarantine.withColumns(
            {f: F.col(f) & (F.col("pickup_location_id") % 10 != 0) for f in spec.REJECTION_FLAGS})),
        WB(f", broken AS (SELECT * REPLACE ({cleared}) FROM quarantine)\nSELECT count(*) AS quarantined_rows, "
           f"count(*) FILTER (WHERE {none}) AS rows_without_reason FROM broken"))

    def _dups(s, sf):
        r = silver_result(s, sf, edge=True)
        b = profile.bronze_duplicates(raw_trips(s, sf, edge=True)).select(F.lit("bronze").alias("table"), "*")
        sv = profile.silver_duplicates(r.silver).select(F.lit("silver").alias("table"), "*")
        return b.unionByName(sv)

    dup_sql = """SELECT 'bronze' AS "table", count(*) AS duplicate_groups,
  CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT * EXCLUDE (_bronze_source_file), count(*) AS c FROM bronze GROUP BY ALL HAVING count(*) > 1) d
UNION ALL
SELECT 'silver' AS "table", count(*) AS duplicate_groups, CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT *, count(*) AS c FROM silver GROUP BY ALL HAVING count(*) > 1) d"""
    q["duplicates"] = Query(_dups, WE(dup_sql))

    def _ledger(s, sf):
        r = silver_result(s, sf)
        return profile.ledger_balance(_transform_log(r.flagged), r.silver, r.quarantine)

    q["ledger_balance"] = Query(_ledger, WB("""SELECT
  count(*) FILTER (WHERE rows_read <> rows_written + rows_rejected) AS unbalanced_entries,
  CAST(coalesce(sum(rows_read), 0) AS BIGINT) AS log_rows_read,
  CAST(coalesce(sum(rows_rejected), 0) AS BIGINT) AS log_rows_rejected,
  CAST(coalesce(sum(rows_written), 0) AS BIGINT) AS log_rows_written,
  (SELECT count(*) FROM silver) AS silver_rows,
  (SELECT count(*) FROM quarantine) AS quarantine_rows,
  CAST(coalesce(sum(rows_rejected), 0) AS BIGINT) = (SELECT count(*) FROM quarantine) AS log_matches_quarantine,
  CAST(coalesce(sum(rows_written), 0) AS BIGINT) = (SELECT count(*) FROM silver) AS log_matches_silver
FROM (SELECT _bronze_source_file, count(*) AS rows_read, count(*) FILTER (WHERE is_valid) AS rows_written,
        count(*) FILTER (WHERE NOT is_valid) AS rows_rejected FROM flagged2 WHERE file_ok GROUP BY 1) l"""))

    def _balance(s, sf):
        r = silver_result(s, sf)
        return quality.source_balance(r.flagged.agg(F.count(F.lit(1)).alias("bronze_rows")), r.silver, r.quarantine)

    q["source_balance"] = Query(_balance, WB("""SELECT b.n AS bronze_rows, s.n AS silver_rows,
  q.n AS quarantine_rows, s.n + q.n AS accounted_rows, (b.n = 0 OR s.n + q.n = b.n) AS balanced
FROM (SELECT count(*) AS n FROM bronze) b, (SELECT count(*) AS n FROM silver) s,
     (SELECT count(*) AS n FROM quarantine) q"""))
    return q


# ---------------------------------------------------------------------------
# Bronze profiling
# ---------------------------------------------------------------------------

def _r2(x: str) -> str:
    return f"round(({x}) * 100.0) / 100.0"


def _share(cnt: str) -> str:
    return f"CASE WHEN count(*) <> 0 THEN {_r2(f'({cnt})::DOUBLE / count(*)::DOUBLE * 100.0')} ELSE 0.0 END"


def profile_queries() -> dict[str, Query]:
    q = {}
    nulls = "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE "{c}" IS NULL) AS null_count,
  {_share(f'count(*) FILTER (WHERE "{c}" IS NULL)')} AS null_percentage FROM bronze""" for c in RAW_COLUMNS)
    q["null_summary"] = Query(lambda s, sf: profile.null_summary(_bronze(s, sf)), WB(nulls), ["null_percentage"])
    negs = "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE "{c}" < 0) AS negative_count,
  {_share(f'count(*) FILTER (WHERE "{c}" < 0)')} AS negative_percentage FROM bronze"""
        for c in RAW_NUMERIC_COLUMNS)
    q["negative_summary"] = Query(lambda s, sf: profile.negative_summary(_bronze(s, sf)), WB(negs),
                                  ["negative_percentage"])
    anyneg = " OR ".join(f'"{c}" < 0' for c in RAW_NUMERIC_COLUMNS)
    q["negative_rows"] = Query(
        lambda s, sf: profile.negative_rows(_bronze(s, sf)),
        WB(f"SELECT count(*) FILTER (WHERE {anyneg}) AS negative_row_count, "
           f"{_share(f'count(*) FILTER (WHERE {anyneg})')} AS negative_percentage FROM bronze"),
        ["negative_percentage"])
    numeric = "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", count("{c}") AS count, CAST(avg("{c}") AS DOUBLE) AS mean, stddev_samp("{c}") AS stddev,
  CAST(min("{c}") AS DOUBLE) AS min, quantile_cont("{c}"::DOUBLE, 0.25) AS p25, quantile_cont("{c}"::DOUBLE, 0.5) AS p50,
  quantile_cont("{c}"::DOUBLE, 0.75) AS p75, CAST(max("{c}") AS DOUBLE) AS max FROM bronze""" for c in RAW_NUMERIC_COLUMNS)
    q["numeric_summary"] = Query(lambda s, sf: profile.numeric_summary(_bronze(s, sf)), WB(numeric),
                                 ["mean", "stddev", "min", "p25", "p50", "p75", "max"])
    for name, col in (("freq_by_payment", "payment_type"), ("freq_by_passenger", "passenger_count"),
                      ("freq_by_file", spec.SOURCE_FILE_COLUMN)):
        q[name] = Query((lambda c: lambda s, sf: profile.frequency(_bronze(s, sf), c))(col),
                        WB(f"SELECT {col}, count(*) AS count FROM bronze GROUP BY 1"))
    zcols = [c for c in RAW_COLUMNS if c not in ("tpep_pickup_datetime", "tpep_dropoff_datetime")]
    zsql = "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", CAST("{c}" AS VARCHAR) AS value, count(*) AS count FROM z GROUP BY 2"""
        for c in zcols)
    q["zero_duration_profile"] = Query(
        lambda s, sf: profile.zero_duration_profile(_bronze(s, sf)),
        WB(f", z AS (SELECT * FROM bronze WHERE tpep_pickup_datetime = tpep_dropoff_datetime)\n{zsql}"))
    p, d = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    q["timestamp_health"] = Query(lambda s, sf: profile.timestamp_health(_bronze(s, sf)), WB(f"""SELECT
  count(*) FILTER (WHERE {p} IS NULL) AS missing_pickup,
  count(*) FILTER (WHERE {d} IS NULL) AS missing_dropoff,
  count(*) FILTER (WHERE {p} IS NOT NULL AND {d} IS NOT NULL AND {d} <= {p}) AS dropoff_not_after_pickup,
  count(*) FILTER (WHERE {p} IS NOT NULL AND {d} IS NOT NULL
                   AND CAST(epoch({d}) AS BIGINT) - CAST(epoch({p}) AS BIGINT) > 86400) AS duration_over_24_hours
FROM bronze"""))
    q["duration_days"] = Query(lambda s, sf: profile.duration_days(raw_trips(s, sf, edge=True)), WE(
        f"SELECT datesub('day', {p}, {d}) AS trip_duration_days, count(*) AS count FROM bronze "
        f"WHERE {p} IS NOT NULL AND {d} IS NOT NULL GROUP BY 1"))
    lab = f"regexp_extract(_bronze_source_file, '{O.RX_LABEL}', 1)"
    start = f"CASE WHEN {lab} <> '' THEN CAST({lab} || '-01' AS DATE) END"
    q["misdated"] = Query(lambda s, sf: profile.misdated(_bronze(s, sf)), WB(f"""SELECT
  count(*) FILTER (WHERE {p} IS NOT NULL AND (CAST({p} AS DATE) < DATE '2026-01-01'
                   OR CAST({p} AS DATE) >= DATE '2026-04-01')) AS outside_global_dates,
  count(*) FILTER (WHERE {p} IS NOT NULL AND {start} IS NOT NULL AND (CAST({p} AS DATE) < {start}
                   OR CAST({p} AS DATE) >= {start} + INTERVAL 1 MONTH)) AS outside_source_month,
  count(*) FILTER (WHERE {p} IS NOT NULL AND ({p} < TIMESTAMP '{spec.MIN_PICKUP}'
                   OR {p} > TIMESTAMP '{spec.MAX_PICKUP}')) AS outside_allowed_range
FROM bronze"""))
    q["anomaly_crosstab"] = Query(lambda s, sf: profile.anomaly_crosstab(_bronze(s, sf)), WB("""SELECT
  count(*) FILTER (WHERE trip_distance <= 0) AS invalid_trip_distance,
  count(*) FILTER (WHERE fare_amount < 0) AS invalid_fare_amount,
  count(*) FILTER (WHERE total_amount < 0) AS invalid_total_amount,
  count(*) FILTER (WHERE passenger_count <= 0) AS invalid_passenger_count,
  count(*) FILTER (WHERE fare_amount < 0) AS fare_l_0,
  count(*) FILTER (WHERE fare_amount = 0) AS fare_eq_0,
  count(*) FILTER (WHERE fare_amount = 0 AND trip_distance = 0) AS fare_eq_0_and_distance_eq_0,
  count(*) FILTER (WHERE trip_distance = 0) AS distance_eq_0,
  count(*) FILTER (WHERE trip_distance < 0) AS distance_l_0,
  count(*) FILTER (WHERE total_amount = 0) AS total_eq_0,
  count(*) FILTER (WHERE total_amount = 0 AND fare_amount = 0) AS total_eq_0_and_fare_eq_0,
  count(*) FILTER (WHERE total_amount < fare_amount) AS total_lt_fare
FROM bronze"""))
    flex_null = " AND ".join(f"{c} IS NULL" for c in spec.FLEX_FARE_FIELDS_RAW)
    q["flex_violations"] = Query(lambda s, sf: profile.flex_violations(raw_trips(s, sf, edge=True)), WE(f"""SELECT
  count(*) FILTER (WHERE {flex_null}) AS all_profile_fields_null_rows,
  count(*) FILTER (WHERE NOT ((payment_type = 0) = ({flex_null}))) AS flex_fare_violations
FROM bronze"""))
    q["flex_profile"] = Query(lambda s, sf: profile.flex_profile(_bronze(s, sf)), WB(f""",
fz AS (SELECT * FROM bronze WHERE {flex_null})
SELECT 'VendorID' AS dimension, CAST(VendorID AS VARCHAR) AS value, count(*) AS count FROM fz GROUP BY 2
UNION ALL
SELECT '{spec.SOURCE_FILE_COLUMN}' AS dimension, {spec.SOURCE_FILE_COLUMN} AS value, count(*) AS count
FROM fz GROUP BY 2
UNION ALL
SELECT 'payment_type' AS dimension, CAST(payment_type AS VARCHAR) AS value, count(*) AS count FROM fz GROUP BY 2"""))
    return q


# ---------------------------------------------------------------------------
# Reports and dashboard operators
# ---------------------------------------------------------------------------

def report_queries() -> dict[str, Query]:
    q = {}
    for name, (report, params, limit, ties, where, order) in REPORT_QUERIES.items():
        q[name] = Query(_report(report, params, limit, ties), _report_sql(report, limit, where, order),
                        GOLD_DOUBLES[reports.REPORTS[report].table])

    def _sel(table, variant="all", basis="pickup_month"):
        def run(s, sf):
            return _gold_frames(s, sf, [table], variant, basis)[table]
        return run

    def _months(s, sf):
        """The month choice of the monthly figures (F6: in order)."""
        chosen = reports.filter_months(_sel("monthly_kpi")(s, sf), ["2026-01", "2026-03"])
        return reports.numbered(chosen.select("year_month", "trip_count", "total_revenue"), [F.asc("year_month")])

    q["overview_months"] = Query(_months, WT(O.gold_tables("monthly_kpi"), """SELECT year_month, trip_count, total_revenue,
  CAST(row_number() OVER (ORDER BY year_month) AS INTEGER) AS row_no
FROM monthly_kpi WHERE data_variant = 'all' AND month_basis = 'pickup_month' AND year_month IN ('2026-01', '2026-03')"""), ["total_revenue"])

    def _vendor_labels(s, sf):
        rows = gold.build(silver_result(s, sf, edge=True).silver, "vendor_monthly", ("all",), ("pickup_month",))
        return reports.as_category_strings(rows, ["vendor_id"]).select("vendor_id", "year_month", "trip_count")

    q["vendor_labels"] = Query(_vendor_labels, O.with_tables(O.gold_tables("vendor_monthly"), """SELECT coalesce(CAST(vendor_id AS VARCHAR), 'Unknown') AS vendor_id,
  year_month, trip_count FROM vendor_monthly WHERE data_variant = 'all' AND month_basis = 'pickup_month'""", edge=True))

    def _weighted(s, sf):
        return reports.weighted_kpis(_sel("monthly_kpi")(s, sf))

    q["weighted_kpis"] = Query(_weighted, WT(O.gold_tables("monthly_kpi"), """SELECT
  CAST(coalesce(sum(trip_count), 0) AS BIGINT) AS total_trips,
  coalesce(sum(total_revenue), 0.0) AS total_revenue,
  CASE WHEN coalesce(sum(trip_count), 0) <> 0
       THEN coalesce(sum(avg_trip_distance * trip_count), 0.0) / sum(trip_count) ELSE 0.0 END AS weighted_distance,
  CASE WHEN coalesce(sum(trip_count), 0) <> 0
       THEN coalesce(sum(avg_trip_duration_min * trip_count), 0.0) / sum(trip_count) ELSE 0.0 END
       AS weighted_duration
FROM monthly_kpi WHERE data_variant = 'all' AND month_basis = 'pickup_month'"""),
        ["total_revenue", "weighted_distance", "weighted_duration"])

    for name, table, zone in (("top_zones_share", "pickup_zone_monthly", "pickup_location_id"),
                              ("top_dropoff_zones_share", "dropoff_zone_monthly", "dropoff_location_id")):
        def run(s, sf, table=table, zone=zone):
            return reports.top_zones_share(_sel(table)(s, sf), zone, 20)
        sql = WT({**O.gold_tables(table),
                  "sel": f"SELECT * FROM {table} WHERE data_variant = 'all' AND month_basis = 'pickup_month'",
                  "z": f"SELECT {zone}, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM sel "
                       f"WHERE {zone} IS NOT NULL GROUP BY 1",
                  "base": "SELECT CAST(sum(trip_count) AS DOUBLE) AS b FROM sel",
                  "top": f"SELECT * FROM z ORDER BY trip_count DESC, {zone} ASC LIMIT 20"},
                 f"""SELECT coalesce(CAST(CAST({zone} AS BIGINT) AS VARCHAR), 'Unknown') AS {zone}, trip_count,
  CASE WHEN b <> 0 THEN trip_count / b * 100.0 END AS share_percent FROM top, base""")
        q[name] = Query(run, sql, ["share_percent"])

    for name, table, key in (("payment_totals", "payment_monthly", "payment_type"),
                             ("vendor_totals", "vendor_monthly", "vendor_id")):
        def run(s, sf, table=table, key=key):
            return reports.totals_by(_sel(table)(s, sf), key)
        q[name] = Query(run, WT(O.gold_tables(table), f"""SELECT
  coalesce(CAST(CAST({key} AS BIGINT) AS VARCHAR), 'Unknown') AS {key},
  CAST(sum(trip_count) AS BIGINT) AS trip_count
FROM {table} WHERE data_variant = 'all' AND month_basis = 'pickup_month' AND {key} IS NOT NULL GROUP BY {key}"""))

    def _funnel(s, sf):
        return reports.pipeline_funnel(_gold_frames(s, sf, ["data_quality_summary"])["data_quality_summary"])

    q["pipeline_funnel"] = Query(_funnel, WT({
        **O.gold_tables("data_quality_summary"),
        "f": """SELECT CAST(list_position(['bronze_rows', 'silver_rows', 'rows_rejected_unique'], metric_name)
       AS INTEGER) AS step, metric_name, min(metric_value) AS metric_value
     FROM data_quality_summary WHERE month_basis = 'overall' AND metric_category = 'pipeline'
       AND metric_name IN ('bronze_rows', 'silver_rows', 'rows_rejected_unique') AND metric_value IS NOT NULL
     GROUP BY metric_name""",
        "i": "SELECT metric_value AS v FROM f ORDER BY step LIMIT 1"},
        "SELECT step, metric_name, metric_value, CASE WHEN v <> 0 THEN metric_value / v * 100.0 END "
        "AS percent_initial FROM f, i"), ["metric_value", "percent_initial"])

    tie = ["year_month", "pickup_location_id", "dropoff_location_id"]
    order = "trip_count DESC, year_month ASC NULLS LAST, pickup_location_id ASC NULLS LAST, " \
            "dropoff_location_id ASC NULLS LAST"

    def _top_flows(s, sf):
        return reports.top_k(_sel("zone_flow_monthly")(s, sf), 100, tie_keys=tie)

    q["top_flows"] = Query(_top_flows, WT(O.gold_tables("zone_flow_monthly"),
                                          "SELECT * FROM zone_flow_monthly WHERE data_variant = 'all' AND "
                                          f"month_basis = 'pickup_month' ORDER BY {order} LIMIT 100"),
                           GOLD_DOUBLES["zone_flow_monthly"])

    def _top_pay_flows(s, sf):
        flows = reports.filter_equal(_sel("payment_zone_flow_monthly")(s, sf), payment_type=2)
        return reports.top_k(flows, 100, tie_keys=tie)

    q["top_payment_flows"] = Query(_top_pay_flows, WT(
        O.gold_tables("payment_zone_flow_monthly"),
        "SELECT * FROM payment_zone_flow_monthly WHERE data_variant = 'all' AND month_basis = 'pickup_month' "
        f"AND payment_type = 2 ORDER BY {order} LIMIT 100"), GOLD_DOUBLES["payment_zone_flow_monthly"])

    months = ["2026-01", "2026-02"]

    def _overview(s, sf):
        daily = _gold_frames(s, sf, ["daily_trip_summary"], "all")["daily_trip_summary"]
        return reports.filter_daily_months(daily, months, "pickup_month")

    q["overview_daily"] = Query(_overview, WT(
        O.gold_tables("daily_trip_summary"),
        "SELECT * FROM daily_trip_summary WHERE data_variant = 'all' AND "
        "substr(CAST(trip_date AS VARCHAR), 1, 7) IN ('2026-01', '2026-02')"), GOLD_DOUBLES["daily_trip_summary"])

    cats = ["rejection_reason", "rejection_detail", "silver_warning"]

    def _quality_raw(s, sf):
        rows = reports.quality_metrics(_gold_frames(s, sf, ["data_quality_summary"])["data_quality_summary"],
                                       cats, include_overall=True)
        return reports.numbered(rows, [reports.order_key(c) for c in reports.QUALITY_ORDER])

    q["quality_raw"] = Query(_quality_raw, WT(
        O.gold_tables("data_quality_summary"),
        "SELECT *, CAST(row_number() OVER (ORDER BY month_basis, source_month NULLS LAST, metric_category, metric_name) AS INTEGER) AS row_no "
        "FROM data_quality_summary WHERE metric_category IN ('rejection_reason', 'rejection_detail', 'silver_warning')"), GOLD_DOUBLES["data_quality_summary"])

    def _profile_metrics(s, sf):
        return reports.profile_as_metrics(_gold_frames(s, sf, ["payment_null_profile"])["payment_null_profile"])

    q["null_profile_metrics"] = Query(_profile_metrics, WT(
        O.gold_tables("payment_null_profile"),
        "SELECT data_variant, payment_type, field_name AS metric_name, row_count, null_count AS metric_value, "
        "null_percent AS metric_percent, all_profile_fields_null_count, all_profile_fields_null_percent "
        "FROM payment_null_profile WHERE data_variant = 'all' AND payment_type = 0"),
        ["metric_percent", "all_profile_fields_null_percent"])

    dims = {"months": ("monthly_kpi", "year_month"), "pickup_zones": ("zone_flow_monthly", "pickup_location_id"),
            "dropoff_zones": ("zone_flow_monthly", "dropoff_location_id"),
            "payment_types": ("payment_monthly", "payment_type"), "vendors": ("vendor_monthly", "vendor_id")}

    def _dims(s, sf):
        # The values come straight from Silver, in one scan: a Gold key's values are those of its rows.
        sil = silver_result(s, sf).silver.withColumn("year_month", F.date_format("pickup_datetime", "yyyy-MM"))
        metrics = _gold_frames(s, sf, ["data_quality_summary"])["data_quality_summary"]
        return reports.dimension_values(sil, {n: c for n, (_, c) in dims.items()}).unionByName(
            reports.dimension_values(metrics, {"metric_categories": "metric_category"}))

    def _zones(s, sf):
        return reports.numbered(reports.distinct_sorted(silver_result(s, sf).silver, "pickup_location_id"), [F.asc("pickup_location_id")])

    q["zone_choices"] = Query(_zones, WB("""SELECT pickup_location_id, CAST(row_number() OVER (ORDER BY pickup_location_id) AS INTEGER) AS row_no
FROM (SELECT DISTINCT pickup_location_id FROM silver WHERE pickup_location_id IS NOT NULL) z"""))

    parts = [f"SELECT DISTINCT '{n}' AS dimension, CAST({c} AS VARCHAR) AS value FROM {t} "
             f"WHERE data_variant = 'all' AND month_basis = 'pickup_month' AND {c} IS NOT NULL"
             for n, (t, c) in dims.items()]
    parts.append("SELECT DISTINCT 'metric_categories' AS dimension, metric_category AS value "
                 "FROM data_quality_summary WHERE metric_category IS NOT NULL")
    q["dimension_values"] = Query(_dims, WT(
        O.gold_tables(*sorted({t for t, _ in dims.values()}), "data_quality_summary"),
        "\nUNION ALL\n".join(parts)))
    return q


# ---------------------------------------------------------------------------
# Gold checks
# ---------------------------------------------------------------------------

#: Faults put into Gold: table -> (rows that stay, column -> expression), the same text in Spark and DuckDB.
BROKEN_GOLD = {
    "daily_trip_summary": ("data_variant <> 'exclude_zero_distance'", {}),
    "monthly_kpi": ("true", {"trip_count": "CASE WHEN data_variant = 'exclude_both' AND year_month = '2026-02' THEN trip_count + 1000000000 ELSE trip_count END"}),
    "pickup_zone_monthly": ("pickup_location_id % 2 = 0", {}),
    "dropoff_zone_monthly": ("month_basis = 'pickup_month'", {}),
    "vendor_monthly": ("true", {"data_variant": "CASE WHEN data_variant = 'all' THEN 'every' ELSE data_variant END"}),
    "data_quality_summary": ("month_basis <> 'source_month'", {}),
}

RECONCILE_TABLES = list(gold.GOLD_DEFS) + ["payment_null_profile", "data_quality_summary"]


def _reconcile_sql(broken: bool = False) -> str:
    variants = "[" + ", ".join(f"'{v}'" for v in spec.DATA_VARIANTS) + "]"
    bases = "[" + ", ".join(f"'{b}'" for b in spec.MONTH_BASES) + "]"

    def setdiff(table, col, values):
        got = f"SELECT DISTINCT CAST({col} AS VARCHAR) AS v FROM {table} WHERE {col} IS NOT NULL"
        exp = f"SELECT unnest({values}) AS v"
        return (f"SELECT count(*) FROM (({got}) EXCEPT ALL ({exp}) UNION ALL "
                f"(({exp}) EXCEPT ALL ({got}))) d")

    parts = []
    for t in RECONCILE_TABLES:
        if t == "data_quality_summary":
            parts.append(f"SELECT '{t}:month_basis' AS \"check\", CAST(3 - (SELECT count(DISTINCT month_basis) "
                         f"FROM {t} WHERE month_basis IN ('overall', 'pickup_month', 'source_month')) AS BIGINT) "
                         "AS violations")
            continue
        parts.append(f"SELECT '{t}:data_variant' AS \"check\", ({setdiff(t, 'data_variant', variants)}) "
                     "AS violations")
        if t in gold.GOLD_DEFS and gold.GOLD_DEFS[t].monthly:
            parts.append(f"SELECT '{t}:month_basis' AS \"check\", ({setdiff(t, 'month_basis', bases)}) "
                         "AS violations")
    parts.append("""SELECT 'monthly_kpi:variant_monotonic' AS "check", count(*) AS violations FROM (
  SELECT month_basis, year_month,
    coalesce(sum(trip_count) FILTER (WHERE data_variant = 'all'), 0) AS a,
    coalesce(sum(trip_count) FILTER (WHERE data_variant = 'exclude_zero_duration'), 0) AS d,
    coalesce(sum(trip_count) FILTER (WHERE data_variant = 'exclude_zero_distance'), 0) AS z,
    coalesce(sum(trip_count) FILTER (WHERE data_variant = 'exclude_both'), 0) AS b
  FROM monthly_kpi GROUP BY 1, 2) p WHERE NOT (a >= d AND a >= z AND d >= b AND z >= b)""")
    parts.append("""SELECT 'daily_vs_pickup_month_totals' AS "check", count(*) AS violations FROM
  (SELECT data_variant, sum(trip_count) AS l FROM daily_trip_summary GROUP BY 1) x
  FULL OUTER JOIN (SELECT data_variant, sum(trip_count) AS r FROM monthly_kpi
                   WHERE month_basis = 'pickup_month' GROUP BY 1) y
  ON x.data_variant IS NOT DISTINCT FROM y.data_variant WHERE l IS DISTINCT FROM r""")
    for name, t in (("pickup_zone_vs_flow_totals", "pickup_zone_monthly"),
                    ("dropoff_zone_vs_flow_totals", "dropoff_zone_monthly")):
        parts.append(f"""SELECT '{name}' AS "check", count(*) AS violations FROM
  (SELECT data_variant, month_basis, year_month, sum(trip_count) AS l FROM {t} GROUP BY 1, 2, 3) x
  FULL OUTER JOIN (SELECT data_variant, month_basis, year_month, sum(trip_count) AS r FROM zone_flow_monthly
                   GROUP BY 1, 2, 3) y
  ON x.data_variant IS NOT DISTINCT FROM y.data_variant AND x.month_basis IS NOT DISTINCT FROM y.month_basis
     AND x.year_month IS NOT DISTINCT FROM y.year_month
  WHERE l IS DISTINCT FROM r""")
    tables = O.gold_tables(*RECONCILE_TABLES)
    if broken:
        for t, (kept, changed) in BROKEN_GOLD.items():
            replace = f" REPLACE ({', '.join(f'{e} AS {c}' for c, e in changed.items())})" if changed else ""
            tables[t] = f"SELECT *{replace} FROM ({tables[t]}) g WHERE {kept}"
    return WT(tables, "\nUNION ALL\n".join(parts))


def _all_gold(s, sf) -> dict[str, DataFrame]:
    """All Gold tables, rolled up as in the Gold step from its two shared reductions of Silver, each written once.

    The validated trips are derived in one reading of `lineitem` and written; every reduction reads those it needs of
    their columns.
    """
    root = scratch_dir(s, "reconcile")
    flagged_table(s, sf).write.parquet(f"{root}/flagged")
    r = split_trips(s.read.parquet(f"{root}/flagged"))
    shared = {}
    for key, made in (("monthly", gold.shared_preaggregate(r.silver)), ("daily", gold.daily_preaggregate(r.silver))):
        made.write.parquet(f"{root}/{key}")
        shared[key] = s.read.parquet(f"{root}/{key}")
    out = {"data_quality_summary": quality_of(r)}
    out |= {n: gold.build_from_shared(shared["monthly"], n) for n in gold.MONTHLY_TABLES}
    return out | {"daily_trip_summary": gold.daily_from_shared(shared["daily"]), "payment_null_profile": gold.null_profile_from_shared(shared["daily"])}


def check_queries() -> dict[str, Query]:
    def _reconcile(s, sf):
        return checks.gold_reconcile(s, _all_gold(s, sf))

    def _reconcile_broken(s, sf):
        frames = _all_gold(s, sf)
        for t, (kept, changed) in BROKEN_GOLD.items():
            frames[t] = frames[t].where(kept).withColumns({c: F.expr(e) for c, e in changed.items()})
        return checks.gold_reconcile(s, frames)

    def _inventory(s, sf):
        return checks.dq_inventory(_gold_frames(s, sf, ["data_quality_summary"])["data_quality_summary"])

    return {
        "gold_reconcile": Query(_reconcile, _reconcile_sql()),
        "gold_reconcile_broken": Query(_reconcile_broken, _reconcile_sql(broken=True)),
        "dq_inventory": Query(_inventory, WT(
            O.gold_tables("data_quality_summary"),
            "SELECT month_basis, metric_category, metric_name, count(*) AS rows FROM data_quality_summary "
            "GROUP BY 1, 2, 3")),
    }


# ---------------------------------------------------------------------------
# The file-based pipeline: raw files written, run, and read back
# ---------------------------------------------------------------------------

MADE = "made.trips"


def _make_raw(s, sf, root: str, edge: bool = False) -> list[str]:
    """The trips as monthly raw files beside the raw folder, in one reading of `lineitem`; the files' names."""
    made = pipeline.Warehouse(s, root)
    made.publish(raw_trips(s, sf, edge), MADE, [spec.SOURCE_FILE_COLUMN])
    return made.partition_values(MADE)  # three files


def _arrive(s, root: str, names: list[str]) -> None:
    """Move the named files into the raw folder."""
    made = pipeline.Warehouse(s, root)
    made.swap([(made.partition(MADE, spec.SOURCE_FILE_COLUMN, n), f"{root}/raw/{n}") for n in names], made.staging("arrive"))


def _run_steps(s, cfg: spec.PipelineConfig, gold_tables: list[str] | None) -> None:
    steps = [lambda: pipeline.ingest_bronze(s, cfg), lambda: pipeline.transform_silver(s, cfg)]
    if gold_tables != []:
        steps.append(lambda: pipeline.build_gold(s, cfg, gold_tables))
    for step in steps:
        res = step()
        if res.exit_code:
            raise RuntimeError(f"{res.step}: {'; '.join(res.messages)}")


def _run_pipeline(s, sf, gold_tables: list[str] | None = None, **settings) -> spec.PipelineConfig:
    """Write the trips as monthly raw files below the checkpoint folder and run
    the steps over them; of Gold all tables, or the given ones."""
    root = scratch_dir(s, "run")
    _arrive(s, root, _make_raw(s, sf, root))
    cfg = spec.PipelineConfig(warehouse=f"{root}/warehouse", raw_dir=f"{root}/raw", **settings)
    _run_steps(s, cfg, gold_tables)
    return cfg


def _ledgers(s, sf) -> DataFrame:
    """What the three ledgers hold after a run, without run ids, sizes and times."""
    wh = pipeline.Warehouse(s, _run_pipeline(s, sf).warehouse)
    none = F.lit(None)
    parts = [
        wh.read(spec.INGESTION_LOG_TABLE).select(F.lit("ingestion").alias("ledger"), "source_file", "target_table", "status",
                                                 F.col("row_count").alias("rows_read"), none.cast("bigint").alias("rows_rejected"), F.col("row_count").alias("rows_written")),
        wh.read(spec.TRANSFORM_LOG_TABLE).select(F.lit("transform").alias("ledger"), "source_file", "target_table", "status", "rows_read", "rows_rejected", "rows_written"),
        wh.read(spec.GOLD_LOG_TABLE).select(F.lit("gold").alias("ledger"), none.cast("string").alias("source_file"), "target_table", "status",
                                            "rows_read", none.cast("bigint").alias("rows_rejected"), "rows_written"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _ledgers_sql() -> str:
    gold_parts = "\nUNION ALL\n".join(
        f"SELECT 'gold' AS ledger, NULL AS source_file, '{spec.GOLD_NAMESPACE}.{t}' AS target_table, 'success' AS status, "
        f"(SELECT count(*) FROM silver){' + (SELECT count(*) FROM quarantine)' if t == 'data_quality_summary' else ''} AS rows_read, "
        f"CAST(NULL AS BIGINT) AS rows_rejected, (SELECT count(*) FROM {t}) AS rows_written" for t in spec.GOLD_TABLES)
    return WT(O.gold_tables(*spec.GOLD_TABLES), f"""SELECT 'ingestion' AS ledger, _bronze_source_file AS source_file, '{spec.BRONZE_TABLE}' AS target_table,
  'success' AS status, count(*) AS rows_read, CAST(NULL AS BIGINT) AS rows_rejected, count(*) AS rows_written FROM bronze GROUP BY 2
UNION ALL
SELECT 'transform', _bronze_source_file, '{spec.SILVER_TABLE}', 'success', count(*), count(*) FILTER (WHERE NOT is_valid),
  count(*) FILTER (WHERE is_valid) FROM flagged2 WHERE file_ok GROUP BY 2
UNION ALL
{gold_parts}""")


ZONES_SQL = """
SELECT year_month, pickup_location_id, dropoff_location_id, trip_count, total_revenue, avg_trip_distance
FROM zone_analysis(data_variant => :variant, pickup_location_id => :zone)
ORDER BY trip_count DESC, year_month, pickup_location_id, dropoff_location_id
LIMIT :row_limit"""

FREE_SQL = """
WITH shown AS (SELECT * FROM payment_analysis(month_basis => :basis)),
     months AS (SELECT year_month, trip_count AS month_trips FROM monthly_kpi(month_basis => :basis))
SELECT shown.year_month, shown.payment_type, shown.trip_count, 100.0D * shown.trip_count / months.month_trips AS trip_percent,
       sum(shown.total_revenue) OVER (PARTITION BY shown.payment_type ORDER BY shown.year_month) AS revenue_so_far
FROM shown JOIN months ON shown.year_month = months.year_month
WHERE shown.year_month >= :first_month
UNION ALL
SELECT 'all months', payment_type, sum(trip_count), NULL, sum(total_revenue) FROM gold_payment_monthly
WHERE data_variant = 'exclude_both' AND month_basis = :basis GROUP BY payment_type"""


def _sql_over_gold(tables: list[str], text: str, **params):
    """SQL text over the written Gold tables, as views and table functions of the session."""
    def run(s, sf):
        cfg = _run_pipeline(s, sf, tables)
        made = relations.register(s, {t: pipeline.load_gold(s, cfg.warehouse, t) for t in tables}, prefix="gold_")
        out = relations.run_sql(s, text, **params)
        relations.unregister(s, made)  # the analysed query does not need the names any more
        return out
    return run


def _grown_gold(s, sf) -> DataFrame:
    """monthly_kpi after two months, then a third: the second Gold run reduces the third month's file alone."""
    root = scratch_dir(s, "grown")
    cfg = spec.PipelineConfig(warehouse=f"{root}/warehouse", raw_dir=f"{root}/raw")
    names = _make_raw(s, sf, root)
    for files in (names[:2], names[2:]):
        _arrive(s, root, files)
        _run_steps(s, cfg, ["monthly_kpi"])
    return pipeline.load_gold(s, cfg.warehouse, "monthly_kpi")


def _months_one_by_one(s, sf) -> tuple[pipeline.Warehouse, list[str]]:
    """Bronze of the edge trips and its stored row hashes, a month at a time."""
    root = scratch_dir(s, "months")
    names = _make_raw(s, sf, root, edge=True)
    cfg = spec.PipelineConfig(warehouse=f"{root}/warehouse", raw_dir=f"{root}/raw")
    wh = pipeline.Warehouse(s, cfg.warehouse)
    for name in names:
        _arrive(s, root, [name])
        if pipeline.ingest_bronze(s, cfg).exit_code:
            raise RuntimeError(f"{name} was not ingested")
        duplicates.add_files(wh, wh.read(spec.BRONZE_TABLE), [name])
    return wh, names


def _duplicates_by_month(s, sf) -> DataFrame:
    return duplicates.duplicate_summary(_months_one_by_one(s, sf)[0])


def _seen_before(s, sf) -> DataFrame:
    wh, names = _months_one_by_one(s, sf)
    return duplicates.seen_before(wh, names[-1:])


def _pending_rows(s, sf) -> DataFrame:
    """Bronze's rows of the files that the transform ledger lacks: one of three, after the others were transformed."""
    root = scratch_dir(s, "pending")
    cfg = spec.PipelineConfig(warehouse=f"{root}/warehouse", raw_dir=f"{root}/raw")
    names = _make_raw(s, sf, root)
    _arrive(s, root, names[:2])
    _run_steps(s, cfg, [])
    _arrive(s, root, names[2:])
    if pipeline.ingest_bronze(s, cfg).exit_code:
        raise RuntimeError("the last month was not ingested")
    wh = pipeline.Warehouse(s, cfg.warehouse)
    files = B.successful(wh.read(spec.INGESTION_LOG_TABLE), spec.BRONZE_TABLE)
    pending = B.pending_files(files, wh.read(spec.TRANSFORM_LOG_TABLE), spec.SILVER_TABLE)
    return B.rows_of(wh.read(spec.BRONZE_TABLE), pending).groupBy(spec.SOURCE_FILE_COLUMN).agg(
        F.count("*").alias("rows"), F.sum("total_amount").alias("total_amount"))


def _run_checks(s, sf) -> DataFrame:
    """What must hold of tables and ledgers after a run, a rerun of all files, a write that fails and one that is refused."""
    began = datetime.now(timezone.utc)
    cfg = _run_pipeline(s, sf, ["vendor_monthly"])
    wh = pipeline.Warehouse(s, cfg.warehouse)
    pipeline._transform(wh, wh.partition_values(spec.BRONZE_TABLE), cfg)
    fails = wh.read(spec.SILVER_TABLE).withColumn("vendor_id", F.when(F.col("vendor_id") > 0, F.raise_error(F.lit("torn"))).cast("int"))
    counts = {"failed_writes": 0, "refused_schemas": 0}
    try:
        wh.publish(fails, spec.SILVER_TABLE)
    except Exception as e:
        counts["failed_writes"] += "torn" in str(e)
    try:
        pipeline.check_schema(wh, "gold.vendor_monthly", wh.read(spec.SILVER_TABLE).schema)
    except ValueError:
        counts["refused_schemas"] += 1
    ended = datetime.now(timezone.utc)
    counts["bronze_rows_by_footers"] = wh.row_count(spec.BRONZE_TABLE)
    silver, quarantine, log = wh.read(spec.SILVER_TABLE), wh.read(spec.QUARANTINE_TABLE), wh.read(spec.TRANSFORM_LOG_TABLE)
    outside = lambda c: F.count_if(F.col(c).isNull() | (F.col(c) < F.lit(began)) | (F.col(c) > F.lit(ended)))
    parts = [s.createDataFrame(list(counts.items()), "check string, value long")]
    parts += [df.agg(v.cast("long").alias("value")).select(F.lit(n).alias("check"), "value") for n, df, v in (
        ("silver_rows_after_rerun", silver, F.count("*")), ("quarantine_rows_after_rerun", quarantine, F.count("*")),
        ("silver_stamps_outside_run", silver, outside(spec.PROCESSED_AT_COLUMN)), ("quarantine_stamps_outside_run", quarantine, outside(spec.REJECTED_AT_COLUMN)),
        ("successes_without_run_id", log, F.count_if((F.col("status") == "success") & F.col("snapshot_id").isNull())), ("silver_runs", log, F.count_distinct("snapshot_id")))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def pipeline_queries() -> dict[str, Query]:
    def _partitions(s, sf):
        """Rows of each month's partitions, and whether as many files hold them as the table's listing has."""
        table = pipeline.Warehouse(s, _run_pipeline(s, sf, []).warehouse).read(spec.SILVER_TABLE)
        listed = [(p.split("pickup_month=")[1].split("/")[0],) for p in table.inputFiles()]
        listed = s.createDataFrame(listed, "pickup_month string").groupBy("pickup_month").agg(F.count("*").alias("listed"))
        return profile.partition_inventory(table).join(listed, "pickup_month", "full_outer").select(
            "pickup_month", "record_count", F.col("file_count").eqNullSafe(F.col("listed")).alias("files_as_listed"))

    def _loaded(s, sf):
        return pipeline.load_gold(s, _run_pipeline(s, sf, ["payment_monthly"]).warehouse, "payment_monthly")

    def _empty(s, sf):
        """A run whose bounds reject every trip: Gold is there, without rows."""
        cfg = _run_pipeline(s, sf, ["vendor_monthly"], min_pickup="1990-01-01 00:00:00", max_pickup="1990-01-02 00:00:00")
        frame = pipeline.load_gold(s, cfg.warehouse, "vendor_monthly")
        return frame.agg(F.count("*").alias("rows")).select("rows", F.lit(len(frame.columns)).alias("n_columns"))

    held = {"failed_writes": "1", "refused_schemas": "1", "bronze_rows_by_footers": "(SELECT count(*) FROM bronze)",
            "silver_rows_after_rerun": "(SELECT count(*) FROM silver)", "quarantine_rows_after_rerun": "(SELECT count(*) FROM quarantine)",
            "silver_stamps_outside_run": "0", "quarantine_stamps_outside_run": "0", "successes_without_run_id": "0", "silver_runs": "1"}
    return {
        "pipeline_ledgers": Query(_ledgers, _ledgers_sql()),
        "pipeline_checks": Query(_run_checks, WB("\nUNION ALL\n".join(f"SELECT '{k}' AS \"check\", CAST({v} AS BIGINT) AS value" for k, v in held.items()))),
        "duplicates_by_month": Query(_duplicates_by_month, WE("""SELECT count(*) AS duplicate_groups, CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT * EXCLUDE (_bronze_source_file), count(*) AS c FROM bronze GROUP BY ALL HAVING count(*) > 1) d""")),
        "duplicates_seen_before": Query(_seen_before, WE(f""", keyed AS (SELECT _bronze_source_file AS f, t::VARCHAR AS t
  FROM (SELECT _bronze_source_file, row({', '.join(c for c in RAW_COLUMNS if c != spec.SOURCE_FILE_COLUMN)}) AS t FROM bronze) x)
SELECT f AS _bronze_source_file, count(*) AS rows, count(*) FILTER (WHERE t IN (SELECT t FROM keyed WHERE f <> 'demo_tripdata_2026-04.parquet')) AS rows_seen_before
FROM keyed WHERE f = 'demo_tripdata_2026-04.parquet' GROUP BY f""")),
        "pending_rows": Query(_pending_rows, WB("""SELECT _bronze_source_file, count(*) AS rows, sum(total_amount) AS total_amount
FROM bronze WHERE _bronze_source_file = 'demo_tripdata_2026-03.parquet' GROUP BY 1"""), ["total_amount"]),
        "gold_incremental": Query(_grown_gold, O.gold_sql("monthly_kpi"), GOLD_DOUBLES["monthly_kpi"]),
        "gold_sql_zones": Query(_sql_over_gold(["zone_flow_monthly"], ZONES_SQL, variant="exclude_zero_duration", zone=132, row_limit=25), WT(
            O.gold_tables("zone_flow_monthly"), """SELECT year_month, pickup_location_id, dropoff_location_id, trip_count, total_revenue, avg_trip_distance
FROM zone_flow_monthly WHERE data_variant = 'exclude_zero_duration' AND month_basis = 'pickup_month' AND pickup_location_id = 132
ORDER BY trip_count DESC, year_month, pickup_location_id, dropoff_location_id LIMIT 25"""), ["total_revenue", "avg_trip_distance"]),
        "gold_sql_free": Query(_sql_over_gold(["payment_monthly", "monthly_kpi"], FREE_SQL, basis="source_month", first_month="2026-02"), WT(
            O.gold_tables("payment_monthly", "monthly_kpi"), """SELECT p.year_month, p.payment_type, p.trip_count, 100.0::DOUBLE * p.trip_count / m.trip_count AS trip_percent,
  sum(p.total_revenue) OVER (PARTITION BY p.payment_type ORDER BY p.year_month) AS revenue_so_far
FROM payment_monthly p JOIN monthly_kpi m USING (data_variant, month_basis, year_month)
WHERE data_variant = 'all' AND month_basis = 'source_month' AND year_month >= '2026-02'
UNION ALL
SELECT 'all months', payment_type, CAST(sum(trip_count) AS BIGINT), NULL, sum(total_revenue) FROM payment_monthly
WHERE data_variant = 'exclude_both' AND month_basis = 'source_month' GROUP BY payment_type"""), ["trip_percent", "revenue_so_far"]),
        "silver_partitions": Query(_partitions, WB("SELECT strftime(pickup_datetime, '%Y-%m') AS pickup_month, count(*) AS record_count, "
                                                   "true AS files_as_listed FROM silver GROUP BY 1")),
        "gold_from_warehouse": Query(_loaded, O.gold_sql("payment_monthly"), GOLD_DOUBLES["payment_monthly"]),
        "gold_without_rows": Query(_empty, WT(O.gold_tables("vendor_monthly"), """SELECT (SELECT count(*) FROM silver WHERE pickup_datetime < TIMESTAMP '1990-01-02')
  AS rows, CAST(3 + 8 + (SELECT count(*) FROM vendor_monthly WHERE false) + 1 AS INTEGER) AS n_columns""")),
    }


def more_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for part in (bronze_queries, silver_queries, profile_queries, report_queries, check_queries, pipeline_queries):
        out.update(part())
    return out
