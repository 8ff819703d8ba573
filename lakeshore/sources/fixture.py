"""Synthetic raw trip records derived from the `lineitem` table.

The derivation is integer arithmetic only, so the same SQL text runs in Spark
and in DuckDB (only the base-timestamp literal differs). The result has the
raw (pre-Silver) trip schema plus the `_bronze_source_file` lineage column,
spread over three monthly files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPARK_BASE_TS = "CAST('2026-01-01 00:00:00' AS TIMESTAMP_NTZ)"
DUCKDB_BASE_TS = "TIMESTAMP '2026-01-01 00:00:00'"

# Fixed derivation (documented in FIXTURES.md); `{B}` is the base timestamp.
TRIPS_SQL = """
WITH k AS (
  SELECT l_orderkey*7 + l_linenumber AS r, l_suppkey % 3 AS mi, l_partkey, l_suppkey, l_orderkey, l_quantity, l_discount
  FROM lineitem),
p AS (
  SELECT *,
    CASE WHEN r % 211 = 0 THEN -365*86400 WHEN r % 97 = 0 THEN 31*86400 ELSE 0 END
      + CASE mi WHEN 0 THEN 0 WHEN 1 THEN 31*86400 ELSE 59*86400 END
      + (r*7919 + l_partkey*101) % (28*86400) AS ps,
    CASE WHEN r % 151 = 0 THEN -60 WHEN r % 53 = 0 THEN 0 ELSE 60 + (r*31) % 5400 END AS dur
  FROM k)
SELECT
  CAST(1 + l_suppkey % 2 AS INT) AS VendorID,
  CASE WHEN r % 499 = 0 THEN NULL ELSE {B} + ps * INTERVAL '1' SECOND END AS tpep_pickup_datetime,
  {B} + (ps + dur) * INTERVAL '1' SECOND AS tpep_dropoff_datetime,
  CASE WHEN r % 4 = 0 THEN NULL WHEN r % 89 = 0 THEN 0 ELSE 1 + r % 6 END AS passenger_count,
  CASE WHEN r % 613 = 0 THEN CAST(-1 AS DOUBLE) WHEN r % 41 = 0 THEN CAST(0 AS DOUBLE) ELSE l_quantity END AS trip_distance,
  CASE WHEN r % 4 = 0 THEN NULL ELSE 1 + r % 5 END AS RatecodeID,
  CASE WHEN r % 4 = 0 THEN NULL WHEN r % 29 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
  CAST(1 + l_partkey % 263 AS INT) AS PULocationID,
  CAST(1 + (l_partkey*31 + l_orderkey) % 263 AS INT) AS DOLocationID,
  CASE WHEN r % 4 = 0 THEN 0 ELSE 1 + r % 4 END AS payment_type,
  CASE WHEN r % 307 = 0 THEN -l_quantity WHEN r % 61 = 0 THEN CAST(0 AS DOUBLE) ELSE l_quantity*2.5 END AS fare_amount,
  CAST(0.5 AS DOUBLE) AS extra,
  CASE WHEN r % 701 = 0 THEN NULL ELSE CAST(0.5 AS DOUBLE) END AS mta_tax,
  l_discount * l_quantity AS tip_amount,
  CAST(0 AS DOUBLE) AS tolls_amount,
  CAST(1 AS DOUBLE) AS improvement_surcharge,
  CASE WHEN r % 67 = 0 THEN CAST(0 AS DOUBLE) WHEN r % 71 = 0 THEN l_quantity ELSE l_quantity*3 END AS total_amount,
  CASE WHEN r % 4 = 0 THEN NULL WHEN r % 401 = 0 THEN CAST(-2.5 AS DOUBLE) ELSE CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
  CASE WHEN r % 4 = 0 THEN NULL ELSE CAST(1.75 AS DOUBLE) END AS Airport_fee,
  CAST(0.75 AS DOUBLE) AS cbd_congestion_fee,
  CASE mi WHEN 0 THEN 'demo_tripdata_2026-01.parquet' WHEN 1 THEN 'demo_tripdata_2026-02.parquet'
          ELSE 'demo_tripdata_2026-03.parquet' END AS _bronze_source_file
FROM p
"""


# Raw columns of the derived trips, in order, and the numeric ones among them.
RAW_COLUMNS = (
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
    "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID", "payment_type", "fare_amount",
    "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
    "congestion_surcharge", "Airport_fee", "cbd_congestion_fee", "_bronze_source_file",
)
RAW_NUMERIC_COLUMNS = tuple(c for c in RAW_COLUMNS if c not in (
    "tpep_pickup_datetime", "tpep_dropoff_datetime", "store_and_fwd_flag", "_bronze_source_file"))


#: Rows that the plain trips (kind 0) lack, as further kinds of a trip's row: kind -> when a trip has it.
EDGE_KINDS = {
    0: "true",
    1: "PULocationID % 40 = 0",                        # exact duplicates
    2: "PULocationID % 80 = 0",
    3: "PULocationID % 41 = 1",                        # trips of one to three days
    4: "PULocationID % 43 = 2 AND payment_type <> 0",  # flex-fare trips whose profile fields are set
    5: "PULocationID % 47 = 3 AND payment_type <> 0",  # card payments
    6: "PULocationID % 53 = 5",                        # a fourth monthly file
    7: "PULocationID % 59 = 7",                        # no vendor
}
EDGE_CHANGES = {
    "VendorID": "CASE WHEN k <> 7 THEN VendorID END",
    "tpep_dropoff_datetime": "CASE WHEN k = 3 THEN tpep_dropoff_datetime + (1 + PULocationID % 3) * INTERVAL '1' DAY ELSE tpep_dropoff_datetime END",
    "payment_type": "CASE k WHEN 4 THEN payment_type - payment_type WHEN 5 THEN payment_type - payment_type + 1 ELSE payment_type END",
    "_bronze_source_file": "CASE WHEN k = 6 THEN 'demo_tripdata_2026-04.parquet' ELSE _bronze_source_file END",
}


def _edge_sql(dialect: str) -> str:
    """The plain trips and their further kinds, in one reading of them."""
    kinds = ", ".join(f"CASE WHEN {cond} THEN {k} END" for k, cond in EDGE_KINDS.items())
    each = (f"explode(filter(array({kinds}), i -> i IS NOT NULL))" if dialect == "spark" else f"unnest(list_filter([{kinds}], lambda i: i IS NOT NULL))")
    cols = ", ".join(f"{EDGE_CHANGES[c]} AS {c}" if c in EDGE_CHANGES else c for c in RAW_COLUMNS)
    return f"SELECT {cols} FROM (SELECT *, {each} AS k FROM trips) kinds"


def trips_sql(dialect: str = "spark", edge: bool = False) -> str:
    base = SPARK_BASE_TS if dialect == "spark" else DUCKDB_BASE_TS
    plain = TRIPS_SQL.replace("{B}", base)
    return f"WITH trips AS ({plain})\n{_edge_sql(dialect)}" if edge else plain


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str, edge: bool = False) -> DataFrame:
    """Raw trip rows (with `_bronze_source_file`) derived from `lineitem`;
    with `edge`, those of EDGE_KINDS too.

    Uses a DataFrame-bound SQL so no session-wide view is registered; only the
    six lineitem columns used are read (column pruning reaches the scan).
    """
    lineitem = load_table(spark, sf_dir, "lineitem")
    text = trips_sql("spark", edge).replace("FROM lineitem", "FROM {lineitem}")
    return spark.sql(text, lineitem=lineitem)
