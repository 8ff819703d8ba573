"""Silver rules on hand-made rows: NULL, NaN, +-inf, bounds, file names."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from lakeshore import spec
from lakeshore.operators import silver

RAW = StructType([
    StructField("VendorID", IntegerType()),
    StructField("tpep_pickup_datetime", TimestampNTZType()),
    StructField("tpep_dropoff_datetime", TimestampNTZType()),
    StructField("passenger_count", LongType()),
    StructField("trip_distance", DoubleType()),
    StructField("RatecodeID", LongType()),
    StructField("store_and_fwd_flag", StringType()),
    StructField("PULocationID", IntegerType()),
    StructField("DOLocationID", IntegerType()),
    StructField("payment_type", LongType()),
    *[StructField(c, DoubleType()) for c in
      ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
       "congestion_surcharge", "Airport_fee", "cbd_congestion_fee")],
    StructField("_bronze_source_file", StringType()),
])

T0 = dt.datetime(2026, 1, 15, 10, 0, 0)
GOOD = dict(VendorID=1, tpep_pickup_datetime=T0, tpep_dropoff_datetime=T0 + dt.timedelta(minutes=30),
            passenger_count=1, trip_distance=3.0, RatecodeID=1, store_and_fwd_flag="N", PULocationID=1,
            DOLocationID=2, payment_type=1, fare_amount=10.0, extra=0.5, mta_tax=0.5, tip_amount=1.0,
            tolls_amount=0.0, improvement_surcharge=1.0, total_amount=13.0, congestion_surcharge=2.5,
            Airport_fee=0.0, cbd_congestion_fee=0.75, _bronze_source_file="yellow_tripdata_2026-01.parquet")


def _run(spark, rows):
    data = [tuple({**GOOD, **r}.get(f.name) for f in RAW.fields) for r in rows]
    df = spark.createDataFrame(data, RAW)
    flagged = silver.flag_rules(df).withColumn("_i", F.monotonically_increasing_id())
    rules = ["timestamp_order", "pickup_range", "distance", "amounts", "passengers"]
    out = flagged.select(*[F.col("_rule_" + r) for r in rules], "_valid", "_file_ok").collect()
    return [r.asDict() for r in out]


CASES = [
    ({}, True, None),
    ({"trip_distance": float("nan")}, False, "distance"),
    ({"trip_distance": float("inf")}, True, None),
    ({"trip_distance": None}, False, "distance"),
    ({"trip_distance": -0.1}, False, "distance"),
    ({"trip_distance": 0.0}, True, None),
    ({"fare_amount": None}, False, "amounts"),
    ({"fare_amount": float("nan")}, False, "amounts"),
    ({"fare_amount": float("-inf")}, False, "amounts"),
    ({"fare_amount": float("inf")}, True, None),
    ({"congestion_surcharge": None}, True, None),
    ({"Airport_fee": float("nan")}, False, "amounts"),
    ({"Airport_fee": -1.75}, False, "amounts"),
    ({"passenger_count": None}, True, None),
    ({"passenger_count": 0}, False, "passengers"),
    ({"payment_type": None}, True, None),
    ({"tpep_dropoff_datetime": None}, False, "timestamp_order"),
    ({"tpep_pickup_datetime": None}, False, "timestamp_order"),
    ({"tpep_dropoff_datetime": T0 - dt.timedelta(seconds=1)}, False, "timestamp_order"),
    ({"tpep_dropoff_datetime": T0}, True, None),
    ({"tpep_pickup_datetime": dt.datetime(2025, 12, 31, 23, 0, 0),
      "tpep_dropoff_datetime": dt.datetime(2025, 12, 31, 23, 5, 0)}, True, None),
    ({"tpep_pickup_datetime": dt.datetime(2025, 12, 31, 22, 59, 59),
      "tpep_dropoff_datetime": dt.datetime(2025, 12, 31, 23, 5, 0)}, False, "pickup_range"),
    ({"tpep_pickup_datetime": dt.datetime(2026, 4, 1, 1, 0, 0),
      "tpep_dropoff_datetime": dt.datetime(2026, 4, 1, 1, 5, 0)}, True, None),
    ({"tpep_pickup_datetime": dt.datetime(2026, 4, 1, 1, 0, 1),
      "tpep_dropoff_datetime": dt.datetime(2026, 4, 1, 1, 5, 0)}, False, "pickup_range"),
]


def test_rules_on_edge_rows(spark):
    out = _run(spark, [c[0] for c in CASES])
    for (row, valid, failing), got in zip(CASES, out):
        assert got["_valid"] is valid, (row, got)
        if failing:
            assert got["_rule_" + failing] is False, (row, got)
        assert all(v is not None for v in got.values()), "rules must never be NULL"


@pytest.mark.parametrize("name,ok", [
    ("yellow_tripdata_2026-01.parquet", True),
    ("x_2026-12.parquet", True),
    ("yellow_tripdata_2026-13.parquet", False),
    ("yellow_tripdata_2026-00.parquet", False),
    ("yellow_tripdata.parquet", False),
    ("yellow_tripdata_2026-01.csv", False),
])
def test_source_file_month(spark, name, ok):
    out = _run(spark, [{"_bronze_source_file": name}])
    assert out[0]["_file_ok"] is ok


def test_silver_derived_columns(spark):
    rows = [{}, {"tpep_dropoff_datetime": T0}, {"store_and_fwd_flag": "Y"}, {"store_and_fwd_flag": None},
            {"tpep_pickup_datetime": dt.datetime(2026, 2, 3, 4, 5, 6),
             "tpep_dropoff_datetime": dt.datetime(2026, 2, 3, 4, 35, 6)},
            {"_bronze_source_file": "bad_name.parquet"}]
    data = [tuple({**GOOD, **r}.get(f.name) for f in RAW.fields) for r in rows]
    res = silver.clean(spark.createDataFrame(data, RAW))
    out = res.silver.orderBy("pickup_datetime", "dropoff_datetime", F.asc_nulls_first("store_and_fwd_flag")).collect()
    assert len(out) == 5  # the bad file name is split off, not silver and not quarantine
    assert res.quarantine.count() == 0
    zero = [r for r in out if r.dropoff_datetime == r.pickup_datetime][0]
    assert zero.trip_duration_min == 0.0 and zero.avg_speed_mph is None and zero._silver_zero_duration
    normal = [r for r in out if r.trip_duration_min == 30.0 and r.store_and_fwd_flag == 0][0]
    assert normal.avg_speed_mph == pytest.approx(6.0)
    assert sorted(r.store_and_fwd_flag for r in out if r.store_and_fwd_flag is not None) == [0, 0, 0, 1]
    feb = [r for r in out if r.pickup_datetime.month == 2][0]
    assert feb[spec.OFFSET_COLUMN] == 1
    assert dict(res.silver.dtypes)["store_and_fwd_flag"] == "tinyint"
    assert dict(res.silver.dtypes)[spec.OFFSET_COLUMN] == "int"


def test_quarantine_reasons(spark):
    rows = [{"trip_distance": -1.0, "fare_amount": -2.0}, {"passenger_count": 0}, {"tpep_dropoff_datetime": None}]
    data = [tuple({**GOOD, **r}.get(f.name) for f in RAW.fields) for r in rows]
    q = silver.clean(spark.createDataFrame(data, RAW)).quarantine
    out = {(r.trip_distance, r.passenger_count): r for r in q.collect()}
    a = out[(-1.0, 1)]
    assert a._invalid_distance and a._invalid_amount and not a._invalid_passenger_count
    assert out[(3.0, 0)]._invalid_passenger_count
    c = [r for r in q.collect() if r.dropoff_datetime is None][0]
    assert c._invalid_timestamp_order and not c._outside_pickup_range
    assert dict(q.dtypes)["store_and_fwd_flag"] == "string"


def test_finite_speed_and_percent(spark):
    from lakeshore.functions.common import finite_or_null, percent_of
    df = spark.createDataFrame([(1.0, 0, 0), (float("inf"), 1, 4), (float("nan"), 3, 0), (None, 2, 8)],
                               "x double, p long, w long")
    out = df.select(finite_or_null(F.col("x")).alias("f"), percent_of(F.col("p"), F.col("w")).alias("pc")).collect()
    assert [r.f for r in out] == [1.0, None, None, None]
    assert [r.pc for r in out] == [None, 25.0, None, 25.0]
    assert not any(isinstance(r.f, float) and math.isnan(r.f) for r in out)


def test_durations_ignore_session_time_zone(spark):
    """A trip across the 2026-03-08 US daylight-saving gap keeps its wall-clock
    duration whatever the session zone is."""
    rows = [{"tpep_pickup_datetime": dt.datetime(2026, 3, 8, 1, 35, 9),
             "tpep_dropoff_datetime": dt.datetime(2026, 3, 8, 2, 6, 7),
             "_bronze_source_file": "yellow_tripdata_2026-03.parquet"}]
    data = [tuple({**GOOD, **r}.get(f.name) for f in RAW.fields) for r in rows]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        out = silver.clean(spark.createDataFrame(data, RAW)).silver.collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert out.trip_duration_min == pytest.approx(30 + 58 / 60)
