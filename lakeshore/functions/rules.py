"""Column expressions for the Silver validity rules, warnings and derived fields.

Every rule is a non-null boolean: NULL inputs get an explicit per-rule default,
and floating inputs get a NaN guard because Spark orders NaN above every number
(so `NaN >= 0` is true in Spark, but must count as invalid here).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StructType

from .. import spec


def _is_floating(schema: StructType | None, name: str) -> bool:
    if schema is None or name not in schema.fieldNames():
        return True
    dtype: DataType = schema[name].dataType
    return isinstance(dtype, (DoubleType, FloatType))


def compare_num(name: str, op: str, bound: float, default: bool,
                schema: StructType | None = None) -> Column:
    """`name <op> bound`, NaN counts as failing, NULL -> `default`."""
    c = F.col(name)
    cond = {">=": c >= bound, ">": c > bound}[op]
    if _is_floating(schema, name):
        cond = cond & ~F.isnan(c)
    return F.coalesce(cond, F.lit(default))


def ntz(ts: str) -> Column:
    return F.lit(ts).cast("timestamp_ntz")


def timestamp_order_valid() -> Column:
    return F.coalesce(F.col("dropoff_datetime") >= F.col("pickup_datetime"), F.lit(False))


def pickup_range_valid(min_pickup: str = spec.MIN_PICKUP, max_pickup: str = spec.MAX_PICKUP) -> Column:
    p = F.col("pickup_datetime")
    return F.coalesce((p >= ntz(min_pickup)) & (p <= ntz(max_pickup)), F.lit(False))


def distance_valid(schema: StructType | None = None) -> Column:
    return compare_num("trip_distance", ">=", 0.0, False, schema)


def amount_valid(column: str, schema: StructType | None = None) -> Column:
    return compare_num(column, ">=", 0.0, column in spec.OPTIONAL_AMOUNT_COLUMNS, schema)


def amounts_valid(schema: StructType | None = None) -> Column:
    return reduce(lambda a, b: a & b, [amount_valid(c, schema) for c in spec.AMOUNT_COLUMNS])


def passengers_valid(schema: StructType | None = None) -> Column:
    return compare_num("passenger_count", ">", 0, True, schema)


def rule_columns(schema: StructType | None = None, min_pickup: str = spec.MIN_PICKUP,
                 max_pickup: str = spec.MAX_PICKUP) -> dict[str, Column]:
    """The five validity rules, keyed by rule name (renamed columns expected)."""
    return {
        "timestamp_order": timestamp_order_valid(),
        "pickup_range": pickup_range_valid(min_pickup, max_pickup),
        "distance": distance_valid(schema),
        "amounts": amounts_valid(schema),
        "passengers": passengers_valid(schema),
    }


def zero_duration_warning() -> Column:
    return F.coalesce(F.col("dropoff_datetime") == F.col("pickup_datetime"), F.lit(False))


def warning_columns() -> dict[str, Column]:
    return {
        "_silver_zero_duration": zero_duration_warning(),
        "_silver_zero_distance": F.coalesce(F.col("trip_distance") == 0.0, F.lit(False)),
        "_silver_zero_fare": F.coalesce(F.col("fare_amount") == 0.0, F.lit(False)),
        "_silver_zero_total": F.coalesce(F.col("total_amount") == 0.0, F.lit(False)),
        "_silver_total_less_than_fare": F.coalesce(
            F.col("total_amount") < F.col("fare_amount"), F.lit(False)),
    }


def file_month_label(source_file: Column) -> Column:
    """`YYYY-MM` from a `..._YYYY-MM.parquet` name, '' when it does not match.
    The one regex per row; validity and month number derive from its text."""
    return F.regexp_extract(source_file, spec.SOURCE_MONTH_LABEL_REGEX, 1)


def _label_year(label: Column) -> Column:
    return F.substring(label, 1, 4).try_cast("int")


def _label_month(label: Column) -> Column:
    return F.substring(label, 6, 2).try_cast("int")


def file_label_valid(label: Column) -> Column:
    """The name carries a usable month (it matched, and the month is 1..12)."""
    return F.coalesce((label != "") & _label_month(label).between(1, 12), F.lit(False))


def source_file_valid(source_file: Column) -> Column:
    return file_label_valid(file_month_label(source_file))


def source_month_offset(pickup: Column, label: Column) -> Column:
    """(pickup year*12 + month) - (file year*12 + month), as int; `label` is
    the file's `YYYY-MM` (see file_month_label)."""
    file_number = _label_year(label) * 12 + _label_month(label)
    pickup_number = F.year(pickup) * 12 + F.month(pickup)
    return (pickup_number - file_number).cast("int")


def interval_micros(iv: Column) -> Column:
    """A day-time interval in microseconds.

    TIMESTAMP_NTZ subtraction yields such an interval, computed on the wall
    clock alone; `timestamp_diff` would cast to the session time zone first,
    which skews trips that span a daylight-saving change in non-UTC sessions.
    """
    return (F.extract(F.lit("DAY"), iv).cast("long") * 86_400_000_000
            + F.extract(F.lit("HOUR"), iv).cast("long") * 3_600_000_000
            + F.extract(F.lit("MINUTE"), iv).cast("long") * 60_000_000
            + (F.extract(F.lit("SECOND"), iv) * 1_000_000).cast("long"))


def duration_minutes(iv: Column) -> Column:
    """Minutes of the interval between pickup and dropoff, which the caller names once as a column."""
    return interval_micros(iv).cast("double") / F.lit(60_000_000.0)


def avg_speed_mph(duration_min: Column) -> Column:
    return F.when(duration_min > 0.0, F.col("trip_distance") * 60.0 / duration_min)


def encode_flag(name: str = "store_and_fwd_flag") -> Column:
    return (F.col(name) == F.lit("Y")).cast("tinyint")
