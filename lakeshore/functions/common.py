"""Small, reusable column helpers (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import spec

INF = float("inf")


def count_true(cond: Column) -> Column:
    """Rows where `cond` is true; NULL counts as false; 0 on no rows."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def percent_of(part: Column, whole: Column) -> Column:
    """part / whole * 100 as double, NULL when whole is 0 or NULL."""
    w = whole.cast("double")
    return F.when(w != 0.0, part.cast("double") / w * 100.0)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when den is NULL or 0."""
    return F.when(den.isNotNull() & (den != 0.0), num / den)


def finite_or_null(c: Column) -> Column:
    """Keep finite values; NULL, NaN and +-inf become NULL."""
    return F.when(F.abs(c) < F.lit(INF), c)


def source_month_label(source_file: Column) -> Column:
    """`YYYY-MM` from a `..._YYYY-MM.parquet` name, else NULL."""
    return F.nullif(F.regexp_extract(source_file, spec.SOURCE_MONTH_LABEL_REGEX, 1), F.lit(""))


def as_category_string(c: Column) -> Column:
    """Integer-like id as text; NULL or unparseable -> 'Unknown'."""
    return F.coalesce(c.try_cast("double").try_cast("bigint").cast("string"), F.lit("Unknown"))


def optional_eq(c: Column, value) -> Column:
    """`value IS NULL OR c = value`: a filter that disappears when unset."""
    if value is None:
        return F.lit(True)
    return c == F.lit(value)


def variant_list(zero_duration: Column, zero_distance: Column) -> Column:
    """Data variants a row belongs to (variants overlap: a fan-out)."""
    zd = F.coalesce(zero_duration, F.lit(False))
    zdist = F.coalesce(zero_distance, F.lit(False))
    return F.filter(
        F.array(
            F.lit("all"),
            F.when(~zd, F.lit("exclude_zero_duration")),
            F.when(~zdist, F.lit("exclude_zero_distance")),
            F.when(~zd & ~zdist, F.lit("exclude_both")),
        ),
        lambda v: v.isNotNull(),
    )


def keep_for_variant(variant: str) -> Column:
    """Row filter of one data variant over Silver warning flags."""
    zd = F.coalesce(F.col("_silver_zero_duration"), F.lit(False))
    zdist = F.coalesce(F.col("_silver_zero_distance"), F.lit(False))
    if variant == "all":
        return F.lit(True)
    if variant == "exclude_zero_duration":
        return ~zd
    if variant == "exclude_zero_distance":
        return ~zdist
    if variant == "exclude_both":
        return ~zd & ~zdist
    raise ValueError(f"unknown data variant {variant!r}")
