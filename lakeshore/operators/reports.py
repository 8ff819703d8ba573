"""Reporting layer over the Gold tables, as Spark jobs.

Each report is described once (`REPORTS`): its Gold table, the columns whose
value must be given, those whose value may be given (None means all rows) and
the order. `run_report` makes the query of it.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import as_category_string, optional_eq


@dataclass(frozen=True)
class Report:
    table: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    #: Column names in order; "-" before a name: descending, "^": nulls first.
    order: tuple[str, ...] = ()
    limited: bool = False


REPORTS = {
    "daily_metrics": Report("daily_trip_summary", ("data_variant",), order=("trip_date",)),
    "monthly_kpi": Report("monthly_kpi", ("data_variant", "month_basis"), order=("year_month",)),
    "zone_analysis": Report(
        "zone_flow_monthly", ("data_variant", "month_basis"), ("year_month", "pickup_location_id", "dropoff_location_id"),
        ("-trip_count", "year_month", "pickup_location_id", "dropoff_location_id"), limited=True),
    "payment_analysis": Report("payment_monthly", ("data_variant", "month_basis"), ("year_month", "payment_type"), ("year_month", "payment_type")),
    "vendor_analysis": Report("vendor_monthly", ("data_variant", "month_basis"), ("year_month", "vendor_id"), ("year_month", "vendor_id")),
    "data_quality": Report(
        "data_quality_summary", (), ("month_basis", "metric_category", "source_month"),
        ("month_basis", "^source_month", "metric_category", "metric_name")),
    "payment_null_profile": Report("payment_null_profile", ("data_variant",), ("payment_type",), ("payment_type", "field_name")),
}


def order_key(key: str) -> Column:
    if key.startswith("-"):
        return F.desc_nulls_last(key[1:])
    return F.asc_nulls_first(key[1:]) if key.startswith("^") else F.asc_nulls_last(key)


def run_report(report: str, table: DataFrame, params: dict[str, Any], row_limit: int | None = None,
               extra_order: tuple[str, ...] = ()) -> DataFrame:
    """The rows of one report from its Gold table, in its order (then `extra_order`, for ties)."""
    r = REPORTS[report]
    if unknown := set(params) - set(r.required) - set(r.optional):
        raise ValueError(f"{report} takes no {', '.join(sorted(unknown))}")
    if missing := [c for c in r.required if params.get(c) is None]:
        raise ValueError(f"{report} needs {', '.join(missing)}")
    out = filter_equal(table, **{c: params.get(c) for c in (*r.required, *r.optional)})
    out = out.orderBy(*map(order_key, (*r.order, *extra_order)))
    return out.limit(row_limit) if r.limited and row_limit is not None else out


def numbered(df: DataFrame, keys: list[Column]) -> DataFrame:
    """df with `row_no`, each row's place in the given order (for results of a few pages: one window over all rows)."""
    return df.withColumn("row_no", F.row_number().over(Window.orderBy(*keys)))


# ---------------------------------------------------------------------------
# Dashboard data operators.
# ---------------------------------------------------------------------------

def filter_months(df: DataFrame, months: Iterable[str] | None, column: str = "year_month") -> DataFrame:
    """Keep rows in the chosen months; an empty choice means no filter."""
    months = list(months or [])
    return df.filter(F.col(column).isin(months)) if months else df


def filter_daily_months(daily: DataFrame, months: Iterable[str] | None, month_basis: str) -> DataFrame:
    """Daily rows by month prefix of the date; only under the pickup basis."""
    months = list(months or [])
    if not months or month_basis != "pickup_month":
        return daily
    return daily.filter(F.substring(F.col("trip_date").cast("string"), 1, 7).isin(months))


def filter_equal(df: DataFrame, **selected) -> DataFrame:
    """Equality filters where None (the 'All' choice) means no filter."""
    for column, value in selected.items():
        if value is not None:
            df = df.filter(optional_eq(F.col(column), value))
    return df


def as_category_strings(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: as_category_string(F.col(c)) for c in columns if c in df.columns})


def weighted_kpis(monthly: DataFrame) -> DataFrame:
    """Trip-weighted averages over the chosen monthly rows (0 when no trips)."""
    agg = monthly.agg(
        F.coalesce(F.sum("trip_count"), F.lit(0)).cast("bigint").alias("total_trips"),
        F.coalesce(F.sum("total_revenue"), F.lit(0.0)).alias("total_revenue"),
        F.sum(F.col("avg_trip_distance") * F.col("trip_count")).alias("_wd"),
        F.sum(F.col("avg_trip_duration_min") * F.col("trip_count")).alias("_wt"),
    )
    trips = F.col("total_trips")
    return agg.select(
        "total_trips", "total_revenue",
        F.when(trips != 0, F.coalesce(F.col("_wd"), F.lit(0.0)) / trips).otherwise(0.0).alias("weighted_distance"),
        F.when(trips != 0, F.coalesce(F.col("_wt"), F.lit(0.0)) / trips).otherwise(0.0).alias("weighted_duration"),
    )


def top_k(df: DataFrame, k: int, by: str = "trip_count", tie_keys: list[str] | None = None) -> DataFrame:
    """k largest rows by `by`; ties broken by the given keys (ascending).

    orderBy + limit plans as TakeOrderedAndProject: each task keeps its own
    top k and only k rows per task reach the final merge.
    """
    keys = [F.desc_nulls_last(by)] + [F.asc_nulls_last(c) for c in (tie_keys or [])]
    return df.orderBy(*keys).limit(k)


def top_zones_share(zone_monthly: DataFrame, zone_column: str, k: int = 20) -> DataFrame:
    """Top-k zones by summed trips with their share of all shown-zone trips.

    The share base is the total over all zones (not just the top k, and with
    the trips of no zone); a base of 0 gives NULL ("n/a"). It is summed from the
    per-zone totals, a row a zone, so the table is read once.
    """
    per_zone = zone_monthly.groupBy(zone_column).agg(F.sum("trip_count").cast("bigint").alias("trip_count"))
    everything = Window.partitionBy()
    per_zone = per_zone.withColumn("base", F.sum("trip_count").over(everything).cast("double")).filter(F.col(zone_column).isNotNull())
    top = top_k(per_zone, k, tie_keys=[zone_column])
    return top.select(
        as_category_string(F.col(zone_column)).alias(zone_column),
        "trip_count",
        F.when(F.col("base") != 0, F.col("trip_count") / F.col("base") * 100.0).alias("share_percent"),
    )


def totals_by(df: DataFrame, key: str) -> DataFrame:
    """Summed trips per key; NULL keys are dropped (as a pandas groupby does)."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.sum("trip_count").cast("bigint").alias("trip_count"))
            .select(as_category_string(F.col(key)).alias(key), "trip_count"))


FUNNEL_ORDER = ("bronze_rows", "silver_rows", "rows_rejected_unique")


def pipeline_funnel(quality: DataFrame) -> DataFrame:
    """Overall pipeline metrics in fixed funnel order, first row per name,
    with each step's percent of the first step."""
    order = F.array(*[F.lit(n) for n in FUNNEL_ORDER])
    pipe = quality.filter((F.col("month_basis") == "overall") & (F.col("metric_category") == "pipeline")
                          & F.col("metric_name").isin(*FUNNEL_ORDER) & F.col("metric_value").isNotNull())
    pipe = pipe.withColumn("step", F.array_position(order, F.col("metric_name")).cast("int"))
    # First row per name (deterministically the smallest value); the first step's value is
    # that of the first of at most three rows, by a window over them: one plan of the table.
    first = pipe.groupBy("metric_name", "step").agg(F.min("metric_value").alias("metric_value"))
    initial = F.first("metric_value").over(Window.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    first = first.withColumn("initial", initial)
    return first.select(
        "step", "metric_name", "metric_value",
        F.when(F.col("initial") != 0, F.col("metric_value") / F.col("initial") * 100.0).alias("percent_initial"),
    )


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def dimension_values(df: DataFrame, dimensions: dict[str, str]) -> DataFrame:
    """Distinct non-null values of several columns (dimension name -> column) as (dimension, value), in one scan."""
    pairs = F.array(*[F.struct(F.lit(n).alias("dimension"), F.col(c).cast("string").alias("value")) for n, c in dimensions.items()])
    return df.select(F.explode(pairs).alias("p")).select("p.*").filter(F.col("value").isNotNull()).distinct()


QUALITY_ORDER = ("month_basis", "source_month", "metric_category", "metric_name")


def quality_metrics(quality: DataFrame, categories: list[str] | None = None,
                    include_overall: bool = True) -> DataFrame:
    """Raw DQ metrics for the chosen categories, sorted with NULLs last."""
    out = quality
    if categories is not None:
        out = out.filter(F.col("metric_category").isin(categories))
    if not include_overall:
        out = out.filter(F.col("month_basis") != "overall")
    return out.orderBy(*map(order_key, QUALITY_ORDER))


def profile_as_metrics(profile: DataFrame, data_variant: str = "all", payment_type: int = 0) -> DataFrame:
    """Null-profile rows of one payment type renamed to the metric vocabulary."""
    rows = profile.filter((F.col("data_variant") == data_variant) & (F.col("payment_type") == payment_type))
    return rows.withColumnsRenamed({"field_name": "metric_name", "null_percent": "metric_percent",
                                    "null_count": "metric_value"})


def share_of_total(df: DataFrame, value: str, base: Column | None = None) -> DataFrame:
    """Each row's share of the total of the shown rows (or of a given base).

    The total is a scalar subquery (its own global aggregate, computed once),
    not a window over an unpartitioned frame, so no task holds all rows.
    """
    total = df.agg(F.sum(value).cast("double")).scalar() if base is None else base.cast("double")
    return df.withColumn("share_percent", F.when(total != 0, F.col(value) / total * 100.0))
