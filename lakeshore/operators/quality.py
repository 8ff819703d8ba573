"""Long-form data-quality summary (one row per metric) and source balance.

No driver loops and no copies: Silver is reduced once to a tiny frame at (file,
month offset, pickup month, zero flags). One explode sends each of its rows to
every scope that counts it (all rows, its two months, its offset, its file's
offset), one aggregate sums the scopes, and one explode of each scope's metrics
makes the long rows. The quarantine's metrics come the same way from one
aggregate of their own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .. import spec
from ..functions.common import count_true, percent_of, source_month_label

METRIC_COLUMNS = ["month_basis", "source_file", "source_month", "metric_category", "metric_name",
                  "metric_value", "metric_percent", "percent_denominator"]


def _metric(name: Column | str, value: Column, percent: Column, category: str, denominator: str, *, basis: Column | None = None,
            source_file: Column | None = None, source_month: Column | None = None) -> Column:
    """One metric as a struct of METRIC_COLUMNS."""
    text = lambda c: F.lit(None).cast("string") if c is None else c
    month = source_month if source_month is not None else None if source_file is None else source_month_label(source_file)
    return F.struct(
        (basis if basis is not None else F.lit(spec.OVERALL_BASIS)).alias("month_basis"),
        text(source_file).alias("source_file"),
        text(month).alias("source_month"),
        F.lit(category).alias("metric_category"),
        (F.lit(name) if isinstance(name, str) else name).alias("metric_name"),
        value.cast("double").alias("metric_value"),
        percent.cast("double").alias("metric_percent"),
        F.lit(denominator).alias("percent_denominator"),
    )


def _share(name: str, column: str, of: str, category: str, denominator: str, **where: Column) -> Column:
    return _metric(name, F.col(column), percent_of(F.col(column), F.col(of)), category, denominator, **where)


def _explode(df: DataFrame, metrics: Column) -> DataFrame:
    return df.select(F.inline(metrics)).select(*METRIC_COLUMNS)


def silver_profile(silver: DataFrame) -> DataFrame:
    """Silver reduced to (file, offset, pickup_month, zero flags) + counts."""
    zd = F.coalesce(F.col("_silver_zero_duration"), F.lit(False))
    zdist = F.coalesce(F.col("_silver_zero_distance"), F.lit(False))
    return silver.groupBy(
        F.col(spec.SOURCE_FILE_COLUMN).alias("file"),
        F.col(spec.OFFSET_COLUMN).alias("offset"),
        F.date_format(F.col("pickup_datetime"), "yyyy-MM").alias("pickup_month"),
        zd.alias("zd"), zdist.alias("zdist"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        count_true(F.col("_silver_zero_fare")).alias("zfare"),
        count_true(F.col("_silver_zero_total")).alias("ztotal"),
        count_true(F.col("_silver_total_less_than_fare")).alias("tlf"),
    )


def _zero_sums(zd: Column, zdist: Column) -> list[Column]:
    def _sum_if(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("n")).otherwise(0)), F.lit(0))

    return [
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        _sum_if(zd).alias("zero_duration"),
        _sum_if(zdist).alias("zero_distance"),
        _sum_if(zd | zdist).alias("zero_duration_or_distance"),
        _sum_if(zd & zdist).alias("zero_duration_and_distance"),
        F.coalesce(F.sum("zfare"), F.lit(0)).alias("zero_fare_amount"),
        F.coalesce(F.sum("ztotal"), F.lit(0)).alias("zero_total_amount"),
        F.coalesce(F.sum("tlf"), F.lit(0)).alias("total_less_than_fare"),
    ]


def _with_remaining(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "v_all": F.col("rows"),
        "v_exclude_zero_duration": F.col("rows") - F.col("zero_duration"),
        "v_exclude_zero_distance": F.col("rows") - F.col("zero_distance"),
        "v_exclude_both": F.col("rows") - F.col("zero_duration_or_distance"),
    })


def scope_totals(prof: DataFrame) -> DataFrame:
    """Counts of every scope: kind (overall, a month basis, offset, offset_file), file, month, offset.

    The overall scope is there also when Silver is empty, by a row that counts nothing.
    """
    none = F.lit(None)

    def scope(kind: str, file=none, month=none, offset=none) -> Column:
        return F.struct(F.lit(kind).alias("kind"), file.cast("string").alias("file"), month.cast("string").alias("month"),
                        offset.cast("int").alias("offset"))
    source_month = source_month_label(F.col("file"))
    scopes = F.filter(F.array(
        scope("overall"),
        scope("pickup_month", month=F.col("pickup_month")),
        scope("source_month", month=source_month),
        scope("offset", offset=F.col("offset")),
        scope("offset_file", file=F.col("file"), offset=F.col("offset")),
    ), lambda x: x["month"].isNotNull() | ~x["kind"].endswith("_month"))
    empty = prof.sparkSession.range(1).select(
        *(F.lit(None).cast(f.dataType).alias(f.name) if f.name in ("file", "offset", "pickup_month")
          else F.lit(f.name == "x").cast(f.dataType).alias(f.name) for f in prof.schema.fields), F.array(scope("overall")).alias("scopes"))
    fanned = prof.withColumn("scopes", scopes).unionByName(empty).withColumn("s", F.explode("scopes"))
    return _with_remaining(fanned.groupBy("s.kind", "s.file", "s.month", "s.offset").agg(*_zero_sums(F.col("zd"), F.col("zdist"))))


def quarantine_profile(quarantine: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Rejected rows, the 5 reason counts and 4 detail counts: one row (or one for each value of `by`)."""
    return quarantine.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rejected"),
        *[count_true(F.col(flag)).alias(flag) for flag in spec.REJECTION_FLAGS],
        count_true(F.col("trip_distance") < 0.0).alias("negative_trip_distance"),
        count_true(F.col("fare_amount") < 0.0).alias("negative_fare_amount"),
        count_true(F.col("total_amount") < 0.0).alias("negative_total_amount"),
        count_true(F.col("dropoff_datetime") < F.col("pickup_datetime")).alias("dropoff_before_pickup"),
    )


def quarantine_profile_schema() -> StructType:
    """Counts of a `quarantine_profile` row."""
    names = ("rejected", *spec.REJECTION_FLAGS, "negative_trip_distance", "negative_fare_amount", "negative_total_amount", "dropoff_before_pickup")
    return StructType([StructField(n, LongType()) for n in names])


def data_quality_summary(silver: DataFrame, quarantine: DataFrame, bronze_rows: DataFrame,
                         transform_log: DataFrame, *, with_run_columns: bool = True) -> DataFrame:
    """All metric families of the quality table.

    `bronze_rows` is a one-row frame with column `bronze_rows`; `transform_log`
    holds successful Silver runs (source_file, rows_read, rows_rejected,
    rows_written).
    """
    return summary_of_profiles(silver_profile(silver), quarantine_profile(quarantine), bronze_rows, transform_log, with_run_columns=with_run_columns)


def summary_of_profiles(profile: DataFrame, rejected_profile: DataFrame, bronze_rows: DataFrame,
                        transform_log: DataFrame, *, with_run_columns: bool = True) -> DataFrame:
    """The quality table from (stored) rows of `silver_profile` and `quarantine_profile`, which may be several a scope."""
    totals = scope_totals(profile).withColumn("scope_rows", F.sum("rows").over(Window.partitionBy("kind", "file")))
    counts = [f.name for f in quarantine_profile_schema()]
    qp = rejected_profile.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in counts])

    # Metrics of the zero filters, for all rows and for each month of either basis.
    monthly = {"basis": F.col("kind"), "source_month": F.col("month")}
    impact = [(n, n) for n in spec.ZERO_IMPACT_NAMES]
    remaining = [(v, f"v_{v}") for v in spec.DATA_VARIANTS]
    overall = [
        *(_share(spec.WARNING_NAMES[f], spec.WARNING_NAMES[f], "rows", "silver_warning", "silver_rows") for f in spec.WARNING_FLAGS),
        *(_share(n, c, "rows", "zero_filter_impact", "silver_rows") for n, c in impact),
        *(_share(n, c, "rows", "zero_filter_remaining", "silver_rows") for n, c in remaining)]
    by_month = [
        *(_share(n, c, "rows", "zero_filter_impact_month", "silver_rows_in_month", **monthly) for n, c in impact),
        *(_share(n, c, "rows", "zero_filter_remaining_month", "silver_rows_in_month", **monthly) for n, c in remaining)]
    # The denominator of an offset is its scope's rows (a window over one scope's distinct offsets).
    offset = F.concat(F.lit("offset_"), F.col("offset").cast("string"))
    offset_share = percent_of(F.col("rows"), F.col("scope_rows"))
    by_offset = [_metric(offset, F.col("rows"), offset_share, "month_offset", "silver_rows")]
    by_file = [_metric(offset, F.col("rows"), offset_share, "month_offset_file", "silver_rows_in_source_file", source_file=F.col("file"))]
    # pipeline: bronze, silver, rejected, accounted (percent of bronze rows). The
    # bronze and rejected counts enter as scalar subqueries (no joins).
    totals = totals.withColumns({
        "bronze_rows": bronze_rows.select(F.col("bronze_rows").cast("bigint")).scalar(),
        "rows_rejected_unique": qp.select("rejected").scalar()})
    accounted = F.col("rows") + F.col("rows_rejected_unique")
    pipeline = [_metric("bronze_rows", F.col("bronze_rows"), F.lit(100.0), "pipeline", "bronze_rows")] + [
        _metric(n, c, percent_of(c, F.col("bronze_rows")), "pipeline", "bronze_rows")
        for n, c in (("silver_rows", F.col("rows")), ("rows_rejected_unique", F.col("rows_rejected_unique")), ("rows_accounted_for", accounted))]
    of_silver = _explode(totals, F.when(F.col("kind") == "overall", F.array(*pipeline, *overall))
                         .when(F.col("kind") == "offset", F.array(*by_offset)).when(F.col("kind") == "offset_file", F.array(*by_file))
                         .otherwise(F.array(*by_month)))

    # pipeline_file: one triple per successful Silver run.
    runs = [_metric(n, F.col(n), F.lit(100.0) if n == "rows_read" else percent_of(F.col(n), F.col("rows_read")), "pipeline_file",
                    "file_rows_read", source_file=F.col("source_file")) for n in ("rows_read", "rows_written", "rows_rejected")]
    # rejection_reason / rejection_detail over quarantine rows.
    rejected = [_share(spec.REJECTION_REASON_NAMES[f], f, "rejected", "rejection_reason", "rejected_rows") for f in spec.REJECTION_FLAGS]
    rejected += [_share(n, n, "rejected", "rejection_detail", "rejected_rows")
                 for n in ("negative_trip_distance", "negative_fare_amount", "negative_total_amount", "dropoff_before_pickup")]
    out = reduce(DataFrame.unionByName, [of_silver, _explode(transform_log, F.array(*runs)), _explode(qp, F.array(*rejected))])
    if with_run_columns:
        out = out.select(
            "month_basis", F.current_date().alias("metric_date"), "source_file", "source_month",
            "metric_category", "metric_name", "metric_value", "metric_percent", "percent_denominator",
            F.current_timestamp().alias("generated_at"))
    return out


def source_balance(bronze_rows: DataFrame, silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """bronze = silver + quarantine? (skipped, i.e. balanced, when bronze is 0)."""
    out = bronze_rows.select(
        F.col("bronze_rows").cast("bigint").alias("bronze_rows"),
        silver.agg(F.count(F.lit(1))).scalar().alias("silver_rows"),
        quarantine.agg(F.count(F.lit(1))).scalar().alias("quarantine_rows"),
    )
    accounted = F.col("silver_rows") + F.col("quarantine_rows")
    return out.select(
        "bronze_rows", "silver_rows", "quarantine_rows", accounted.alias("accounted_rows"),
        ((F.col("bronze_rows") == 0) | (accounted == F.col("bronze_rows"))).alias("balanced"),
    )
