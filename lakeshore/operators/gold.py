"""Silver -> Gold summary tables under 4 data variants x 2 month bases.

Plan shape (the point of this module):

1. Aggregate Silver once at the table's grain plus the two zero flags and the
   two month keys, keeping mergeable measures only: row count, sums, and
   non-null counts of every averaged column. Map-side partial aggregation
   shrinks the shuffle to (distinct keys per task).
2. Explode that small frame into the data variants each flag pair belongs to
   (variants overlap, so this is a fan-out) and into the two month bases.
3. Re-aggregate and finish the means as sum / non-null count.

This equals filtering Silver per variant and grouping per basis (8 scans of
Silver) but scans it once; the explode multiplies only the pre-aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import spec
from ..functions.common import finite_or_null, keep_for_variant, percent_of, safe_ratio, source_month_label, variant_list

ZD = "_silver_zero_duration"
ZDIST = "_silver_zero_distance"


# The output columns of the Gold tables, in order.
# Output column -> (kind, source). Kinds: count | sum | sum0 | mean | ratio.
COUNT = ("count", None)


def SUM(c):
    return ("sum", c)


def SUM0(c):
    return ("sum0", c)


def MEAN(c):
    return ("mean", c)


DAILY_MEASURES = [
    ("trip_count", COUNT),
    ("passenger_count_total", SUM0("passenger_count")),
    ("total_trip_distance", SUM("trip_distance")),
    ("total_fare_amount", SUM("fare_amount")),
    ("total_tip_amount", SUM("tip_amount")),
    ("total_revenue", SUM("total_amount")),
    ("avg_trip_distance", MEAN("trip_distance")),
    ("avg_trip_duration_min", MEAN("trip_duration_min")),
    ("avg_speed_mph", MEAN("finite_speed_mph")),
    ("avg_fare_amount", MEAN("fare_amount")),
    ("avg_total_amount", MEAN("total_amount")),
]

MONTHLY_MEASURES = [
    ("trip_count", COUNT),
    ("passenger_count_total", SUM0("passenger_count")),
    ("total_trip_distance", SUM("trip_distance")),
    ("total_revenue", SUM("total_amount")),
    ("total_fare_amount", SUM("fare_amount")),
    ("total_tip_amount", SUM("tip_amount")),
    ("avg_fare_amount", MEAN("fare_amount")),
    ("avg_total_amount", MEAN("total_amount")),
    ("avg_trip_distance", MEAN("trip_distance")),
    ("avg_trip_duration_min", MEAN("trip_duration_min")),
    ("avg_speed_mph", MEAN("finite_speed_mph")),
]

ZONE_MEASURES = [
    ("trip_count", COUNT),
    ("total_revenue", SUM("total_amount")),
    ("avg_total_amount", MEAN("total_amount")),
    ("avg_fare_amount", MEAN("fare_amount")),
    ("avg_tip_amount", MEAN("tip_amount")),
    ("avg_trip_distance", MEAN("trip_distance")),
    ("avg_trip_duration_min", MEAN("trip_duration_min")),
    ("avg_speed_mph", MEAN("finite_speed_mph")),
]

PAYMENT_MEASURES = [
    ("trip_count", COUNT),
    ("total_revenue", SUM("total_amount")),
    ("total_fare_amount", SUM("fare_amount")),
    ("total_tip_amount", SUM("tip_amount")),
    ("avg_total_amount", MEAN("total_amount")),
    ("avg_fare_amount", MEAN("fare_amount")),
    ("avg_tip_amount", MEAN("tip_amount")),
    ("recorded_tip_to_fare_rate", ("ratio", ("tip_amount", "fare_amount"))),
    ("avg_trip_distance", MEAN("trip_distance")),
    ("avg_trip_duration_min", MEAN("trip_duration_min")),
]

# Declared Gold key types (values of the measures are bigint or double).
KEY_TYPES = {
    "trip_date": "date",
    "year_month": "string",
    "pickup_location_id": "int",
    "dropoff_location_id": "int",
    "vendor_id": "int",
    "payment_type": "bigint",
}


@dataclass(frozen=True)
class GoldTable:
    name: str
    keys: tuple[str, ...]          # grouping keys besides the month
    measures: list
    monthly: bool = True           # built under both month bases


GOLD_DEFS = {
    "daily_trip_summary": GoldTable("daily_trip_summary", ("trip_date",), DAILY_MEASURES, monthly=False),
    "monthly_kpi": GoldTable("monthly_kpi", (), MONTHLY_MEASURES),
    "pickup_zone_monthly": GoldTable("pickup_zone_monthly", ("pickup_location_id",), ZONE_MEASURES),
    "dropoff_zone_monthly": GoldTable("dropoff_zone_monthly", ("dropoff_location_id",), ZONE_MEASURES),
    "zone_flow_monthly": GoldTable("zone_flow_monthly", ("pickup_location_id", "dropoff_location_id"),
                                   ZONE_MEASURES),
    "payment_zone_flow_monthly": GoldTable(
        "payment_zone_flow_monthly", ("payment_type", "pickup_location_id", "dropoff_location_id"), ZONE_MEASURES),
    "vendor_zone_flow_monthly": GoldTable(
        "vendor_zone_flow_monthly", ("vendor_id", "pickup_location_id", "dropoff_location_id"), ZONE_MEASURES),
    "payment_monthly": GoldTable("payment_monthly", ("payment_type",), PAYMENT_MEASURES),
    "vendor_monthly": GoldTable("vendor_monthly", ("vendor_id",), ZONE_MEASURES),
}


def _atoms(measures) -> tuple[list[str], list[str]]:
    """Columns whose sum, and whose non-null count, the measures need."""
    sums: list[str] = []
    counts: list[str] = []
    for _, (kind, src) in measures:
        if kind in ("sum", "sum0"):
            sums.append(src)
        elif kind == "mean":
            sums.append(src)
            counts.append(src)
        elif kind == "ratio":
            sums.extend(src)
    return list(dict.fromkeys(sums)), list(dict.fromkeys(counts))


def _month_keys(silver: DataFrame) -> list[Column]:
    """Integer month keys (year * 12 + month - 1) for both bases.

    Silver's `_silver_source_month_offset` is pickup month minus file month,
    so the file month is the pickup month minus the offset: all-integer keys,
    no per-row string hashing or regex. Tables without the offset fall back
    to grouping by the file name (labelled after aggregation).
    """
    p = F.col("pickup_datetime")
    pickup_idx = F.year(p) * 12 + F.month(p) - 1
    if spec.OFFSET_COLUMN in silver.columns:
        source = (pickup_idx - F.col(spec.OFFSET_COLUMN)).alias("_source_idx")
    else:
        source = F.col(spec.SOURCE_FILE_COLUMN).alias("_source_file")
    return [pickup_idx.alias("_pickup_idx"), source]


def _idx_label(idx: Column) -> Column:
    """`yyyy-MM` text of a month index (NULL stays NULL)."""
    return F.when(idx.isNotNull(), F.format_string("%04d-%02d", F.floor(idx / 12), idx % 12 + 1))


def preaggregate(silver: DataFrame, keys, measures, monthly: bool) -> DataFrame:
    """Stage 1: one pass over Silver at (keys, zero flags, month keys)."""
    sums, counts = _atoms(measures)
    group = [F.col(k) for k in keys]
    if monthly:
        group += _month_keys(silver)
    group += [F.coalesce(F.col(ZD), F.lit(False)).alias("_zd"),
              F.coalesce(F.col(ZDIST), F.lit(False)).alias("_zdist")]
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.sum(c).alias(f"_s_{c}") for c in sums]
    aggs += [F.count(c).alias(f"_c_{c}") for c in counts]
    return silver.groupBy(*group).agg(*aggs)


def _label(codes: tuple[str, ...], idx: Column) -> Column:
    """Text label of an integer code (0-based index into `codes`)."""
    return F.element_at(F.array(*[F.lit(c) for c in codes]), idx + 1)


def _variant_codes(zd: Column, zdist: Column) -> Column:
    """Indexes into DATA_VARIANTS of the variants a flag pair belongs to."""
    return F.filter(F.array(F.lit(0), F.when(~zd, F.lit(1)), F.when(~zdist, F.lit(2)),
                            F.when(~zd & ~zdist, F.lit(3))), lambda v: v.isNotNull())


def fan_out(pre: DataFrame, monthly: bool) -> DataFrame:
    """Stage 2: each pre-aggregated row -> its variants x month bases.

    Variant, basis and month stay integer codes through the merge; the text
    labels are produced on the final rows only.
    """
    out = pre.withColumn("_v", F.explode(_variant_codes(F.col("_zd"), F.col("_zdist"))))
    if monthly:
        by_file = "_source_file" in pre.columns
        pickup_m = F.col("_pickup_idx").cast("string") if by_file else F.col("_pickup_idx")
        source_m = F.col("_source_file") if by_file else F.col("_source_idx")
        bases = F.array(F.struct(F.lit(0).alias("b"), pickup_m.alias("m")),
                        F.struct(F.lit(1).alias("b"), source_m.alias("m")))
        out = out.withColumn("_basis", F.explode(bases)).withColumns(
            {"_b": F.col("_basis.b"), "_m": F.col("_basis.m")})
    return out


def _month_text(m: Column, by_file: bool, basis: Column) -> Column:
    if not by_file:
        return _idx_label(m)
    # Fallback layout: pickup months arrive as index text, source months as file names.
    return F.when(basis == 0, _idx_label(m.cast("int"))).otherwise(source_month_label(m))


def finish(fanned: DataFrame, keys, measures, monthly: bool) -> DataFrame:
    """Stage 3: merge the measures per output row and compute the means."""
    sums, counts = _atoms(measures)
    group = ["_v"] + (["_b", "_m"] if monthly else []) + list(keys)
    merged = fanned.groupBy(*group).agg(
        F.sum("_n").alias("_n"),
        *[F.sum(f"_s_{c}").alias(f"_s_{c}") for c in sums],
        *[F.sum(f"_c_{c}").alias(f"_c_{c}") for c in counts],
    )
    cols = [_label(spec.DATA_VARIANTS, F.col("_v")).alias("data_variant")]
    if monthly:
        by_file = "_source_file" in fanned.columns
        cols += [_label(spec.MONTH_BASES, F.col("_b")).alias("month_basis"),
                 _month_text(F.col("_m"), by_file, F.col("_b")).alias("year_month")]
    return merged.select(*cols, *_outputs(keys, measures))


def _outputs(keys, measures) -> list[Column]:
    """The typed keys and the measures, from merged sums and counts."""
    cols = [F.col(k).cast(KEY_TYPES[k]).alias(k) if k in KEY_TYPES else F.col(k) for k in keys]
    for name, (kind, src) in measures:
        if kind == "count":
            expr = F.col("_n").cast("bigint")
        elif kind == "sum0":
            expr = F.coalesce(F.col(f"_s_{src}"), F.lit(0)).cast("bigint")
        elif kind == "sum":
            expr = F.col(f"_s_{src}").cast("double")
        elif kind == "mean":
            expr = F.when(F.col(f"_c_{src}") > 0,
                          F.col(f"_s_{src}").cast("double") / F.col(f"_c_{src}").cast("double"))
        elif kind == "ratio":
            num, den = src
            expr = safe_ratio(F.col(f"_s_{num}").cast("double"), F.col(f"_s_{den}").cast("double"))
        else:
            raise ValueError(kind)
        cols.append(expr.alias(name))
    return cols


def prepare(silver: DataFrame, table: str) -> DataFrame:
    """Silver plus the derived inputs this table's measures and keys need."""
    d = GOLD_DEFS[table]
    src = silver
    if "finite_speed_mph" not in silver.columns:
        src = src.withColumn("finite_speed_mph", finite_or_null(F.col("avg_speed_mph")))
    if "trip_date" in d.keys and "trip_date" not in src.columns:
        src = src.withColumn("trip_date", F.to_date(F.col("pickup_datetime")))
    return src


def build(silver: DataFrame, table: str, variants: tuple[str, ...] | None = None,
          bases: tuple[str, ...] | None = None) -> DataFrame:
    """Build one Gold table from Silver rows: all variants and bases, or the chosen ones.

    A single variant (and, for a monthly table, a single basis) needs no
    fan-out: its rows are filtered before the only aggregate.
    """
    d = GOLD_DEFS[table]
    src = prepare(silver, table)
    if variants is not None and len(variants) == 1 and (not d.monthly or bases is not None and len(bases) == 1):
        return _build_one(src, d, variants[0], bases[0] if d.monthly else None)
    pre = preaggregate(src, d.keys, d.measures, d.monthly)
    out = finish(fan_out(pre, d.monthly), d.keys, d.measures, d.monthly)
    if variants is not None:
        out = out.filter(F.col("data_variant").isin(list(variants)))
    return out.filter(F.col("month_basis").isin(list(bases))) if d.monthly and bases is not None else out


def _build_one(src: DataFrame, d: GoldTable, variant: str, basis: str | None) -> DataFrame:
    sums, counts = _atoms(d.measures)
    keys = [F.col(k) for k in d.keys]
    if basis is not None:
        month = dict(zip(spec.MONTH_BASES, _month_keys(src)))[basis]
        keys.append(month.alias("_m"))
    merged = src.filter(keep_for_variant(variant)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_s_{c}") for c in sums], *[F.count(c).alias(f"_c_{c}") for c in counts])
    lead = [F.lit(variant).alias("data_variant")]
    if basis is not None:
        by_file = basis == spec.MONTH_BASES[1] and spec.OFFSET_COLUMN not in src.columns
        lead += [F.lit(basis).alias("month_basis"),
                 (source_month_label(F.col("_m")) if by_file else _idx_label(F.col("_m"))).alias("year_month")]
    return merged.select(*lead, *_outputs(d.keys, d.measures))


# ---------------------------------------------------------------------------
# Shared pre-aggregate for the pipeline: the eight monthly tables all roll up
# from one finest-grain reduction of Silver, so a Gold run scans Silver once
# for all of them (plus once for the daily table and the null profile).
# ---------------------------------------------------------------------------

SHARED_KEYS = ("payment_type", "vendor_id", "pickup_location_id", "dropoff_location_id")
MONTHLY_TABLES = tuple(t for t, d in GOLD_DEFS.items() if d.monthly)


def _shared_measures() -> list:
    out, seen = [], set()
    for t in MONTHLY_TABLES:
        for m in GOLD_DEFS[t].measures:
            if m[1] not in seen:
                seen.add(m[1])
                out.append(m)
    return out


def shared_preaggregate(silver: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Silver reduced at (payment, vendor, pickup zone, dropoff zone, month
    keys, zero flags, the columns `more`) with every atom the monthly tables need."""
    src = prepare(silver, "monthly_kpi")
    return preaggregate(src, (*SHARED_KEYS, *more), _shared_measures(), monthly=True)


def build_from_shared(shared: DataFrame, table: str) -> DataFrame:
    """A monthly Gold table rolled up from the shared pre-aggregate."""
    d = GOLD_DEFS[table]
    if not d.monthly:
        raise ValueError(f"{table} is not built from the shared pre-aggregate")
    sums, counts = _atoms(d.measures)
    month_keys = [c for c in ("_pickup_idx", "_source_idx", "_source_file") if c in shared.columns]
    pre = shared.groupBy(*d.keys, *month_keys, "_zd", "_zdist").agg(
        F.sum("_n").alias("_n"),
        *[F.sum(f"_s_{c}").alias(f"_s_{c}") for c in sums],
        *[F.sum(f"_c_{c}").alias(f"_c_{c}") for c in counts],
    )
    return finish(fan_out(pre, True), d.keys, d.measures, True)


# ---------------------------------------------------------------------------
# payment_null_profile: long table, one row per payment type x profile field.
# ---------------------------------------------------------------------------

def _null_profile_atoms() -> list[Column]:
    fields = spec.PAYMENT_NULL_PROFILE_FIELDS
    all_null = F.lit(True)
    for f in fields:
        all_null = all_null & F.col(f).isNull()
    return [*[F.count_if(F.col(f).isNull()).alias(f"_null_{f}") for f in fields],
            F.count_if(all_null).alias("_all_null")]


def _flag_keys() -> list[Column]:
    return [F.coalesce(F.col(ZD), F.lit(False)).alias("_zd"),
            F.coalesce(F.col(ZDIST), F.lit(False)).alias("_zdist")]


def payment_null_profile(silver: DataFrame) -> DataFrame:
    pre = silver.groupBy(F.col("payment_type"), *_flag_keys()).agg(
        F.count(F.lit(1)).alias("_n"), *_null_profile_atoms())
    return null_profile_finish(pre)


def null_profile_finish(pre: DataFrame) -> DataFrame:
    """The long profile from counts at (payment_type, _zd, _zdist)."""
    fields = spec.PAYMENT_NULL_PROFILE_FIELDS
    fanned = pre.withColumn("data_variant", F.explode(variant_list(F.col("_zd"), F.col("_zdist"))))
    merged = fanned.groupBy("data_variant", "payment_type").agg(
        F.sum("_n").alias("row_count"),
        *[F.sum(f"_null_{f}").alias(f"_null_{f}") for f in fields],
        F.sum("_all_null").alias("all_profile_fields_null_count"),
    )
    stack = "stack({n}, {pairs}) AS (field_name, null_count)".format(
        n=len(fields), pairs=", ".join(f"'{f}', `_null_{f}`" for f in fields))
    long = merged.select("data_variant", "payment_type", "row_count", "all_profile_fields_null_count",
                         F.expr(stack))
    return long.select(
        "data_variant",
        F.col("payment_type").cast("bigint").alias("payment_type"),
        "field_name",
        F.col("row_count").cast("bigint").alias("row_count"),
        F.col("null_count").cast("bigint").alias("null_count"),
        percent_of(F.col("null_count"), F.col("row_count")).alias("null_percent"),
        F.col("all_profile_fields_null_count").cast("bigint").alias("all_profile_fields_null_count"),
        percent_of(F.col("all_profile_fields_null_count"), F.col("row_count"))
        .alias("all_profile_fields_null_percent"),
    )


# ---------------------------------------------------------------------------
# Shared daily pre-aggregate for the pipeline: the daily table and the payment
# null profile both roll up from one reduction of Silver at (trip date,
# payment type, zero flags), at most days x payment types x 4 rows, so the
# Gold step scans Silver once for the two of them.
# ---------------------------------------------------------------------------

def daily_preaggregate(silver: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    src = prepare(silver, "daily_trip_summary")
    sums, counts = _atoms(DAILY_MEASURES)
    return src.groupBy(F.col("trip_date"), F.col("payment_type"), *more, *_flag_keys()).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(f"_s_{c}") for c in sums],
        *[F.count(c).alias(f"_c_{c}") for c in counts],
        *_null_profile_atoms(),
    )


def daily_from_shared(pre: DataFrame) -> DataFrame:
    """`daily_trip_summary` rolled up from `daily_preaggregate`."""
    d = GOLD_DEFS["daily_trip_summary"]
    sums, counts = _atoms(d.measures)
    rolled = pre.groupBy("trip_date", "_zd", "_zdist").agg(
        F.sum("_n").alias("_n"),
        *[F.sum(f"_s_{c}").alias(f"_s_{c}") for c in sums],
        *[F.sum(f"_c_{c}").alias(f"_c_{c}") for c in counts],
    )
    return finish(fan_out(rolled, False), d.keys, d.measures, False)


def null_profile_from_shared(pre: DataFrame) -> DataFrame:
    """`payment_null_profile` rolled up from `daily_preaggregate`."""
    fields = spec.PAYMENT_NULL_PROFILE_FIELDS
    rolled = pre.groupBy("payment_type", "_zd", "_zdist").agg(
        F.sum("_n").alias("_n"), *[F.sum(f"_null_{f}").alias(f"_null_{f}") for f in fields],
        F.sum("_all_null").alias("_all_null"))
    return null_profile_finish(rolled)
