"""The Gold tables in their literal form (filter per variant, group per basis,
union), to prove the plans of operators/gold.py."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore import spec
from lakeshore.functions.common import finite_or_null, keep_for_variant, safe_ratio, source_month_label
from lakeshore.operators.gold import GOLD_DEFS


def with_gold_columns(silver: DataFrame) -> DataFrame:
    """trip_date, pickup_month, source_month and finite_speed_mph."""
    p = F.col("pickup_datetime")
    return silver.withColumns({
        "trip_date": F.to_date(p),
        "pickup_month": F.date_format(p, "yyyy-MM"),
        "source_month": source_month_label(F.col(spec.SOURCE_FILE_COLUMN)),
        "finite_speed_mph": finite_or_null(F.col("avg_speed_mph")),
    })


def build_direct(silver: DataFrame, table: str) -> DataFrame:
    d = GOLD_DEFS[table]
    g = with_gold_columns(silver)
    parts = []
    for variant in spec.DATA_VARIANTS:
        sub = g.filter(keep_for_variant(variant))
        bases = spec.MONTH_BASES if d.monthly else (None,)
        for basis in bases:
            keys = ([F.lit(basis).alias("month_basis"), F.col(basis).alias("year_month")] if basis else [])
            keys += [F.col(k) for k in d.keys]
            aggs = []
            for name, (kind, src) in d.measures:
                if kind == "count":
                    aggs.append(F.count(F.lit(1)).alias(name))
                elif kind == "sum0":
                    aggs.append(F.coalesce(F.sum(src), F.lit(0)).cast("bigint").alias(name))
                elif kind == "sum":
                    aggs.append(F.sum(src).cast("double").alias(name))
                elif kind == "mean":
                    aggs.append(F.avg(src).alias(name))
                else:
                    num, den = src
                    aggs.append(safe_ratio(F.sum(num), F.sum(den)).alias(name))
            grouped = sub.groupBy(*keys).agg(*aggs)
            parts.append(grouped.select(F.lit(variant).alias("data_variant"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
