"""Gold invariants as one Spark job: (check, violations), 0 where the invariant holds.

Each Gold table is read once and reduced to its facts: rows and trips by
(variant, basis, month). A fact goes to every check that it bears on, as a
value in one of the check's slots under a key; one aggregate by (check, key)
sums the slots, and a condition of the check's kind tells a violated key:

* `set`: a value is there (slot 0) but not expected (slot 1), or the reverse;
* `has`: an expected value is not there;
* `order`: all >= either single exclusion >= both exclusions;
* `equal`: two tables' totals differ, or one has no such key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import spec

FACTS = ("table", "data_variant", "month_basis", "year_month")


def table_facts(name: str, gold: DataFrame) -> DataFrame:
    """Trips of a Gold table by its dimensions (null where it lacks one)."""
    keys = [F.col(c) if c in gold.columns else F.lit(None).cast("string").alias(c) for c in FACTS[1:]]
    trips = F.sum("trip_count") if "trip_count" in gold.columns else F.lit(None).cast("bigint")
    return gold.groupBy(*keys).agg(trips.cast("bigint").alias("trips")).select(F.lit(name).alias("table"), *FACTS[1:], "trips")


def _entry(check: Column | str, kind: str, key: Column, slot: int | Column, value: Column) -> Column:
    return F.struct((F.lit(check) if isinstance(check, str) else check).alias("check"), F.lit(kind).alias("kind"), key.cast("string").alias("key"),
                    (F.lit(slot) if isinstance(slot, int) else slot).cast("int").alias("slot"), value.cast("bigint").alias("value"))


def _named(*columns: str) -> Column:
    """Several columns as one key; nulls keep apart from texts."""
    return F.to_json(F.struct(*columns))


def _tables_of(tables: dict[str, DataFrame]) -> tuple[list[str], list[str], list[str]]:
    """Tables whose variants are checked, tables whose bases are, and pairs of totals as check names."""
    variants = [n for n in tables if n != "data_quality_summary"]
    bases = [n for n in variants if "month_basis" in tables[n].columns]
    pairs = []
    if {"monthly_kpi", "daily_trip_summary"} <= tables.keys():
        pairs.append("daily_vs_pickup_month_totals")
    if {"pickup_zone_monthly", "dropoff_zone_monthly", "zone_flow_monthly"} <= tables.keys():
        pairs += ["pickup_zone_vs_flow_totals", "dropoff_zone_vs_flow_totals"]
    return variants, bases, pairs


def gold_reconcile(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """All Gold invariants over the given tables (name -> DataFrame), each read once."""
    variants, bases, pairs = _tables_of(tables)
    facts = reduce(DataFrame.unionByName, [table_facts(n, df) for n, df in tables.items()])
    t, one, trips = F.col("table"), F.lit(1), F.col("trips")
    total_key = _named("data_variant", "month_basis", "year_month")
    entries = [
        (t.isin(variants) & F.col("data_variant").isNotNull(), _entry(F.concat(t, F.lit(":data_variant")), "set", F.col("data_variant"), 0, one)),
        (t.isin(bases) & F.col("month_basis").isNotNull(), _entry(F.concat(t, F.lit(":month_basis")), "set", F.col("month_basis"), 0, one)),
        ((t == "data_quality_summary") & F.col("month_basis").isNotNull(), _entry("data_quality_summary:month_basis", "has", F.col("month_basis"), 0, one)),
    ]
    if "monthly_kpi" in tables:
        place = F.array_position(F.array(*map(F.lit, spec.DATA_VARIANTS)), F.col("data_variant")) - 1
        entries.append(((t == "monthly_kpi"), _entry("monthly_kpi:variant_monotonic", "order", _named("month_basis", "year_month"), place, trips)))
    sides = {"daily_vs_pickup_month_totals": (t == "daily_trip_summary", (t == "monthly_kpi") & (F.col("month_basis") == "pickup_month"), F.col("data_variant")),
             "pickup_zone_vs_flow_totals": (t == "pickup_zone_monthly", t == "zone_flow_monthly", total_key),
             "dropoff_zone_vs_flow_totals": (t == "dropoff_zone_monthly", t == "zone_flow_monthly", total_key)}
    for check in pairs:
        left, right, key = sides[check]
        entries += [(left, _entry(check, "equal", key, 0, trips)), (right, _entry(check, "equal", key, 1, trips))]
    found = facts.select(F.explode(F.filter(F.array(*[F.when(cond, e) for cond, e in entries]), lambda e: e.isNotNull())).alias("e")).select("e.*")

    expected = [(f"{n}:data_variant", "set", v) for n in variants for v in spec.DATA_VARIANTS]
    expected += [(f"{n}:month_basis", "set", v) for n in bases for v in spec.MONTH_BASES]
    if "data_quality_summary" in tables:
        expected += [("data_quality_summary:month_basis", "has", v) for v in (spec.OVERALL_BASIS, *spec.MONTH_BASES)]
    expected += [(c, "none", None) for c in (["monthly_kpi:variant_monotonic"] if "monthly_kpi" in tables else []) + pairs]  # a row also without keys
    known = spark.createDataFrame(expected, "check string, kind string, key string").select("*", F.lit(1).alias("slot"), F.lit(1).cast("bigint").alias("value"))

    slots = found.unionByName(known).groupBy("check", "kind", "key").agg(
        *[F.sum(F.when(F.col("slot") == i, F.col("value"))).alias(f"s{i}") for i in range(4)])
    a, d, z, b = (F.coalesce(F.col(f"s{i}"), F.lit(0)) for i in range(4))
    kind = F.col("kind")
    bad = (F.when(kind == "set", F.col("s0").isNull() != F.col("s1").isNull()).when(kind == "has", F.col("s0").isNull())
           .when(kind == "order", ~((a >= d) & (a >= z) & (d >= b) & (z >= b))).when(kind == "equal", ~F.col("s0").eqNullSafe(F.col("s1"))).otherwise(False))
    return slots.groupBy("check").agg(F.count_if(bad).alias("violations"))


def dq_inventory(quality: DataFrame) -> DataFrame:
    """Rows per (basis, category, metric name); NULL keys kept."""
    return quality.groupBy("month_basis", "metric_category", "metric_name").agg(F.count(F.lit(1)).alias("rows"))
