"""The pre-aggregate + fan-out Gold plans equal the literal per-variant form,
and the Gold invariants hold."""

import pytest
from pyspark.sql import functions as F

from lakeshore import registry, spec
from lakeshore.operators import checks, gold
from lakeshore.registry_more import RECONCILE_TABLES, _all_gold, _gold_frames
from lakeshore.sources.fixture import raw_trips

from .conftest import SF001
from .gold_direct import build_direct


@pytest.fixture(scope="module")
def silver_df(spark):
    return registry.silver_result(spark, SF001).silver.cache()


@pytest.mark.parametrize("table", list(gold.GOLD_DEFS))
def test_preaggregate_equals_direct(spark, silver_df, table):
    fast = registry.stable(gold.build(silver_df, table))
    direct = registry.stable(build_direct(silver_df, table).select(*fast.columns))
    assert fast.schema.simpleString() == direct.schema.simpleString()
    assert fast.exceptAll(direct).count() == 0
    assert direct.exceptAll(fast).count() == 0


def test_gold_variants_and_bases(spark, silver_df):
    kpi = gold.build(silver_df, "monthly_kpi")
    assert {r[0] for r in kpi.select("data_variant").distinct().collect()} == set(spec.DATA_VARIANTS)
    assert {r[0] for r in kpi.select("month_basis").distinct().collect()} == set(spec.MONTH_BASES)
    daily = gold.build(silver_df, "daily_trip_summary")
    assert "month_basis" not in daily.columns
    n = silver_df.count()
    totals = {r.data_variant: r.n for r in daily.groupBy("data_variant").agg(F.sum("trip_count").alias("n")).collect()}
    assert totals["all"] == n
    zd = silver_df.filter("_silver_zero_duration").count()
    assert totals["exclude_zero_duration"] == n - zd


def test_null_profile_shape(spark, silver_df):
    prof = gold.payment_null_profile(silver_df)
    rows = prof.filter("data_variant = 'all' AND payment_type = 0").collect()
    assert sorted(r.field_name for r in rows) == sorted(spec.PAYMENT_NULL_PROFILE_FIELDS)
    # In the fixture every payment-type-0 trip has all five profile fields null.
    assert all(r.null_percent == 100.0 and r.all_profile_fields_null_percent == 100.0 for r in rows)


def test_gold_invariants(spark):
    out = checks.gold_reconcile(spark, _gold_frames(spark, SF001, RECONCILE_TABLES)).collect()
    assert out and all(r.violations == 0 for r in out), [r for r in out if r.violations]


def test_reconciled_gold_reads_trips_once(spark, monkeypatch):
    """The trips are derived and written in one reading of `lineitem`; no Gold table reads it again."""
    read = []
    monkeypatch.setattr(registry, "raw_trips", lambda *a: read.append(a) or raw_trips(*a))
    tables = _all_gold(spark, SF001)
    assert len(read) == 1 and set(tables) == set(RECONCILE_TABLES)
    assert not any("lineitem" in f for df in tables.values() for f in df.inputFiles())
    assert all(r.violations == 0 for r in checks.gold_reconcile(spark, tables).collect())


def test_variant_filter_is_not_a_partition(spark):
    from lakeshore.functions.common import variant_list
    df = spark.createDataFrame([(False, False), (True, False), (False, True), (True, True), (None, None)],
                               "zd boolean, zdist boolean")
    got = [sorted(r[0]) for r in df.select(variant_list(F.col("zd"), F.col("zdist"))).collect()]
    assert got == [sorted(spec.DATA_VARIANTS), ["all", "exclude_zero_distance"], ["all", "exclude_zero_duration"],
                   ["all"], sorted(spec.DATA_VARIANTS)]


def test_daily_shared_preaggregate_equals_direct(spark, silver_df):
    # The pipeline builds the daily table and the null profile from one
    # reduction of Silver; both must equal their one-table builds.
    pre = gold.daily_preaggregate(silver_df)
    for fast, direct in ((gold.daily_from_shared(pre), gold.build(silver_df, "daily_trip_summary")),
                         (gold.null_profile_from_shared(pre), gold.payment_null_profile(silver_df))):
        a, b = registry.stable(fast), registry.stable(direct)
        assert a.schema.simpleString() == b.schema.simpleString()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("table", list(gold.GOLD_DEFS))
def test_one_slice_needs_one_exchange_and_no_fan_out(spark, silver_df, table):
    basis = ("source_month",) if gold.GOLD_DEFS[table].monthly else None
    one = gold.build(silver_df, table, ("exclude_both",), basis)
    want = gold.build(silver_df, table).where("data_variant = 'exclude_both'" + (" AND month_basis = 'source_month'" if basis else ""))
    a, b = registry.stable(one), registry.stable(want)
    assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    plan = one._jdf.queryExecution().sparkPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan
    planned = one._jdf.queryExecution().executedPlan().toString()
    assert planned.count("Exchange hashpartitioning") + planned.count("Exchange SinglePartition") == 1
