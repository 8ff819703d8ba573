"""Every registered query against its DuckDB twin (order-insensitive),
as the driver's correctness gate does, on the smallest scale factor."""

import pytest

import __spark_entry__ as entry_mod
from lakeshore import registry

from .conftest import SF001
from .harness import compare, duck_connection

QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF001)


def test_every_query_has_an_oracle_or_a_reason():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)


def test_declared_double_columns(spark):
    """The oracle side stabilises exactly the DOUBLE columns the Spark side does."""
    from pyspark.sql.types import DoubleType, FloatType
    for name, q in registry.all_queries().items():
        if not q.sql:
            continue
        schema = q.build(spark, SF001).schema
        doubles = {f.name for f in schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
        assert doubles == set(q.doubles), (name, doubles ^ set(q.doubles))


def test_entry_contract(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert set(QUERIES) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sp = QUERIES[name](spark, SF001).toPandas()
    dk = duck.execute(ORACLE[name]).df()
    res = compare(sp, dk)
    assert res["cols_match"], res
    assert res["rows_match"], res
    assert res["values_match"], res
    assert res["exact_match"], res


@pytest.mark.parametrize("name", ["top_payment_flows", "incremental_pending_files", "duplicates", "duration_days", "flex_violations",
                                  "quarantine_no_reason_broken", "gold_sql_zones", "gold_sql_free", "silver_revalidation_broken", "gold_reconcile_broken"])
def test_checks_have_something_to_find(duck, name):
    rows = duck.execute(ORACLE[name]).df()
    numbers = rows.select_dtypes("number")
    assert len(rows) > 0 and (numbers != 0).any(axis=None)
    if name == "gold_sql_zones":
        assert len(rows) > 3
    if name == "silver_revalidation_broken":
        assert (numbers.iloc[0] > 0).all(), numbers.iloc[0]
    if name == "gold_reconcile_broken":
        found = set(rows[rows.violations > 0].check)
        assert {"daily_trip_summary:data_variant", "dropoff_zone_monthly:month_basis", "monthly_kpi:variant_monotonic", "pickup_zone_vs_flow_totals",
                "dropoff_zone_vs_flow_totals", "daily_vs_pickup_month_totals", "data_quality_summary:month_basis", "vendor_monthly:data_variant"} <= found
