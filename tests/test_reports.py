"""Reports: parameters left out mean no filter, limits bind, rows come in order."""

import pytest

from lakeshore import registry
from lakeshore.operators import gold, reports

from .conftest import SF001


def test_report_parameters(spark):
    flows = gold.build(registry.silver_result(spark, SF001).silver, "zone_flow_monthly")
    base = {"data_variant": "all", "month_basis": "pickup_month"}
    everything = reports.run_report("zone_analysis", flows, base, row_limit=10 ** 9)
    assert everything.count() == flows.filter("data_variant = 'all' AND month_basis = 'pickup_month'").count()
    rows = reports.run_report("zone_analysis", flows, {**base, "year_month": None}, row_limit=5).collect()
    assert len(rows) == 5 and rows == sorted(rows, key=lambda r: -r.trip_count)
    one_zone = reports.run_report("zone_analysis", flows, {**base, "pickup_location_id": rows[0].pickup_location_id}, row_limit=1000)
    assert {r.pickup_location_id for r in one_zone.collect()} == {rows[0].pickup_location_id}
    with pytest.raises(ValueError, match="needs month_basis"):
        reports.run_report("zone_analysis", flows, {"data_variant": "all"})
    with pytest.raises(ValueError, match="takes no vendor_id"):
        reports.run_report("zone_analysis", flows, {**base, "vendor_id": 1})


@pytest.mark.parametrize("name", ["report_daily", "report_zone_topk", "report_quality_all", "report_payment", "quality_raw", "zone_choices"])
def test_rows_come_in_order(spark, name):
    rows = registry.all_queries()[name].build(spark, SF001).collect()
    assert [r.row_no for r in rows] == list(range(1, len(rows) + 1))


def test_vendor_report_has_all_vendors_and_one(spark):
    vendors = gold.build(registry.silver_result(spark, SF001).silver, "vendor_monthly").filter(
        "data_variant = 'all' AND month_basis = 'pickup_month'").select("year_month", "vendor_id").collect()
    everything, one = (registry.all_queries()[n].build(spark, SF001).collect() for n in ("report_vendor", "report_vendor_one"))
    assert {(r.year_month, r.vendor_id) for r in everything} == {tuple(r) for r in vendors} and len({r.vendor_id for r in everything}) > 1
    assert [r[:-1] for r in one] == [r[:-1] for r in everything if r.vendor_id == 2] and one


def test_order_of_nulls(spark):
    df = spark.createDataFrame([("overall", None, "a", "x"), ("overall", "2026-01", "a", "x"), (None, None, "a", "x")],
                               "month_basis string, source_month string, metric_category string, metric_name string")
    assert [(r[0], r[1]) for r in reports.run_report("data_quality", df, {}).collect()] == [
        ("overall", None), ("overall", "2026-01"), (None, None)]
    assert [(r[0], r[1]) for r in reports.quality_metrics(df).collect()] == [("overall", "2026-01"), ("overall", None), (None, None)]


def test_share_and_topk_operators(spark):
    df = spark.createDataFrame([(1, 5), (2, 3), (3, 2), (None, 10)], "zone int, trip_count long")
    shares = {r.zone: r.share_percent for r in reports.share_of_total(df, "trip_count").collect()}
    assert shares[1] == 25.0 and shares[None] == 50.0
    top = reports.top_zones_share(df.withColumnRenamed("zone", "pickup_location_id"), "pickup_location_id", 2)
    got = [(r.pickup_location_id, r.trip_count, r.share_percent) for r in top.collect()]
    assert got == [("1", 5, 25.0), ("2", 3, 15.0)]  # base includes the NULL zone's trips
    zero = spark.createDataFrame([(1, 0)], "pickup_location_id int, trip_count long")
    assert reports.top_zones_share(zero, "pickup_location_id").collect()[0].share_percent is None
