"""End-to-end medallion run over raw monthly files derived from lineitem:
incremental reruns, idempotence, failure isolation, Gold == lazy queries."""

import os

from pyspark.sql import functions as F

from lakeshore import registry, spec
from lakeshore.operators import profile
from lakeshore.plans import pipeline
from lakeshore.sources.fixture import raw_trips
from lakeshore.sources.tables import Warehouse

from .conftest import SF001

FILES = ("demo_tripdata_2026-01.parquet", "demo_tripdata_2026-02.parquet", "demo_tripdata_2026-03.parquet")


def _write_raw(spark, raw_dir, names, rename=None):
    trips = raw_trips(spark, SF001)
    for name in names:
        target = (rename or {}).get(name, name)
        (trips.filter(F.col(spec.SOURCE_FILE_COLUMN) == name).drop(spec.SOURCE_FILE_COLUMN)
         .coalesce(1).write.mode("overwrite").parquet(os.path.join(raw_dir, target)))


def _cfg(root):
    return spec.PipelineConfig(warehouse=os.path.join(root, "warehouse"), raw_dir=os.path.join(root, "raw"))


def test_full_run_incremental_and_idempotent(spark, scratch):
    cfg = _cfg(scratch)
    _write_raw(spark, cfg.raw_dir, FILES[:2])
    assert pipeline.run_all(spark, cfg) == 0
    wh = Warehouse(spark, cfg.warehouse)
    n_bronze = wh.row_count(spec.BRONZE_TABLE)
    n_silver, n_quar = wh.row_count(spec.SILVER_TABLE), wh.row_count(spec.QUARANTINE_TABLE)
    assert n_bronze > 0 and n_silver + n_quar == n_bronze

    # Second run: nothing pending, tables unchanged.
    b = pipeline.ingest_bronze(spark, cfg)
    s = pipeline.transform_silver(spark, cfg)
    assert (b.processed, b.skipped, s.processed, s.skipped) == (0, 2, 0, 2)
    assert wh.row_count(spec.BRONZE_TABLE) == n_bronze and wh.row_count(spec.SILVER_TABLE) == n_silver

    # Partition inventory of the month-partitioned Silver table.
    inv = profile.partition_inventory(wh.read(spec.SILVER_TABLE)).collect()
    assert sum(r.record_count for r in inv) == n_silver
    assert all(r.file_count >= 1 for r in inv) and all(len(r.pickup_month) == 7 for r in inv)

    # A new month arrives: only it is processed.
    _write_raw(spark, cfg.raw_dir, FILES[2:])
    assert pipeline.run_all(spark, cfg) == 0
    assert wh.row_count(spec.BRONZE_TABLE) == raw_trips(spark, SF001).count()
    log = wh.read(spec.TRANSFORM_LOG_TABLE)
    assert log.filter("status = 'success'").count() == 3
    assert log.filter("rows_read <> rows_written + rows_rejected").count() == 0

    # Re-running Silver for a file (ledger lost) replaces, not duplicates.
    flagged_before = wh.row_count(spec.SILVER_TABLE)
    res = pipeline._transform(wh, [FILES[0]], cfg)
    assert res[0]["file_ok"]
    assert wh.row_count(spec.SILVER_TABLE) == flagged_before

    # Gold written from the warehouse (monthly tables via the shared
    # pre-aggregate) equals the lazy registered queries, table by table.
    all_q = registry.all_queries()
    for table, qname in [(t, {"payment_zone_flow_monthly": "payment_zone_flow",
                              "vendor_zone_flow_monthly": "vendor_zone_flow"}.get(t, t))
                         for t in spec.GOLD_TABLES]:
        gold_file = pipeline.load_gold(spark, cfg.warehouse, table)
        lazy = all_q[qname].build(spark, SF001)
        keep = [c for c in lazy.columns if c not in ("metric_date", "generated_at")]
        a = registry.stable(gold_file.select(*keep))
        b_ = registry.stable(lazy.select(*keep))
        assert a.exceptAll(b_).count() == 0 and b_.exceptAll(a).count() == 0, table
    gold_file = pipeline.load_gold(spark, cfg.warehouse, "monthly_kpi")
    lazy = all_q["monthly_kpi"].build(spark, SF001)
    assert gold_file.columns == lazy.columns  # partition columns restored to the front
    flows = pipeline.load_gold(spark, cfg.warehouse, "zone_flow_monthly")
    pruned = flows.filter("data_variant = 'all' AND month_basis = 'pickup_month'")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data_variant" in plan
    dq = pipeline.load_gold(spark, cfg.warehouse, "data_quality_summary")
    assert dq.filter("metric_category = 'pipeline_file' AND metric_name = 'rows_read'").count() == 3
    glog = wh.read(spec.GOLD_LOG_TABLE)
    assert glog.filter("status = 'success'").select("target_table").distinct().count() == len(spec.GOLD_TABLES)


def test_bad_file_name_is_isolated(spark, scratch):
    cfg = _cfg(scratch)
    _write_raw(spark, cfg.raw_dir, FILES[:2], rename={FILES[1]: "demo_tripdata_2026-13.parquet"})
    assert pipeline.ingest_bronze(spark, cfg).exit_code == 0
    res = pipeline.transform_silver(spark, cfg)
    assert (res.processed, res.failed, res.exit_code) == (1, 1, 1)
    wh = Warehouse(spark, cfg.warehouse)
    log = {r.source_file: r for r in wh.read(spec.TRANSFORM_LOG_TABLE).collect()}
    assert log[FILES[0]].status == "success"
    assert log["demo_tripdata_2026-13.parquet"].status == "failed"
    assert "Cannot determine month" in log["demo_tripdata_2026-13.parquet"].error_message
    files_in_silver = {r[0] for r in wh.read(spec.SILVER_TABLE).select(spec.SOURCE_FILE_COLUMN).distinct().collect()}
    assert files_in_silver == {FILES[0]}
    # The failed file stays pending; the good one is skipped next time.
    again = pipeline.transform_silver(spark, cfg)
    assert (again.skipped, again.failed) == (1, 1)


def test_gold_schema_guard(spark, scratch):
    cfg = _cfg(scratch)
    _write_raw(spark, cfg.raw_dir, FILES[:1])
    assert pipeline.run_all(spark, cfg) == 0
    wh = Warehouse(spark, cfg.warehouse)
    # Replace one Gold table with an incompatible schema: its rebuild fails, others succeed.
    spark.range(3).write.mode("overwrite").parquet(wh.path("gold.monthly_kpi"))
    res = pipeline.build_gold(spark, cfg)
    assert res.failed == 1 and res.processed == len(spec.GOLD_TABLES) - 1
    # Tables build concurrently; the report still follows table order.
    assert [m.split(":")[0].split(".")[-1] for m in res.messages] == list(spec.GOLD_TABLES)
    failed = wh.read(spec.GOLD_LOG_TABLE).filter("status = 'failed'").collect()
    assert [r.target_table for r in failed] == ["gold.monthly_kpi"]
    assert "Schema mismatch" in failed[0].error_message


def test_missing_inputs(spark, scratch):
    cfg = _cfg(scratch)
    os.makedirs(cfg.raw_dir)
    assert pipeline.ingest_bronze(spark, cfg).exit_code == 1
    assert pipeline.transform_silver(spark, cfg).exit_code == 1
    assert pipeline.build_gold(spark, cfg).exit_code == 1


def _counts(spark, cfg):
    wh = Warehouse(spark, cfg.warehouse)
    return wh.row_count(spec.BRONZE_TABLE), wh.row_count(spec.SILVER_TABLE), wh.row_count(spec.QUARANTINE_TABLE)


def test_awkward_file_names_keep_their_rows(spark, scratch):
    cfg = _cfg(scratch)
    names = {FILES[0]: "demo trip+a_2026-01.parquet", FILES[1]: "demo 100%_2026-02.parquet"}
    _write_raw(spark, cfg.raw_dir, FILES[:2], rename=names)
    # A nested folder is not searched.
    _write_raw(spark, os.path.join(cfg.raw_dir, "nested"), FILES[2:])
    assert pipeline.ingest_bronze(spark, cfg).exit_code == 0 and pipeline.transform_silver(spark, cfg).exit_code == 0
    want = {names[r[0]]: r[1] for r in raw_trips(spark, SF001).groupBy(spec.SOURCE_FILE_COLUMN).count().collect() if r[0] in names}
    log = Warehouse(spark, cfg.warehouse).read(spec.INGESTION_LOG_TABLE).collect()
    assert {r.source_file: r.row_count for r in log} == want and {r.status for r in log} == {"success"}
    n_bronze, n_silver, n_quarantine = _counts(spark, cfg)
    assert n_bronze == sum(want.values()) == n_silver + n_quarantine and n_silver > 0
    again = pipeline.ingest_bronze(spark, cfg)
    assert (again.processed, again.skipped) == (0, 2)


def test_rerun_with_other_bounds_leaves_no_stale_rows(spark, scratch):
    cfg = _cfg(scratch)
    _write_raw(spark, cfg.raw_dir, FILES[:1])
    assert pipeline.ingest_bronze(spark, cfg).exit_code == 0 and pipeline.transform_silver(spark, cfg).exit_code == 0
    before = _counts(spark, cfg)
    narrow = spec.PipelineConfig(warehouse=cfg.warehouse, raw_dir=cfg.raw_dir, min_pickup="2026-01-15 00:00:00", max_pickup="2026-01-20 00:00:00")
    pipeline._transform(Warehouse(spark, cfg.warehouse), [FILES[0]], narrow)
    n_bronze, n_silver, n_quarantine = _counts(spark, cfg)
    assert n_silver + n_quarantine == n_bronze == before[0] and 0 < n_silver < before[1]
    pipeline._transform(Warehouse(spark, cfg.warehouse), [FILES[0]], cfg)
    assert _counts(spark, cfg) == before


def test_files_that_do_not_fit_the_schema_fail_alone(spark, scratch):
    cfg = _cfg(scratch)
    _write_raw(spark, cfg.raw_dir, FILES)
    good = raw_trips(spark, SF001).filter(F.col(spec.SOURCE_FILE_COLUMN) == FILES[1]).drop(spec.SOURCE_FILE_COLUMN)
    bad = good.drop("cbd_congestion_fee").withColumn("new_fee", F.lit(1.0)).withColumn("VendorID", F.col("VendorID").cast("string"))
    bad.write.mode("overwrite").parquet(os.path.join(cfg.raw_dir, FILES[1]))
    res = pipeline.ingest_bronze(spark, cfg)
    assert (res.processed, res.failed, res.exit_code) == (2, 1, 1)
    log = {r.source_file: r for r in Warehouse(spark, cfg.warehouse).read(spec.INGESTION_LOG_TABLE).collect()}
    assert {n: r.status for n, r in log.items()} == {FILES[0]: "success", FILES[1]: "failed", FILES[2]: "success"}
    for said in ("missing columns: cbd_congestion_fee", "additional columns: new_fee", "retyped columns: VendorID"):
        assert said in log[FILES[1]].error_message
    # Mended, the file is taken up by the next run.
    good.write.mode("overwrite").parquet(os.path.join(cfg.raw_dir, FILES[1]))
    again = pipeline.ingest_bronze(spark, cfg)
    assert (again.processed, again.skipped, again.exit_code) == (1, 2, 0)
    assert _counts(spark, cfg)[0] == raw_trips(spark, SF001).count()


def test_declared_schema_guards_order_and_nullability(spark, scratch):
    import pytest
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from lakeshore.sources.tables import check_schema
    wh = Warehouse(spark, scratch)
    a, b = StructField("a", LongType(), True), StructField("b", StringType(), True)
    spark.createDataFrame([(1, "x")], StructType([a, b])).write.parquet(wh.path("gold.t"))
    check_schema(wh, "gold.t", StructType([b, a]))  # undeclared: files tell neither order nor nullability
    wh.declare("gold.t", StructType([a, b]))
    check_schema(wh, "gold.t", StructType([a, b]))
    for other in (StructType([b, a]), StructType([StructField("a", LongType(), False), b]), StructType([a])):
        with pytest.raises(ValueError, match="Schema mismatch"):
            check_schema(wh, "gold.t", other)
    wh.declare("gold.empty", StructType([a]))
    assert wh.exists("gold.empty") and wh.read("gold.empty", required=True).columns == ["a"]


def test_settings_from_a_file(tmp_path):
    import pytest
    path = tmp_path / "c.toml"
    path.write_text('warehouse = "/w"\nmin_pickup = "2025-01-01 00:00:00"\n[tables]\nsilver = "clean.trips"\n')
    cfg = spec.load_config(str(path), raw_dir="/r", min_pickup=None)
    assert (cfg.warehouse, cfg.raw_dir, cfg.min_pickup, cfg.tables.silver, cfg.tables.bronze) == (
        "/w", "/r", "2025-01-01 00:00:00", "clean.trips", spec.BRONZE_TABLE)
    path.write_text('warehouse = "/w"\nmonths = 3\n')
    with pytest.raises(ValueError, match="months"):
        spec.load_config(str(path))


def test_a_cluster_needs_a_shared_checkpoint_folder():
    import types

    import pytest

    from lakeshore.session import checkpoint_dir
    sc = types.SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: {}, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(types.SimpleNamespace(sparkContext=sc, conf={}))


def test_no_plan_deals_rows_round_robin(spark):
    plan = registry.silver_result(spark, SF001).silver._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan and "Exchange" not in plan


def test_observed_breakdown_equals_direct(spark, scratch):
    """The counts of the writing job are those of the breakdown by aggregation, and Bronze is scanned once."""
    from lakeshore.operators import silver as silver_ops
    cfg = _cfg(scratch)
    _write_raw(spark, cfg.raw_dir, FILES)
    assert pipeline.ingest_bronze(spark, cfg).exit_code == 0
    wh = Warehouse(spark, cfg.warehouse)
    found = sorted(pipeline._transform(wh, list(FILES), cfg), key=lambda r: r["source_file"])
    direct = silver_ops.rule_breakdown(registry.silver_result(spark, SF001).flagged).orderBy("source_file").collect()
    assert found == [r.asDict() for r in direct] and len(found) == 3
    rows = silver_ops.outcome_rows(silver_ops.flag_rules(wh.read(spec.BRONZE_TABLE)), F.current_timestamp())
    counted = rows.observe(silver_ops_observation(), *silver_ops.outcome_metrics(rows, list(FILES)))
    assert counted._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    # Both tables read as if each had been written by itself.
    r = registry.silver_result(spark, SF001)
    for table, want, stamp in ((spec.SILVER_TABLE, r.silver, spec.PROCESSED_AT_COLUMN), (spec.QUARANTINE_TABLE, r.quarantine, spec.REJECTED_AT_COLUMN)):
        got = wh.read(table)
        cols = [c for c in want.columns if c != stamp]
        assert [c for c in got.columns if c not in (stamp, "pickup_month", spec.INGESTED_AT_COLUMN)] == cols
        assert dict(got.select(*cols).dtypes) == dict(want.select(*cols).dtypes)
        assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0 and got.count() == want.count()


def silver_ops_observation():
    from pyspark.sql import Observation
    return Observation()


def test_a_failing_write_leaves_the_old_rows(spark, scratch):
    import pytest
    cfg = _cfg(scratch)
    _write_raw(spark, cfg.raw_dir, FILES[:2])
    assert pipeline.ingest_bronze(spark, cfg).exit_code == 0 and pipeline.transform_silver(spark, cfg).exit_code == 0
    before, wh = _counts(spark, cfg), Warehouse(spark, cfg.warehouse)
    fails = wh.read(spec.BRONZE_TABLE).withColumn("VendorID", F.when(F.col("PULocationID") > 100, F.raise_error(F.lit("torn"))).otherwise(F.col("VendorID")).cast("int"))
    with pytest.raises(Exception, match="torn"):
        wh.publish(fails, spec.BRONZE_TABLE, [spec.SOURCE_FILE_COLUMN], replace=list(FILES[:2]))
    with pytest.raises(Exception, match="torn"):
        wh.publish(fails, spec.SILVER_TABLE)
    assert _counts(spark, cfg) == before and wh.recover() == 0


def test_a_swap_cut_short_is_finished(spark, scratch, monkeypatch):
    import pytest
    wh = Warehouse(spark, scratch)

    def frame(lo, parts):
        return spark.range(lo, lo + 12).selectExpr("id", f"concat('p', id % {parts}) AS p")
    wh.publish(frame(0, 3), "ns.t", ["p"], replace=["p0", "p1", "p2"])
    plain, calls = Warehouse._rename, []
    for stop in range(1, 5):  # the journal, then two renames for each partition
        def dies(self, src, dst, stop=stop):
            calls.append(dst)
            if len(calls) > stop:
                raise KeyboardInterrupt
            plain(self, src, dst)
        calls.clear()
        monkeypatch.setattr(Warehouse, "_rename", dies)
        with pytest.raises(KeyboardInterrupt):
            wh.publish(frame(100 * stop, 2), "ns.t", ["p"], replace=["p0", "p1", "p2"])
        monkeypatch.setattr(Warehouse, "_rename", plain)
        assert wh.recover() == 1 and wh.recover() == 0
        assert sorted(r.id for r in wh.read("ns.t").collect()) == list(range(100 * stop, 100 * stop + 12))
        assert wh.partition_values("ns.t") == ["p0", "p1"]


def test_cli_without_checkpoint_dir(spark, scratch):
    # A fresh session that names no spark.checkpoint.dir: the Gold step keeps
    # its partial states in the warehouse and builds every table.
    import subprocess
    import sys

    cfg = _cfg(scratch)
    _write_raw(spark, cfg.raw_dir, FILES[:1])
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # An empty conf folder: no spark-defaults.conf, so no spark.checkpoint.dir.
    conf_dir = os.path.join(scratch, "empty-conf")
    os.makedirs(conf_dir)
    env = {**os.environ, "PYTHONPATH": repo, "SPARK_CONF_DIR": conf_dir}
    out = subprocess.run(
        [sys.executable, "-m", "lakeshore.plans.pipeline", "--raw-dir", cfg.raw_dir, "--warehouse", cfg.warehouse,
         "--master", "local[2]"], cwd=repo, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    wh = Warehouse(spark, cfg.warehouse)
    log = wh.read(spec.GOLD_LOG_TABLE).collect()
    assert len(log) == len(spec.GOLD_TABLES) and {r.status for r in log} == {"success"}
    assert wh.partition_values("metadata.gold_partial_monthly") == [FILES[0]]


def _gold_rows(spark, cfg):
    out = {}
    for t in spec.GOLD_TABLES:
        df = pipeline.load_gold(spark, cfg.warehouse, t)
        out[t] = registry.stable(df.select(*[c for c in df.columns if c not in ("metric_date", "generated_at")]))
    return out


def test_gold_reads_new_files_only_and_equals_a_full_build(spark, scratch, monkeypatch):
    import shutil

    from lakeshore.operators import gold as gold_ops
    cfg = _cfg(scratch)
    _write_raw(spark, cfg.raw_dir, FILES[:2])
    assert pipeline.run_all(spark, cfg) == 0
    read = []
    plain = gold_ops.shared_preaggregate

    def spying(silver, more=()):
        read.append({f.split(f"{spec.SOURCE_FILE_COLUMN}=")[1].split("/")[0] for f in silver.inputFiles()})
        return plain(silver, more)
    monkeypatch.setattr(gold_ops, "shared_preaggregate", spying)
    pipeline.build_gold(spark, cfg)
    assert len(read) == 1  # the schema only: nothing is stale
    read.clear()
    _write_raw(spark, cfg.raw_dir, FILES[2:])
    assert pipeline.run_all(spark, cfg) == 0
    wh = Warehouse(spark, cfg.warehouse)
    assert len(read) == 2
    states = {r[spec.SOURCE_FILE_COLUMN]: r.snapshot_id for r in wh.read("metadata.gold_partial_monthly").select(spec.SOURCE_FILE_COLUMN, "snapshot_id").distinct().collect()}
    assert len(set(states.values())) == 2 and states[FILES[0]] == states[FILES[1]] != states[FILES[2]]
    plan = pipeline.Partials(wh, wh.read(spec.SILVER_TABLE), wh.read(spec.QUARANTINE_TABLE))
    assert all(plan.stale(k) == ([], []) for k in ("monthly", "daily", "quality", "rejected"))
    grown = _gold_rows(spark, cfg)
    full = spec.PipelineConfig(warehouse=os.path.join(scratch, "full"), raw_dir=cfg.raw_dir)
    assert pipeline.run_all(spark, full) == 0
    for t, rows in _gold_rows(spark, full).items():
        assert rows.exceptAll(grown[t]).count() == 0 and grown[t].exceptAll(rows).count() == 0, t
    # A file that leaves Silver leaves Gold.
    shutil.rmtree(wh.partition(spec.SILVER_TABLE, spec.SOURCE_FILE_COLUMN, FILES[2]))
    shutil.rmtree(wh.partition(spec.QUARANTINE_TABLE, spec.SOURCE_FILE_COLUMN, FILES[2]))
    assert pipeline.build_gold(spark, cfg).exit_code == 0
    assert wh.partition_values("metadata.gold_partial_monthly") == list(FILES[:2])
    left = pipeline.load_gold(spark, cfg.warehouse, "monthly_kpi").filter("data_variant = 'all' AND month_basis = 'source_month'")
    assert left.agg(F.sum("trip_count")).first()[0] == wh.row_count(spec.SILVER_TABLE)


def test_pending_rows_are_pruned_by_the_join(spark, scratch):
    from lakeshore.operators import bronze as bronze_ops
    cfg = _cfg(scratch)
    _write_raw(spark, cfg.raw_dir, FILES)
    assert pipeline.ingest_bronze(spark, cfg).exit_code == 0
    wh = Warehouse(spark, cfg.warehouse)
    pending = wh.read(spec.INGESTION_LOG_TABLE).filter("status = 'success' AND source_file LIKE '%-02.parquet'")
    rows = bronze_ops.rows_of(wh.read(spec.BRONZE_TABLE), pending)
    assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString().lower()
    assert {r[0] for r in rows.select(spec.SOURCE_FILE_COLUMN).distinct().collect()} == {FILES[1]}


def test_a_ledger_of_many_runs_stays_small(spark, scratch, monkeypatch):
    from datetime import datetime, timedelta, timezone

    from lakeshore.operators import bronze as bronze_ops
    from lakeshore.sources import ledger
    monkeypatch.setattr(ledger, "COMPACT_FILES", 4)
    wh, start = Warehouse(spark, scratch), datetime(2026, 1, 1, tzinfo=timezone.utc)
    rows = []
    for run in range(13):
        for name in ("a", "b", "c"):
            status = "success" if (name, run) in (("a", 2), ("a", 7), ("b", 5)) else "failed"
            rows.append({"source_file": name, "target_table": "t", "status": status, "row_count": run, "file_size_bytes": 1, "snapshot_id": run,
                         "started_at": start, "finished_at": start + timedelta(hours=run), "error_message": None})
        ledger.append_rows(spark, wh, "metadata.log", ledger.INGESTION_LOG_SCHEMA, rows[-3:])
        assert wh.data_files("metadata.log") <= 4
    whole = spark.createDataFrame([tuple(r.values()) for r in rows], ledger.INGESTION_LOG_SCHEMA)
    files = spark.createDataFrame([(n,) for n in "abcd"], "source_file string")
    status = lambda log: sorted(map(tuple, bronze_ops.file_status(files, log, "t").collect()))
    small = wh.read("metadata.log")
    assert status(small) == status(whole) == [("a", True), ("b", True), ("c", False), ("d", False)]
    assert small.count() < 15 and small.filter("source_file = 'a' AND status = 'success'").agg(F.max("row_count")).first()[0] == 7


def test_a_source_file_is_named_without_a_regular_expression(spark):
    from lakeshore.operators.bronze import source_file_name
    cases = {"file:/raw/a_2026-01.parquet": "a_2026-01.parquet", "file:/raw/a_2026-01.parquet/part-0.snappy.parquet": "a_2026-01.parquet",
             "s3://b/x.parquet/y.parquet/z.parquet": "y.parquet", "file:/raw/a%20b+c.parquet/part-0.parquet": "a b+c.parquet",
             "file:/r%20w/a+b.parquet": "a+b.parquet", "file:/raw/%C3%A9%25.parquet/p.parquet": "\u00e9%.parquet", "a.parquet": "a.parquet",
             "file:/x.parquet/deep/p.parquet": "p.parquet", "file:/raw/.parquet/p.parquet": "p.parquet", "file:/raw/a.csv": "", None: None}
    df = spark.createDataFrame([(k,) for k in cases], "path string")
    named = df.select("path", source_file_name(F.col("path")).alias("name"))
    assert {r.path: r.name for r in named.collect()} == cases
    assert "regexp" not in named._jdf.queryExecution().optimizedPlan().toString().lower()


def test_partitioned_writes_hold_no_sort_of_whole_rows(spark, scratch):
    import threading

    from lakeshore.sources import tables
    key, wh = "spark.sql.maxConcurrentOutputFileWriters", Warehouse(spark, scratch)
    before = spark.conf.get(key)
    rows = spark.range(1000).select("id", F.concat(F.lit("f"), F.col("id") % 40).alias("f"))  # more partitions than open files
    seen = {}

    def write(name):
        with tables.unsorted_writes(spark):
            seen[name] = spark.conf.get(key)
            wh.publish(rows, name, ["f"])
    threads = [threading.Thread(target=write, args=(f"t.{i}",)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert seen == {f"t.{i}": str(tables.OPEN_FILES) for i in range(4)} and spark.conf.get(key) == before
    for i in range(4):
        assert wh.read(f"t.{i}").select("id", "f").exceptAll(rows).count() == 0 and wh.row_count(f"t.{i}") == 1000
    spark.conf.set(key, "3")
    try:
        with tables.unsorted_writes(spark):
            pass
        assert spark.conf.get(key) == "3"
    finally:
        spark.conf.unset(key)


def test_raw_months_arrive_whole(spark, scratch):
    from lakeshore import registry_more
    names = registry_more._make_raw(spark, SF001, scratch)
    assert names == sorted(FILES) and not os.path.exists(os.path.join(scratch, "raw"))
    registry_more._arrive(spark, scratch, names[:1])
    assert os.listdir(os.path.join(scratch, "raw")) == names[:1]
    registry_more._arrive(spark, scratch, names[1:])
    for name in names:
        got = spark.read.parquet(os.path.join(scratch, "raw", name))
        want = raw_trips(spark, SF001).filter(F.col(spec.SOURCE_FILE_COLUMN) == name).drop(spec.SOURCE_FILE_COLUMN)
        assert got.columns == want.columns and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
