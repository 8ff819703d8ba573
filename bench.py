"""Benchmark: all trip queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query's plan runs to completion into Spark's `noop` sink (the full job
executes, nothing is collected to the driver). Then the file-based pipeline
(Bronze -> Silver -> Gold, with ledgers) runs over raw monthly files derived
from `lineitem`; writing those raw files is setup and is not timed.

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

#: Runs of the file pipeline, timed by themselves below.
NOT_TIMED = {"pipeline_ledgers", "silver_partitions", "gold_from_warehouse", "gold_without_rows", "pipeline_checks", "gold_incremental",
             "gold_sql_zones", "gold_sql_free", "duplicates_by_month", "duplicates_seen_before", "pending_rows"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None

    from pyspark.sql import functions as F

    from lakeshore import registry, spec
    from lakeshore.plans import pipeline
    from lakeshore.session import checkpoint_dir, get_session
    from lakeshore.sources.fixture import raw_trips

    scratch = tempfile.mkdtemp(prefix="lakeshore-bench-")
    spark = get_session(f"local[{cpus}]", app="lakeshore-bench", shuffle_partitions=max(8, 2 * cpus), extra={
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        "spark.local.dir": os.path.join(scratch, "spark-local"),
    })
    checkpoint_dir(spark)
    # The library's builders as users call them (the correctness registry
    # additionally rounds DOUBLE columns for the cross-engine check).
    queries = {name: q.build for name, q in registry.all_queries().items()}

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    run(queries["monthly_kpi"](spark, sf_dir))  # warm-up (JIT, file listing caches)

    times: dict[str, float] = {}
    for name in queries:
        if name in NOT_TIMED:
            continue
        t0 = time.perf_counter()
        run(queries[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)

    # File-based pipeline over three monthly raw files.
    raw_dir = os.path.join(scratch, "raw")
    trips = raw_trips(spark, sf_dir)
    for month in ("2026-01", "2026-02", "2026-03"):
        name = f"demo_tripdata_{month}.parquet"
        # Each raw month as a directory of part files (read as one source
        # file), so scans are parallel as they are on real multi-file input.
        (trips.filter(F.col(spec.SOURCE_FILE_COLUMN) == name).drop(spec.SOURCE_FILE_COLUMN)
         .repartition(cpus).write.mode("overwrite").parquet(os.path.join(raw_dir, name)))
    cfg = spec.PipelineConfig(warehouse=os.path.join(scratch, "warehouse"), raw_dir=raw_dir)
    codes = {}
    for step_name, step in (("pipeline_bronze", pipeline.ingest_bronze), ("pipeline_silver", pipeline.transform_silver),
                            ("pipeline_gold", pipeline.build_gold)):
        t0 = time.perf_counter()
        codes[step_name] = step(spark, cfg).exit_code
        times[step_name] = round(time.perf_counter() - t0, 3)

    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times, "sf": sf,
        "cpus": cpus, "pipeline_exit_codes": codes,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
