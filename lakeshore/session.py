"""SparkSession construction and checkpoint-directory handling."""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # ORDER BY .. LIMIT k keeps a k-slot priority queue per task; above this
    # many rows plan a distributed sort + limit instead (a user-supplied
    # report row_limit of 10^9 must not allocate a 10^9-slot queue).
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
    # The JVM interprets methods over 8,000 bytes of bytecode. A stage whose
    # fused method would be longer (Silver's rules and derived columns) runs
    # operator by operator instead, in methods that are compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str | None = None, *, app: str = "lakeshore",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def compiled(spark: SparkSession) -> None:
    """Hold a session that the caller made to the method size that the JVM compiles, unless it has a lower limit."""
    key, limit = "spark.sql.codegen.hugeMethodLimit", BASE_CONF["spark.sql.codegen.hugeMethodLimit"]
    if int(spark.conf.get(key, "65535")) > int(limit):
        spark.conf.set(key, limit)


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by the cluster (spark.checkpoint.dir).

    Only when the session has none is one chosen: `fallback` (a folder on the
    same shared storage as the tables, as the pipeline passes), else, in local
    mode only, a private temporary folder. On a cluster a folder of one machine
    would lose data, so there the setting is required.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and fallback is None and not re.fullmatch(r"local(\[[^-]*\])?", sc.master):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    if not configured:
        configured = fallback or tempfile.mkdtemp(prefix="lakeshore-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder, deleted at the end of the application."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/lakeshore-{name}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(_clean)
    _SCRATCH.append((spark, path))
    return path


def _clean() -> None:
    for spark, path in _SCRATCH:
        with contextlib.suppress(Exception):  # the session may be gone; the folder is scratch
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
