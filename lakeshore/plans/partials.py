"""Gold's stored partial states: what each source file adds to the Gold tables.

Four small tables below `metadata`, partitioned by source file, hold mergeable
rows (counts, sums, non-null counts): at the finest grain of the monthly
tables, by day and payment type, by scope of the quality table, and of the
quarantine. Each row carries the run that wrote the file's Silver rows, so a
file that is new, or was written again, is known by its ledger entry. A Gold
run reduces those files alone and merges all stored states; files that are no
longer in Silver lose theirs.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import spec
from ..operators import gold, quality
from ..sources import ledger
from ..sources.tables import Warehouse

FILE, RUN = spec.SOURCE_FILE_COLUMN, "snapshot_id"

#: Partial state -> (whether it reduces Silver or quarantine, the reduction of the given files' rows).
STATES = {
    "monthly": ("silver", lambda rows: gold.shared_preaggregate(rows, (FILE,))),
    "daily": ("silver", lambda rows: gold.daily_preaggregate(rows, (FILE,))),
    "quality": ("silver", lambda rows: quality.silver_profile(rows).withColumnRenamed("file", FILE)),
    "rejected": ("quarantine", lambda rows: quality.quarantine_profile(rows, (FILE,))),
}


class Partials:
    """The states, each brought up to date when it is first asked for."""

    def __init__(self, wh: Warehouse, silver: DataFrame, quarantine: DataFrame):
        self.wh, self.rows = wh, {"silver": silver, "quarantine": quarantine}
        self.locks = {k: threading.Lock() for k in STATES}
        self.ready: dict[str, DataFrame] = {}
        log = ledger.read(wh, wh.tables.transform_log, ledger.TRANSFORM_LOG_SCHEMA).filter(
            (F.col("status") == "success") & (F.col("target_table") == wh.tables.silver))
        self.runs = {r.source_file: r.run for r in log.groupBy("source_file").agg(F.max(RUN).alias("run")).collect()}  # a row a file

    def table(self, key: str) -> str:
        return f"metadata.gold_partial_{key}"

    def stale(self, key: str) -> tuple[list[str], list[str]]:
        """Files whose state is missing or of another run, and files whose state must go."""
        of, table = STATES[key][0], self.table(key)
        there = self.wh.partition_values(self.wh.tables.silver if of == "silver" else self.wh.tables.quarantine)
        stored = {}
        if self.wh.exists(table):
            known = self.wh.read(table).select(FILE, RUN).distinct().collect()  # a row a file
            stored = {r[FILE]: r[RUN] for r in known}
        return ([f for f in there if f not in self.runs or stored.get(f) != self.runs[f]], [f for f in stored if f not in there])

    def get(self, key: str) -> DataFrame:
        with self.locks[key]:
            if key not in self.ready:
                self.ready[key] = self._refresh(key)
            return self.ready[key]

    def _refresh(self, key: str) -> DataFrame:
        wh, table = self.wh, self.table(key)
        of, reduce = STATES[key]
        wanted = reduce(self.rows[of]).withColumn(RUN, F.lit(0).cast("long")).schema
        declared = wh.declared(table)
        if declared is not None and [(f.name, f.dataType) for f in declared] != [(f.name, f.dataType) for f in wanted]:
            wh.delete(wh.path(table))  # states of another version
        new, gone = self.stale(key)
        if new or gone:
            runs = F.create_map(*(F.lit(x) for f in new for x in (f, self.runs.get(f, -1)))) if new else F.lit(None)
            rows = reduce(self.rows[of].filter(F.col(FILE).isin(new)))
            rows = rows.withColumn(RUN, (runs[F.col(FILE)] if new else F.lit(None)).cast("long"))
            wh.publish(rows.select(*wanted.names), table, [FILE], replace=[*new, *gone])
        wh.declare(table, wanted)
        return wh.read(table)
