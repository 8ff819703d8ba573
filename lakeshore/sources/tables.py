"""Warehouse tables as Parquet directories: `<root>/<namespace>/<table>`.

Paths go through Hadoop's FileSystem API, so the same code works on a local
disk, HDFS or an object store. Missing tables read back as typed empty
frames where the pipeline allows it.
"""

from __future__ import annotations

import contextlib
import json
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .. import spec

#: Hidden file in a table's folder that holds its declared schema.
SCHEMA_FILE = "_declared_schema.json"

#: Folder below the root where tables are written before they are put in place.
STAGING = "_staging"
#: Field metadata: the stored column that a declared column is read from, if its name differs.
STORED_AS = "stored_as"

#: Files that a task of a partitioned write holds open; a task with rows of more partitions sorts the rest.
OPEN_FILES = 32
_OPEN_KEY = "spark.sql.maxConcurrentOutputFileWriters"
_open_lock, _open_writes = threading.Lock(), {}


@contextlib.contextmanager
def unsorted_writes(spark: SparkSession):
    """Partitioned writes in this block write each row to its partition's open file.

    Without it a task first sorts its whole rows by partition, which holds them
    in memory or spills them. The setting is the session's, so it stays until
    the last of the blocks that threads run at the same time has ended.
    """
    key = spark._jsparkSession.hashCode()
    with _open_lock:
        running, before = _open_writes.get(key, (0, spark.conf.get(_OPEN_KEY, None)))
        _open_writes[key] = (running + 1, before)
        if running == 0:
            spark.conf.set(_OPEN_KEY, str(OPEN_FILES))
    try:
        yield
    finally:
        with _open_lock:
            running, before = _open_writes.pop(key)
            if running > 1:
                _open_writes[key] = (running - 1, before)
            elif before is None:
                spark.conf.unset(_OPEN_KEY)
            else:
                spark.conf.set(_OPEN_KEY, before)


def _visible(name: str) -> bool:
    """Spark's rule: names starting with '.' or '_' are hidden, except
    partition directories such as `_bronze_source_file=...`."""
    return not (name.startswith(".") or (name.startswith("_") and "=" not in name))


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, tables: spec.TableNames | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = tables or spec.TableNames()

    def path(self, table: str) -> str:
        namespace, name = table.split(".", 1)
        return f"{self.root}/{namespace}/{name}"

    def _fs_path(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def exists(self, table: str) -> bool:
        """A table exists once a committed write left a data file or a
        partition directory, or its schema was declared."""
        return self.declared(table) is not None or self._has_data(table)

    def _has_data(self, table: str) -> bool:
        fs, p = self._fs_path(self.path(table))
        return fs.exists(p) and any(_visible(s.getPath().getName()) for s in fs.listStatus(p))

    def declared(self, table: str) -> StructType | None:
        """The schema that the last `declare` recorded, with column order and nullability."""
        text = self._read_text(f"{self.path(table)}/{SCHEMA_FILE}")
        return None if text is None else StructType.fromJson(json.loads(text))

    def declare(self, table: str, schema: StructType) -> None:
        """Record a table's schema beside its data. Parquet gives neither the
        order of partition columns nor nullability back, and a partitioned
        write without rows leaves no file at all."""
        self._write_text(f"{self.path(table)}/{SCHEMA_FILE}", schema.json())

    def _read_text(self, path: str) -> str | None:
        fs, p = self._fs_path(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write_text(self, path: str, text: str) -> None:
        fs, p = self._fs_path(path)
        out = fs.create(p, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def delete(self, path: str) -> None:
        fs, p = self._fs_path(path)
        if fs.exists(p):
            fs.delete(p, True)

    def partition(self, table: str, column: str, value: str) -> str:
        """Path of a first-level partition folder."""
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        return f"{self.path(table)}/{column}={escape(value)}"

    def partition_values(self, table: str) -> list[str]:
        """Values of the first-level partition column, from the folders' names alone."""
        unescape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        fs, p = self._fs_path(self.path(table))
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(unescape(n.split("=", 1)[1]) for n in names if "=" in n)

    def data_files(self, table: str) -> int:
        """Data files directly in a table's folder."""
        fs, p = self._fs_path(self.path(table))
        return sum(_visible(s.getPath().getName()) and s.isFile() for s in fs.listStatus(p)) if fs.exists(p) else 0

    # --- publishing: write beside the live table, swap when the write has succeeded -----------

    def staging(self, name: str) -> str:
        """A new folder, which no reader of a table sees, to write into."""
        return f"{self.root}/{STAGING}/{name}-{uuid.uuid4().hex}"

    def swap(self, moves: list[tuple[str, str]], staged: str) -> None:
        """Put each written folder (first) in the place of a live one (second), or drop the
        live one if nothing was written, then delete `staged`.

        A journal is written first: a run that dies among the renames is
        finished by `recover`. Before it is written the live folders are as
        they were; so a write that fails leaves every old row.
        """
        journal = f"{staged}.swap.json"
        self._write_text(f"{journal}.new", json.dumps({"moves": moves, "staged": staged}))
        self._rename(f"{journal}.new", journal)
        self._finish(journal)

    def recover(self) -> int:
        """Finish the swaps that a run left unfinished; their number. For the begin of a step, not beside a running one."""
        fs, p = self._fs_path(f"{self.root}/{STAGING}")
        names = sorted(s.getPath().toString() for s in fs.listStatus(p)) if fs.exists(p) else []
        journals = [n for n in names if n.endswith(".swap.json")]
        for j in journals:
            self._finish(j)
        return len(journals)

    def _finish(self, journal: str) -> None:
        todo = json.loads(self._read_text(journal))
        old = f"{todo['staged']}-old"
        for i, (new, live) in enumerate(todo["moves"]):
            if self._there(f"{old}/{i}.done"):
                continue
            if self._there(live) and not self._there(f"{old}/{i}"):
                self._rename(live, f"{old}/{i}")
            if self._there(new):
                self._rename(new, live)
            self._write_text(f"{old}/{i}.done", "")
        for path in (todo["staged"], old, journal):
            self.delete(path)

    def _there(self, path: str) -> bool:
        fs, p = self._fs_path(path)
        return fs.exists(p)

    def _rename(self, src: str, dst: str) -> None:
        fs, a = self._fs_path(src)
        _, b = self._fs_path(dst)
        fs.mkdirs(b.getParent())
        if not fs.rename(a, b):
            raise OSError(f"cannot move {src} to {dst}")

    def publish(self, df: DataFrame, table: str, partition_by: list[str] | None = None, replace: list[str] | None = None,
                schema: StructType | None = None) -> None:
        """Replace a table by df's rows, or of its first partition column the values `replace` (also by no rows).

        With `schema` a whole table is declared in the same step.
        """
        staged = self.staging(table)
        w = df.write.partitionBy(*partition_by) if partition_by else df.write
        try:
            with unsorted_writes(self.spark):
                w.parquet(staged)
        except Exception:
            self.delete(staged)
            raise
        if replace is None:
            if schema is not None:
                self._write_text(f"{staged}/{SCHEMA_FILE}", schema.json())
            self.swap([(staged, self.path(table))], staged)
        else:
            live = [self.partition(table, partition_by[0], v) for v in replace]
            self.swap([(f"{staged}/{p.rsplit('/', 1)[1]}", p) for p in live], staged)

    def read(self, table: str, schema: StructType | None = None, *, required: bool = False) -> DataFrame:
        """Read a table; a missing one is an error if `required`, else a typed
        empty frame (which needs `schema`)."""
        declared = self.declared(table)
        if self._has_data(table):
            files = self.spark.read.option("basePath", self.path(table))
            if declared is None:
                return files.parquet(self.path(table))
            stored = [StructField(f.metadata.get(STORED_AS, f.name), f.dataType) for f in declared]
            rows = files.schema(StructType(stored)).parquet(self.path(table))
            return rows.select(*(F.col(s.name).alias(f.name) for s, f in zip(stored, declared)))
        schema = declared or (None if required else schema)
        if schema is None:
            raise FileNotFoundError(f"table {table} does not exist at {self.path(table)}")
        return self.spark.createDataFrame([], schema)

    def row_count(self, table: str) -> int:
        """Rows in a table (Parquet footers only); 0 when it does not exist."""
        return self.read(table).count() if self.exists(table) else 0

    def append(self, df: DataFrame, table: str) -> None:
        """Add rows to a table (the ledgers)."""
        df.write.mode("append").parquet(self.path(table))

    def schema(self, table: str) -> StructType | None:
        return self.read(table).schema if self.exists(table) else None


def as_stored(schema: StructType) -> list[tuple[str, str]]:
    """(name, type) pairs by name, all that stored Parquet files tell of a schema."""
    return sorted((f.name, f.dataType.simpleString()) for f in schema.fields)


def differences(have: StructType, want: StructType) -> str:
    """Missing, additional and retyped columns of `have` against `want`, as text; empty if none."""
    a, b = dict(as_stored(have)), dict(as_stored(want))
    said = [("missing", sorted(b.keys() - a.keys())), ("additional", sorted(a.keys() - b.keys())),
            ("retyped", sorted(f"{c} {a[c]} for {b[c]}" for c in a.keys() & b.keys() if a[c] != b[c]))]
    return "; ".join(f"{k} columns: {', '.join(v)}" for k, v in said if v)


def check_schema(wh: Warehouse, table: str, new: StructType) -> None:
    """Refuse to overwrite a table whose columns, types, order or nullability changed.

    A table whose schema was never declared is compared by what its files tell.
    """
    declared = wh.declared(table)
    if declared is not None:
        same = [(f.name, f.dataType, f.nullable) for f in declared] == [(f.name, f.dataType, f.nullable) for f in new]
    else:
        declared = wh.schema(table)
        same = declared is None or as_stored(declared) == as_stored(new)
    if not same:
        raise ValueError(f"Schema mismatch for existing table {table}: drop the old table or migrate it explicitly "
                         f"before rerunning (existing={declared.simpleString()}, new={new.simpleString()}; "
                         f"{differences(new, declared) or 'order or nullability differs'})")
