"""State and result tables as Parquet snapshots that become current together.

A run writes new directories and at last one small pointer that names the directories of
every table. The pointer is written aside and renamed to its run number, which only one
run can take; until then readers see the old tables, so a run that fails half-way
changes nothing and blocks nobody. Two runs at once: the later one fails on its commit,
changes nothing and can be started again on what the first has left.

Growing tables are kept in parts, one per load; appending adds a directory. State tables
that change by key are kept in parts by a hash of the key, and a run writes only the
parts it touches. ``clean`` removes directories that no recent pointer names.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sightline.schemas import INPUTS, conform, schema

POINTER_SCHEMA = "table_name STRING, part STRING, path STRING"
WHOLE = "all"
KEY_PARTS = 64


class CommitConflict(RuntimeError):
    """Another run has committed since this one began."""


def key_part(key: str, parts: int = KEY_PARTS) -> Column:
    """Number of the part that a key belongs to."""
    return F.pmod(F.xxhash64(key), parts).cast("int")


def touched_parts(key: str, *changed: DataFrame, parts: int = KEY_PARTS) -> list[int]:
    """Numbers of the parts with a key of ``changed``; at most ``parts``."""
    found: set[int] = set()
    for df in changed:
        found |= {r[0] for r in df.select(key_part(key, parts).alias("part")).distinct().collect()}
    return sorted(found)


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.refresh()

    def refresh(self) -> None:
        """See what other runs have committed."""
        self.run_id, self.paths = self._load_pointer()

    def _load_pointer(self) -> tuple[int, dict[str, dict[str, str]]]:
        """Newest pointer: table -> part -> directory. One small row per part."""
        try:
            runs = self.spark.read.schema(POINTER_SCHEMA + ", run INT").parquet(f"{self.root}/runs")
        except AnalysisException:
            return 0, {}
        newest = runs.agg(F.max("run")).first()[0]
        paths: dict[str, dict[str, str]] = {}
        for row in runs.filter(F.col("run") == newest).collect():
            paths.setdefault(row.table_name, {})[row.part] = row.path
        return newest or 0, paths

    def read(self, name: str, parts: Iterable[str] | None = None, as_table: str | None = None) -> DataFrame:
        """The table, or those of the named parts that it has."""
        known = self.paths.get(name, {})
        chosen = [known[k] for k in sorted(known) if parts is None or k in set(parts)]
        wanted = schema(as_table or name)
        if not chosen:
            return self.spark.createDataFrame([], wanted)
        return self.spark.read.schema(wanted).parquet(*[f"{self.root}/{path}" for path in chosen])

    def begin(self) -> "SnapshotRun":
        return SnapshotRun(self)

    def clean(self, keep_runs: int = 2, hours: float = 24.0) -> list[str]:
        """Delete table directories that none of the newest pointers names and that are older than ``hours``.

        The age leaves a run alone that is writing now. Returns what was deleted.
        """
        runs = self.spark.read.schema(POINTER_SCHEMA + ", run INT").parquet(f"{self.root}/runs")
        kept = {r.path for r in runs.filter(F.col("run") > self.run_id - keep_runs).select("path").distinct().collect()}
        fs, path = _file_system(self.spark, self.root)
        gone, before = [], (time.time() - hours * 3600) * 1000
        for pattern in ("tables/*/*", "pending/*"):
            for found in fs.globStatus(path(f"{self.root}/{pattern}")) or []:
                name = "/".join(found.getPath().toString().rstrip("/").split("/")[-pattern.count("/") - 1:])
                if found.getModificationTime() < before and not any(k == name or k.startswith(f"{name}/") for k in kept):
                    fs.delete(found.getPath(), True)
                    gone.append(name)
        return sorted(gone)


def _file_system(spark: SparkSession, root: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


class SnapshotRun:
    """Writes of one run; nothing is visible before ``commit``. ``rows`` counts what each write wrote."""

    def __init__(self, store: SnapshotStore):
        self.store = store
        self.run_id = store.run_id + 1
        self.paths = {name: dict(parts) for name, parts in store.paths.items()}
        self.rows: dict[str, int] = {}

    def _write(self, df: DataFrame, path: str, *by: str) -> int:
        """Rows written, counted by the write itself."""
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.partitionBy(*by).parquet(f"{self.store.root}/{path}")
        return seen.get["rows"]

    def replace(self, name: str, df: DataFrame, part: str = WHOLE, as_table: str | None = None) -> DataFrame:
        """Write a whole table, or one part of it; returns what was written."""
        path = f"tables/{name}/{part}-{self.run_id}-{uuid.uuid4().hex[:8]}"
        self.rows[name] = self._write(conform(df, as_table or name), path)
        if part == WHOLE:
            self.paths[name] = {WHOLE: path}
        else:
            self.paths.setdefault(name, {})[part] = path
        return self.store.spark.read.schema(schema(as_table or name)).parquet(f"{self.store.root}/{path}")

    def append(self, name: str, df: DataFrame, part: str, as_table: str | None = None) -> DataFrame:
        label = part
        while label in self.paths.get(name, {}):
            label = f"{part}-{uuid.uuid4().hex[:8]}"
        return self.replace(name, df, label, as_table)

    def replace_parts(self, name: str, df: DataFrame, label: Column, touched: Iterable[str] | None = None) -> None:
        """Write the touched parts of a table anew, in one job; ``df`` has all their rows, ``label`` names a row's part.

        The other parts keep their files. A touched part without rows is gone. Without ``touched`` all parts are.
        """
        path = f"tables/{name}/parts-{self.run_id}-{uuid.uuid4().hex[:8]}"
        labelled = conform(df, name).withColumn("_part", label).hint("rebalance", F.col("_part"))
        self.rows[name] = self._write(labelled, path, "_part")
        kept = dict(self.paths.get(name, {})) if touched is not None else {}
        for part in touched or ():
            kept.pop(part, None)
        fs, at = _file_system(self.store.spark, self.store.root)
        for found in fs.globStatus(at(f"{self.store.root}/{path}/_part=*")) or []:
            folder = found.getPath().getName()
            kept[folder.removeprefix("_part=")] = f"{path}/{folder}"
        self.paths[name] = kept

    def commit(self) -> None:
        """One rename makes all tables current; it fails if another run has taken the number."""
        rows = [(name, part, path) for name, parts in self.paths.items() for part, path in parts.items()]
        pending = f"{self.store.root}/pending/run-{self.run_id}-{uuid.uuid4().hex[:8]}"
        self.store.spark.createDataFrame(rows, POINTER_SCHEMA).coalesce(1).write.parquet(pending)
        context = self.store.spark.sparkContext
        hadoop, path = context._jvm.org.apache.hadoop.fs, context._jvm.org.apache.hadoop.fs.Path
        fs, _ = _file_system(self.store.spark, self.store.root)
        fs.mkdirs(path(f"{self.store.root}/runs"))
        files = hadoop.FileContext.getFileContext(fs.getUri(), context._jsc.hadoopConfiguration())
        nothing = context._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            files.rename(path(pending), path(f"{self.store.root}/runs/run={self.run_id}"), nothing)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            raise CommitConflict(f"run {self.run_id} has been committed by another writer; start again") from None
        self.store.run_id, self.store.paths = self.run_id, self.paths


class StoredTables:
    """Input tables from Parquet directories and state tables from a store, by name."""

    def __init__(self, store: SnapshotStore, inputs: str):
        self.store, self.inputs = store, inputs.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._tables:
            self._tables[name] = self._open(name)
        return self._tables[name]

    def _open(self, name: str) -> DataFrame:
        if name not in INPUTS:
            return self.store.read(name)
        table = self.store.spark.read.schema(schema(name)).parquet(f"{self.inputs}/{name}")
        if "geom" in schema(name).fieldNames():
            # Trip ids may repeat; file and position tell the rows of one id apart.
            # Unlike a generated id this is the same when a task is run again.
            row = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("trip_row")
            return table.select(*schema(name).fieldNames(), row)
        return table
