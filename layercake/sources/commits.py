"""One commit for a run over many tables.

The versions of a table lie side by side below one folder::

    <store>/<table>/<schema id>/run_version=<n>/part-*.parquet
    <store>/commits/part-*.parquet      (table_name, run_version, folder, schema)

A ``Run`` takes the next version number, writes tables under it and, at its
end, appends one file with a row for each of them to ``commits``.  The file
appears by a rename: all rows or none.  A table's catalog entry is a view that
reads the newest committed version, through a scalar subquery on the partition
column, so the scan lists and reads that version only.  Every reader, in any
session, therefore goes from the tables of one run to those of the next at
once, with no refresh, and a run that fails has changed nothing.

Defined results: a table that a run does not write keeps its version; a run
whose base another run has meanwhile replaced cannot commit
(``ConcurrentCommit``); an empty table is a version without rows; with another
schema a table gets another folder, and its view is replaced right after the
commit (the one step that is not part of it).  Commits and versions stay until
``vacuum``.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.session import path_exists, shared_root
from layercake.sources.catalog import Layers

COMMITS = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("run_version", T.IntegerType()),
                        T.StructField("folder", T.StringType()), T.StructField("schema", T.StringType())])


class ConcurrentCommit(RuntimeError):
    """Another run has committed since this one began; nothing was changed."""


def default_store(spark: SparkSession, layers: Layers) -> str:
    """Folder of the versions of some layers, below the shared root."""
    return f"{shared_root(spark)}/layercake/store/{'.'.join(layers.all())}"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def commits(spark: SparkSession, store: str) -> DataFrame:
    """Every committed (table, version) of a store, as it is now."""
    path = f"{store}/commits"
    if not path_exists(spark, path):
        return spark.createDataFrame([], COMMITS)
    return spark.read.schema(COMMITS).parquet(path)


class Run:
    """Writes of one run; visible to ``Run.table`` at once, to all others after ``commit``."""

    def __init__(self, spark: SparkSession, store: str):
        self.spark, self.store = spark, store.rstrip("/")
        newest = F.max_by(F.struct("run_version", "folder", "schema"), "run_version").alias("x")
        rows = commits(spark, self.store).groupBy("table_name").agg(newest).collect()  # one row a table
        self.known = {r["table_name"]: tuple(r["x"]) for r in rows}
        self.base = max((v for v, _, _ in self.known.values()), default=0)
        self.version = self._claim()
        self.written: dict[str, tuple[str, T.StructType]] = {}
        self.views: dict[str, str] = {}

    def _claim(self) -> int:
        """A version number that no other run has: its file can be created once."""
        folder = f"{self.store}/claims"
        n = max([self.base, *(int(c) for c in _children(self.spark, folder) if c.isdigit())]) + 1
        while True:
            fs, path = _fs(self.spark, f"{folder}/{n}")
            fs.mkdirs(path.getParent())
            if not fs.exists(path):
                try:
                    if fs.createNewFile(path):
                        return n
                except Exception as e:  # noqa: BLE001 - some file systems raise where the file is there
                    if "exist" not in str(e).lower():
                        raise
            n += 1

    def _place(self, name: str, schema: T.StructType) -> str:
        kinds = ",".join(f"{f.name.lower()}:{f.dataType.simpleString()}" for f in schema.fields)
        folder = f"{self.store}/{name}/{hashlib.sha256(kinds.encode()).hexdigest()[:8]}"
        self.written[name] = folder, schema
        return f"{folder}/run_version={self.version}"

    def publish(self, df: DataFrame, name: str) -> str:
        """Write ``df`` as this run's version of table ``name``."""
        path = self._place(name, df.schema)
        df.write.mode("overwrite").parquet(path)
        return path

    def publish_path(self, name: str, path: str, schema: T.StructType) -> None:
        """Take already written Parquet files (none: no rows) as this run's version."""
        fs, source = _fs(self.spark, path)
        if not fs.exists(source):
            self.publish(self.spark.createDataFrame([], schema), name)
            return
        _, target = _fs(self.spark, self._place(name, schema))
        fs.mkdirs(target.getParent())
        if fs.exists(target):
            fs.delete(target, True)
        if not fs.rename(source, target):
            raise RuntimeError(f"cannot move {path} to {target}")

    def declare(self, name: str, schema: T.StructType, again: bool = False) -> None:
        """An empty table of the declared columns, if there is none yet (or ``again``)."""
        if again or name not in self.known:
            self.publish(self.spark.createDataFrame([], schema), name)

    def overwrite_small(self, rows: list[tuple], schema: T.StructType, name: str) -> None:
        """Replace a table by a few driver-side rows (cleared logs)."""
        self.publish(self.spark.createDataFrame(rows, schema), name)

    def append(self, rows: list[tuple], schema: T.StructType, name: str) -> None:
        """A table's rows and a few more (logs: a row for each table and run)."""
        df = self.spark.createDataFrame(rows, schema)
        self.publish(self.table(name).unionByName(df) if self.has(name) else df, name)

    def has(self, name: str) -> bool:
        return name in self.written or name in self.known

    def table(self, name: str) -> DataFrame:
        """Table ``name`` as this run sees it: its own version, else the committed one."""
        if name in self.written:
            folder, schema = self.written[name]
            version = self.version
        else:
            version, folder, kinds = self.known[name]
            schema = T.StructType.fromJson(json.loads(kinds))
        return self.spark.read.schema(schema).parquet(f"{folder}/run_version={version}")

    def view(self, name: str, sql: str) -> None:
        """Have the commit (re)define catalog view ``name`` by ``sql``."""
        self.views[name] = sql

    def commit(self) -> int:
        """Make every table of the run visible; returns its version."""
        newest = commits(self.spark, self.store).agg(F.max("run_version")).first()[0] or 0
        if newest != self.base:
            raise ConcurrentCommit(f"version {newest} was committed since this run began at {self.base}")
        rows = [(name, self.version, folder, schema.json()) for name, (folder, schema) in sorted(self.written.items())]
        # one file, which appears by a rename
        self.spark.createDataFrame(rows, COMMITS).coalesce(1).write.mode("append").parquet(f"{self.store}/commits")
        for name, (folder, schema) in self.written.items():
            if self.known.get(name, (0, None))[1] != folder or not is_view(self.spark, name):
                _create_view(self.spark, name, _newest(self.store, name, folder, schema))
        for name, sql in self.views.items():
            _create_view(self.spark, name, sql)
        return self.version


def is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def _create_view(spark: SparkSession, name: str, sql: str) -> None:
    if spark.catalog.tableExists(name) and not is_view(spark, name):
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")


def _newest(store: str, name: str, folder: str, schema: T.StructType) -> str:
    """SQL text of a view over the newest committed version of a table."""
    columns = ", ".join(f"`{f.name}`" for f in schema.fields)
    return (f"SELECT {columns} FROM parquet.`{folder}` WHERE run_version = "
            f"(SELECT max(run_version) FROM parquet.`{store}/commits` WHERE table_name = '{name}')")


def vacuum(spark: SparkSession, store: str, keep: int = 2) -> list[str]:
    """Delete the versions of every table but the newest ``keep`` committed
    ones and those of runs that may still be going (numbers beyond the newest
    commit).  Call it once no reader still uses the older ones.  Returns the
    deleted folders."""
    rows = commits(spark, store).collect()  # a row for each table and commit
    newest = max((r["run_version"] for r in rows), default=0)
    kept: dict[str, list[int]] = {}
    for r in sorted(rows, key=lambda r: -r["run_version"]):
        versions = kept.setdefault(r["table_name"], [])
        if len(versions) < max(keep, 1):
            versions.append(r["run_version"])
    deleted = []
    for name, versions in kept.items():
        for folder in _children(spark, f"{store}/{name}"):
            for child in _children(spark, f"{store}/{name}/{folder}"):
                n = int(child.removeprefix("run_version="))
                if n not in versions and n <= newest:
                    path = f"{store}/{name}/{folder}/{child}"
                    fs, p = _fs(spark, path)
                    fs.delete(p, True)
                    deleted.append(path)
    return deleted
