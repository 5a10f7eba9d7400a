"""Layer namespaces and versioned table publishing.

A table is published by writing a new version directory on shared storage
and then pointing the catalog entry at it.  A failed or rejected load
therefore never truncates the previous data: until the repoint, readers
see the old version.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from layercake.session import run_dir


@dataclass(frozen=True)
class Layers:
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"

    def all(self) -> tuple[str, str, str]:
        return (self.bronze, self.silver, self.gold)


def create_namespaces(spark: SparkSession, layers: Layers = Layers()) -> None:
    for ns in layers.all():
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {ns}")


def _register(spark: SparkSession, name: str, path: str, schema: T.StructType) -> None:
    """Point table ``name`` at ``path``.  An existing table of the same columns
    is repointed, so that it never goes missing; only another schema needs a
    new table."""
    plain = [(f.name.lower(), f.dataType) for f in schema.fields]
    if spark.catalog.tableExists(name) and [
            (f.name.lower(), f.dataType) for f in spark.table(name).schema.fields] == plain:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
        return
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)


def publish(spark: SparkSession, df: DataFrame, name: str) -> str:
    """Write ``df`` to a fresh version directory, then repoint table ``name``.

    Returns the version path.  The write is the action: any error surfaces
    here, before the catalog is touched."""
    path = run_dir(spark, "tables", name.replace(".", "/"))
    df.write.mode("overwrite").parquet(path)
    _register(spark, name, path, df.schema)
    return path


def publish_path(spark: SparkSession, name: str, path: str, schema: T.StructType) -> None:
    """Point table ``name`` at already-written Parquet files."""
    _register(spark, name, path, schema)


def recreate_table(spark: SparkSession, name: str, schema: T.StructType) -> str:
    """Drop and recreate ``name`` as an empty table with the declared schema
    (catalog metadata only; the fresh location holds no files yet)."""
    path = run_dir(spark, "tables", name.replace(".", "/"))
    _register(spark, name, path, schema)
    return path


def append(spark: SparkSession, rows: list[tuple], schema: T.StructType, name: str) -> None:
    """Append a few driver-side rows (audit logs) to table ``name``."""
    df = spark.createDataFrame(rows, schema)
    if spark.catalog.tableExists(name):
        path = _location(spark, name)
        df.write.mode("append").parquet(path)
        spark.catalog.refreshTable(name)
    else:
        publish(spark, df, name)


def overwrite_small(spark: SparkSession, rows: list[tuple], schema: T.StructType,
                    name: str) -> None:
    """Replace table ``name`` with a few driver-side rows (cleared logs)."""
    publish(spark, spark.createDataFrame(rows, schema), name)


class Direct:
    """Tables published one by one: each is repointed as soon as it is written.
    (``commits.Run`` has the same methods and switches all tables at once.)"""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def table(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def publish(self, df: DataFrame, name: str) -> str:
        return publish(self.spark, df, name)

    def publish_path(self, name: str, path: str, schema: T.StructType) -> None:
        publish_path(self.spark, name, path, schema)

    def overwrite_small(self, rows: list[tuple], schema: T.StructType, name: str) -> None:
        overwrite_small(self.spark, rows, schema, name)

    def append(self, rows: list[tuple], schema: T.StructType, name: str) -> None:
        append(self.spark, rows, schema, name)


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    for r in rows:
        if r[0] == "Location":
            return r[1]
    raise RuntimeError(f"no location for {name}")


def vacuum_versions(spark: SparkSession, name: str, keep: int = 2) -> list[str]:
    """Delete old version folders of table ``name``, keeping the newest
    ``keep`` (the current location is always kept).  Opt-in: call it once no
    reader still uses the older versions.  Returns the deleted paths."""
    current = _location(spark, name)
    jvm = spark.sparkContext._jvm
    cur = jvm.org.apache.hadoop.fs.Path(current)
    if cur.getName().startswith("quarantined="):
        cur = cur.getParent()          # CSV loads: the version folder holds both splits
    parent = cur.getParent()
    fs = parent.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    cur_q = fs.makeQualified(cur).toString().rstrip("/")
    if not fs.exists(parent):
        return []                      # declared but never written (recreate_table)
    versions = [st for st in fs.listStatus(parent) if st.isDirectory()]
    versions.sort(key=lambda st: st.getModificationTime(), reverse=True)
    kept = {cur_q}
    for st in versions:
        if len(kept) >= max(keep, 1):
            break
        kept.add(st.getPath().toString().rstrip("/"))
    deleted = []
    for st in versions:
        p = st.getPath().toString().rstrip("/")
        if p not in kept:
            fs.delete(st.getPath(), True)
            deleted.append(p)
    return deleted
