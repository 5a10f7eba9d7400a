"""Session and shared-storage helpers.

Everything that must outlive a task (checkpoints, materialised tables,
staged CSV extracts) goes below one *shared* root taken from the session's
``spark.checkpoint.dir``.  Only when that setting is absent and Spark runs in
local mode (tests) do we create a private temporary directory.
"""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Settings we rely on.  They are Spark defaults in 4.x; set them anyway so a
# cluster profile that switched them off does not silently change the plans.
_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # keep-latest dedup relies on the partial top-1 before its shuffle
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    # round-robin repartition must give the same rows per task on retry
    "spark.sql.execution.sortBeforeRepartition": "true",
    # good and quarantined rows go to two open files, without a sort by the flag
    "spark.sql.maxConcurrentOutputFileWriters": "2",
    # the JVM compiles no method of over 8000 bytes: a longer stage is better
    # run operator by operator than interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the library's plans assume."""
    for k, v in _SQL_CONF.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "layercake", driver_memory: str = "8g") -> SparkSession:
    """Local session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_root(spark: SparkSession) -> str:
    """Base folder on shared storage for this library's intermediate data.

    Order: ``spark.checkpoint.dir`` from the session, then the checkpoint
    directory already set on the SparkContext.  Only local sessions may fall
    back to a fresh temporary directory.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not root:
        ck = sc.getCheckpointDir()
        if ck:
            root = ck.rsplit("/", 1)[0]
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a shared folder is required "
                "on a cluster")
        root = tempfile.mkdtemp(prefix="layercake-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def run_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder below the shared root (one per call)."""
    base = shared_root(spark)
    app = spark.sparkContext.applicationId
    return "/".join([base, "layercake", app, *parts, uuid.uuid4().hex[:12]])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of ``path`` (any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def materialize(df, spark: SparkSession, name: str):
    """Write ``df`` as Parquet below the shared root and read it back.

    Cuts lineage (a lost executor re-reads files instead of recomputing the
    plan) and gives later joins real size statistics for AQE's
    broadcast-or-shuffle decision.
    """
    path = run_dir(spark, "tables", name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def run_concurrently(fn, items, parallel: bool = True, max_workers: int = 6) -> list:
    """Apply ``fn`` to independent items.  With ``parallel`` the Spark jobs
    are submitted from a few driver threads, so small independent tables
    share the cluster instead of queueing.  Results keep the input order."""
    items = list(items)
    if not parallel or len(items) < 2:
        return [fn(i) for i in items]
    with ThreadPoolExecutor(max_workers=min(len(items), max_workers)) as pool:
        return list(pool.map(fn, items))
