"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from layercake.session import materialize, run_dir

__all__ = ["arrow_batches", "binary_array", "connected_components", "materialize",
           "read", "run_dir", "scan_bytes", "steady", "text_buffer"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the given folder."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def arrow_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the record batches handed to Python, so that a run of very long
    texts does not become one batch of gigabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


@lru_cache(1)
def _libc():
    """The C library where it lets memory be given back (glibc); else None."""
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-3, 4 << 20)  # M_MMAP_THRESHOLD: arrays from 4 MB on go back to the system when freed
        return libc
    except (OSError, AttributeError):
        return None


def steady(run):
    """For a function over a task's record batches: the worker, which later
    tasks use again, keeps none of the memory that this one has taken."""
    @wraps(run)
    def held(batches):
        libc = _libc()
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if libc is not None:
                libc.malloc_trim(0)
    return held


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column as one uint8 array, and the n + 1 offsets.
    A null counts as an empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def binary_array(parts: list) -> pa.Array:
    """An Arrow binary column of numpy arrays."""
    return pa.array([np.ascontiguousarray(p).tobytes() for p in parts], pa.binary())


def scan_bytes(df: DataFrame) -> int:
    """Input size as the planner estimates it; used to size partition counts,
    never to choose rows or results."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().longValue())


def connected_components(spark: SparkSession, links: DataFrame, name: str = "components") -> DataFrame:
    """Component of every node of ``links`` (a long, b long): (node, component),
    the component being its smallest node.

    Alternating large-star / small-star (Kiveris et al. 2014).  A star's
    minimum is a map-side combined aggregate and its join can be split by
    adaptive execution, so a node with very many links never has to fit one
    task.  Each round is written to the shared folder, which also cuts the
    lineage.  Self links and repeated links are allowed.
    """
    edges = materialize(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v").distinct(), spark, name)
    before = None
    while True:
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: larger neighbours move to the minimum
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small star: smaller neighbours and the node itself move to the minimum
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(down.select("u", "m")).where("u <> v").distinct())
        edges = materialize(small, spark, name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
