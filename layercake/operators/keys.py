"""Surrogate keys.

``dense_key`` numbers rows 1..n in a total order without funnelling the data
through one task (a plain ``row_number() OVER (ORDER BY ...)`` plans an
``Exchange SinglePartition``):

1. range-partition on the full sort key and sort within partitions - hot
   values are split across partitions because the sort key is a total order
   (AQE may merge adjacent small ranges; ids stay in sort order);
2. tag each row with its partition id and ``monotonically_increasing_id``
   (partition id << 33 + position) and write that once to shared storage,
   which freezes the numbering against recomputation;
3. count rows per partition - one row per partition, the same per-partition
   counts ``RDD.zipWithIndex`` gathers - and turn them into exclusive prefix
   offsets on the driver;
4. key = offset(partition) + position-in-partition + 1, through a broadcast
   join with the offsets (their size is bounded by the partition count, not
   by the data).

Result: identical to the global ``row_number()`` for a total order, one
shuffle, no single-partition exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.session import materialize

# A lookup's keys and taken columns are broadcast up to this size.
LOOKUP_BYTES = 64 << 20
# Up to this size they are hashed after a shuffle: even all in one partition
# (one key, repeated) they fit a task, and the facts need no sort.
HASHED_BYTES = 512 << 20


def dense_key(df: DataFrame, order: Sequence[Column], key: str,
              spark: SparkSession | None = None, num_partitions: int | None = None,
              name: str = "dense_key") -> DataFrame:
    spark = spark or df.sparkSession
    ranged = (df.repartitionByRange(num_partitions, *order) if num_partitions
              else df.repartitionByRange(*order))
    staged = (ranged.sortWithinPartitions(*order)
                    .withColumn("_pid", F.spark_partition_id())
                    .withColumn("_pos", F.monotonically_increasing_id()))
    staged = materialize(staged, spark, f"{name}_staged")
    counts = (staged.groupBy("_pid")
                    .agg(F.count(F.lit(1)).alias("n"), F.min("_pos").alias("first"))
                    .collect())                       # one row per partition
    offsets, before = [], 0
    for r in sorted(counts, key=lambda r: r["_pid"]):
        offsets.append((r["_pid"], before - r["first"]))
        before += r["n"]
    off = spark.createDataFrame(offsets, "_pid int, _base long")
    return (staged.join(F.broadcast(off), "_pid")
                  .withColumn(key, (F.col("_pos") + F.col("_base") + 1).cast("long"))
                  .drop("_pid", "_pos", "_base"))


def lookup_surrogate(facts: DataFrame, dim: DataFrame, fact_key: Column,
                     dim_key: Column, take: Sequence[str]) -> DataFrame:
    """Natural-key -> surrogate-key lookup that keeps unmatched facts.

    A LEFT equi-join.  Only the key and the taken columns of the dimension are
    needed, so they are measured: up to ``LOOKUP_BYTES`` they are broadcast and
    the facts, which are many times as wide and long, are not shuffled at all.
    Beyond that the facts are shuffled, up to ``HASHED_BYTES`` without a sort,
    then by a sort-merge join; AQE splits the skewed partitions of both."""
    d = lookup_side(dim.select(dim_key.alias("_dk"), *take))
    return facts.join(d, fact_key == F.col("_dk"), "left").drop("_dk")


def lookup_side(d: DataFrame) -> DataFrame:
    """``d`` to be broadcast while it is known to be small; else for a shuffle join,
    hashed there while its size is bounded."""
    size = lookup_bytes(d)
    if size <= LOOKUP_BYTES:
        return F.broadcast(d)
    return d.hint("shuffle_hash") if size <= HASHED_BYTES else d


def lookup_bytes(d: DataFrame) -> int:
    """Bytes of the rows of ``d``, as Spark lays them out: a word a column and
    one for the nulls, and the texts."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in d.schema.fields
             if isinstance(f.dataType, T.StringType)]
    width = reduce(Column.__add__, texts, F.lit(8 * (len(d.columns) + 1)).cast("long"))
    return d.agg(F.sum(width)).first()[0] or 0
