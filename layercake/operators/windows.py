"""Skew-safe windows: ``lead_within`` and ``running_totals``.

``lead_within(df, key, order, value, out)`` equals
``lead(value) OVER (PARTITION BY key ORDER BY order)`` but never sends all
rows of one key to one task:

1. range-partition on (key, order...) - with a total order, a hot key is
   cut into several contiguous slices, each in its own partition;
2. inside each (partition, key) slice the plain ``lead`` is exact except for
   the slice's last row;
3. that row's successor is the first row of the next slice of the same key.
   The first value of every slice is one aggregate row per (partition, key)
   (bounded by keys + partitions); shifting it with ``lead`` over the
   partition id gives each slice its successor value, which is appended to
   the slice as a trailing marker row, so step 2's ``lead`` picks it up -
   no join against the data.

The range-partitioned, partition-tagged rows are written once to shared
storage: both consumers (slice summaries and the rows themselves) must see
the same partition assignment, and range bounds are re-sampled per
execution (imbalanced inputs are re-sampled with a seed tied to the RDD id),
so two evaluations may cut differently.

Two shuffles of the data (range, then hash on (partition, key)) plus one
write, in exchange for bounded task sizes under any key skew.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.session import materialize


def lead_within(df: DataFrame, key: str, order: Sequence[str], value: str, out: str,
                num_partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    asc = [F.col(c).asc_nulls_first() for c in order]
    by = [F.col(key).asc_nulls_first(), *asc]
    # no explicit count: AQE may coalesce adjacent ranges (ids stay ordered)
    ranged = (df.repartitionByRange(num_partitions, *by) if num_partitions
              else df.repartitionByRange(*by)).withColumn("_pid", F.spark_partition_id())
    ranged = materialize(ranged, spark, "lead_within")

    if value == order[0]:
        # first value in (value asc nulls first, ...) order: NULL if the slice
        # has a NULL, else the minimum - a hash aggregate (count + min)
        v = F.col(value)
        first = F.when(F.count(F.lit(1)) > F.count(v), F.lit(None)).otherwise(F.min(v))
    else:
        first = F.min_by(F.col(value), F.struct(*[F.col(c) for c in order]))
    firsts = ranged.groupBy("_pid", key).agg(first.alias("_first"))
    successor = firsts.select(
        "_pid", key,
        F.lead("_first").over(Window.partitionBy(key).orderBy("_pid")).alias("_v"))

    real = ranged.withColumns({"_marker": F.lit(False), "_v": F.col(value)})
    markers = successor.select(
        *[F.col(c) if c == key else F.lit(None).cast(df.schema[c].dataType).alias(c)
          for c in df.columns],
        "_pid", F.lit(True).alias("_marker"), "_v")
    w = Window.partitionBy("_pid", key).orderBy(F.col("_marker").asc(), *asc)
    return (real.unionByName(markers)
                .withColumn(out, F.lead("_v").over(w))
                .filter(~F.col("_marker"))
                .drop("_pid", "_marker", "_v"))


def running_totals(df: DataFrame, key: Sequence[str], order: Sequence[Column], totals: dict[str, Column],
                   num_partitions: int | None = None, name: str = "running_totals") -> DataFrame:
    """``sum(expr) OVER (PARTITION BY key ORDER BY order ROWS UNBOUNDED
    PRECEDING)`` for every ``out: expr`` of ``totals``, at any grain and with
    any skew of the key (``key`` may be empty: one running total over all rows).

    Two-level prefix sums: the rows are cut into ranges of (key, order), each
    range is summed by itself, and what the earlier ranges hold of a key is
    added.  Only a key that goes over a range's end needs that, so at most two
    sums a range reach the driver and are broadcast, whatever the data's size.

    Defined results: nulls are added as by SUM (a total of nothing but nulls is
    null); a null key is a key; rows equal in ``order`` come in any order, so
    ``order`` should be total where that matters; an empty table stays empty.
    Rows keep all their columns; columns starting with ``_rt_`` are reserved.
    """
    spark = df.sparkSession
    key, outs = list(key), list(totals)
    by = [F.col(c).asc_nulls_first() for c in key] + list(order)
    valued = df.withColumns({f"_rt_{o}": e for o, e in totals.items()})
    ranged = valued.repartitionByRange(num_partitions, *by) if num_partitions else valued.repartitionByRange(*by)
    # written once: ranges are sampled anew whenever the plan runs
    staged = materialize(ranged.withColumn("_rt_range", F.spark_partition_id()), spark, name)

    names = [f"_rt_key_{i}" for i in range(len(key))]

    def same(more: list[Column]) -> Column:
        return reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(key, names)] + more)

    slices = staged
    if key:  # only keys that more than one range holds: fewer than there are ranges
        over = (staged.groupBy(*key).agg(F.min("_rt_range").alias("_lo"), F.max("_rt_range").alias("_hi"))
                .where("_lo < _hi").select(*[F.col(c).alias(n) for c, n in zip(key, names)]))
        slices = staged.join(F.broadcast(over), same([]), "left_semi")
    sums = (slices.groupBy("_rt_range", *key).agg(*[F.sum(f"_rt_{o}").alias(o) for o in outs])
            .orderBy("_rt_range"))
    before, carried = [], {}
    for r in sums.collect():
        k = tuple(r[c] for c in key)
        had = carried.get(k)
        if had is not None:
            before.append((r["_rt_range"], *k, *had))
        now = [r[o] for o in outs]
        carried[k] = now if had is None else [
            b if a is None else a if b is None else a + b for a, b in zip(had, now)]
    kinds = {f.name: f.dataType for f in sums.schema.fields}
    schema = T.StructType([T.StructField("_rt_of", T.IntegerType())]
                          + [T.StructField(n, kinds[c]) for c, n in zip(key, names)]
                          + [T.StructField(f"_rt_before_{o}", kinds[o]) for o in outs])
    offsets = spark.createDataFrame(before, schema)

    local = Window.partitionBy("_rt_range", *key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = staged.withColumns({f"_rt_{o}": F.sum(f"_rt_{o}").over(local) for o in outs})
    joined = summed.join(F.broadcast(offsets), same([F.col("_rt_range") == F.col("_rt_of")]), "left")
    out = {o: F.coalesce(F.col(f"_rt_{o}") + F.col(f"_rt_before_{o}"), f"_rt_{o}", f"_rt_before_{o}") for o in outs}
    kept = [c for c in df.columns if c not in totals]
    return joined.select(*kept, *[c.alias(o) for o, c in out.items()])
