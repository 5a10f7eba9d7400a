"""Skew-safe lead equals the plain window lead, including a hot key that
spans several partitions, NULL keys, NULL order values and empty partitions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from layercake.operators.windows import lead_within, running_totals


def _compare(df, n):
    got = lead_within(df, "k", ["t", "id"], "t", "nxt", num_partitions=n)
    w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_first(), F.col("id").asc_nulls_first())
    ref = df.withColumn("ref", F.lead("t").over(w))
    j = got.join(ref.select("id", "ref"), "id")
    assert got.count() == df.count()
    return j.filter(~F.col("nxt").eqNullSafe(F.col("ref"))).count()


def test_hot_key(spark):
    df = spark.range(0, 6000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 101 == 1, F.lit(None))
         .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        F.when(F.col("id") % 89 == 2, F.lit(None)).otherwise(F.col("id") * 7 % 1000).alias("t"))
    assert _compare(df, 8) == 0
    # the hot key really is cut into several range partitions
    parts = (df.repartitionByRange(8, F.col("k").asc_nulls_first(), F.col("t").asc_nulls_first(),
                                   F.col("id").asc_nulls_first())
               .filter(F.col("k") == "HOT").select(F.spark_partition_id()).distinct().count())
    assert parts > 1


def test_more_partitions_than_rows(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 3), (3, "b", 1), (4, None, 2)],
                               "id long, k string, t long")
    assert _compare(df, 16) == 0


def test_real_product_versions_match_plain_lead(spark):
    # regression: range bounds re-sampled per evaluation once cut the same
    # key differently in the two consumers of the partition tags
    from layercake.sources import adapter
    from layercake.sources.testdata import TestTables
    b = adapter.crm_prd_info(TestTables(spark, "/root/testdata/sf0.01"))
    got = lead_within(b, "prd_key", ["prd_start_dt", "prd_id"], "prd_start_dt", "nxt",
                      num_partitions=8)
    w = Window.partitionBy("prd_key").orderBy("prd_start_dt", "prd_id")
    ref = b.withColumn("ref", F.lead("prd_start_dt").over(w)).select("prd_id", "ref")
    bad = got.join(ref, "prd_id").filter(~F.col("nxt").eqNullSafe(F.col("ref"))).count()
    assert bad == 0


def test_lead_of_other_column(spark):
    # value column differs from the leading order column (generic min_by path)
    df = spark.range(0, 2000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 20).cast("string"))).alias("k"),
        (F.col("id") * 13 % 500).alias("t"), (F.col("id") * 7).alias("v"))
    got = lead_within(df, "k", ["t", "id"], "v", "nxt", num_partitions=6)
    w = Window.partitionBy("k").orderBy("t", "id")
    ref = df.withColumn("ref", F.lead("v").over(w)).select("id", "ref")
    assert got.join(ref, "id").filter(~F.col("nxt").eqNullSafe(F.col("ref"))).count() == 0


def _totals(spark, keyed, n=None):
    df = spark.range(0, 5000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 101 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        (F.col("id") * 7919 % 5003).alias("t"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 11 - 5).alias("v"))
    key = ["k"] if keyed else []
    w = Window.partitionBy(*key).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    wanted = df.withColumns({"s": F.sum("v").over(w), "n": F.sum(F.lit(1)).over(w)})
    got = running_totals(df, key, [F.asc("t")], {"s": F.col("v"), "n": F.lit(1)}, n)
    assert got.columns == ["id", "k", "t", "v", "s", "n"]
    assert sorted(map(tuple, got.select("id", "s", "n").collect())) == sorted(map(tuple, wanted.select("id", "s", "n").collect()))
    return got


def test_running_totals(spark):
    for keyed in (True, False):
        for n in (None, 1, 16):
            _totals(spark, keyed, n)


def test_running_totals_over_all_rows_need_no_single_task(spark):
    got = _totals(spark, False, 16)
    got.collect()
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()


def test_running_totals_of_nothing_and_of_nulls(spark):
    df = spark.createDataFrame([], "k string, t int, v int")
    assert running_totals(df, ["k"], [F.asc("t")], {"s": F.col("v")}).collect() == []
    df = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("b", 1, 3)], "k string, t int, v int")
    got = running_totals(df, ["k"], [F.asc("t")], {"v": F.col("v")}, 4).collect()  # a total in place of its column
    assert sorted(map(tuple, got), key=str) == [("a", 1, None), ("a", 2, None), ("b", 1, 3)]
