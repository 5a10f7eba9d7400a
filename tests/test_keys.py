"""Dense surrogate keys: equal to a global ROW_NUMBER, 1..n, no
single-partition exchange of the data, robust to a hot sort value."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from layercake.operators.keys import dense_key


def _check(df, order_cols):
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    keyed = dense_key(df, order, "k", num_partitions=6)
    ref = df.withColumn("k_ref", F.row_number().over(Window.orderBy(*order)))
    j = keyed.join(ref, [F.col(c).eqNullSafe(ref[c]) for c in df.columns] and list(df.columns))
    return keyed, j


def test_dense_key_matches_row_number(spark):
    df = spark.range(0, 5000).select(
        (F.col("id") * 7919 % 5000).alias("a"), F.col("id").alias("b"))
    keyed = dense_key(df, [F.col("a").asc(), F.col("b").asc()], "k", num_partitions=6)
    ref = df.withColumn("k_ref", F.row_number().over(Window.orderBy("a", "b")))
    j = keyed.join(ref, ["a", "b"])
    assert j.filter(F.col("k") != F.col("k_ref")).count() == 0
    stats = keyed.agg(F.min("k"), F.max("k"), F.countDistinct("k")).collect()[0]
    assert tuple(stats) == (1, 5000, 5000)


def test_dense_key_hot_value_and_nulls(spark):
    # a third of the rows share one leading sort value; some leading values are NULL
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(42)).when(F.col("id") % 97 == 1, F.lit(None))
         .otherwise(F.col("id")).alias("a"), F.col("id").alias("b"))
    order = [F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first()]
    keyed = dense_key(df, order, "k", num_partitions=8)
    ref = df.withColumn("k_ref", F.row_number().over(Window.orderBy(*order)))
    j = keyed.join(ref, "b")
    assert j.filter(F.col("k") != F.col("k_ref")).count() == 0
    # the hot value is spread over several range partitions, not one task
    hot_parts = (df.repartitionByRange(8, *order).filter(F.col("a") == 42)
                   .select(F.spark_partition_id().alias("p")).distinct().count())
    assert hot_parts > 1


def test_dense_key_plan_has_no_single_partition_exchange(spark):
    df = spark.range(0, 1000).select((F.col("id") % 10).alias("a"), "id")
    keyed = dense_key(df, [F.col("a").asc(), F.col("id").asc()], "k", num_partitions=4)
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    # the only global window is over the per-partition counts (4 rows)
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


def test_lookup_leaves_the_facts_where_they_are(spark, monkeypatch):
    from layercake.operators import keys
    facts = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), ("x", 5)], "k string, n int")
    dim = spark.createDataFrame([("a", 10, "y" * 50), ("b", 20, "z"), ("c", 30, None), (None, 40, "")],
                                "name string, sk long, more string").repartition(3)

    def looked_up():
        out = keys.lookup_surrogate(facts, dim, F.col("k"), F.col("name"), ["sk"])
        return out._jdf.queryExecution().executedPlan().toString(), sorted((r["n"], r["sk"]) for r in out.collect())

    want = [(1, 10), (2, 20), (3, 20), (4, None), (5, None)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan, rows = looked_up()
        assert rows == want and "BroadcastHashJoin" in plan
        monkeypatch.setattr(keys, "LOOKUP_BYTES", 0)
        plan, rows = looked_up()
        assert rows == want and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert keys.lookup_bytes(dim.select("name", "sk")) == 4 * 24 + 3
    assert keys.lookup_bytes(dim.limit(0)) == 0


def test_lookup_beyond_the_broadcast_does_not_sort_the_facts(spark, monkeypatch):
    from layercake.operators import keys
    facts = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), ("x", 5)], "k string, n int")
    dim = spark.createDataFrame([("a", 10), ("b", 20), ("b", 21), (None, 40)], "name string, sk long")
    monkeypatch.setattr(keys, "LOOKUP_BYTES", 0)
    want = [(1, 10), (2, 20), (2, 21), (3, 20), (3, 21), (4, None), (5, None)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for limit, kind in ((keys.HASHED_BYTES, "ShuffledHashJoin"), (1, "SortMergeJoin")):
            monkeypatch.setattr(keys, "HASHED_BYTES", limit)
            out = keys.lookup_surrogate(facts, dim, F.col("k"), F.col("name"), ["sk"])
            assert kind in out._jdf.queryExecution().executedPlan().toString()
            assert sorted((r["n"], r["sk"] or 0) for r in out.collect()) == [(n, sk or 0) for n, sk in want]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
