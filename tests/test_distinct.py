"""Distinct counts from words equal COUNT DISTINCT at every grain."""

import pytest
from pyspark.sql import functions as F

from layercake.operators.distinct import count_words, distinct_words, merge_words, roll_up

ROWS = [(None, 1, 5, 7), (None, 1, 5, None), (1, 1, 63, 64), (1, 1, 64, 64), (1, 2, 63, -1), (1, 2, -1, -64),
        (1, 2, -65, None), (2, None, None, None), (2, None, None, None), (2, 3, 1 << 62, -(1 << 63)), (2, 3, 0, 0)]
SCHEMA = "y int, m int, c long, p long"
LEVELS = {"month": 2, "year": 1, "all": 0}


def _plain(rows):
    return sorted(str(tuple(r)) for r in rows)


def _compare(df):
    words = distinct_words(df, [F.col("y"), F.col("m")], [F.col("c"), F.col("p")])
    got = roll_up(words, ["y", "m"], ["cs", "ps"], LEVELS)
    counts = [F.count_distinct("c").alias("cs"), F.count_distinct("p").alias("ps")]
    want = ([("month", *r) for r in df.groupBy("y", "m").agg(*counts).collect()]
            + [("year", r[0], None, *r[1:]) for r in df.groupBy("y").agg(*counts).collect()]
            + [("all", None, None, *r) for r in df.agg(*counts).collect()])
    assert _plain(got.collect()) == _plain(want)


def test_nulls_negative_keys_and_extra_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    _compare(df)
    _compare(df.withColumn("_bits", F.lit("clash")).withColumn("grain", F.lit(1)))


def test_empty_table_counts_zero(spark):
    df = spark.createDataFrame([], SCHEMA)
    _compare(df)


def test_hot_group_with_dense_keys(spark):
    df = spark.range(40_000).select(
        F.when(F.col("id") % 3 > 0, 2020).otherwise(F.col("id") % 7).cast("int").alias("y"),
        (F.col("id") % 12).cast("int").alias("m"), (F.col("id") % 9_973).alias("c"), (F.col("id") * 31 % 517).alias("p"))
    _compare(df)
    words = distinct_words(df, [F.col("y")], [F.col("c")])
    # a dense group needs a 64th of the rows that its keys have
    assert words.where("y = 2020").count() == 9_973 // 64 + 1
    assert (count_words(merge_words(words, []), [], ["c"]).first()[0]) == 9_973


def test_plan_combines_by_hash_without_expand(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    plan = distinct_words(df, [F.col("y")], [F.col("c"), F.col("p")])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Expand" not in plan


def test_reserved_names(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    with pytest.raises(ValueError):
        distinct_words(df, [F.col("y").alias("_word")], [F.col("c")])
