"""Names and keys under the warehouse's collation, against plain Python."""

import os
import sys
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.operators.cleanse import keep_latest
from layercake.operators.collation import EXACT, WAREHOUSE, collate, declared, group_names, spelled
from layercake.plans import analysis, gold, silver
from layercake.sources import adapter, schemas
from layercake.sources.testdata import TestTables

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))
from plan_report import final_plan  # noqa: E402

NAMES = ["Bikes", "BIKES ", "bikes", " bikes", None, "", "   ", "Straße", "STRASSE", "Été", "ÉTÉ  ", "bikes\t", "Bikes"]


def same(s):
    return None if s is None else s.rstrip(" ").lower()


@pytest.fixture(scope="module")
def named(spark):
    rows = [(i, n, i * i if i % 4 else None) for i, n in enumerate(NAMES * 3)]
    return spark.createDataFrame(rows, "id long, name string, v long")


def test_groups_follow_the_collation(named):
    got = {r["name"]: tuple(r)[1:] for r in group_names(
        named, ["name"], {"n": ("count", "*"), "n_v": ("count", "v"), "total": ("sum", "v"), "low": ("min", "v"),
                          "high": ("max", "v")}, "spellings").collect()}
    groups = defaultdict(list)
    for r in named.collect():
        groups[same(r["name"])].append(r)
    want = {}
    for rows in groups.values():
        v = [r.v for r in rows if r.v is not None]
        texts = {r.name for r in rows}
        least = None if None in texts else min(texts, key=lambda s: s.encode())
        want[least] = (len(rows), len(v), sum(v) if v else None, min(v, default=None), max(v, default=None), len(texts))
    assert got == want


def test_declared_columns_rule_distinct_windows_predicates_and_joins(named, spark):
    c = collate(named, ["name"])
    keys = {same(r["name"]) for r in named.collect()}
    assert c.select("name").distinct().count() == len(keys)
    assert c.agg(F.countDistinct("name")).first()[0] == len(keys - {None})
    kept = keep_latest(c, "name", [F.desc("id")]).collect()
    last = {same(r["name"]): r["id"] for r in named.orderBy("id").collect() if r["name"] is not None}
    assert {same(r["name"]): r["id"] for r in kept} == last
    assert c.where(F.col("name") == "BIKES").count() == sum(same(n) == "bikes" for n in NAMES) * 3
    other = collate(spark.createDataFrame([("bIKES",), ("",), ("none such",)], "other string"))
    joined = c.join(other, F.col("name") == F.col("other"), "left")
    assert joined.where("other IS NOT NULL").count() == sum(same(n) in ("bikes", "") for n in NAMES) * 3
    assert "NestedLoop" not in final_plan(joined) and "CartesianProduct" not in final_plan(joined)
    assert spelled(c).schema["name"].dataType == T.StringType()


def test_rows_are_combined_by_spelling_before_they_are_sorted(named):
    plan = final_plan(group_names(collate(named), ["name"], {"n": ("count", "*")}))
    assert plan.count("HashAggregate") >= 2
    # read from the bottom: scan, then the hash aggregates, then the first sort
    assert plan.rindex("HashAggregate") > plan.rindex("SortAggregate")


def test_hot_name_empty_table_and_unknown_aggregate(named, spark):
    hot = spark.range(30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.when(F.col("id") % 2 == 0, "Hot").otherwise("HOT "))
        .otherwise(F.concat(F.lit("n"), F.col("id"))).alias("name"), "id")
    out = group_names(hot, ["name"], {"n": ("count", "*")}, "spellings")
    assert out.where("n > 1").collect() == [("HOT ", 10_000, 2)]
    assert out.count() == 20_001
    assert group_names(named.limit(0), ["name"], {"n": ("count", "*")}).count() == 0
    with pytest.raises(ValueError):
        group_names(named, ["name"], {"m": ("avg", "v")})


def test_two_names_and_clashing_column_names(spark):
    df = spark.createDataFrame([("A", "x ", 1), ("a ", "X", 2), ("a", None, 4), (None, "x", 8)], "_n0 string, _a0 string, v long")
    got = {tuple(r) for r in group_names(df, ["_n0", "_a0"], {"s": ("sum", "v")}, "k").collect()}
    assert got == {("A", "X", 3, 2), ("a", None, 4, 1), (None, "x", 8, 1)}


def test_declared_table_keeps_its_rule(spark, named):
    schema = declared(T.StructType.fromDDL("id long, name string, note string"), ["name"])
    assert [f.dataType for f in schema] == [T.LongType(), T.StringType(WAREHOUSE), T.StringType()]
    spark.sql("DROP TABLE IF EXISTS collated_names")
    spark.sql(f"CREATE TABLE collated_names ({', '.join(f'{f.name} {f.dataType.simpleString()}' for f in schema)}) USING parquet")
    named.select("id", "name", F.lit(" ").alias("note")).write.insertInto("collated_names")
    back = spark.table("collated_names")
    assert back.schema["name"].dataType == T.StringType(WAREHOUSE)
    assert spark.sql("SELECT count(*) FROM (SELECT name FROM collated_names GROUP BY name)").first()[0] \
        == len({same(n) for n in NAMES})
    spark.sql("DROP TABLE collated_names")


def test_gold_and_analyses_on_declared_columns(spark, small_dir):
    s = silver.clean_all(adapter.bronze_frames(TestTables(spark, small_dir)), "2026-01-01")
    cats = s["erp_px_cat_g1v2"].withColumn("id", F.lower("id"))
    plain = gold.dim_products(s["crm_prd_info"], cats, spark)
    dim = gold.dim_products(collate(s["crm_prd_info"], ["prd_key", "cat_id"]), collate(cats), spark)
    assert spelled(dim).exceptAll(plain).count() == 0 and dim.count() == plain.count()
    fact = spark.createDataFrame([(r["product_key"], 10) for r in plain.select("product_key").collect()],
                                 "product_key long, sales_amount long")
    odd = plain.withColumn("category", adapter.respelt(F.col("product_id"), F.col("category")))
    under = analysis.part_to_whole(fact, collate(odd, ["category"])).collect()
    exact = analysis.part_to_whole(fact, odd).collect()
    assert len(under) == len({same(r.category) for r in exact}) < len(exact)
    totals = defaultdict(int)
    for r in exact:
        totals[same(r.category)] += r.total_sales
    assert {same(r.category): r.total_sales for r in under} == dict(totals)


def test_silver_schema_can_be_declared():
    fields = {f.name: f.dataType for f in declared(schemas.SILVER["crm_prd_info"])}
    assert fields["prd_key"] == T.StringType(WAREHOUSE) and EXACT == T.StringType().collation
    assert schemas.SILVER["crm_prd_info"]["prd_key"].dataType == T.StringType()
