"""Invariants from the test strategy plus property checks of the
arithmetic helpers against pure-Python references."""

import datetime as dt
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from layercake.operators.cleanse import repair_measures
from layercake.functions.exprs import (
    int_date_rejected, int_to_date, month_diff, round_ratio, year_diff)
from layercake.plans import analysis, silver
from layercake.plans.warehouse import warehouse
from layercake.sources import adapter
from layercake.sources.testdata import TestTables


@pytest.fixture(scope="module")
def wh(spark, small_dir):
    return warehouse(spark, small_dir)


def _py_int_to_date(v):
    if v is None or v == 0 or len(str(v)) != 8:
        return None, False
    try:
        return dt.datetime.strptime(str(v), "%Y%m%d").date(), False
    except ValueError:
        return None, True


def test_int_to_date_matches_python(spark):
    rnd = random.Random(7)
    vals = [rnd.randint(10000000, 99999999) for _ in range(1500)]
    vals += [rnd.randint(1900, 2100) * 10000 + rnd.randint(0, 13) * 100 + rnd.randint(0, 32)
             for _ in range(1500)]
    vals += [-1234567, -9999999, -10000000, 0, 1, 9999999, 100000000, 20000229, 19000229,
             20240229, 20230229, 20231131, 20231231, 99991231]
    df = spark.createDataFrame([(v,) for v in vals], "v int")
    got = {r.v: (r.d, r.x) for r in df.select(
        "v", int_to_date("v").alias("d"), int_date_rejected("v").alias("x")).collect()}
    for v in vals:
        assert got[v] == _py_int_to_date(v), v


def _py_round(n, d, digits):
    if d == 0:
        return None
    q = Fraction(n, d) * 10 ** digits
    r = (abs(q.numerator) * 2 + q.denominator) // (2 * q.denominator)
    return (r if q >= 0 else -r) / 10 ** digits


def test_round_ratio_matches_exact_fraction(spark):
    rnd = random.Random(11)
    rows = [(rnd.randint(-10**9, 10**9), rnd.choice([rnd.randint(1, 5000), -rnd.randint(1, 50)]))
            for _ in range(2000)] + [(7, 40), (-7, 40), (1, 8), (5, 0), (0, 3)]
    df = spark.createDataFrame(rows, "n long, d long")
    got = df.select("n", "d", round_ratio("n", "d", 1).alias("r1"),
                    round_ratio("n", "d", 2).alias("r2")).collect()
    for r in got:
        assert r.r1 == _py_round(r.n, r.d, 1)
        assert r.r2 == _py_round(r.n, r.d, 2)


def test_boundary_differences_match_python(spark):
    rnd = random.Random(3)
    base = dt.date(1990, 1, 1)
    pairs = [(base + dt.timedelta(days=rnd.randint(0, 15000)),
              base + dt.timedelta(days=rnd.randint(0, 15000))) for _ in range(1000)]
    df = spark.createDataFrame(pairs, "a date, b date")
    for r in df.select("a", "b", month_diff("a", "b").alias("m"),
                       year_diff("a", "b").alias("y")).collect():
        assert r.m == (r.b.year - r.a.year) * 12 + r.b.month - r.a.month
        assert r.y == r.b.year - r.a.year


def test_silver_customer_ids_unique_and_not_null(spark, small_dir):
    s = silver.clean_customers(adapter.crm_cust_info(TestTables(spark, small_dir)))
    agg = s.agg(F.count("*"), F.countDistinct("cst_id"), F.count("cst_id")).collect()[0]
    assert agg[0] == agg[1] == agg[2]


def test_sales_consistent_where_raw_price_known(spark, small_dir):
    b = adapter.crm_sales_details(TestTables(spark, small_dir))
    r = repair_measures(b.withColumn("raw_price", F.col("sls_price")),
                        "sls_sales", "sls_quantity", "sls_price")
    bad = r.filter(F.col("raw_price").isNotNull() &
                   ~(F.col("sls_sales") == F.col("sls_quantity") * F.col("sls_price")))
    assert r.filter(F.col("raw_price").isNotNull()).count() > 0
    assert bad.count() == 0


def test_percentages_sum_to_100(spark, wh):
    p = analysis.part_to_whole(wh.fact_sales, wh.dim_products)
    total = p.agg(F.sum("sales_pct")).collect()[0][0]
    assert abs(total - 100) < 0.05


def test_location_and_erp_cleaning_idempotent(spark, small_dir):
    t = TestTables(spark, small_dir)
    loc = silver.clean_locations(adapter.erp_loc_a101(t))
    assert loc.exceptAll(silver.clean_locations(loc)).count() == 0
    erp = silver.clean_erp_customers(adapter.erp_cust_az12(t), "2026-01-01")
    assert erp.exceptAll(silver.clean_erp_customers(erp, "2026-01-01")).count() == 0


def test_current_product_numbers_unique(spark, wh):
    # duplicates would fan facts out (same product under two category prefixes)
    d = wh.dim_products
    assert d.count() == d.select("product_number").distinct().count()
