"""Unit rows per rule branch (FIXTURES.md section 2), as_of = 2026-01-01."""

import datetime as dt

from pyspark.sql import functions as F

from layercake.functions.exprs import (
    band, concat_null_propagating, concat_nulls_as_empty, int_date_rejected, int_div,
    int_to_date, month_diff, pct_text, round_ratio, year_diff)
from layercake.operators.cleanse import prefer_known, repair_measures
from layercake.plans import analysis, reports, silver

D = dt.date


def test_int_date_repair(spark):
    vals = [20131231, 0, 32154, None, 20131332, -1234567]
    df = spark.createDataFrame([(v,) for v in vals], "v int")
    out = df.select("v", int_to_date("v").alias("d"), int_date_rejected("v").alias("r")).collect()
    got = {r.v: (r.d, r.r) for r in out}
    assert got[20131231] == (D(2013, 12, 31), False)
    assert got[0] == (None, False)
    assert got[32154] == (None, False)
    assert got[None] == (None, False)
    assert got[20131332] == (None, True)
    assert got[-1234567] == (None, True)


def test_measure_repair(spark):
    rows = [(10, 2, 5), (None, 2, 5), (-10, 2, 5), (0, 2, 5), (11, 2, 5), (10, 2, -5),
            (10, 2, 0), (10, 2, None), (11, 2, None), (None, 2, None), (10, 0, None),
            (-9, 2, None)]
    want = [(10, 5), (10, 5), (10, 5), (10, 5), (10, 5), (10, 5), (0, 0), (10, 5), (11, 5),
            (None, None), (10, None), (None, -4)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "i int, s int, q int, p int")
    out = repair_measures(df, "s", "q", "p").orderBy("i").collect()
    assert [(r.s, r.p) for r in out] == want


def test_int_div_truncates_toward_zero(spark):
    df = spark.createDataFrame([(7, 2), (-7, 2), (7, -2), (1, 0), (None, 3)], "a int, b int")
    assert [r[0] for r in df.select(int_div("a", "b")).collect()] == [3, -3, -3, None, None]


def test_boundary_date_differences(spark):
    df = spark.createDataFrame(
        [(D(2020, 1, 31), D(2020, 2, 1)), (D(2020, 1, 1), D(2020, 1, 31)),
         (D(2019, 12, 31), D(2020, 1, 1)), (None, D(2020, 1, 1))], "a date, b date")
    out = df.select(month_diff("a", "b").alias("m"), year_diff("a", "b").alias("y")).collect()
    assert [(r.m, r.y) for r in out] == [(1, 0), (0, 0), (1, 1), (None, None)]


def test_concat_variants(spark):
    df = spark.createDataFrame([("A", "B"), (None, "B"), (None, None)], "f string, l string")
    out = df.select(concat_nulls_as_empty("f", F.lit(" "), "l").alias("c"),
                    concat_null_propagating("f", F.lit(" "), "l").alias("p")).collect()
    assert [(r.c, r.p) for r in out] == [("A B", "A B"), (" B", None), (" ", None)]


def test_segments(spark):
    df = spark.createDataFrame([(12, 5001), (12, 5000), (11, 9999), (None, 9999), (12, None)],
                               "ls int, sp long")
    out = df.select(analysis.segment("ls", "sp").alias("s")).collect()
    assert [r.s for r in out] == ["VIP", "Regular", "New", "New", "New"]


def test_age_bands_and_tiers(spark):
    ages = spark.createDataFrame([(19,), (20,), (29,), (30,), (49,), (50,), (None,)], "a int")
    got = [r[0] for r in ages.select(
        band("a", reports.AGE_CUTS, reports.AGE_LABELS, reports.AGE_OTHER)).collect()]
    assert got == ["Under 20", "20-29", "20-29", "30-39", "40-49", "50 And Above", "50 And Above"]
    sales = spark.createDataFrame([(5000,), (5001,), (20000,), (20001,), (50000,), (50001,),
                                   (None,)], "s long")
    got = [r[0] for r in sales.select(band("s", reports.TIER_CUTS, reports.TIER_LABELS)).collect()]
    assert got == ["Low Performers", "Mid Performers", "Mid Performers", "High Performers",
                   "High Performers", "Top Performers", None]


def test_percent_text_and_exact_rounding(spark):
    df = spark.createDataFrame([(1, 1), (1, 3), (1, 2), (None, 2), (7, 40)], "n long, d long")
    out = df.select(round_ratio(F.col("n") * 100, "d", 2).alias("p"),
                    round_ratio("n", "d", 1).alias("r")).withColumn("t", pct_text("p")).collect()
    assert [r.t for r in out] == ["100%", "33.33%", "50%", "%", "17.5%"]
    # 7/40 = 0.175 exactly: half away from zero gives 0.2 (binary float would give 0.1x)
    assert out[4].r == 0.2


def test_product_rows(spark):
    rows = [("CO-RF-FR-R92B-58", " A ", None, "r ", "2011-07-01", 1),
            ("CO-RF-FR-R92B-58", "A", 12, "M", "2012-07-01", 2),
            ("AC-HE-HL-U509", "B", 3, "s", "2011-07-01", 3),
            ("AC-HE-HL-U510", "B", 3, "T", "2011-07-01", 4),
            ("AC-HE-HL-U511", "B", 3, None, "2011-07-01", 5),
            ("XX-YY-HL-U509", "B", 3, "q", "2011-07-01", 6)]
    df = spark.createDataFrame(rows, "prd_key string, prd_nm string, prd_cost int, "
                                     "prd_line string, s string, prd_id int")
    df = df.withColumn("prd_start_dt", F.to_timestamp_ntz("s")).withColumn(
        "prd_end_dt", F.lit(None).cast("timestamp_ntz")).drop("s")
    out = {r.prd_id: r for r in silver.clean_products(df).collect()}
    assert (out[1].cat_id, out[1].prd_key, out[1].prd_nm, out[1].prd_cost, out[1].prd_line,
            out[1].prd_end_dt) == ("CO_RF", "FR-R92B-58", "A", 0, "Road", D(2012, 6, 30))
    assert (out[2].prd_line, out[2].prd_end_dt) == ("Mountain", None)
    assert [out[i].prd_line for i in (3, 4, 5, 6)] == ["Other Sales", "Touring", "Unknown",
                                                        "Unknown"]
    assert out[6].cat_id == "XX_YY" and out[6].prd_key == "HL-U509" and out[6].prd_end_dt is None


def test_location_rows(spark):
    rows = [("AW-001", "DE"), ("AW-002", "de "), ("AW-003", "US"), ("AW-004", " usa"),
            ("AW-005", ""), ("AW-006", "  "), ("AW-007", None), ("AW-008", " France ")]
    out = silver.clean_locations(spark.createDataFrame(rows, "cid string, cntry string"))
    got = {r.cid: r.cntry for r in out.collect()}
    assert got == {"AW001": "Germany", "AW002": "Germany", "AW003": "United States",
                   "AW004": "United States", "AW005": "Unknown", "AW006": "Unknown",
                   "AW007": "Unknown", "AW008": "France"}


def test_customer_rows(spark):
    rows = [(1, "K1", " Jon ", "X", "s ", "f", D(2025, 1, 1)),
            (1, "K1", "Jon", "X", "M", "M", D(2025, 6, 1)),
            (2, "K2", "Ann", "Y", None, "x", D(2025, 1, 1)),
            (None, "K3", "Bob", "Z", "S", "M", D(2025, 1, 1))]
    df = spark.createDataFrame(rows, "cst_id int, cst_key string, cst_firstname string, "
                                     "cst_lastname string, cst_marital_status string, "
                                     "cst_gndr string, cst_create_date date")
    out = sorted(tuple(r) for r in silver.clean_customers(df).collect())
    assert out == [(1, "K1", "Jon", "X", "Married", "Male", D(2025, 6, 1)),
                   (2, "K2", "Ann", "Y", "Unknown", "Unknown", D(2025, 1, 1))]


def test_erp_customer_rows(spark):
    rows = [("NASAW001", D(2026, 1, 2), "F"), ("nasAW001", D(2026, 1, 1), " female"),
            ("AW002", D(1925, 1, 1), "M"), ("AW003", D(1925, 1, 2), "MALE "),
            ("AW004", None, ""), ("AW005", None, None), ("AW006", None, "x")]
    out = silver.clean_erp_customers(
        spark.createDataFrame(rows, "cid string, bdate date, gen string"), "2026-01-01").collect()
    assert [r.cid for r in out] == ["AW001", "AW001", "AW002", "AW003", "AW004", "AW005", "AW006"]
    assert [r.bdate for r in out] == [None, D(2026, 1, 1), None, D(1925, 1, 2), None, None, None]
    assert [r.gen for r in out] == ["Female", "Female", "Male", "Male", "Unknown", "Unknown",
                                    "Unknown"]


def test_gender_precedence(spark):
    df = spark.createDataFrame([("Male", "Female"), ("Unknown", "Female"), (None, "Male"),
                                ("Unknown", None)], "crm string, erp string")
    assert [r[0] for r in df.select(prefer_known("crm", "erp")).collect()] == [
        "Male", "Female", "Male", "Unknown"]


def test_product_performance_labels(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "product_key long, product_name string")
    fact = spark.createDataFrame(
        [(1, D(2020, 5, 1), 10), (1, D(2021, 5, 1), 10), (1, D(2022, 5, 1), 11),
         (2, D(2020, 5, 1), 3), (2, D(2021, 5, 1), 1)],
        "product_key long, order_date date, sales_amount int")
    out = analysis.product_performance_yoy(fact, dim).collect()
    got = [(r.product_name, r.order_year, r.avg_change, r.previous_year_change) for r in out]
    assert got == [("a", 2020, "On Avg", "No Changes"), ("a", 2021, "On Avg", "No Changes"),
                   ("a", 2022, "Above Avg", "Sales Increasing"),
                   ("b", 2020, "Above Avg", "No Changes"),
                   ("b", 2021, "Below Avg", "Sales Decreasing")]


def test_part_to_whole_single_category(spark):
    dim = spark.createDataFrame([(1, "c")], "product_key long, category string")
    fact = spark.createDataFrame([(1, 5), (1, 7)], "product_key long, sales_amount int")
    out = analysis.part_to_whole(fact, dim).collect()
    assert [(r.category, r.total_sales, r.sales_percentage) for r in out] == [("c", 12, "100%")]
