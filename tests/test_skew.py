"""Correctness under a hot key: a third of all sales moved to one customer
and one product, reports/analyses compared with the SQL oracle run by
DuckDB directly on the same (exported) skewed tables."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))
import sql_oracle  # noqa: E402
from check_oracle import digest  # noqa: E402
from layercake.plans import analysis, reports  # noqa: E402
from layercake.plans.registry import AS_OF, SPEND_THRESHOLD  # noqa: E402
from layercake.plans.warehouse import warehouse  # noqa: E402
from layercake.session import materialize  # noqa: E402


@pytest.fixture(scope="module")
def skewed(spark, small_dir):
    wh = warehouse(spark, small_dir)
    hot = F.abs(F.hash("order_number")) % 3 == 0
    fact = wh.fact_sales.withColumns({
        "customer_key": F.when(hot, F.lit(1).cast("long")).otherwise(F.col("customer_key")),
        "product_key": F.when(hot, F.lit(1).cast("long")).otherwise(F.col("product_key")),
    })
    tables = {"fact_sales": fact, "dim_products": wh.dim_products,
              "dim_customers": wh.dim_customers}
    out, con = {}, duckdb.connect()
    for name, df in tables.items():
        m = materialize(df, spark, f"skew_{name}")
        out[name] = m
        path = m.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    share = out["fact_sales"].filter(F.col("customer_key") == 1).count() / out["fact_sales"].count()
    assert share > 0.3
    return out, con


CASES = {
    "customers_report": lambda t: reports.customers_report(
        t["fact_sales"], t["dim_customers"], AS_OF, SPEND_THRESHOLD),
    "customer_spending": lambda t: reports.customer_spending(
        t["fact_sales"], t["dim_customers"], SPEND_THRESHOLD),
    "segment_counts": lambda t: analysis.segment_counts(
        t["fact_sales"], t["dim_customers"], SPEND_THRESHOLD),
    "products_report": lambda t: reports.products_report(
        t["fact_sales"], t["dim_products"], AS_OF),
    "products_report_by_product": lambda t: reports.products_report_by_product(
        t["fact_sales"], t["dim_products"], AS_OF),
    "product_performance_yoy": lambda t: analysis.product_performance_yoy(
        t["fact_sales"], t["dim_products"]),
    "part_to_whole": lambda t: analysis.part_to_whole(t["fact_sales"], t["dim_products"]),
    "yearly_trend": lambda t: analysis.yearly_trend(t["fact_sales"]),
}


@pytest.mark.parametrize("name", list(CASES))
def test_hot_key_results_match_sql(skewed, name):
    tables, con = skewed
    df = CASES[name](tables)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql_oracle.QUERIES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
