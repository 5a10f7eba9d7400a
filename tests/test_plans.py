"""Plan-shape checks (scale properties) on the real build at sf0.001."""

import pytest
from pyspark.sql import functions as F

from layercake.plans import analysis, reports, silver
from layercake.plans.warehouse import warehouse
from layercake.sources import adapter
from layercake.sources.testdata import TestTables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def wh(spark, small_dir):
    return warehouse(spark, small_dir)


def test_dedup_pushes_group_limit_below_shuffle(spark, small_dir):
    df = silver.clean_customers(adapter.crm_cust_info(TestTables(spark, small_dir)))
    p = plan(df)
    assert "WindowGroupLimit" in p
    # partial top-1 per key runs before the exchange
    assert p.index("WindowGroupLimit") < p.index("Exchange hashpartitioning(cst_id")
    # the NULL-key filter is pushed below the window, into the scans
    o = optimized(df)
    assert "isnotnull" in o[o.index("WindowGroupLimit"):]
    assert "isnotnull" not in o[:o.index("WindowGroupLimit")]


def test_scans_are_pruned_and_filtered(spark, wh):
    df = analysis.yearly_trend(wh.fact_sales)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(order_date)]" in p
    schema = "struct<customer_key:bigint,order_date:date,sales_amount:int,quantity:int>"
    assert f"ReadSchema: {schema}" in p


def test_reports_aggregate_before_joining_dimension(spark, wh):
    df = reports.customers_report(wh.fact_sales, wh.dim_customers, "2026-01-01")
    o = optimized(df)
    # the join's left input is already an Aggregate over the fact
    join_at = o.index("Join LeftOuter")
    assert "Aggregate" in o[join_at:]


def test_products_report_month_window_is_preaggregated(spark, wh):
    df = reports.products_report(wh.fact_sales, wh.dim_products, "2026-01-01")
    p = plan(df)
    assert "BroadcastExchange" in p
    assert "Inner" in p


def test_part_to_whole_uses_scalar_subquery_not_cross_join(spark, wh):
    df = analysis.part_to_whole(wh.fact_sales, wh.dim_products)
    p = plan(df)
    assert "Subquery" in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_dimension_keys_dense_and_unique(spark, wh):
    for dim, key in ((wh.dim_products, "product_key"), (wh.dim_customers, "customer_key")):
        n = dim.count()
        s = dim.agg(F.min(key), F.max(key), F.countDistinct(key)).collect()[0]
        assert tuple(s) == (1, n, n)


def test_fact_keeps_every_sale(spark, wh):
    assert wh.fact_sales.count() == wh.silver["crm_sales_details"].count()


def test_products_report_deals_the_sales_once(spark, monkeypatch):
    """One shuffle of the sales, and no copies of them for the distinct counts."""
    fact = spark.createDataFrame(
        [(1, "2020-01-01", "o1", 1, 10, 1, 10), (1, "2020-01-01", "o1", 2, 10, 1, 10), (1, "2020-01-01", "o2", 2, 20, 2, 10),
         (1, None, "o3", None, 10, 1, 10), (2, "2020-02-01", "o1", 1, 7, 0, 10), (2, "2020-02-01", "o1", 1, 7, 1, None),
         (None, "2020-02-01", "o1", 1, 7, 1, 7)],
        "product_key long, order_date string, order_number string, customer_key long, sales_amount int, quantity int, "
        "price int").withColumn("order_date", F.to_date("order_date"))
    dim = spark.createDataFrame([(1, "a", "c", "s", 3), (2, "b", "c", "s", 4)],
                                "product_key long, product_name string, category string, sub_category string, cost int")
    plans = []

    def kept(df, spark, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString().splitlines())
        return df
    monkeypatch.setattr(reports, "materialize", kept)
    rows = reports.products_report(fact, dim, "2026-01-01").collect()
    got = {(r["product_key"], r["average_selling_price"], r["recency"] is None): (
        r["total_orders"], r["total_customers"], r["total_sales"]) for r in rows}
    assert got == {(1, 10.0, False): (2, 2, 40), (1, 10.0, True): (1, 0, 10), (2, None, False): (1, 1, 7)}
    sales = [x for x in plans[0] if "Exchange" in x or "Expand" in x]
    assert len(sales) == 1 and "REPARTITION" in sales[0], sales
