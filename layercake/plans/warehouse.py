"""End-to-end build: test tables -> bronze extracts -> silver -> gold.

``build`` returns lazily defined bronze and silver frames plus gold tables
that are materialised once on shared storage (dimensions through
``dense_key``, the fact as Parquet), so surrogate keys are computed once per
build and every analysis reads files with real size statistics.

``warehouse`` memoises the build per (application, input dir, as-of date).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from layercake.plans import gold, silver
from layercake.session import materialize, run_concurrently
from layercake.sources import adapter
from layercake.sources.testdata import TestTables

DEFAULT_AS_OF = dt.date(2026, 1, 1)


@dataclass
class Warehouse:
    bronze: dict[str, DataFrame]
    silver: dict[str, DataFrame]
    dim_products: DataFrame
    dim_customers: DataFrame
    fact_sales: DataFrame
    as_of: dt.date = DEFAULT_AS_OF
    extra: dict = field(default_factory=dict)


def build(spark: SparkSession, sf_dir: str, as_of=DEFAULT_AS_OF) -> Warehouse:
    t = TestTables(spark, sf_dir)
    bronze = adapter.bronze_frames(t)
    s = silver.clean_all(bronze, as_of)
    # the two dimensions are independent: build them concurrently
    dp, dc = run_concurrently(lambda f: f(), [
        lambda: gold.dim_products(s["crm_prd_info"], s["erp_px_cat_g1v2"], spark),
        lambda: gold.dim_customers(s["crm_cust_info"], s["erp_cust_az12"],
                                   s["erp_loc_a101"], spark),
    ])
    # dense_key returns frozen keys: staged files + a local offsets table
    fact = materialize(gold.fact_sales(s["crm_sales_details"], dp, dc), spark, "fact_sales")
    return Warehouse(bronze, s, dp, dc, fact, as_of)


_CACHE: dict[tuple, Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str, as_of=DEFAULT_AS_OF) -> Warehouse:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), str(as_of))
    wh = _CACHE.get(key)
    if wh is None:
        wh = _CACHE[key] = build(spark, sf_dir, as_of)
    return wh
