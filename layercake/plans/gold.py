"""Gold layer: star schema (two dimensions with dense surrogate keys and a
sales fact that looks the keys up by natural key).

Dimensions are numbered with ``dense_key`` (no single-partition exchange) and
are materialised once per build, so every query sees the same keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.functions.exprs import ci_key
from layercake.operators.cleanse import prefer_known
from layercake.operators.keys import dense_key, lookup_surrogate

DIM_PRODUCT_COLUMNS = ["product_key", "product_id", "product_number", "product_name",
                       "category_id", "category", "sub_category", "maintenance", "cost",
                       "product_line", "start_date"]
DIM_CUSTOMER_COLUMNS = ["customer_key", "customer_id", "customer_number", "first_name",
                        "last_name", "country", "marital_status", "gender", "birth_date",
                        "create_date"]
FACT_COLUMNS = ["order_number", "product_key", "customer_key", "order_date",
                "shipping_date", "due_date", "sales_amount", "quantity", "price"]

# Total orders for the surrogate keys (the warehouse sorted by start date
# only, which leaves ties to chance; the remaining columns break them).
PRODUCT_KEY_ORDER = ("start_date", "product_number", "product_id")
CUSTOMER_KEY_ORDER = ("customer_id", "country", "gender", "birth_date")


def _asc(cols):
    return [F.col(c).asc_nulls_first() for c in cols]


def dim_products(products: DataFrame, categories: DataFrame,
                 spark: SparkSession | None = None) -> DataFrame:
    """Current product versions (no end date) with their category."""
    cur = products.filter(F.col("prd_end_dt").isNull())
    cat = categories.select(F.col("id").alias("_cat_id"), "cat", "subcat", "maintenance")
    j = cur.join(cat, ci_key(cur.cat_id) == ci_key(F.col("_cat_id")), "left")
    unkeyed = j.select(
        F.col("prd_id").alias("product_id"), F.col("prd_key").alias("product_number"),
        F.col("prd_nm").alias("product_name"), F.col("cat_id").alias("category_id"),
        F.col("cat").alias("category"), F.col("subcat").alias("sub_category"),
        "maintenance", F.col("prd_cost").alias("cost"),
        F.col("prd_line").alias("product_line"), F.col("prd_start_dt").alias("start_date"))
    keyed = dense_key(unkeyed, _asc(PRODUCT_KEY_ORDER), "product_key", spark,
                      name="dim_products")
    return keyed.select(*DIM_PRODUCT_COLUMNS)


def dim_customers(customers: DataFrame, erp_customers: DataFrame, locations: DataFrame,
                  spark: SparkSession | None = None) -> DataFrame:
    """Customers enriched with ERP demographics and location; gender from CRM
    unless unknown, then ERP."""
    ca = erp_customers.select(F.col("cid").alias("_ca_cid"), "bdate", "gen")
    loc = locations.select(F.col("cid").alias("_loc_cid"), "cntry")
    j = (customers.join(ca, ci_key("cst_key") == ci_key("_ca_cid"), "left")
                  .join(loc, ci_key("cst_key") == ci_key("_loc_cid"), "left"))
    unkeyed = j.select(
        F.col("cst_id").alias("customer_id"), F.col("cst_key").alias("customer_number"),
        F.col("cst_firstname").alias("first_name"), F.col("cst_lastname").alias("last_name"),
        F.col("cntry").alias("country"), F.col("cst_marital_status").alias("marital_status"),
        prefer_known("cst_gndr", "gen").alias("gender"),
        F.col("bdate").alias("birth_date"), F.col("cst_create_date").alias("create_date"))
    keyed = dense_key(unkeyed, _asc(CUSTOMER_KEY_ORDER), "customer_key", spark,
                      name="dim_customers")
    return keyed.select(*DIM_CUSTOMER_COLUMNS)


def fact_sales(sales: DataFrame, dim_p: DataFrame, dim_c: DataFrame) -> DataFrame:
    """Sales with surrogate keys; facts without a dimension row keep NULL keys."""
    f = lookup_surrogate(sales, dim_p, ci_key("sls_prd_key"), ci_key("product_number"),
                         ["product_key"])
    f = lookup_surrogate(f, dim_c, F.col("sls_cust_id"), F.col("customer_id"),
                         ["customer_key"])
    return f.select(
        F.col("sls_ord_num").alias("order_number"), "product_key", "customer_key",
        F.col("sls_order_dt").alias("order_date"), F.col("sls_ship_dt").alias("shipping_date"),
        F.col("sls_due_dt").alias("due_date"), F.col("sls_sales").alias("sales_amount"),
        F.col("sls_quantity").alias("quantity"), F.col("sls_price").alias("price"))
