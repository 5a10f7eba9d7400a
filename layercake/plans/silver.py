"""Silver layer: one pure function per table, bronze DataFrame -> silver.

Only ``clean_products`` (lead per product key) and ``clean_customers``
(keep-latest per customer id) shuffle; the other four are narrow maps that
stay in one whole-stage-codegen span.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.operators.cleanse import (
    fill_null, keep_latest, null_out_of_range, repair_int_dates, repair_measures,
    scd2_end_date, split_key, standardise_codes, standardise_or_keep, strip_prefix,
    trim_columns)
from layercake.functions.exprs import code_map

# ---------------------------------------------------------------------------
# Fixed values of the cleansing rules (must equal the warehouse's rules).
# ---------------------------------------------------------------------------
MARITAL_CODES = {"S": "Single", "M": "Married"}
GENDER_CODES = {"F": "Female", "M": "Male"}
GENDER_LONG_CODES = {("F", "FEMALE"): "Female", ("M", "MALE"): "Male"}
PRODUCT_LINE_CODES = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
COUNTRY_CODES = {("DE",): "Germany", ("US", "USA"): "United States"}
UNKNOWN = "Unknown"
ERP_CUSTOMER_PREFIX = "NAS"
EARLIEST_BIRTH_DATE = "1925-01-01"   # on or before -> NULL
SALES_DATE_COLUMNS = ("sls_order_dt", "sls_ship_dt", "sls_due_dt")


def clean_sales(bronze: DataFrame, reject_flags: bool = False) -> DataFrame:
    """crm_sales_details: int dates -> DATE, sales/price repaired."""
    df = repair_measures(bronze, "sls_sales", "sls_quantity", "sls_price")
    # repair_measures touches only sales/price; dates read raw ints either way
    df = repair_int_dates(df, SALES_DATE_COLUMNS, "_rejected" if reject_flags else None)
    cols = ["sls_ord_num", "sls_prd_key", "sls_cust_id", *SALES_DATE_COLUMNS,
            "sls_sales", "sls_quantity", "sls_price"]
    if reject_flags:
        cols += [f"{c}_rejected" for c in SALES_DATE_COLUMNS]
    return df.select(*cols)


def clean_products(bronze: DataFrame) -> DataFrame:
    """crm_prd_info: key split, trimmed name, cost default, line codes, and
    SCD-2 end dates chained on the RAW product key."""
    df = scd2_end_date(bronze, "prd_key", "prd_start_dt", "prd_end_dt",
                       tie_breakers=("prd_id",))
    df = split_key(df, "prd_key", "cat_id", "prd_key_rest")
    df = trim_columns(df, ["prd_nm"])
    df = fill_null(df, "prd_cost", 0)
    df = df.withColumn("prd_line", code_map("prd_line", PRODUCT_LINE_CODES, UNKNOWN))
    return df.select(
        "prd_id", "cat_id", F.col("prd_key_rest").alias("prd_key"), "prd_nm",
        F.col("prd_cost").cast("int").alias("prd_cost"), "prd_line",
        F.to_date("prd_start_dt").alias("prd_start_dt"), "prd_end_dt")


def clean_locations(bronze: DataFrame) -> DataFrame:
    """erp_loc_a101: '-' removed from the id, country names standardised."""
    df = bronze.withColumn("cid", F.replace(F.col("cid"), F.lit("-"), F.lit("")))
    return standardise_or_keep(df, "cntry", COUNTRY_CODES, UNKNOWN).select("cid", "cntry")


# Newest create date wins; the remaining raw columns break ties so the
# choice is deterministic.
CUSTOMER_TIE_BREAKERS = ("cst_marital_status", "cst_gndr", "cst_firstname",
                         "cst_lastname", "cst_key")


def customer_dedup_order():
    return [F.col("cst_create_date").desc_nulls_last(),
            *[F.col(c).asc_nulls_first() for c in CUSTOMER_TIE_BREAKERS]]


def clean_customers(bronze: DataFrame) -> DataFrame:
    """crm_cust_info: newest row per customer id (NULL ids dropped), trimmed
    names, marital status and gender codes."""
    df = keep_latest(bronze, "cst_id", customer_dedup_order())
    df = trim_columns(df, ["cst_firstname", "cst_lastname"])
    df = standardise_codes(df, {"cst_marital_status": MARITAL_CODES,
                                "cst_gndr": GENDER_CODES}, UNKNOWN)
    return df.select("cst_id", "cst_key", "cst_firstname", "cst_lastname",
                     "cst_marital_status", "cst_gndr", "cst_create_date")


def clean_erp_customers(bronze: DataFrame, as_of: dt.date | str) -> DataFrame:
    """erp_cust_az12: 'NAS' prefix stripped, impossible birth dates NULL,
    gender long/short codes.  ``as_of`` replaces the wall clock."""
    df = strip_prefix(bronze, "cid", ERP_CUSTOMER_PREFIX)
    df = null_out_of_range(df, "bdate", F.lit(str(as_of)).cast("date"),
                           F.lit(EARLIEST_BIRTH_DATE).cast("date"))
    df = df.withColumn("gen", code_map("gen", GENDER_LONG_CODES, UNKNOWN))
    return df.select("cid", "bdate", "gen")


def clean_categories(bronze: DataFrame) -> DataFrame:
    """erp_px_cat_g1v2: pass-through copy."""
    return bronze.select("id", "cat", "subcat", "maintenance")


def clean_all(bronze: dict[str, DataFrame], as_of) -> dict[str, DataFrame]:
    return {
        "crm_sales_details": clean_sales(bronze["crm_sales_details"]),
        "crm_prd_info": clean_products(bronze["crm_prd_info"]),
        "erp_loc_a101": clean_locations(bronze["erp_loc_a101"]),
        "crm_cust_info": clean_customers(bronze["crm_cust_info"]),
        "erp_cust_az12": clean_erp_customers(bronze["erp_cust_az12"], as_of),
        "erp_px_cat_g1v2": clean_categories(bronze["erp_px_cat_g1v2"]),
    }


# Reload order of the silver runner (fixed).
SILVER_ORDER = ("crm_sales_details", "crm_prd_info", "erp_loc_a101", "crm_cust_info",
                "erp_cust_az12", "erp_px_cat_g1v2")
