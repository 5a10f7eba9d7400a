"""Declared table schemas (fixed, never inferred).

CSV extracts are mapped to these by position after skipping the header.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _st(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, I, D, TS = T.StringType(), T.IntegerType(), T.DateType(), T.TimestampNTZType()
L = T.LongType()

# Bronze: raw extracts, types as loaded.
BRONZE: dict[str, T.StructType] = {
    "crm_cust_info": _st(("cst_id", I), ("cst_key", S), ("cst_firstname", S),
                         ("cst_lastname", S), ("cst_marital_status", S),
                         ("cst_gndr", S), ("cst_create_date", D)),
    "crm_prd_info": _st(("prd_id", I), ("prd_key", S), ("prd_nm", S), ("prd_cost", I),
                        ("prd_line", S), ("prd_start_dt", TS), ("prd_end_dt", TS)),
    "crm_sales_details": _st(("sls_ord_num", S), ("sls_prd_key", S), ("sls_cust_id", I),
                             ("sls_order_dt", I), ("sls_ship_dt", I), ("sls_due_dt", I),
                             ("sls_sales", I), ("sls_quantity", I), ("sls_price", I)),
    "erp_cust_az12": _st(("cid", S), ("bdate", D), ("gen", S)),
    "erp_loc_a101": _st(("cid", S), ("cntry", S)),
    "erp_px_cat_g1v2": _st(("id", S), ("cat", S), ("subcat", S), ("maintenance", S)),
}

# Silver: cleaned; every table also carries the load-time audit column.
SILVER: dict[str, T.StructType] = {
    "crm_cust_info": _st(("cst_id", I), ("cst_key", S), ("cst_firstname", S),
                         ("cst_lastname", S), ("cst_marital_status", S),
                         ("cst_gndr", S), ("cst_create_date", D)),
    "crm_prd_info": _st(("prd_id", I), ("cat_id", S), ("prd_key", S), ("prd_nm", S),
                        ("prd_cost", I), ("prd_line", S), ("prd_start_dt", D),
                        ("prd_end_dt", D)),
    "crm_sales_details": _st(("sls_ord_num", S), ("sls_prd_key", S), ("sls_cust_id", I),
                             ("sls_order_dt", D), ("sls_ship_dt", D), ("sls_due_dt", D),
                             ("sls_sales", I), ("sls_quantity", I), ("sls_price", I)),
    "erp_cust_az12": _st(("cid", S), ("bdate", D), ("gen", S)),
    "erp_loc_a101": _st(("cid", S), ("cntry", S)),
    "erp_px_cat_g1v2": _st(("id", S), ("cat", S), ("subcat", S), ("maintenance", S)),
}
AUDIT_COLUMN = "dwh_create_date"

# Load audit tables.
BRONZE_SUCCESS_LOG = _st(("table_name", S), ("file_path", S), ("rows_inserted", L),
                         ("rows_rejected", L), ("insert_time", T.TimestampType()))
BRONZE_ERROR_LOG = _st(("table_name", S), ("file_path", S), ("error_message", S),
                       ("error_time", T.TimestampType()))
SILVER_SUCCESS_LOG = _st(("procedure_nm", S), ("table_nm", S), ("row_count", L),
                         ("start_time", T.TimestampType()), ("end_time", T.TimestampType()),
                         ("duration_sec", L), ("inserted_at", T.TimestampType()))
SILVER_ERROR_LOG = _st(("procedure_nm", S), ("table_nm", S), ("error_msg", S),
                       ("error_line", S), ("start_time", T.TimestampType()),
                       ("error_time", T.TimestampType()))
