"""Named queries: one per surveyed operator / table / report.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame computed from
the test tables found in ``sf_dir`` (whole tables, no sampling).  Gold-level
queries share one memoised warehouse build per application.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.functions.exprs import ci_key, code_map, int_date_rejected, int_to_date
from layercake.operators.cleanse import (
    keep_latest, null_out_of_range, prefer_known, repair_measures, scd2_end_date, split_key,
    standardise_or_keep, strip_prefix)
from layercake.operators.collation import collate, group_names, spelled
from layercake.operators.keys import dense_key
from layercake.plans import analysis, reports, silver
from layercake.plans.warehouse import DEFAULT_AS_OF, warehouse
from layercake.plans import runners
from layercake.session import run_dir
from layercake.sources import adapter, schemas
from layercake.sources.catalog import Layers
from layercake.sources.csv_ingest import CORRUPT, read_extract, write_extract, write_lines
from layercake.sources.testdata import TestTables

AS_OF = DEFAULT_AS_OF
# The default VIP threshold (5000) puts every long-lived customer of the test
# data in one segment; the registered queries use a threshold that splits them.
SPEND_THRESHOLD = 2_500_000

REPORTS = ("customer_spending", "customers_report", "products_report")

Query = Callable[[SparkSession, str], DataFrame]


def _bronze(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: adapter.EXTRACTS[name](TestTables(spark, d))


def _wh(spark, d):
    return warehouse(spark, d, AS_OF)


# ---- silver tables ---------------------------------------------------------

def silver_sales(spark, d):
    return silver.clean_sales(_bronze("crm_sales_details")(spark, d))


def silver_products(spark, d):
    return silver.clean_products(_bronze("crm_prd_info")(spark, d))


def silver_locations(spark, d):
    return silver.clean_locations(_bronze("erp_loc_a101")(spark, d))


def silver_customers(spark, d):
    return silver.clean_customers(_bronze("crm_cust_info")(spark, d))


def silver_erp_customers(spark, d):
    return silver.clean_erp_customers(_bronze("erp_cust_az12")(spark, d), AS_OF)


def silver_categories(spark, d):
    return silver.clean_categories(_bronze("erp_px_cat_g1v2")(spark, d))


# ---- generic cleansing operators, each on its natural input ----------------

def keep_latest_dedup(spark, d):
    b = _bronze("crm_cust_info")(spark, d)
    return keep_latest(b, "cst_id", silver.customer_dedup_order())


def int_date_repair(spark, d):
    b = _bronze("crm_sales_details")(spark, d)
    cols = silver.SALES_DATE_COLUMNS
    dated = b.select("sls_ord_num", "sls_prd_key",
                     *[F.col(c).alias(f"{c}_raw") for c in cols],
                     *[int_to_date(c).alias(c) for c in cols])
    flagged = dated.withColumns(
        {f"{c}_rejected": int_date_rejected(f"{c}_raw", c) for c in cols})
    order = []
    for c in cols:
        order += [f"{c}_raw", c, f"{c}_rejected"]
    return flagged.select("sls_ord_num", "sls_prd_key", *order)


def measure_repair(spark, d):
    b = _bronze("crm_sales_details")(spark, d).select(
        "sls_ord_num", "sls_prd_key", F.col("sls_sales").alias("sls_sales_raw"),
        "sls_quantity", F.col("sls_price").alias("sls_price_raw"), "sls_sales", "sls_price")
    return repair_measures(b, "sls_sales", "sls_quantity", "sls_price")


def scd2_end_dates(spark, d):
    b = _bronze("crm_prd_info")(spark, d)
    return (scd2_end_date(b, "prd_key", "prd_start_dt", "prd_end_dt", ("prd_id",))
            .select("prd_id", "prd_key", F.to_date("prd_start_dt").alias("prd_start_dt"),
                    "prd_end_dt"))


def composite_key_split(spark, d):
    b = _bronze("crm_prd_info")(spark, d)
    return (split_key(b, "prd_key", "cat_id", "_rest")
            .select("prd_id", F.col("prd_key").alias("prd_key_raw"), "cat_id",
                    F.col("_rest").alias("prd_key")))


def code_standardisation(spark, d):
    cust = _bronze("crm_cust_info")(spark, d)
    prd = _bronze("crm_prd_info")(spark, d)
    erp = _bronze("erp_cust_az12")(spark, d)

    def mapped(df, domain, col, mapping):
        return df.select(F.lit(domain).alias("domain"), F.col(col).alias("raw_code"),
                         code_map(col, mapping, silver.UNKNOWN).alias("standard_code"))

    parts = [mapped(cust, "marital_status", "cst_marital_status", silver.MARITAL_CODES),
             mapped(cust, "gender", "cst_gndr", silver.GENDER_CODES),
             mapped(prd, "product_line", "prd_line", silver.PRODUCT_LINE_CODES),
             mapped(erp, "erp_gender", "gen", silver.GENDER_LONG_CODES)]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("domain", "raw_code", "standard_code").agg(F.count(F.lit(1)).alias("n_rows"))


def country_standardisation(spark, d):
    b = _bronze("erp_loc_a101")(spark, d).select(F.col("cntry").alias("cntry_raw"), "cntry")
    s = standardise_or_keep(b, "cntry", silver.COUNTRY_CODES, silver.UNKNOWN)
    return s.groupBy("cntry_raw", "cntry").agg(F.count(F.lit(1)).alias("n_rows"))


def prefix_strip(spark, d):
    b = _bronze("erp_cust_az12")(spark, d)
    return strip_prefix(b.select(F.col("cid").alias("cid_raw")), "cid_raw",
                        silver.ERP_CUSTOMER_PREFIX, out="cid")


def date_range_null(spark, d):
    b = _bronze("erp_cust_az12")(spark, d).select(
        "cid", F.col("bdate").alias("bdate_raw"), "bdate")
    return null_out_of_range(b, "bdate", F.lit(str(AS_OF)).cast("date"),
                             F.lit(silver.EARLIEST_BIRTH_DATE).cast("date"))


def attribute_precedence(spark, d):
    ci = silver_customers(spark, d)
    ca = silver_erp_customers(spark, d).select(F.col("cid").alias("_cid"), "gen")
    j = ci.join(ca, ci_key("cst_key") == ci_key("_cid"), "left")
    return j.select("cst_id", F.col("cst_gndr").alias("crm_gender"),
                    F.col("gen").alias("erp_gender"),
                    prefer_known("cst_gndr", "gen").alias("gender"))


def surrogate_key_dense(spark, d):
    orders = silver_sales(spark, d).select("sls_ord_num").distinct()
    return dense_key(orders, [F.col("sls_ord_num").asc_nulls_first()], "order_key", spark,
                     name="order_keys").select("order_key", "sls_ord_num")


# ---- gold ------------------------------------------------------------------

def dim_products(spark, d):
    return _wh(spark, d).dim_products


def dim_customers(spark, d):
    return _wh(spark, d).dim_customers


def fact_sales(spark, d):
    return _wh(spark, d).fact_sales


# ---- analyses and reports ----------------------------------------------------

def yearly_trend(spark, d):
    return analysis.yearly_trend(_wh(spark, d).fact_sales)


def monthly_trend(spark, d):
    return analysis.monthly_trend(_wh(spark, d).fact_sales)


def distinct_trend(spark, d):
    return analysis.distinct_trend(_wh(spark, d).fact_sales)


def cumulative_as_written(spark, d):
    return analysis.cumulative_as_written(_wh(spark, d).fact_sales)


def cumulative_intended(spark, d):
    return analysis.cumulative_intended(_wh(spark, d).fact_sales)


def cumulative_daily(spark, d):
    return analysis.cumulative_daily(_wh(spark, d).fact_sales)


def product_performance_yoy(spark, d):
    wh = _wh(spark, d)
    return analysis.product_performance_yoy(wh.fact_sales, wh.dim_products)


def part_to_whole(spark, d):
    wh = _wh(spark, d)
    return analysis.part_to_whole(wh.fact_sales, wh.dim_products)


def segment_counts(spark, d):
    wh = _wh(spark, d)
    return analysis.segment_counts(wh.fact_sales, wh.dim_customers, SPEND_THRESHOLD)


def customer_spending(spark, d):
    wh = _wh(spark, d)
    return reports.customer_spending(wh.fact_sales, wh.dim_customers, SPEND_THRESHOLD)


def customers_report(spark, d):
    wh = _wh(spark, d)
    return reports.customers_report(wh.fact_sales, wh.dim_customers, AS_OF, SPEND_THRESHOLD)


def products_report(spark, d):
    wh = _wh(spark, d)
    return reports.products_report(wh.fact_sales, wh.dim_products, AS_OF)


def products_report_by_product(spark, d):
    wh = _wh(spark, d)
    return reports.products_report_by_product(wh.fact_sales, wh.dim_products, AS_OF)


# ---- load control ------------------------------------------------------------

def csv_roundtrip(spark, d):
    """Bronze sales extract written as CSV to shared storage and re-read typed."""
    path = write_extract(_bronze("crm_sales_details")(spark, d),
                         run_dir(spark, "roundtrip") + "/sales_details.csv")
    back = read_extract(spark, path, schemas.BRONZE["crm_sales_details"])
    return back.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def csv_text_forms(spark, d):
    """Orders as text lines with padded numbers and dates in every accepted form, read back typed."""
    o, k = TestTables(spark, d).orders, F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    form = F.when(k % 3 == 0, day).when(k % 3 == 1, F.concat(day, F.lit(" 06:07:08"))) \
        .otherwise(F.concat(F.lit(" "), day, F.lit("T06:07:08.250 ")))
    lines = o.select(F.concat_ws(",", F.concat(F.lit(" "), k.cast("string")), form, form,
                                 F.concat(F.col("o_custkey").cast("string"), F.lit("  "))).alias("line"))
    path = write_lines(lines, "order_id,order_time,order_day,customer_id", run_dir(spark, "text_forms") + "/orders.csv")
    schema = T.StructType.fromDDL("order_id long, order_time timestamp_ntz, order_day date, customer_id long")
    return read_extract(spark, path, schema).select(
        "order_id", F.date_format("order_time", "yyyy-MM-dd HH:mm:ss.SSS").alias("order_time"), "order_day",
        "customer_id", F.col(CORRUPT).isNotNull().alias("rejected"))


def _results_frame(spark, results):
    rows = [(r.table, r.status, r.rows_read if r.status in ("loaded", "rejected") else None,
             r.rows_loaded if r.status == "loaded" else None,
             r.rows_rejected if r.status in ("loaded", "rejected") else None,
             r.status == "loaded") for r in results]
    return spark.createDataFrame(
        rows, "table_name string, status string, rows_read bigint, rows_loaded bigint, "
              "rows_rejected bigint, published boolean")


def quarantine_counts(spark, d):
    """Bronze load of the six extracts, the sales one with malformed lines:
    rows read / loaded / rejected per table; with a threshold of 10 rejects given,
    more block the table (the previous version stays)."""
    base = runners.stage_extracts(spark, d, dirty_sales=True)
    return _results_frame(spark, runners.run_bronze(spark, runners.manifest(base),
                                                     Layers("qc_bronze", "qc_silver", "qc_gold"), max_errors=10))


def load_audit(spark, d):
    """Bronze load with one extract missing: audit log rows (success + error)."""
    layers = Layers("la_bronze", "la_silver", "la_gold")
    base = runners.stage_extracts(spark, d)
    specs = [s if s.table != "erp_loc_a101" else
             runners.LoadSpec(s.table, s.path.replace(".csv", "_absent.csv"), s.schema)
             for s in runners.manifest(base)]
    runners.run_bronze(spark, specs, layers)
    ok = spark.table(f"{layers.bronze}.bronze_load_success_logs").select(
        "table_name", F.lit("loaded").alias("status"), "rows_inserted", "rows_rejected",
        F.lit(None).cast("string").alias("message"))
    err = spark.table(f"{layers.bronze}.bronze_load_error_logs").select(
        "table_name", F.lit("error").alias("status"),
        F.lit(None).cast("long").alias("rows_inserted"),
        F.lit(None).cast("long").alias("rows_rejected"), F.col("error_message").alias("message"))
    return ok.unionByName(err)


def layer_rebuild(spark, d):
    """Namespaces, declared tables, bronze load, silver reload, gold publish:
    row counts of every published table, the reports among them."""
    layers = Layers("lr_bronze", "lr_silver", "lr_gold")
    out = runners.rebuild(spark, d, layers, AS_OF)
    rows = [("bronze", r.table, r.rows_loaded) for r in out["bronze"]]
    rows += [("silver", name.split(".", 1)[1], n) for _, name, n, *_ in out["silver_ok"]]
    for t in ("dim_products", "dim_customers", "fact_sales", *REPORTS):
        rows.append(("gold", t, spark.table(f"{layers.gold}.{t}").count()))
    return spark.createDataFrame(rows, "layer string, table_name string, row_count bigint")


def report_views(spark, d):
    """The three report views, read by name after a reload: a first run without
    the locations and the ERP customers, then one with all extracts.  Rows and
    totals of each report by its segment or tier."""
    layers = Layers("rv_bronze", "rv_silver", "rv_gold")
    base = runners.stage_extracts(spark, d)
    specs = [s if s.table not in ("erp_loc_a101", "erp_cust_az12") else
             runners.LoadSpec(s.table, s.path + "_absent", s.schema) for s in runners.manifest(base)]
    runners.run_all(spark, base, layers, AS_OF, specs=specs, spend_threshold=SPEND_THRESHOLD,
                    afresh=("bronze", "silver"))
    runners.run_all(spark, base, layers, AS_OF, spend_threshold=SPEND_THRESHOLD)
    return spark.sql(f"""
        SELECT 'customer_spending' AS report, customer_segment AS label, count(*) AS n_rows,
               sum(total_spending) AS total, sum(lifespan) AS months FROM {layers.gold}.customer_spending GROUP BY 2
        UNION ALL
        SELECT 'customers_report', concat(customer_segment, ', ', age_group), count(*), sum(total_sales), sum(recency)
        FROM {layers.gold}.customers_report GROUP BY 2
        UNION ALL
        SELECT 'products_report', performance_sales_products, count(*), sum(average_monthly_revenue), sum(recency)
        FROM {layers.gold}.products_report GROUP BY 2""")


def silver_logs(spark, d):
    """The published logs and the audit column after a silver reload in which
    one bronze table is absent: one row for each log row, in reload order."""
    layers = Layers("sl_bronze", "sl_silver", "sl_gold")
    base = runners.stage_extracts(spark, d)
    for t in (*(f"{layers.bronze}.{t}" for t in schemas.BRONZE), *(f"{layers.silver}.{t}" for t in schemas.SILVER),
              f"{layers.silver}.data_load_success_logs", f"{layers.silver}.data_load_error_logs"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    runners.run_bronze(spark, [s for s in runners.manifest(base) if s.table != "erp_cust_az12"], layers)
    runners.run_silver(spark, layers, AS_OF, parallel=False)
    audited = None
    for t in silver.SILVER_ORDER:
        name = f"{layers.silver}.{t}"
        if spark.catalog.tableExists(name):
            one = spark.table(name).agg(F.lit(name).alias("table_nm"), F.count(schemas.AUDIT_COLUMN).alias("audited_rows"))
            audited = one if audited is None else audited.union(one)
    ok = spark.table(f"{layers.silver}.data_load_success_logs").select(
        "table_nm", "procedure_nm", F.lit("loaded").alias("status"), "row_count", "start_time",
        (F.col("end_time") >= F.col("start_time")).alias("in_time"),
        (F.col("duration_sec") == F.expr("timestampdiff(SECOND, start_time, end_time)")).alias("duration_fits"))
    err = spark.table(f"{layers.silver}.data_load_error_logs").select(
        "table_nm", "procedure_nm", F.concat(F.lit("error: "), "error_line").alias("status"),
        F.lit(None).cast("long").alias("row_count"), "start_time",
        (F.col("error_time") >= F.col("start_time")).alias("in_time"), F.length("error_msg") > 0)
    rows = ok.union(err).join(audited, "table_nm", "left")
    place = F.row_number().over(Window.partitionBy("procedure_nm").orderBy("start_time"))  # a row a table
    return rows.select(F.substring_index("table_nm", ".", -1).alias("table_name"), "procedure_nm", place.alias("place"),
                       "status", "row_count", "audited_rows", "in_time", "duration_fits")


# ---- names and keys under a collation ------------------------------------------

def collated_sales(spark, d):
    """Sales by category and product line, both in several spellings, under the
    warehouse's collation: lines, amount, first and last order, spellings."""
    wh = _wh(spark, d)
    k = F.col("product_id")
    dim = wh.dim_products.select("product_key", adapter.respelt(k, F.col("category")).alias("category"),
                                 adapter.respelt(F.col("cost"), F.col("product_line")).alias("product_line"))
    pre = wh.fact_sales.groupBy("product_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sales_amount").alias("amount"),
        F.min("order_date").alias("first"), F.max("order_date").alias("last"))
    return group_names(pre.join(dim, "product_key", "left"), ["category", "product_line"], {
        "n_lines": ("sum", "n"), "total_sales": ("sum", "amount"),
        "first_order_date": ("min", "first"), "last_order_date": ("max", "last")}, "n_spellings")


def collated_keep_latest(spark, d):
    """The newest CRM row of each customer key, keys in several spellings."""
    b = _bronze("crm_cust_info")(spark, d)
    key = adapter.respelt(F.dayofmonth("cst_create_date"), F.col("cst_key"))
    named = collate(b.withColumn("spelling", key).withColumn("cst_key", key), ["cst_key"])
    newest = keep_latest(named, "cst_key", [F.desc("cst_create_date"), F.asc("spelling"), F.asc_nulls_first("cst_id"),
                                            F.asc("cst_marital_status"), F.asc("cst_firstname")])
    return spelled(newest.select("cst_key", "cst_id", "cst_lastname", "cst_marital_status", "cst_create_date"))


def collated_lookup(spark, d):
    """Customers and their locations joined on declared keys in different
    spellings: customers, distinct keys and matches by country, countries
    grouped under the collation too."""
    day = F.dayofmonth("cst_create_date")
    cust = _bronze("crm_cust_info")(spark, d).select(
        adapter.respelt(day, F.col("cst_key")).alias("cst_key"), day.alias("day"))
    loc = silver_locations(spark, d).select(adapter.respelt(F.length("cntry"), F.col("cid")).alias("cid"), "cntry")
    j = collate(cust, ["cst_key"]).join(collate(loc, ["cid"]), F.col("cst_key") == F.col("cid"), "left")
    j = j.withColumn("cntry", adapter.respelt(F.col("day"), F.col("cntry")))
    per_key = group_names(j, ["cst_key", "cntry"], {"rows": ("count", "*"), "hits": ("count", "cid")})
    return group_names(per_key, ["cntry"], {"n_keys": ("count", "*"), "n_rows": ("sum", "rows"), "n_matched": ("sum", "hits")})


QUERIES: dict[str, Query] = {f.__name__: f for f in [
    silver_sales, silver_products, silver_locations, silver_customers, silver_erp_customers,
    silver_categories, keep_latest_dedup, int_date_repair, measure_repair, scd2_end_dates,
    composite_key_split, code_standardisation, country_standardisation, prefix_strip,
    date_range_null, attribute_precedence, surrogate_key_dense, dim_products, dim_customers,
    fact_sales, yearly_trend, monthly_trend, cumulative_as_written, cumulative_intended,
    product_performance_yoy, part_to_whole, segment_counts, customer_spending,
    customers_report, products_report, products_report_by_product,
    csv_roundtrip, csv_text_forms, quarantine_counts, load_audit, layer_rebuild,
    cumulative_daily, report_views, silver_logs, collated_sales, collated_keep_latest, collated_lookup,
    distinct_trend,
]}
