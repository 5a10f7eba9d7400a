"""Layer runners: stage extracts, bronze load, silver reload, gold publish.

Each table is one Spark job; a failing table is logged and the next one
runs (failure isolation).  Logs are small driver-side row lists: one row per
table, never per data row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.plans import gold, reports, silver, views as report_sql
from layercake.session import run_concurrently, run_dir
from layercake.sources import adapter, schemas
from layercake.sources.catalog import Direct, Layers, create_namespaces
from layercake.sources.commits import Run, default_store
from layercake.sources.csv_ingest import (
    DEFAULT_MAX_ERRORS, LoadResult, LoadSpec, ingest, write_extract, write_lines)
from layercake.sources.testdata import TestTables

# Source file of each bronze table (relative to the extract folder).
SOURCE_FILES = {
    "crm_cust_info": "source_crm/cust_info.csv",
    "crm_prd_info": "source_crm/prd_info.csv",
    "crm_sales_details": "source_crm/sales_details.csv",
    "erp_cust_az12": "source_erp/cust_az12.csv",
    "erp_loc_a101": "source_erp/loc_a101.csv",
    "erp_px_cat_g1v2": "source_erp/px_cat_g1v2.csv",
}

# Textual dirt for the quarantine check, keyed on the order number.
BAD_QTY_MOD, BAD_QTY_REM = 101, 7        # quantity written as 'n/a'
SHORT_MOD, SHORT_REM = 103, 11           # last field missing
LONG_MOD, LONG_REM = 107, 13             # one field too many


def manifest(base: str) -> list[LoadSpec]:
    return [LoadSpec(t, f"{base}/{f}", schemas.BRONZE[t]) for t, f in SOURCE_FILES.items()]


def dirty_sales_lines(sales: DataFrame) -> DataFrame:
    """Sales extract as raw text lines, some deliberately malformed."""
    cols = schemas.BRONZE["crm_sales_details"].fieldNames()
    k = F.substring("sls_ord_num", 3, 30).cast("long")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    qi = cols.index("sls_quantity")
    fields[qi] = F.when(k % BAD_QTY_MOD == BAD_QTY_REM, F.lit("n/a")).otherwise(fields[qi])
    full = F.concat_ws(",", *fields)
    line = (F.when(k % SHORT_MOD == SHORT_REM, F.concat_ws(",", *fields[:-1]))
             .when(k % LONG_MOD == LONG_REM, F.concat(full, F.lit(",extra")))
             .otherwise(full))
    return sales.select(line.alias("line"))


def stage_extracts(spark: SparkSession, sf_dir: str, dirty_sales: bool = False,
                   parallel: bool = True) -> str:
    """Write the six bronze-shaped extracts derived from the test tables as
    CSV files below a fresh shared folder; returns that folder."""
    base = run_dir(spark, "extracts")
    frames = adapter.bronze_frames(TestTables(spark, sf_dir))

    def write(item):
        table, rel = item
        df = frames[table]
        if dirty_sales and table == "crm_sales_details":
            cols = schemas.BRONZE[table].fieldNames()
            write_lines(dirty_sales_lines(df), ",".join(cols), f"{base}/{rel}")
        else:
            write_extract(df, f"{base}/{rel}")

    run_concurrently(write, SOURCE_FILES.items(), parallel)
    return base


def run_bronze(spark: SparkSession, specs: list[LoadSpec], layers: Layers = Layers(),
               max_errors: int | None = DEFAULT_MAX_ERRORS,
               parallel: bool = True, into=None) -> list[LoadResult]:
    """Load every spec (isolated from each other); logs are cleared each run
    and list the tables in manifest order.  Tables are published one by one,
    or ``into`` a run, which commits them together."""
    create_namespaces(spark, layers)
    into = into or Direct(spark)
    results = run_concurrently(
        lambda s: ingest(spark, s, f"{layers.bronze}.{s.table}", max_errors, into), specs, parallel)
    now = dt.datetime.now()
    ok = [(r.table, r.path, r.rows_loaded, r.rows_rejected, now)
          for r in results if r.status == "loaded"]
    err = [(r.table, r.path, r.message, now) for r in results if r.status != "loaded"]
    into.overwrite_small(ok, schemas.BRONZE_SUCCESS_LOG, f"{layers.bronze}.bronze_load_success_logs")
    into.overwrite_small(err, schemas.BRONZE_ERROR_LOG, f"{layers.bronze}.bronze_load_error_logs")
    return results


def _cleaner(table: str, as_of):
    return {
        "crm_sales_details": silver.clean_sales,
        "crm_prd_info": silver.clean_products,
        "erp_loc_a101": silver.clean_locations,
        "crm_cust_info": silver.clean_customers,
        "erp_cust_az12": lambda df: silver.clean_erp_customers(df, as_of),
        "erp_px_cat_g1v2": silver.clean_categories,
    }[table]


class SilverRun(tuple):
    """``(success_rows, error_rows)`` plus ``total_seconds`` of the reload."""

    def __new__(cls, ok: list[tuple], err: list[tuple], total_seconds: float):
        run = super().__new__(cls, (ok, err))
        run.total_seconds = total_seconds
        return run


def run_silver(spark: SparkSession, layers: Layers = Layers(), as_of=None,
               procedure: str = "reload_silver_tables",
               parallel: bool = True, into=None) -> SilverRun:
    """Reload the six silver tables (each isolated); logs are appended in the
    fixed reload order.  The result also carries the total duration.  Tables
    are published one by one, or ``into`` a run."""
    as_of = as_of or dt.date.today()
    into = into or Direct(spark)
    proc_start = dt.datetime.now()

    def reload(table):
        start = dt.datetime.now()
        name = f"{layers.silver}.{table}"
        try:
            src = into.table(f"{layers.bronze}.{table}")
            df = _cleaner(table, as_of)(src).withColumn(schemas.AUDIT_COLUMN,
                                                        F.current_timestamp())
            obs = Observation(f"silver_{table}_{start.timestamp()}")
            into.publish(df.observe(obs, F.count(F.lit(1)).alias("n")), name)
            end = dt.datetime.now()
            return "ok", (procedure, name, int(obs.get["n"]), start, end,
                          int((end - start).total_seconds()), end)
        except Exception as e:  # noqa: BLE001 - failure isolation
            cond = getattr(e, "getCondition", lambda: None)() or type(e).__name__
            return "err", (procedure, name, str(e), cond, start, dt.datetime.now())

    outcomes = run_concurrently(reload, silver.SILVER_ORDER, parallel)
    ok = [row for kind, row in outcomes if kind == "ok"]
    err = [row for kind, row in outcomes if kind == "err"]
    into.append(ok, schemas.SILVER_SUCCESS_LOG, f"{layers.silver}.data_load_success_logs")
    # also without an error: the log is there to be queried
    into.append(err, schemas.SILVER_ERROR_LOG, f"{layers.silver}.data_load_error_logs")
    return SilverRun(ok, err, (dt.datetime.now() - proc_start).total_seconds())


def run_star(spark: SparkSession, layers: Layers, into) -> None:
    """Publish the star schema from the silver tables that ``into`` sees."""
    s = {t: into.table(f"{layers.silver}.{t}") for t in silver.SILVER_ORDER}
    dims = {
        "dim_products": lambda: gold.dim_products(s["crm_prd_info"], s["erp_px_cat_g1v2"],
                                                  spark),
        "dim_customers": lambda: gold.dim_customers(s["crm_cust_info"], s["erp_cust_az12"],
                                                    s["erp_loc_a101"], spark),
    }
    run_concurrently(lambda kv: into.publish(kv[1](), f"{layers.gold}.{kv[0]}"), dims.items(), True)
    dp = into.table(f"{layers.gold}.dim_products")
    dc = into.table(f"{layers.gold}.dim_customers")
    into.publish(gold.fact_sales(s["crm_sales_details"], dp, dc), f"{layers.gold}.fact_sales")


def run_gold(spark: SparkSession, layers: Layers = Layers(), as_of=None) -> dict[str, DataFrame]:
    """Publish the star schema and the three reports as tables; the reports
    also as temporary views over the current star schema."""
    as_of = as_of or dt.date.today()
    into = Direct(spark)
    run_star(spark, layers, into)
    fact, dp, dc = (spark.table(f"{layers.gold}.{t}") for t in ("fact_sales", "dim_products", "dim_customers"))
    views = {
        "customer_spending": reports.customer_spending(fact, dc),
        "customers_report": reports.customers_report(fact, dc, as_of),
        "products_report": reports.products_report(fact, dp, as_of),
    }
    # stored in the gold namespace, so that other sessions see them too
    run_concurrently(lambda kv: into.publish(kv[1], f"{layers.gold}.{kv[0]}"), views.items(), True)
    for v, df in views.items():
        df.createOrReplaceTempView(f"{layers.gold}_{v}")
    return views


def declare(run: Run, layers: Layers, only: tuple[str, ...] = ("bronze", "silver"), again: bool = False) -> None:
    """Have every declared table of the layers (empty, if it is new or ``again``)."""
    declared = {"bronze": {f"{layers.bronze}.{t}": st for t, st in schemas.BRONZE.items()},
                "silver": {f"{layers.silver}.{t}": T.StructType(
                    [*st.fields, T.StructField(schemas.AUDIT_COLUMN, T.TimestampType())])
                    for t, st in schemas.SILVER.items()}}
    for layer in only:
        for name, schema in declared[layer].items():
            run.declare(name, schema, again)


def recreate(spark: SparkSession, layers: Layers = Layers(), only: tuple[str, ...] = ("bronze", "silver"),
             store: str | None = None) -> int:
    """Recreate the declared tables of some layers, empty, in one commit; any number of times."""
    create_namespaces(spark, layers)
    run = Run(spark, store or default_store(spark, layers))
    declare(run, layers, only, again=True)
    return run.commit()


def run_all(spark: SparkSession, extract_dir: str, layers: Layers = Layers(), as_of=None,
            max_errors: int | None = DEFAULT_MAX_ERRORS, specs: list[LoadSpec] | None = None,
            store: str | None = None, spend_threshold=report_sql.VIP_MIN_SPEND_EXCLUSIVE,
            afresh: tuple[str, ...] = ()) -> dict:
    """The whole warehouse from a folder of CSV extracts laid out as in
    ``SOURCE_FILES``, as one commit: namespaces, declared tables (those of the
    layers in ``afresh`` emptied first), bronze load, silver reload, star
    schema and report views.

    A bronze or silver table that fails is logged and keeps its version; any
    other failure leaves all tables, logs and views as they were.  The reports
    are catalog views over the star schema (``as_of`` None: the day of reading).
    """
    create_namespaces(spark, layers)
    run = Run(spark, store or default_store(spark, layers))
    declare(run, layers)
    declare(run, layers, afresh, again=True)
    bronze = run_bronze(spark, specs or manifest(extract_dir), layers, max_errors, into=run)
    loaded = run_silver(spark, layers, as_of, into=run)
    run_star(spark, layers, run)
    for v, sql in report_sql.report_views(layers, as_of, spend_threshold).items():
        run.view(f"{layers.gold}.{v}", sql)
    version = run.commit()
    views = {v: spark.table(f"{layers.gold}.{v}") for v in report_sql.report_views(layers)}
    for v, df in views.items():
        df.createOrReplaceTempView(f"{layers.gold}_{v}")
    ok, err = loaded
    return {"bronze": bronze, "silver_ok": ok, "silver_err": err,
            "silver_total_seconds": loaded.total_seconds, "views": views, "version": version}


def rebuild(spark: SparkSession, sf_dir: str, layers: Layers = Layers(), as_of=None,
            missing: tuple[str, ...] = ()) -> dict:
    """Rebuild from scratch on extracts staged from the test tables:
    declared bronze tables recreated, then the layers, in one commit."""
    base = stage_extracts(spark, sf_dir)
    specs = [LoadSpec(s.table, s.path + "_missing", s.schema) if s.table in missing else s
             for s in manifest(base)]
    return run_all(spark, base, layers, as_of, specs=specs, afresh=("bronze",))
