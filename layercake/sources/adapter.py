"""Bronze-shaped, deterministically dirty extracts derived from the test tables.

The warehouse expects six CRM/ERP extracts that are not shipped.  These
functions derive tables of exactly that shape from the TPC-H-like test tables
with pure column expressions (no randomness), so every cleansing rule meets
the dirt it is written for: blank and padded codes, duplicate customers with
NULL ids, product versions, impossible dates, inconsistent measures, and
facts whose product or customer has no dimension row.

Each rule is a function of a key modulo a small prime; the same expressions
are written into the SQL oracle (``sql_oracle.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layercake.sources.testdata import TestTables


def _case(key: Column, branches: dict[int, object], default) -> Column:
    out = None
    for k, v in branches.items():
        lit = F.lit(v)
        out = F.when(key == k, lit) if out is None else out.when(key == k, lit)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def _aw_key(k: Column, sep: str = "") -> Column:
    """'AW' + key left-padded with zeros to 8 digits (never truncated)."""
    return F.format_string(f"AW{sep}%08d", k)


def _yyyymmdd(ts: Column) -> Column:
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def _days_after(day: str, n: Column) -> Column:
    return F.date_add(F.lit(day).cast("date"), n.cast("int"))


def crm_cust_info(t: TestTables) -> DataFrame:
    c = t.customer
    k = F.col("c_custkey")
    main = c.select(
        # some customers carry an id that no sale uses
        F.when(k % 97 == 5, -k).otherwise(k).cast("int").alias("cst_id"),
        _aw_key(k).alias("cst_key"),
        F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")).alias("cst_firstname"),
        F.when(k % 50 == 3, F.lit(None)).otherwise(F.concat("c_name", F.lit("  ")))
        .alias("cst_lastname"),
        _case(k % 5, {0: "S", 1: "m ", 2: " s", 3: "X"}, F.lit(None).cast("string"))
        .alias("cst_marital_status"),
        _case(k % 4, {0: "F", 1: " m", 2: "n/a"}, F.lit(None).cast("string"))
        .alias("cst_gndr"),
        _days_after("2025-01-01", k % 365).alias("cst_create_date"),
    )
    dups = c.filter(k % 10 == 0).select(
        F.when(k % 20 == 0, F.lit(None)).otherwise(k.cast("int")).alias("cst_id"),
        _aw_key(k).alias("cst_key"),
        F.col("c_mktsegment").alias("cst_firstname"),
        F.col("c_name").alias("cst_lastname"),
        F.lit("M").alias("cst_marital_status"),
        F.lit("F").alias("cst_gndr"),
        _days_after("2024-12-01", k % 60).alias("cst_create_date"),
    )
    return main.unionByName(dups)


def _prd_key(p: Column) -> Column:
    a = F.when(p % 40 == 9, F.lit("ZZ")).otherwise(F.substring("p_type", 1, 2))
    b = F.substring("p_type", 3, 2)
    return F.concat(a, F.lit("-"), b, F.lit("-P"), p.cast("string"))


def crm_prd_info(t: TestTables) -> DataFrame:
    part = t.part
    p = F.col("p_partkey")
    no_ts = F.lit(None).cast("timestamp_ntz")
    main = part.select(
        p.cast("int").alias("prd_id"),
        _prd_key(p).alias("prd_key"),
        F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("prd_nm"),
        F.when(p % 11 == 0, F.lit(None)).otherwise(F.floor("p_retailprice").cast("int"))
        .alias("prd_cost"),
        _case(p % 6, {0: "M", 1: "r ", 2: "S", 3: " t", 4: "q"}, F.lit(None).cast("string"))
        .alias("prd_line"),
        _days_after("1994-01-01", p % 700).cast("timestamp_ntz").alias("prd_start_dt"),
        no_ts.alias("prd_end_dt"),
    )
    versions = part.filter(p % 3 == 0).select(
        (p + 1000000).cast("int").alias("prd_id"),
        _prd_key(p).alias("prd_key"),
        F.col("p_name").alias("prd_nm"),
        (F.floor("p_retailprice") + 1).cast("int").alias("prd_cost"),
        F.lit("M").alias("prd_line"),
        _days_after("1997-01-01", p % 300).cast("timestamp_ntz").alias("prd_start_dt"),
        no_ts.alias("prd_end_dt"),
    )
    return main.unionByName(versions)


def crm_sales_details(t: TestTables) -> DataFrame:
    li = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    qty = F.col("l_quantity").cast("int")
    u = F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("int")
    ship = _yyyymmdd(F.col("l_shipdate"))
    return j.select(
        F.concat(F.lit("SO"), ok.cast("string")).alias("sls_ord_num"),
        F.when(pk % 71 == 0, F.lit("NOPART")).otherwise(F.concat(F.lit("P"), pk.cast("string")))
        .alias("sls_prd_key"),
        F.col("o_custkey").cast("int").alias("sls_cust_id"),
        F.when(ok % 53 == 0, F.lit(0)).when(ok % 53 == 1, F.lit(32154))
        .when(ok % 53 == 2, F.lit(20131332)).when(ok % 53 == 3, F.lit(None))
        .otherwise(_yyyymmdd(F.col("o_orderdate"))).cast("int").alias("sls_order_dt"),
        ship.alias("sls_ship_dt"),
        ship.alias("sls_due_dt"),
        F.when(pk % 13 == 0, F.lit(None)).when(pk % 13 == 1, F.lit(-5))
        .when(pk % 13 == 2, F.lit(7)).otherwise(qty * u).cast("int").alias("sls_sales"),
        qty.alias("sls_quantity"),
        F.when(sk % 17 == 0, F.lit(None)).when(sk % 17 == 1, -u)
        .when(sk % 17 == 2, F.lit(0)).otherwise(u).cast("int").alias("sls_price"),
    )


def erp_cust_az12(t: TestTables) -> DataFrame:
    c = t.customer
    k = F.col("c_custkey")
    # some customers carry an ERP id that no CRM row uses
    cid = F.when(k % 19 == 4, F.format_string("EX%08d", k)).otherwise(_aw_key(k))
    return c.select(
        F.when(k % 2 == 0, F.concat(F.lit("NAS"), cid)).otherwise(cid).alias("cid"),
        F.when(k % 31 == 0, F.lit("2050-01-01").cast("date"))
        .when(k % 31 == 1, F.lit("1900-05-05").cast("date"))
        .when(k % 31 == 2, F.lit(None).cast("date"))
        .otherwise(_days_after("1940-01-01", (k * 37) % 25000)).alias("bdate"),
        _case(k % 7, {0: "F", 1: "female ", 2: "M", 3: " Male", 4: "", 5: "x"},
              F.lit(None).cast("string")).alias("gen"),
    )


def erp_loc_a101(t: TestTables) -> DataFrame:
    c = t.customer.select("c_custkey", "c_nationkey")
    # no hint: the optimizer broadcasts nation after checking its size
    n = t.nation.select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "inner")
    nk = F.col("c_nationkey")
    return j.select(
        _aw_key(F.col("c_custkey"), "-").alias("cid"),
        F.when(nk % 6 == 0, F.lit("DE")).when(nk % 6 == 1, F.lit(" us"))
        .when(nk % 6 == 2, F.lit("USA")).when(nk % 6 == 3, F.lit("  "))
        .when(nk % 6 == 4, F.lit(None))
        .otherwise(F.concat("n_name", F.lit(" "))).alias("cntry"),
    )


def erp_px_cat_g1v2(t: TestTables) -> DataFrame:
    ty = F.col("p_type")
    return t.part.select(
        F.concat(F.substring(ty, 1, 2), F.lit("_"), F.substring(ty, 3, 2)).alias("id"),
        ty.alias("cat"),
        F.concat(ty, F.lit(" sub")).alias("subcat"),
        F.lit("Yes").alias("maintenance"),
    ).distinct()


def respelt(key: Column, text: Column) -> Column:
    """``text`` in capitals, in small letters with trailing spaces, or as it is, by ``key``."""
    return F.when(key % 3 == 0, F.upper(text)).when(key % 3 == 1, F.concat(F.lower(text), F.lit("  "))).otherwise(text)


EXTRACTS = {
    "crm_cust_info": crm_cust_info,
    "crm_prd_info": crm_prd_info,
    "crm_sales_details": crm_sales_details,
    "erp_cust_az12": erp_cust_az12,
    "erp_loc_a101": erp_loc_a101,
    "erp_px_cat_g1v2": erp_px_cat_g1v2,
}


def bronze_frames(t: TestTables) -> dict[str, DataFrame]:
    """All six bronze-shaped extracts as lazy DataFrames."""
    return {name: fn(t) for name, fn in EXTRACTS.items()}
