"""Load control: quarantine, threshold, missing file, failure isolation,
log semantics (bronze logs cleared per run, silver logs appended)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.plans import registry, runners
from layercake.session import run_dir
from layercake.sources.catalog import Layers
from layercake.sources.csv_ingest import CORRUPT, LoadSpec, ingest, read_extract

SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()),
                       T.StructField("c", T.IntegerType())])


def _write(path, text):
    import os
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-0.csv", "w") as f:
        f.write(text)


@pytest.fixture()
def csv_dir(spark):
    d = run_dir(spark, "test_csv").removeprefix("file:")
    _write(d, 'a,b,c\n1,x,3\n2,"q"uoted,4\n3,,5\nx,y,6\n7,z\n8,q,9,10\n')
    return d


def test_quarantine_split(spark, csv_dir):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS t_bronze")
    res = ingest(spark, LoadSpec("t", csv_dir, SCHEMA), "t_bronze.t", max_errors=10)
    assert res.status == "loaded"
    assert (res.rows_read, res.rows_loaded, res.rows_rejected) == (6, 3, 3)
    good = sorted(tuple(r) for r in spark.table("t_bronze.t").collect())
    assert good == [(1, "x", 3), (2, '"q"uoted', 4), (3, None, 5)]
    assert spark.table("t_bronze.t_quarantine").count() == 3


def test_validity_does_not_depend_on_what_is_read(spark, csv_dir):
    rows = read_extract(spark, csv_dir, SCHEMA)
    bad = rows.filter(F.col(CORRUPT).isNotNull())
    assert rows.count() == 6 and bad.count() == 3
    assert bad.select("b").count() == len(bad.select("b").collect()) == 3
    assert sorted(r[0] for r in bad.select(CORRUPT).collect()) == ["7,z", "8,q,9,10", "x,y,6"]


def test_accepted_text_forms(spark):
    d = run_dir(spark, "test_forms").removeprefix("file:")
    _write(d, "a,t,d\n 3,2011-07-01,2011-07-01\n4 ,2011-07-01 10:11:12.500,2011-07-01 00:00:00.000\n"
              "5,2011-07-01T10:11:12,\n6,2011-02-30,2011-07-01\n7,2011,2011-07-01\n8,2011-07-01x,\n,,\n  ,,\n1.5,,\n")
    schema = T.StructType.fromDDL("a int, t timestamp_ntz, d date")
    rows = read_extract(spark, d, schema)
    day, noon = dt.date(2011, 7, 1), dt.datetime(2011, 7, 1, 10, 11, 12)
    good = rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT).collect()
    assert sorted(map(tuple, good), key=str) == sorted([
        (3, dt.datetime(2011, 7, 1), day), (4, noon.replace(microsecond=500000), day), (5, noon, None),
        (None, None, None)], key=str)
    assert sorted(r[CORRUPT] for r in rows.filter(F.col(CORRUPT).isNotNull()).collect()) == sorted(
        ["6,2011-02-30,2011-07-01", "7,2011,2011-07-01", "8,2011-07-01x,", "  ,,", "1.5,,"])


def test_first_run_with_a_failing_silver_table(spark, small_dir, monkeypatch):
    layers = Layers("v_bronze", "v_silver", "v_gold")
    clean = runners._cleaner

    def cleaner(table, as_of):
        if table == "erp_loc_a101":
            raise ValueError("no such rule")
        return clean(table, as_of)

    monkeypatch.setattr(runners, "_cleaner", cleaner)
    out = runners.rebuild(spark, small_dir, layers, "2026-01-01")
    assert [(r[1], r[2]) for r in out["silver_err"]] == [("v_silver.erp_loc_a101", "no such rule")]
    assert spark.table("v_silver.erp_loc_a101").count() == 0
    other = spark.newSession()
    for report, df in out["views"].items():
        assert other.table(f"v_gold.{report}").count() == df.count() > 0


def test_report_views_first_run_lacks_two_extracts_only(spark, small_dir, monkeypatch):
    run_all, runs = runners.run_all, []

    def run(*args, **options):
        out = run_all(*args, **options)
        facts = spark.table("rv_gold.fact_sales")
        runs.append(({name.split(".")[1]: n for _, name, n, *_ in out["silver_ok"]}, facts.count(),
                     facts.where("customer_key is not null and product_key is not null").count()))
        return out

    monkeypatch.setattr(runners, "run_all", run)
    registry.report_views(spark, small_dir)
    (first, facts, keyed), (loaded, *then) = runs
    assert len(loaded) == 6 and all(loaded.values())
    assert first == loaded | {"erp_loc_a101": 0, "erp_cust_az12": 0}
    assert [facts, keyed] == then and keyed > 0


def test_threshold_keeps_previous_version(spark, csv_dir):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS t_bronze")
    ingest(spark, LoadSpec("t2", csv_dir, SCHEMA), "t_bronze.t2", max_errors=10)
    before = spark.table("t_bronze.t2").count()
    res = ingest(spark, LoadSpec("t2", csv_dir, SCHEMA), "t_bronze.t2", max_errors=2)
    assert res.status == "rejected" and res.rows_rejected == 3
    assert spark.table("t_bronze.t2").count() == before


def test_missing_file_keeps_table(spark, csv_dir):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS t_bronze")
    ingest(spark, LoadSpec("t3", csv_dir, SCHEMA), "t_bronze.t3")
    res = ingest(spark, LoadSpec("t3", csv_dir + "_nope", SCHEMA), "t_bronze.t3")
    assert (res.status, res.message) == ("missing", "File not found")
    assert spark.table("t_bronze.t3").count() == 3


def test_runners_isolation_and_log_semantics(spark, small_dir):
    layers = Layers("u_bronze", "u_silver", "u_gold")
    base = runners.stage_extracts(spark, small_dir)
    specs = runners.manifest(base)
    specs = [s if s.table != "erp_loc_a101" else LoadSpec(s.table, s.path + "_x", s.schema)
             for s in specs]
    res = runners.run_bronze(spark, specs, layers)
    assert sum(r.status == "loaded" for r in res) == 5
    err = spark.table("u_bronze.bronze_load_error_logs").collect()
    assert [(r.table_name, r.error_message) for r in err] == [("erp_loc_a101", "File not found")]
    # second run clears bronze logs
    runners.run_bronze(spark, runners.manifest(base), layers)
    assert spark.table("u_bronze.bronze_load_error_logs").count() == 0
    assert spark.table("u_bronze.bronze_load_success_logs").count() == 6
    # a clean extract has an empty (folder-less) quarantine table
    assert spark.table("u_bronze.erp_px_cat_g1v2_quarantine").count() == 0
    assert "_corrupt_record" in spark.table("u_bronze.erp_px_cat_g1v2_quarantine").columns
    # silver: appended logs, each table its own job
    run1 = runners.run_silver(spark, layers, "2026-01-01")
    ok1, err1 = run1
    assert run1.total_seconds >= max(r[5] for r in ok1)
    ok2, _ = runners.run_silver(spark, layers, "2026-01-01")
    assert len(ok1) == 6 and not err1
    assert spark.table("u_silver.data_load_success_logs").count() == 12
    assert [t for _, t, *_ in ok1] == [f"u_silver.{t}" for t in runners.silver.SILVER_ORDER]
    # a broken bronze table fails alone
    spark.sql("DROP TABLE u_bronze.erp_px_cat_g1v2")
    ok3, err3 = runners.run_silver(spark, layers, "2026-01-01")
    assert len(ok3) == 5 and [e[1] for e in err3] == ["u_silver.erp_px_cat_g1v2"]
    assert spark.table("u_silver.data_load_error_logs").count() == 1


def test_failed_publish_keeps_previous_version(spark):
    from pyspark.sql import functions as F
    from layercake.sources.catalog import publish
    spark.sql("CREATE NAMESPACE IF NOT EXISTS t_silver")
    publish(spark, spark.range(5).withColumn("v", F.col("id") * 2), "t_silver.p")
    boom = spark.range(5).withColumn("v", F.when(F.col("id") == 3, F.raise_error(F.lit("boom")))
                                     .otherwise(F.col("id")))
    with pytest.raises(Exception):
        publish(spark, boom, "t_silver.p")          # lazy error surfaces at the write
    assert sorted(r.v for r in spark.table("t_silver.p").collect()) == [0, 2, 4, 6, 8]


def test_run_all_on_extract_folder(spark, small_dir):
    from layercake.plans.warehouse import warehouse
    layers = Layers("ra_bronze", "ra_silver", "ra_gold")
    base = runners.stage_extracts(spark, small_dir)
    out = runners.run_all(spark, base, layers, "2026-01-01")
    assert all(r.status == "loaded" for r in out["bronze"]) and not out["silver_err"]
    wh = warehouse(spark, small_dir)
    assert spark.table("ra_gold.fact_sales").count() == wh.fact_sales.count()
    assert spark.table("ra_gold.dim_products").count() == wh.dim_products.count()
    n = spark.sql("SELECT count(*) FROM ra_gold_customers_report").collect()[0][0]
    assert n == wh.fact_sales.select("customer_key").distinct().count()


def test_vacuum_keeps_current_and_newest(spark):
    import time
    from layercake.sources.catalog import publish, vacuum_versions
    spark.sql("CREATE NAMESPACE IF NOT EXISTS t_vac")
    for i in range(4):
        publish(spark, spark.range(i + 1), "t_vac.v")
        time.sleep(0.05)
    deleted = vacuum_versions(spark, "t_vac.v", keep=2)
    assert len(deleted) == 2
    assert spark.table("t_vac.v").count() == 4          # current version intact


def test_vacuum_loaded_table(spark, csv_dir):
    from layercake.sources.catalog import vacuum_versions
    spark.sql("CREATE NAMESPACE IF NOT EXISTS t_bronze")
    for _ in range(2):
        ingest(spark, LoadSpec("tv", csv_dir, SCHEMA), "t_bronze.tv")
    assert len(vacuum_versions(spark, "t_bronze.tv", keep=1)) == 1
    assert spark.table("t_bronze.tv").count() == 3
    assert spark.table("t_bronze.tv_quarantine").count() == 3


def test_vacuum_on_never_written_table(spark):
    from layercake.sources import schemas
    from layercake.sources.catalog import recreate_table, vacuum_versions
    spark.sql("CREATE NAMESPACE IF NOT EXISTS t_vac")
    recreate_table(spark, "t_vac.empty", schemas.BRONZE["erp_loc_a101"])
    assert vacuum_versions(spark, "t_vac.empty") == []


def test_lines_are_whole_whatever_they_hold(spark):
    d = run_dir(spark, "test_lines").removeprefix("file:")
    odd = "x\u0001\u0002\u0001y"
    _write(d, f"a,b,c\n1,{odd},3\n\n2,\u0000z\t,4\na,b,c\n5,\u0085 ,6\n7,{odd}\n")
    with open(f"{d}/part-1.csv", "w") as f:
        f.write("a,b,c\n8,last,9")
    open(f"{d}/part-2.csv", "w").close()           # an empty file has no header either
    rows = read_extract(spark, d, SCHEMA)
    good = sorted(tuple(r) for r in rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT).collect())
    assert good == [(1, odd, 3), (2, "\u0000z\t", 4), (5, "\u0085 ", 6), (8, "last", 9)]
    bad = sorted(r[0] for r in rows.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT).collect())
    assert bad == sorted(["", "a,b,c", f"7,{odd}"])  # a blank line, a line equal to the header, a short one


def test_headers_of_split_files(spark):
    """Only a file's first line goes, not the first of its further splits."""
    d = run_dir(spark, "test_splits").removeprefix("file:")
    _write(d, "a,b,c\n" + "".join(f"{i},{'w' * 50},1\n" for i in range(4000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = read_extract(spark, d, SCHEMA)
        assert rows.rdd.getNumPartitions() > 4
        assert rows.filter(F.col(CORRUPT).isNull()).agg(F.count("*"), F.sum("a")).first()[:] == (4000, 4000 * 3999 // 2)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
