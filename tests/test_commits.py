"""One commit for a run: readers see the tables of one run, whatever happens in between."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.plans import gold, runners
from layercake.session import run_dir
from layercake.sources import schemas
from layercake.sources.catalog import Layers, create_namespaces
from layercake.sources.commits import ConcurrentCommit, Run, commits, vacuum

LAYERS = Layers("oc_bronze", "oc_silver", "oc_gold")


@pytest.fixture(scope="module")
def base(spark, small_dir):
    return runners.stage_extracts(spark, small_dir)


def _counts(session, layers):
    names = [f"{layers.bronze}.{t}" for t in schemas.BRONZE] + [f"{layers.silver}.{t}" for t in schemas.SILVER]
    names += [f"{layers.gold}.{t}" for t in ("dim_products", "dim_customers", "fact_sales", "customer_spending",
                                             "customers_report", "products_report")]
    names += [f"{layers.bronze}.bronze_load_success_logs", f"{layers.silver}.data_load_success_logs"]
    return {n: session.table(n).count() for n in names}


def test_a_run_is_seen_whole_or_not_at_all(spark, base, monkeypatch):
    before_schemas = {t: len(st.fields) for t, st in schemas.SILVER.items()}
    specs = [s for s in runners.manifest(base) if s.table != "erp_loc_a101"]
    first = runners.run_all(spark, base, LAYERS, "2026-01-01", specs=specs)
    other = spark.newSession()
    before = _counts(other, LAYERS)
    assert before["oc_silver.erp_loc_a101"] == 0 < before["oc_gold.fact_sales"]

    def broken(*_):
        raise ValueError("no room left")

    with monkeypatch.context() as m:
        m.setattr(gold, "fact_sales", broken)  # the last table, after new bronze, silver and dimensions
        with pytest.raises(ValueError):
            runners.run_all(spark, base, LAYERS, "2026-01-01")
    assert _counts(other, LAYERS) == before == _counts(spark, LAYERS)

    report = other.table("oc_gold.customers_report")  # defined before, read after the next run
    second = runners.run_all(spark, base, LAYERS, "2026-01-01")
    after = _counts(other, LAYERS)
    assert second["version"] > first["version"] + 1  # the failed run's number is not used again
    assert after["oc_silver.erp_loc_a101"] == after["oc_bronze.erp_loc_a101"] > 0
    assert after["oc_silver.data_load_success_logs"] == 12  # appended
    assert other.table("oc_gold.dim_customers").where("country is not null").count() > 0
    assert report.count() == other.table("oc_gold.customers_report").count()
    assert {t: len(st.fields) for t, st in schemas.SILVER.items()} == before_schemas
    assert all(c.count("dwh_create_date") == 1 for c in (spark.table(f"oc_silver.{t}").columns for t in schemas.SILVER))


def test_reports_follow_the_star_schema(spark, base):
    layers = Layers("rf_bronze", "rf_silver", "rf_gold")
    runners.run_all(spark, base, layers, "2026-01-01")
    other = spark.newSession()
    total = other.table("rf_gold.customer_spending").agg(F.sum("total_spending")).first()[0]
    run = Run(spark, runners.default_store(spark, layers))
    fact = run.table("rf_gold.fact_sales")
    run.publish(fact.withColumn("sales_amount", (F.col("sales_amount") * 2).cast("int")), "rf_gold.fact_sales")
    assert other.table("rf_gold.customer_spending").agg(F.sum("total_spending")).first()[0] == total
    run.commit()
    assert other.table("rf_gold.customer_spending").agg(F.sum("total_spending")).first()[0] == 2 * total
    assert spark.catalog.getTable("rf_gold.customer_spending").tableType == "VIEW"


def test_recreate_any_number_of_times(spark, base):
    layers = Layers("rc_bronze", "rc_silver", "rc_gold")
    for _ in range(2):
        runners.recreate(spark, layers)
        assert all(spark.table(f"rc_silver.{t}").count() == 0 for t in schemas.SILVER)
    runners.run_all(spark, base, layers, "2026-01-01")
    n = spark.table("rc_silver.crm_cust_info").count()
    runners.recreate(spark, layers, only=("bronze",))
    assert spark.table("rc_bronze.crm_cust_info").count() == 0 < n == spark.table("rc_silver.crm_cust_info").count()


def test_versions(spark):
    create_namespaces(spark, Layers("ov_b", "ov_s", "ov_g"))
    store = run_dir(spark, "store")
    schema = T.StructType.fromDDL("a int, `odd name` string")
    rows = lambda *x: spark.createDataFrame([(i, str(i)) for i in x], schema)

    def publish(df, name="ov_b.t"):
        run = Run(spark, store)
        run.publish(df, name)
        return run.commit()

    one = publish(rows(1))
    assert publish(rows(), "ov_b.empty") == one + 1 and spark.table("ov_b.empty").count() == 0
    a, b = Run(spark, store), Run(spark, store)
    assert a.version != b.version
    a.publish(rows(1, 2), "ov_b.t")
    b.publish(rows(9), "ov_b.t")
    a.commit()
    with pytest.raises(ConcurrentCommit):
        b.commit()
    assert sorted(r.a for r in spark.table("ov_b.t").collect()) == [1, 2]
    last = publish(rows(1, 2, 3))
    assert spark.table("ov_b.t").count() == 3 and spark.table("ov_b.empty").count() == 0
    gone = vacuum(spark, store, keep=1)
    assert gone and all("ov_b.t/" in g for g in gone) and spark.table("ov_b.t").count() == 3
    publish(rows(4).withColumn("more", F.lit(1)))  # another schema: another folder, and a new view
    assert spark.table("ov_b.t").columns == ["a", "odd name", "more"] and spark.table("ov_b.t").count() == 1
    run = Run(spark, store)
    run.append([(5, "x")], schema, "ov_b.log")
    run.commit()
    run = Run(spark, store)
    run.append([(6, "y")], schema, "ov_b.log")
    run.commit()
    assert spark.table("ov_b.log").count() == 2
    assert commits(spark, store).where("table_name = 'ov_b.t'").count() == 4 and last > one
    # only the newest version's files are read
    plan = spark.table("ov_b.log")._jdf.queryExecution().executedPlan().toString()
    assert "run_version" in plan and "PartitionFilters" in plan
