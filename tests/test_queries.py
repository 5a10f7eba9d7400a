"""Every registered query against its SQL oracle (DuckDB) at sf0.001:
row count, column names and an order-insensitive value hash."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))
import __spark_entry__ as E  # noqa: E402
from check_oracle import digest  # noqa: E402
from layercake.plans.registry import QUERIES  # noqa: E402
from layercake.sources.testdata import TABLES  # noqa: E402

NAMES = list(E.oracle_sql())


@pytest.fixture(scope="module")
def con(small_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small_dir}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle():
    # the optional queries have oracles only where SQL can express them
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["order_year", "total_sales", "total_customers", "total_quantity"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, small_dir, name):
    df = E.queries()[name](spark, small_dir)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
