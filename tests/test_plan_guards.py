"""Scale guards over the final plan of every registered query."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))
from plan_report import final_plan, summarise  # noqa: E402
from layercake.plans.registry import QUERIES  # noqa: E402

# single-partition exchanges allowed only over provably bounded inputs:
# a global sum's partial rows (one per partition), one row per year, one row
# per table and commit (views), one per table (logs), one per partition (total)
BOUNDED_SINGLE_PARTITION = {"part_to_whole", "cumulative_as_written", "cumulative_intended",
                            "report_views", "silver_logs",
                            "distinct_trend"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan_guards(spark, small_dir, name):
    s = summarise(final_plan(QUERIES[name](spark, small_dir)))
    assert s["nested_loop"] == 0, "no cross / nested-loop joins"
    assert s["python"] == 0, "no Python UDF or pandas operators"
    if name not in BOUNDED_SINGLE_PARTITION:
        assert s["single"] == 0, "no single-partition exchange"
