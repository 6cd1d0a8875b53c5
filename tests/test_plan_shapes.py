"""Scale guards on every registered query's physical plan (planned, not executed): no nested-loop
join, no cartesian product, no Python evaluation in the hot path."""

import contextlib
import io

import pytest

from ledgerline.plans.driver_queries import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_forbidden_operators(spark, name):
    jobs = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    df = QUERIES[name](spark, SF)
    assert set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == jobs, "building the frame ran a job"
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    plan = buf.getvalue()
    assert "Physical Plan" in plan
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
