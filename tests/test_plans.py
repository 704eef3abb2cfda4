"""Plan-shape guards over the whole catalogue: no cross joins, no Python UDFs."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_plan_has_no_cross_join_or_python_udf(spark, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan], plan[:2000]


def test_fact_plan_preaggregates_before_the_fan_out_join(spark):
    plan = entry.queries()["fact_by_region"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    # partial sums on both sides of the join: before it (per postcode, year,
    # type) and after it (per region, year, type)
    assert plan.count("partial_sum") >= 2
