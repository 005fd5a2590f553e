"""Plan guards over every registered query: no cross join or nested-loop join anywhere,
and no Python UDF in any plan (everything stays in JVM expressions)."""

import pytest

from edustar.plans.catalog import queries
from tests.conftest import SF001

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("name", sorted(queries()))
def test_plan_has_no_cross_join_or_python(spark, name):
    df = queries()[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    bad = [op for op in FORBIDDEN if op in plan]
    assert not bad, (name, bad)
