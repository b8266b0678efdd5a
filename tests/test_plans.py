"""Plan hygiene for every registered query: no cartesian product, no Python."""

import pytest

from mcrunstat.plans.queries import queries
from tests.conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


@pytest.mark.parametrize("key", sorted(queries()))
def test_plan_has_no_cartesian_or_python(spark, key):
    df = queries()[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, f"{key}: {bad} in plan"


def test_flagship_prunes_and_pushes_down(spark):
    df = queries()["detailed_ip_standard"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_returnflag), Not(EqualTo(l_returnflag,R))" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double," \
           "l_returnflag:string>" in plan


def test_flagship_without_broadcasts(spark):
    """At scale no side is small: two sort-merge joins' sides, two aggregations, no more."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        df = queries()["detailed_ip_standard"](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 3
    assert plan.count("Exchange hashpartitioning") == 8
