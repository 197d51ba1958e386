"""Every registered query against its SQL oracle on the smallest sample."""

import os

import pytest

import check_oracles
from __spark_entry__ import entry
from oracles.registry import oracle_sql
from salesloom.registry import queries

FOLDER = os.environ.get("SAMPLE_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables not found")


@pytest.fixture(scope="module")
def con():
    return check_oracles.connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("key", sorted(queries()))
def test_query_equals_oracle(spark, con, key):
    df = queries()[key](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow"):
        assert operator not in plan
    assert check_oracles.compare(con, key, df) == ""


@pytest.mark.parametrize("key", sorted(queries()))
def test_no_job_runs_while_a_query_is_built(spark, key):
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup(f"build-{key}", key)
    try:
        queries()[key](spark, FOLDER)
        assert not tracker.getJobIdsForGroup(f"build-{key}")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_entry(spark):
    assert entry(spark).columns == ["order_date", "channel", "city", "department", "orders", "revenue", "avg_order_revenue", "customers"]
