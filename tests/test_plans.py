"""Plan lint over every registered query (sf0.001): no Python UDF, no cross or
nested-loop join, and - with at-scale broadcast settings - no fact table on
the broadcast side of a join."""

import re

import pytest

from contrail.plans.queries import QUERIES
from helpers import plan_text

SF = "/root/testdata/sf0.001"
# Queries that write during construction return a plain read-back; their
# write plans are covered by the plans of the equivalent read-only queries.
READ_ONLY = sorted(n for n, f in QUERIES.items() if "Writes" not in (f.__doc__ or ""))
FACTS = ("lineitem.parquet", "orders.parquet", "events.parquet")


@pytest.fixture(scope="module")
def at_scale(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "contrail.broadcast.maxBytes")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("contrail.broadcast.maxBytes", "4000")
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", READ_ONLY)
def test_plan_lint(at_scale, name):
    plan = plan_text(QUERIES[name](at_scale, SF), "simple")
    assert "EvalPython" not in plan, "Python UDF in plan"
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # A BroadcastExchange may read a fact table only through an aggregate
    # (a bounded summary such as the hot-key table), never raw fact rows.
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "BroadcastExchange" not in line:
            continue
        depth = len(line) - len(line.lstrip(" :+-"))
        aggregated = False
        for sub in lines[i + 1:]:
            if len(sub) - len(sub.lstrip(" :+-")) <= depth:
                break
            aggregated = aggregated or "Aggregate" in sub
            assert aggregated or not any(f in sub for f in FACTS), f"fact rows broadcast: {sub.strip()[:120]}"


# Pruning sparse columns decides the schema from the data, which takes one aggregate job.
BUILDS_WITH_A_JOB = {"prune_sparse_columns"}


@pytest.mark.parametrize("name", sorted(set(READ_ONLY) - BUILDS_WITH_A_JOB))
def test_building_runs_no_job(spark, name):
    sc = spark.sparkContext
    QUERIES[name](spark, SF)                       # file listings and schemas are cached by now
    sc.setJobGroup(f"build-{name}", name)
    try:
        QUERIES[name](spark, SF)
        assert not sc.statusTracker().getJobIdsForGroup(f"build-{name}")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_lint_covers_most_queries():
    assert len(READ_ONLY) >= 40 and re.match(r"^[a-z0-9_]+$", READ_ONLY[0])
