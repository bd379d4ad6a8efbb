"""Plans of the training-data queries when no table is small enough to broadcast."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from touchline.llm.queries import QUERIES

NATIVE = ("op5_", "op6_", "op9_")


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_no_pairwise_join_and_only_sums_in_one_task(name, spark, sf_dir, no_broadcast):
    plan = contract.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name.startswith(NATIVE):
        assert not any(f"{kind}Eval" in plan or f"MapIn{kind}" in plan for kind in ("Python", "Arrow", "Pandas"))
    lines = plan.splitlines()
    for line, below in zip(lines, lines[1:]):
        if "SinglePartition" in line:
            # One row for each partition of a stored frame.
            assert "HashAggregate(keys=[_part#" in below
