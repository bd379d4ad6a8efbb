"""Plans as they must look when no table is small enough to broadcast."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from touchline.plans.catalog import QUERIES

#: These read what a stream or a file load wrote; the work is not in their plan.
WRITTEN = {
    "team_stats_upsert_stream",
    "late_event_policy",
    "raw_append_stream",
    "enriched_stream",
    "dashboard_refresh",
    "csv_fact_load",
    "csv_match_load",
    "csv_player_load",
    "warehouse_append",
    "keyed_log_compaction",
}

#: Queries whose result is one row or a fixed few: they end in a single task,
#: fed by partial aggregates or a partial top-k.
FEW_ROWS = {
    "hist_avg_events",
    "live_vs_baseline",
    "baseline_display",
    "team_selector_default",
    "roster_fill",
    "lineup_positions",
}


@pytest.fixture
def no_broadcast(spark):
    names = (
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.autoBroadcastJoinThreshold",
    )
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITTEN))
def test_no_pairwise_join_and_no_single_task(name, spark, sf_dir, no_broadcast):
    plan = plan_of(contract.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    if name not in FEW_ROWS:
        assert "SinglePartition" not in plan


@pytest.mark.parametrize("name", ["live_enriched", "possession_rolling", "roster_fill"])
def test_results_hold_without_broadcast(name, spark, sf_dir, duck, no_broadcast):
    from compare import difference

    assert difference(contract.queries()[name](spark, sf_dir), duck, contract.oracle_sql()[name]) == ""


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = plan_of(contract.queries()["hist_avg_events"](spark, sf_dir))
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan
    plan = plan_of(contract.queries()["latest_window_per_team"](spark, sf_dir))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan


def test_window_counts_shuffle_panes_only(spark, sf_dir):
    """Events combine before the first shuffle and are not copied per window."""
    plan = plan_of(contract.queries()["sliding_window_counts"](spark, sf_dir))
    assert "partial_count(1)" in plan and "Expand" not in plan
    assert plan.count("Exchange hashpartitioning") == 2
    latest = plan_of(contract.queries()["latest_window_per_team"](spark, sf_dir))
    assert "Expand" not in latest and "partial_max_by(pane_events" in latest
