from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from touchline.operators import enrich, pitch, recent


@pytest.fixture
def crowded(events):
    """One match with most of the events, spread over many partitions."""
    rng = random.Random(3)
    data = [
        ("hot" if rng.random() < 0.7 else f"m{i % 5}", i, f"t{rng.randrange(3)}",
         f"p{rng.randrange(40)}")
        for i in range(3000)
    ]
    rng.shuffle(data)
    return data, events(data).drop("event_time").repartition(16)


@pytest.mark.parametrize("fan_in", [1, 3, 1024, 0])
@pytest.mark.parametrize("k", [1, 100, 1000])
def test_top_k_is_exact_for_any_grouping(crowded, rows, fan_in, k):
    data, frame = crowded
    expected = []
    for match in {m for m, *_ in data}:
        newest = sorted((t for m, t, *_ in data if m == match), reverse=True)[:k]
        expected += [(match, float(t), i + 1) for i, t in enumerate(newest)]
    found = recent.recent_events(frame, k, fan_in)
    assert rows(found, "match_id", "timestamp", "recency") == sorted(expected)


def test_top_k_cuts_before_each_shuffle(crowded):
    _, frame = crowded
    for fan_in, steps in ((recent.MERGE_FAN_IN, 2), (0, 1), (8, 2)):
        found = recent.recent_events(frame, 100, fan_in)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("WindowGroupLimit") == 2 * steps
        assert plan.count("Exchange hashpartitioning") == steps


def test_small_files_have_the_plan_of_large_ones(spark, crowded, tmp_path):
    crowded[1].write.parquet(f"{tmp_path}/events")
    found = recent.recent_events(spark.read.parquet(f"{tmp_path}/events"), 100)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_ties_of_top_k_do_not_depend_on_the_grouping(spark, rows):
    data = [("m", 1, f"{n:02}") for n in range(40)]
    frame = spark.createDataFrame(data, "k string, t int, v string").repartition(9)
    for fan_in in (0, 1, 2, recent.MERGE_FAN_IN):
        found = recent.top_k(frame, ["k"], [F.col("t")], 3, fan_in=fan_in)
        assert rows(found, "v") == [("00",), ("01",), ("02",)]


def test_k_above_the_group_limit_threshold(spark, crowded, rows):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "50")
    try:
        found = rows(recent.recent_events(crowded[1], 60), "match_id", "timestamp")
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert found == rows(recent.recent_events(crowded[1], 60, 0), "match_id", "timestamp")


def test_single_match_plans_as_top_k(crowded):
    _, frame = crowded
    found = recent.recent_events_of_match(frame, "hot", 10)
    assert "TakeOrderedAndProject" in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 10


def test_latest_per_key(spark, rows):
    frame = spark.createDataFrame(
        [("a", 1, "x", 5), ("a", 2, None, 6), ("b", 7, "z", 1)],
        "k string, seq int, v string, w int",
    )
    assert rows(recent.latest_per_key(frame, ["k"], ["seq"])) == [("a", None, 6), ("b", "z", 1)]
    plan = recent.latest_per_key(frame, ["k"], ["seq"])._jdf.queryExecution().toString()
    assert "partial_max(" in plan
    ties = spark.createDataFrame([("a", 1, "x", 5), ("a", 1, "y", 1)], frame.schema).coalesce(1)
    for rows_in in (ties, ties.orderBy(F.col("w"))):
        assert rows(recent.latest_per_key(rows_in, ["k"], ["seq"])) == [("a", "y", 1)]


@pytest.fixture
def dims(spark):
    teams = spark.createDataFrame([("t0", "Zero FC")], "team_id string, official_name string")
    players = spark.createDataFrame([("p1", "P. One")], "player_id string, short_name string")
    return teams, players


@pytest.fixture
def sessions(spark):
    return spark.createDataFrame(
        [("hot", "t0", "Home", "t1", "Away")],
        "match_id string, team_a_id string, team_a_name string, "
        "team_b_id string, team_b_name string",
    )


def test_names_fall_back_to_ids(events, dims, rows):
    named = enrich.with_names(
        events([("m", 1, "t0", "p1"), ("m", 2, "t9", "p9")]), *dims
    )
    assert rows(named, "team_name", "player_name") == [("Zero FC", "P. One"), ("t9", "p9")]


def test_limit_comes_before_team_filter(events, sessions):
    frame = events([("hot", t, "other") for t in range(10, 20)] + [("hot", 1, "t0")])
    assert enrich.live_frame(frame, sessions, limit=10).count() == 0
    assert enrich.live_frame(frame, sessions, limit=11).count() == 1


def test_views_are_bounded(crowded, sessions, dims):
    teams, players = dims
    frame = enrich.live_frame(crowded[1], sessions)
    radar = pitch.radar(frame, players)
    assert {(r.team_name, r["count"]) for r in radar.groupBy("team_name").count().collect()} == {
        ("Home", 11), ("Away", 11)
    }
    assert radar.select("team", "player_id").distinct().count() == 22
    assert pitch.action_map(frame, teams, players).count() == 100
    feed = pitch.feed(frame, teams, players).orderBy("position").collect()
    assert [r.position for r in feed] == [1, 2, 3, 4, 5, 6]
    assert feed[0].asDict().keys() == {"match_id", "position", "Team", "Player", "Event"}


def test_colours_follow_configured_names(events, spark, dims):
    teams, players = dims
    set_up = spark.createDataFrame(
        [("m", "t0", "Zero FC", "t1", "Away")],
        "match_id string, team_a_id string, team_a_name string, "
        "team_b_id string, team_b_name string",
    )
    frame = enrich.live_frame(events([("m", 1, "t0"), ("m", 2, "t1")]), set_up)
    actions = {r.team: r for r in pitch.action_map(frame, teams, players).collect()}
    assert actions["t0"].colour == "#3b82f6" and actions["t0"].legend == "Zero FC Pass"
    assert actions["t1"].colour == "yellow" and actions["t1"].team_name == "t1"
    radar = {r.team: r for r in pitch.radar(frame, players).collect()}
    assert radar["t1"].colour == "#ef4444" and radar["t1"].glow == "#f87171"
    assert radar["t0"].label_y == 2.0 - 3.5


def test_matrix_points_stay_in_order(events, spark, dims, sessions):
    frame = enrich.live_frame(events([("hot", t, "t0") for t in range(150)]), sessions)
    matrix = pitch.action_matrix(pitch.action_map(frame, *dims)).collect()
    assert len(matrix) == 1 and matrix[0].n == 100
    assert [p.position for p in matrix[0].points] == list(range(1, 101))


def test_distinct_values(events, rows):
    frame = events([("m", 1, "A"), ("m", 2, "A"), ("m", 3, "B")])
    assert rows(pitch.distinct_values(frame, "team")) == [("A",), ("B",)]


def test_of_teams(events):
    frame = events([("m", 1, "A"), ("m", 2, "B"), ("m", 3, "C")])
    assert enrich.of_teams(frame, "A", "C").count() == 2
    assert frame.filter((F.col("team") == "A") & (F.col("event_type") == "pass")).count() == 1
