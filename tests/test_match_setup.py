from __future__ import annotations

from datetime import datetime

import pytest

from touchline import schemas
from touchline.operators import baseline, roster, sessions
from touchline.sources import control
from touchline.streaming.counts import PIECE_SCHEMA
from touchline.streaming.jobs import team_stats


@pytest.fixture
def teams(spark):
    return spark.createDataFrame(
        [("1", "Zeta", 1), ("2", "alpha", 2), ("3", "Beta", 3), ("4", "Beta", 4)],
        "team_id string, official_name string, seq int",
    )


def test_options_are_sorted_and_keep_the_last(teams):
    options = sessions.team_options(teams, "seq")
    assert [tuple(r) for r in options.collect()] == [("Beta", "4"), ("Zeta", "1"), ("alpha", "2")]
    assert [r.official_name for r in sessions.default_pair(options).collect()] == ["Beta", "Zeta"]


def test_deploying_a_match(spark, teams, tmp_path):
    path = f"{tmp_path}/control"
    assert control.read_sessions(spark, path).isEmpty()
    stats = team_stats(str(tmp_path))
    start, end = datetime(2024, 1, 1, 12), datetime(2024, 1, 1, 13)
    row = ("m", "A", start, end, 1, 0, 0, 0, 0, "v1")
    stats.write_batch(spark.createDataFrame([row], PIECE_SCHEMA), 0)
    assert stats.read(spark).count() == 1
    options = sessions.team_options(teams, "seq")
    first = control.deploy_match(spark, options, "Beta", "Zeta", path, (stats,))
    assert len(first) == 12 and stats.read(spark).isEmpty()
    second = control.deploy_match(spark, options, "alpha", "Beta", path)
    assert first != second
    assert control.read_sessions(spark, path).count() == 2
    current = control.current_session(spark, path).collect()
    assert [(r.match_id, r.team_a_id, r.team_b_id) for r in current] == [(second, "2", "4")]


def test_documents_without_session_id(spark):
    documents = spark.createDataFrame(
        [(1, "A", 2, "B")], "team_a_id int, team_a_name string, team_b_id int, team_b_name string"
    )
    row = sessions.resolve_sessions(documents).first()
    assert (row.match_id, row.team_a_id) == (schemas.DEFAULT_SESSION, "1")


def test_last_document_of_a_session_counts(spark, tmp_path):
    path = tmp_path / "control"
    path.mkdir()
    for i, name in enumerate(("First", "Second")):
        (path / f"{i}.json").write_text(
            f'{{"team_a_id": "1", "team_a_name": "{name}", "team_b_id": "2", '
            f'"team_b_name": "B", "deployed_at": "2024-01-0{i + 1}T00:00:00Z"}}\n'
        )
    found = control.read_sessions(spark, str(path)).collect()
    assert [(r.match_id, r.team_a_name) for r in found] == [(schemas.DEFAULT_SESSION, "Second")]


def test_reset_hides_earlier_events(spark, tmp_path):
    path = f"{tmp_path}/resets"
    live = spark.sql(
        "SELECT * FROM VALUES ('m', timestamp'2000-01-01'), ('m', timestamp'2999-01-01'), "
        "('n', timestamp'2000-01-01') AS t(match_id, ingest_time)"
    )
    assert control.after_resets(live, control.read_resets(spark, path)).count() == 3
    control.reset_session(spark, path, "m")
    kept = control.after_resets(live, control.read_resets(spark, path))
    assert sorted(r.match_id for r in kept.collect()) == ["m", "n"]


def table(spark, rows, columns):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns.split()))


def squads(spark, teams, players, facts):
    found = roster.roster(
        table(spark, [(t,) for t in teams], "team_id"),
        table(spark, players, "player_id short_name currentTeamId"),
        table(spark, facts, "team_id player_id"),
    )
    out = {}
    for r in found.orderBy("team_id", "slot").collect():
        out.setdefault(r.team_id, []).append((r.player_id, r.player_name, r.tier))
    return out


def brute_squads(teams, players, facts, size=11):
    names = {p: n for p, n, _ in players}
    out = {}
    for team in teams:
        chosen = []
        tiers = (
            sorted({p for p, _, t in players if t == team}),
            sorted({p for t, p in facts if t == team}),
            sorted(names),
        )
        for tier, ids in enumerate(tiers, 1):
            for player in ids:
                if len(chosen) < size and player not in [c[0] for c in chosen]:
                    chosen.append((player, names.get(player, ""), tier))
        while len(chosen) < size:
            n = len(chosen) + 1
            chosen.append((f"SYN_{team}_{n}", f"Player {n}", 4))
        out[team] = chosen
    return out


@pytest.mark.parametrize("people", [0, 3, 12, 60])
def test_roster_equals_tier_by_tier_choice(spark, people):
    players = [(f"p{i:02}", f"Name {i}", "T" + str(i % 7) if i % 3 else "T0") for i in range(people)]
    facts = [("T1", f"p{i:02}") for i in range(5, 9)] * 3 + [("T2", f"x{i:02}") for i in range(20)]
    teams = ["T0", "T1", "T2", "T9"]
    assert squads(spark, teams, players, facts) == brute_squads(teams, players, facts)


def test_lineup_places_shared_players_on_side_b(spark):
    teams = ["A", "B"]
    players = [(f"p{i:02}", f"N{i}", "A" if i < 11 else "B") for i in range(22)]
    members = table(spark, players, "player_id short_name currentTeamId")
    facts = table(spark, [("B", "p00")], "team_id player_id")
    squad = roster.roster(table(spark, [(t,) for t in teams], "team_id"), members, facts)
    set_up = spark.createDataFrame(
        [("m", "A", "B"), ("same", "A", "A")],
        "match_id string, team_a_id string, team_b_id string",
    )
    placed = roster.lineup(squad, set_up).collect()
    match = [r for r in placed if r.match_id == "m"]
    assert len(match) == 22
    keepers = {(r.side, r.base_x, r.base_y) for r in match if r.slot == 0}
    assert keepers == {("A", 5, 50), ("B", 95, 50)}
    positions = {(r.side, r.slot): (r.base_x, r.base_y) for r in match}
    assert [positions["A", i] for i in range(11)] == list(schemas.FORMATION_A)
    assert [positions["B", i] for i in range(11)] == list(schemas.FORMATION_B)
    same = [r for r in placed if r.match_id == "same"]
    assert len(same) == 11 and {r.side for r in same} == {"B"}


def test_historical_average(spark):
    facts = table(spark, [("a",)] * 5 + [("b",)] * 2, "match_id")
    row = baseline.historical_average(facts).first()
    assert (row.average_exact, row.historical_avg) == (3.5, 3)
    nothing = baseline.historical_average(facts.filter("false")).first()
    assert (nothing.average_exact, nothing.historical_avg) == (None, 1450)


def test_baseline_card(spark, events):
    set_up = spark.createDataFrame(
        [("m", "A", "An", "B", "Bn"), ("quiet", "A", "An", "B", "Bn")],
        "match_id string, team_a_id string, team_a_name string, "
        "team_b_id string, team_b_name string",
    )
    live = events([("m", 1, "A"), ("m", 2, "B"), ("m", 3, "C")])
    counts = baseline.live_counts(live, set_up)
    card = baseline.live_vs_baseline(table(spark, [], "match_id"), counts)
    found = {r.match_id: (r.live_events, r.historical_avg, r.delta) for r in card.collect()}
    assert found == {"m": (2, 1450, 1448), "quiet": (0, 1450, 1450)}
    text = {r.match_id: tuple(r)[1:] for r in baseline.baseline_text(card).collect()}
    assert text["m"] == ("1,450", "2", "1448 to average")


def test_label_lists(spark):
    from pyspark.sql import functions as F

    from touchline.operators import labels

    rows = spark.createDataFrame(
        [(1, "[{'id': 1801}, {'id': 101}, {'id': 9}, {'id': 101}]"), (2, "[]"), (3, None)], "id int, tags string"
    ).withColumn("codes", labels.code_list(F.col("tags")))
    tags = spark.createDataFrame([("101", "Goal"), ("1801", "accurate")], "tag string, label string")
    found = labels.with_label_lists(rows, ("id",), "codes", tags)
    assert {r.id: r.labels for r in found.collect()} == {1: ["accurate", "Goal", "9", "Goal"], 2: [], 3: []}
