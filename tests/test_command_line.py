from __future__ import annotations

import json

import pytest

from touchline.__main__ import main
from touchline.sources import control
from touchline.streaming import jobs


def test_from_csv_to_live_tables(spark, tmp_path, capsys):
    csv, warehouse, root = tmp_path / "csv", f"{tmp_path}/wh", f"{tmp_path}/live"
    csv.mkdir()
    (csv / "teams.csv").write_text("wyId,officialName\n1,Alpha\n2.0,Beta\n")
    (csv / "matches_x.csv").write_text("wyId,gameweek\n5,3.7\n")
    (csv / "events_x.csv").write_text("matchId,playerId\n5,8.0\n5,9\n")
    main(["setup", "--database", "cli"], spark)
    assert spark.catalog.tableExists("cli.live_events")
    for rows in (2, 4):
        main(["load", "--csv", str(csv), "--warehouse", warehouse], spark)
        assert spark.read.parquet(f"{warehouse}/wyscout_events").count() == rows
    stored = jobs.ServingFrames(warehouse)
    assert stored.read(spark, "teams").count() == 2
    assert stored.read(spark, "players").count() == 0
    assert "appended 2 events" in capsys.readouterr().out

    deploy = ["deploy", "Alpha", "Beta", "--warehouse", warehouse, "--root", root]
    main([*deploy, "--truncate"], spark)
    session = control.current_session(spark, f"{root}/control").first()
    assert (session.team_a_id, session.team_b_id) == ("1", "2")

    source = tmp_path / "messages"
    source.mkdir()
    (source / "1.json").write_text(
        json.dumps({"match_id": session.match_id, "timestamp": 5.0, "team": "1"}) + "\nbad\n"
    )
    main(["stream", "--source", "files", "--messages", str(source), "--root", root], spark)
    assert jobs.read_live_events(spark, f"{root}/live_events").count() == 1
    stats = jobs.team_stats(root)
    assert [(r.team, r.total_events) for r in stats.read(spark).collect()] == [("1", 1)]
    main(["reset", session.match_id, "--root", root], spark)
    resets = control.read_resets(spark, f"{root}/resets")
    assert jobs.read_live_events(spark, f"{root}/live_events", resets=resets).count() == 0
    assert stats.read(spark).count() == 0
    # Views and names through the command line, after the reset.
    (source / "2.json").write_text(
        "\n".join(
            json.dumps({"match_id": session.match_id, "timestamp": t, "team": team})
            for t, team in ((6.0, "1"), (7.0, "1"), (8.0, "2"))
        )
    )
    stream = ["stream", "--source", "files", "--messages", str(source), "--root", root]
    main([*stream, "--views", "--names", "--warehouse", warehouse], spark)
    assert {r.team: r.total_events for r in stats.read(spark).collect()} == {"1": 2, "2": 1}
    views = jobs.ServingViews(f"{root}/views")
    card = views.read(spark, "baseline").first()
    assert (card.live_events, card.historical_avg) == (3, 4)
    assert [r.Team for r in views.read(spark, "feed").orderBy("position").collect()] == ["Beta", "Alpha", "Alpha"]
    named = jobs.enriched_log(f"{root}/named_events").read(spark)
    assert {r.team_name for r in named.collect()} == {"Alpha", "Beta"}
    with pytest.raises(SystemExit):
        main([*stream, "--views"], spark)


def test_a_load_without_a_dimension_leaves_it(spark, tmp_path):
    first, second, warehouse = tmp_path / "first", tmp_path / "second", f"{tmp_path}/wh"
    for folder in (first, second):
        folder.mkdir()
        (folder / "events_x.csv").write_text("matchId,playerId\n5,8\n")
    (first / "teams.csv").write_text("wyId,officialName\n1,Alpha\n2,Beta\n")
    (first / "players.csv").write_text("wyId,shortName\n7,P\n8,Q\n")
    (second / "teams.csv").write_text("wyId,officialName\n2,Better\n3,Gamma\n")
    for folder in (first, second):
        main(["load", "--csv", str(folder), "--warehouse", warehouse], spark)
    stored = jobs.ServingFrames(warehouse)
    assert stored.read(spark, "players").count() == 2
    counts = spark.read.parquet(f"{warehouse}/events_per_match").collect()
    assert [(r.match_id, r.n) for r in counts] == [("5", 1), ("5", 1)]
    assert stored.read(spark, "average").first().average_exact == 2.0
    teams = {r.team_id: r.official_name for r in stored.read(spark, "teams").collect()}
    assert teams == {"1": "Alpha", "2": "Better", "3": "Gamma"}


def test_tables_that_set_up_makes_hold_what_load_and_streams_write(spark, tmp_path):
    csv, source, root = tmp_path / "csv", tmp_path / "messages", f"{tmp_path}/live"
    for folder in (csv, source):
        folder.mkdir()
    (csv / "events_x.csv").write_text("matchId,playerId\n5,8\n5,9\n6,9\n")
    (csv / "teams.csv").write_text("wyId,officialName\n1,Alpha\n2,Beta\n")
    (csv / "eventid2name.csv").write_text("event,subevent,event_label,subevent_label\n1,10,Duel,Air duel\n")
    (csv / "tags2name.csv").write_text("Tag,Label,Description\n101,Goal,A goal\n1801,accurate,Accurate")
    (csv / "competitions.csv").write_text('name,wyId,format,area,type\nFirst,524,League,"{\'id\': \'380\'}",club\n')
    main(["setup", "--database", "whole"], spark)
    load = ["load", "--csv", str(csv), "--warehouse", f"{tmp_path}/wh", "--database", "whole"]
    for loads in (1, 2):
        main(load, spark)
        assert spark.table("whole.wyscout_events").count() == 3 * loads
        assert spark.table("whole.teams").count() == 2 and spark.table("whole.matches").count() == 0
    assert jobs.ServingFrames(f"{tmp_path}/wh").read(spark, "average").first().average_exact == 3.0
    found = {n: [tuple(r) for r in spark.table(f"whole.{n}").collect()] for n in ("event_names", "tags", "competitions")}
    assert found == {
        "event_names": [("1", "10", "Duel", "Air duel")],
        "tags": [("101", "Goal", "A goal"), ("1801", "accurate", "Accurate")],
        "competitions": [("524", "First", "League", "club")],
    }

    lines = [json.dumps({"match_id": "m", "timestamp": 5.0, "team": t}) for t in "AB"]
    (source / "1.json").write_text("\n".join(lines))
    stream = ["stream", "--source", "files", "--messages", str(source), "--root", root]
    main(stream, spark)
    for _ in range(2):
        main(["publish", "--root", root, "--database", "whole"], spark)
        # The last line of a key wins, as the source is read in order.
        assert [(r.match_id, r.team) for r in spark.table("whole.live_events").collect()] == [("m", "B")]
        assert {r.team: r.total_events for r in spark.table("whole.live_team_stats").collect()} == {"A": 1, "B": 1}
    main(["reset", "m", "--root", root], spark)
    main(["publish", "--root", root, "--database", "whole"], spark)
    assert spark.table("whole.live_events").isEmpty() and spark.table("whole.live_team_stats").isEmpty()
    spark.sql("DROP DATABASE whole CASCADE")


def test_unknown_teams_are_refused(spark, tmp_path):
    options = spark.createDataFrame([("1", "Alpha")], "team_id string, official_name string")
    with pytest.raises(ValueError, match="Omega"):
        control.deploy_match(spark, options, "Alpha", "Omega", f"{tmp_path}/control")


def test_a_new_checkpoint_version_keeps_all_events(spark, tmp_path):
    root, source = f"{tmp_path}/live", tmp_path / "messages"
    source.mkdir()

    def send(name, *teams):
        lines = [json.dumps({"match_id": "m", "timestamp": t, "team": team}) for t, team in teams]
        (source / name).write_text("\n".join(lines))

    command = ["stream", "--source", "files", "--messages", str(source), "--root", root]
    send("1.json", (1.0, "A"), (2.0, "B"))
    main([*command, "--version", "v1"], spark)
    send("2.json", (3.0, "C"), (4.0, "A"))
    main([*command, "--version", "v2"], spark)
    assert jobs.read_live_events(spark, f"{root}/live_events").count() == 4
    counts = {"A": 2, "B": 1, "C": 1}
    assert {r.team: r.total_events for r in jobs.team_stats(root).read(spark).collect()} == counts
    # Starting a known version again changes nothing.
    main([*command, "--version", "v1"], spark)
    assert jobs.read_live_events(spark, f"{root}/live_events").count() == 4
    assert {r.team: r.total_events for r in jobs.team_stats(root).read(spark).collect()} == counts


def test_nothing_stored_reads_as_no_rows(spark, tmp_path):
    assert jobs.read_live_events(spark, f"{tmp_path}/none").count() == 0
    assert jobs.ServingFrames(f"{tmp_path}/none").read(spark, "feed").count() == 0
