from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators import labels
from touchline.operators.normalise import dedupe, normalise
from touchline.sources import csvfiles, files, tables


@pytest.fixture
def folder(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True, parents=True)
        path.write_text(text, encoding="utf-8")
        return str(tmp_path)

    return write


FACT_HEADER = "matchId,eventId,eventName,subEventName,playerId,teamId,eventSec"


def test_facts(spark, folder):
    root = folder(
        "events_a.csv",
        f"{FACT_HEADER},extra\n"
        "16943900.0,8,Pass,Simple pass,8.0,1613,2.5,x\n"
        'm2,1,"Shot, far",NA,,null,oops,y\n',
    )
    folder("events_b.csv", "eventSec,y_end,matchId,eventName\n1e1,3.25,m3,Duel\n")
    folder("other.csv", "a,b\n1,2\n")
    facts = csvfiles.load_facts(spark, f"{root}/events_*.csv")
    assert facts.schema.simpleString() == schemas.FACTS.schema.simpleString()
    assert sorted(tuple(r) for r in facts.collect()) == [
        ("16943900", "8", "Pass", "Simple pass", "8", "1613", 2.5, 0.0, 0.0, 0.0, 0.0),
        ("m2", "1", "Shot, far", "", "", "", 0.0, 0.0, 0.0, 0.0, 0.0),
        ("m3", "", "Duel", "", "", "", 10.0, 0.0, 0.0, 0.0, 3.25),
    ]


def test_names_of_facts_keep_their_suffix(spark):
    raw = spark.createDataFrame([("1.0", "v2.0")], "matchId string, eventName string")
    row = normalise(raw, schemas.FACTS).first()
    assert (row.match_id, row.event_name) == ("1", "v2.0")


def test_dimension_names_lose_their_suffix(spark):
    raw = spark.createDataFrame([("1.0", "Club 2.0", "nan")], "wyId string, name string, city string")
    assert tuple(normalise(raw, schemas.TEAMS).first()) == ("1", "Club 2", "", "", "")


def test_numeric_columns_are_taken_as_text(spark):
    raw = spark.createDataFrame([(16943900.0, 3.7)], "wyId double, gameweek double")
    row = normalise(raw, schemas.MATCHES).first()
    assert (row.match_id, row.gameweek) == ("16943900", 3)


def test_team_file_layout(spark, folder):
    root = folder(
        "teams.csv",
        "city,name,wyId,officialName,area,type\n"
        "Newcastle upon Tyne,Newcastle,1613,Newcastle FC,"
        "\"{'name': 'England', 'id': '0'}\",club\n"
        '"La Coru\\u00f1a, Galicia",Depor,699,Deportivo,"{\'id\': 724}",club\n'
        "Málaga,Málaga,1,Málaga CF,,club\n",
    )
    teams = csvfiles.load_dimension(spark, f"{root}/teams.csv", schemas.TEAMS)
    assert sorted(tuple(r) for r in teams.collect()) == [
        ("1", "Málaga", "Málaga CF", "Málaga", "club"),
        ("1613", "Newcastle", "Newcastle FC", "Newcastle upon Tyne", "club"),
        ("699", "Depor", "Deportivo", "La Coru\\u00f1a, Galicia", "club"),
    ]


def test_doubled_quotes_and_line_breaks(spark, folder):
    root = folder("teams.csv", 'wyId,name\n1,"The ""Reds""\nof old"\n')
    teams = csvfiles.load_csv(spark, f"{root}/teams.csv", schemas.TEAMS, multi_line=True)
    assert teams.first().name == 'The "Reds"\nof old'


def test_missing_file_gives_an_empty_table(spark, tmp_path):
    for pattern in ("players.csv", "matches_*.csv"):
        found = csvfiles.load_dimension(spark, f"{tmp_path}/{pattern}", schemas.PLAYERS)
        assert found.columns == schemas.PLAYERS.columns and found.isEmpty()
    assert files.glob(spark, f"{tmp_path}/none*") == []


def test_reloading_keeps_one_row_per_key(spark, folder):
    folder("matches_1.csv", "wyId,label,gameweek\n1,old,1\n2,only,x\n")
    root = folder("matches_2.csv", "gameweek,wyId,seasonId\n4.0,1,s\n")
    pattern = f"{root}/matches_*.csv"
    unique = csvfiles.load_dimension(spark, pattern, schemas.MATCHES)
    assert sorted(tuple(r) for r in unique.collect()) == [
        ("1", "", "", "", "s", 4), ("2", "only", "", "", "", 0)
    ]
    assert csvfiles.load_dimension(spark, pattern, schemas.MATCHES, unique=False).count() == 3


def test_rows_by_file(spark, folder):
    folder("events_a.csv", f"{FACT_HEADER}\n" + "m,1,a,b,1,2,3\n" * 3)
    root = folder("events_b.csv", "matchId\nm\n")
    rows = csvfiles.load_csv(
        spark, f"{root}/events_*.csv", schemas.FACTS, with_source=True
    )
    counted = {r.source_file.rsplit("/", 1)[1]: r.rows for r in csvfiles.count_by_file(rows).collect()}
    assert counted == {"events_a.csv": 3, "events_b.csv": 1}


def test_dedupe_is_deterministic(spark):
    rows = spark.createDataFrame(
        [("k", "a", 1), ("k", "b", 2), ("k", "c", 2)], "team_id string, name string, seq int"
    )
    assert [tuple(r) for r in dedupe(rows, ("team_id",), "seq").collect()] == [("k", "c")]


@pytest.mark.parametrize("layout", ["sorted", "ranged"])
def test_append_counts_and_sorts(spark, tmp_path, layout):
    raw = spark.range(1000).select(
        (F.col("id") % 7).cast("string").alias("matchId"),
        F.col("id").cast("string").alias("playerId"),
    )
    facts = normalise(raw, schemas.FACTS)
    target = f"{tmp_path}/facts"
    assert tables.append(facts, target, schemas.FACTS, layout).rows == 1000
    assert tables.append(facts, target, schemas.FACTS, layout).rows == 1000
    stored = spark.read.parquet(target)
    assert stored.count() == 2000 and stored.columns == schemas.FACTS.columns
    per_file = stored.select("match_id", F.input_file_name().alias("f"),
                             F.monotonically_increasing_id().alias("n"))
    for file in {r.f for r in per_file.select("f").distinct().collect()}:
        ids = [r.match_id for r in per_file.filter(F.col("f") == file).orderBy("n").collect()]
        assert ids == sorted(ids)


def test_unknown_layout(spark):
    with pytest.raises(ValueError):
        tables.laid_out(spark.createDataFrame([], schemas.TEAMS.schema), schemas.TEAMS, "random")


def test_tables_are_created_once(spark):
    for _ in range(2):
        tables.create_warehouse(spark, "history")
        tables.create_serving(spark, "live")
    names = {r.tableName for r in spark.sql("SHOW TABLES IN history").collect()}
    assert names == set(schemas.WAREHOUSE)
    raw = spark.createDataFrame([("1", "X")], "wyId string, officialName string")
    report = tables.append(normalise(raw, schemas.TEAMS), "history.teams", schemas.TEAMS)
    assert report.rows == 1
    tables.create_warehouse(spark, "history")
    assert spark.table("history.teams").first().official_name == "X"
    assert spark.table("live.live_team_stats").schema == schemas.TEAM_STATS_SCHEMA
    properties = spark.sql("SHOW TBLPROPERTIES live.live_events").collect()
    assert ("touchline.key", "match_id,timestamp") in [tuple(r) for r in properties]


def test_labels(spark):
    rows = spark.createDataFrame([(1, 10), (1, 99), (8, None)], "event int, subevent int")
    names = spark.createDataFrame(
        [("1", "10", "Duel", "Air duel")],
        "event string, subevent string, event_label string, subevent_label string",
    )
    found = labels.with_labels(
        rows,
        names,
        {"event": "event", "subevent": "subevent"},
        {"event_label": "event_text", "subevent_label": "subevent_text"},
    )
    assert sorted((r.event_text, r.subevent_text) for r in found.collect()) == [
        ("1/99", "1/99"), ("8", "8"), ("Duel", "Air duel")
    ]


def test_names_keep_their_line_breaks(spark, tmp_path):
    (tmp_path / "players.csv").write_text('wyId,shortName\n1,"A\nB"\n2,C\n')
    players = csvfiles.load_dimension(spark, f"{tmp_path}/players.csv", schemas.PLAYERS)
    found = {r.player_id: r.short_name for r in players.collect()}
    assert found == {"1": "A\nB", "2": "C"}


def test_many_headers(spark, tmp_path):
    for n in range(70):
        (tmp_path / f"events_{n}.csv").write_text(f"matchId,playerId{',x_start' * (n % 2)}\n{n},1\n")
    facts = csvfiles.load_facts(spark, f"{tmp_path}/events_*.csv")
    assert facts.count() == 70
