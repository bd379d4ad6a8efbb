from __future__ import annotations

import json
import time
from collections import Counter
from functools import reduce
from pathlib import Path

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators.normalise import normalise
from touchline.sources import control, messages
from touchline.sources.keyed_log import KeyedLog
from touchline.streaming import jobs, replay
from touchline.streaming.counts import WindowCounts, newest_windows


class Feed:
    """A folder of message files; each push is one later file."""

    def __init__(self, folder):
        self.folder = folder
        folder.mkdir()
        self.count = 0

    def push(self, *lines):
        self.count += 1
        path = self.folder / f"{self.count:03}.json"
        path.write_text("".join(f"{line}\n" for line in lines))
        time.sleep(0.02)

    def events(self, *seconds, team="A", match="m"):
        self.push(
            *[
                json.dumps({"match_id": match, "timestamp": float(s), "team": team,
                            "player_id": "1", "player_name": "One", "event_type": "pass",
                            "x_coord": 1.0, "y_coord": 2.0})
                for s in seconds
            ]
        )


@pytest.fixture
def feed(tmp_path):
    return Feed(tmp_path / "messages")


def decoded(spark, feed, files_per_batch=None):
    source = messages.message_stream(
        spark, "files", str(feed.folder), max_files_per_trigger=files_per_batch
    )
    return messages.decode(source)


BAD_AND_GOOD = [
    "garbage",
    "",
    '{"match_id":"m","timestamp":"x","team":7}',
    '{"timestamp":1.5}',
    '{"match_id":"m","timestamp":1.5,"team":"A","x_coord":3}',
    '{"match_id":"m","timestamp":2.5,"team":7,"x_coord":"left","player_name":"dropped"}',
    '{"match_id":"m","timestamp":NaN}',
]


def test_messages_are_routed_by_their_key(spark, rows):
    source = spark.createDataFrame([(v,) for v in [*BAD_AND_GOOD, None]], "value string")
    parsed = messages.decode(source)
    kept = messages.valid_events(parsed).collect()
    assert sorted((r.match_id, r.timestamp, r.team, r.x_coord) for r in kept) == [
        ("m", 1.5, "A", 3.0), ("m", 2.5, "7", None)
    ]
    assert "player_name" not in kept[0].asDict()
    refused = Counter(r.reason for r in messages.quarantined(parsed).collect())
    late = spark.createDataFrame([('{"match_id":"m","timestamp":1.7e12}',)], "value string")
    reasons = messages.quarantined(messages.decode(late)).collect()
    assert [r.reason for r in reasons] == ["timestamp out of range"]
    assert refused == {"unreadable": 1, "empty": 2, "no timestamp": 2, "no match_id": 1}


def test_messages_are_parsed_once(spark):
    source = spark.createDataFrame([("x",)], "value string")
    plan = messages.valid_events(messages.decode(source))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("from_json(") == 1


def test_unknown_source(spark):
    with pytest.raises(ValueError):
        messages.message_stream(spark, "socket", "localhost")


def test_pipeline_end_to_end(spark, feed, tmp_path):
    feed.events(0, 5, 61)
    feed.events(62, team="B")
    feed.push(*BAD_AND_GOOD)
    root = f"{tmp_path}/live"
    for query in jobs.start_all(
        messages.file_stream(spark, str(feed.folder)), root, buckets=4
    ):
        query.awaitTermination()
        assert query.exception() is None
    live = jobs.read_live_events(spark, f"{root}/live_events")
    assert live.count() == 6
    assert jobs.read_live_events(spark, f"{root}/live_events", "m", buckets=4).count() == 6
    assert spark.read.parquet(f"{root}/quarantine").count() == 5
    stats = jobs.team_stats(root).read(spark)
    found = {r.team: (r.window_start.timestamp(), r.total_events) for r in stats.collect()}
    assert found == {"A": (60.0, 1), "B": (60.0, 1), "7": (0.0, 1)}


def test_last_write_wins_in_the_raw_log(spark, feed, tmp_path):
    feed.events(1, team="A")
    feed.events(1, team="B")
    root = f"{tmp_path}/raw"
    jobs.append_events(decoded(spark, feed), root, f"{tmp_path}/cp").awaitTermination()
    assert [r.team for r in jobs.read_live_events(spark, root).collect()] == ["B"]


def windows_after(spark, feed, tmp_path, pushes):
    log = WindowCounts(f"{tmp_path}/windows", "all")
    for seconds in pushes:
        feed.events(*seconds)
    events = messages.valid_events(decoded(spark, feed, 1))
    query = jobs.start_counts(events, log, f"{tmp_path}/cp")
    query.awaitTermination()
    counts = {
        int(r.window_end.timestamp()): r.total_events for r in log.read(spark).collect()
    }
    return counts, jobs.dropped_by_watermark(query)


def test_late_events_within_reach_count(spark, feed, tmp_path):
    counts, dropped = windows_after(spark, feed, tmp_path, [[0], [100], [35, 85], [101]])
    assert dropped == 0
    assert [counts[end] for end in (40, 50, 60)] == [2, 2, 2]


def test_late_events_drop_per_expired_window(spark, feed, tmp_path):
    counts, dropped = windows_after(spark, feed, tmp_path, [[0], [100], [101], [35, 85, 85]])
    assert dropped > 0
    assert [counts.get(end) for end in (40, 50, 60, 70, 80, 90)] == [1, 1, 1, None, None, None]
    assert [counts[end] for end in (100, 110, 120, 130, 140)] == [2, 4, 4, 4, 4]


def test_stream_folds_to_the_batch_result(spark, feed, tmp_path, events, rows):
    data = [("m", t * 7 % 300, "AB"[t % 2]) for t in range(300)]
    by_time = sorted(data, key=lambda r: r[1])
    for i in range(0, 300, 100):
        for team in "AB":
            feed.events(*[t for _, t, x in by_time[i : i + 100] if x == team], team=team)
    stats = WindowCounts(f"{tmp_path}/stats")
    query = jobs.start_counts(
        messages.valid_events(decoded(spark, feed, 2)), stats, f"{tmp_path}/cp"
    )
    query.awaitTermination()
    from touchline.operators.windows import latest_window

    columns = ["match_id", "team", "window_start", "window_end", "total_events"]
    assert rows(stats.read(spark), *columns) == rows(latest_window(events(data)), *columns)
    assert len(batches(stats)) >= 3
    before = rows(stats.read(spark))
    for _ in range(2):
        stats.compact(spark, "v1")
        assert rows(stats.read(spark)) == before
    assert len(folds(stats)) == 1


def folders(counts, kind):
    path = Path(counts.path, "counts") if isinstance(counts, WindowCounts) else Path(counts.path)
    return sorted(int(p.name.split("=")[1]) for p in path.glob(f"run=*/{kind}=*"))


def batches(counts):
    return folders(counts, "batch")


def folds(counts):
    return folders(counts, "fold")


def piece(spark, team, end, count, offsets=(0, 0), partition=0, number=0):
    """Counts of one window of match m, from one piece of the source."""
    first, last = offsets
    return spark.sql(
        f"SELECT 'm' AS match_id, '{team}' AS team, timestamp_seconds({end - 60}) AS window_start, "
        f"timestamp_seconds({end}) AS window_end, CAST({count} AS BIGINT) AS total_events, "
        f"CAST({partition} AS BIGINT) AS ingest_partition, CAST({number} AS BIGINT) AS piece, "
        f"CAST({first} AS BIGINT) AS first_offset, CAST({last} AS BIGINT) AS last_offset"
    )


def served(spark, counts):
    return {r.team: r.total_events for r in counts.read(spark).collect()}


def test_older_window_arriving_later_does_not_win(spark, tmp_path):
    counts = WindowCounts(f"{tmp_path}/stats")
    counts.write_batch(piece(spark, "A", 160, 5), 1)
    counts.write_batch(piece(spark, "A", 140, 9), 2)
    assert served(spark, counts) == {"A": 5}
    counts.write_batch(piece(spark, "A", 160, 6), 3)
    assert served(spark, counts) == {"A": 6}
    assert served(spark, WindowCounts(counts.path, "max")) == {"A": 9}
    assert WindowCounts(counts.path, "all").read(spark).count() == 2
    with pytest.raises(ValueError):
        WindowCounts(counts.path, "first")


def test_newest_windows_are_found_without_gathering_a_team(spark, tmp_path):
    counts = WindowCounts(f"{tmp_path}/stats")
    parts = [piece(spark, "A", end, end, number=n) for end in (60, 70, 80) for n in (0, 1)]
    parts += [piece(spark, "B", 70, 5), piece(spark, "B", 60, 6)]
    nobody = piece(spark, "C", 90, 7).withColumn("team", F.lit(None).cast("string"))
    counts.write_batch(reduce(DataFrame.unionByName, [*parts, nobody]), 0)
    assert served(spark, counts) == {"A": 160, "B": 5, None: 7}
    stored = spark.read.parquet(f"{counts.log.path}/run=v1/batch=0")
    assert "Window" not in newest_windows(stored)._jdf.queryExecution().executedPlan().toString()
    counts.compact(spark, "v1")
    assert spark.read.parquet(f"{counts.log.path}/run=v1/fold=0").count() == 4
    assert served(spark, counts) == {"A": 160, "B": 5, None: 7}


def test_steps_are_bounded_and_whole(spark, events, rows, tmp_path):
    data = [("m", t * 7 % 1000, "AB"[t % 2]) for t in range(1000)]
    untimed = events([("m", 0, "A")] * 3).withColumn("timestamp", F.lit(None).cast("double"))
    given = events(data).unionByName(untimed).drop("event_time")
    steps = replay.in_steps(given, 100, f"{tmp_path}/steps")
    sizes = [step.count() for step in steps]
    assert len(steps) == 11 and sum(sizes) == 1003 and max(sizes) <= 110
    assert Counter(rows(reduce(DataFrame.unionByName, steps).dropna())) == Counter(rows(given.dropna()))
    ends = [step.agg(F.min("timestamp"), F.max("timestamp")).first() for step in steps]
    assert all(before[1] < after[0] for before, after in zip(ends, ends[1:]))
    assert steps[0].where("timestamp IS NULL").count() == 3
    assert [step.count() for step in replay.in_steps(given.limit(0), 100, f"{tmp_path}/none")] == [0]
    one_time = events([("m", 5, "A")] * 300).drop("event_time")
    assert [s.count() for s in replay.in_steps(one_time, 100, f"{tmp_path}/one")] == [0, 300]
    assert [s.count() for s in replay.in_steps(untimed, 1, f"{tmp_path}/untimed")] == [3]


@pytest.mark.parametrize("name", ["deployed_sessions", "dashboard_refresh"])
def test_matches_played_in_steps(name, spark, sf_dir, duck, monkeypatch):
    """No micro-batch of the counts takes more than a step, and the result is that of one step."""
    import __spark_entry__ as contract
    from compare import difference
    from touchline.plans import catalog

    taken = []
    write = WindowCounts.write_batch

    def written(self, batch, batch_id, run):
        taken.append(batch.count())
        return write(self, batch, batch_id, run)

    monkeypatch.setattr(WindowCounts, "write_batch", written)
    monkeypatch.setattr(catalog, "STEP_EVENTS", 400, raising=False)
    assert difference(contract.queries()[name](spark, sf_dir), duck, contract.oracle_sql()[name]) == ""
    assert max(taken) <= 420 * 6  # an event is in six windows


@pytest.mark.parametrize("reset", [False, True])
def test_a_match_is_not_one_tasks_work_where_it_meets_resets(spark, events, tmp_path, reset):
    root, started = str(tmp_path), time.time()
    ingest = {f.name: F.lit(None).cast(f.dataType) for f in jobs.INGEST_FIELDS}
    came = ingest | {"ingest_time": F.timestamp_seconds(F.lit(started) + F.col("timestamp") - 1000)}
    rows = events([("m", t, "A") for t in range(2000)]).drop("event_time").withColumns(came)
    rows.withColumn(jobs.BUCKET, jobs.match_bucket(F.col("match_id"), 8)).write.parquet(f"{root}/log")
    if reset:
        told = [("m", started), ("m", started - 500), ("other", started + 5000)]
        resets = spark.createDataFrame(told, "match_id string, at double")
        resets.select("match_id", F.timestamp_seconds("at").alias("reset_at")).write.json(f"{root}/resets")
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in held}
    try:
        for name, value in held.items():
            spark.conf.set(name, value)
        resets = control.read_resets(spark, f"{root}/resets")
        live = jobs.read_live_events(spark, f"{root}/log", buckets=8, resets=resets)
        sizes = [r[1] for r in live.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert abs(sum(sizes) - (1000 if reset else 2000)) <= 2
    assert len(sizes) > 1 and max(sizes) < 0.5 * sum(sizes)


def test_replayed_and_half_written_batches(spark, tmp_path):
    log = KeyedLog(f"{tmp_path}/log", piece(spark, "A", 60, 1).schema, ("match_id", "team"))
    assert log.read(spark).isEmpty() and log.compact(spark, "v1") is None
    assert log.write_batch(piece(spark, "A", 60, 1), 0)
    assert not log.write_batch(piece(spark, "A", 60, 99), 0)
    assert served(spark, log) == {"A": 1}
    half = tmp_path / "log/run=v1/batch=1"
    piece(spark, "A", 70, 50).write.parquet(str(half))
    (half / "_SUCCESS").unlink()
    assert served(spark, log) == {"A": 1}
    assert log.write_batch(piece(spark, "A", 70, 2), 1)
    assert served(spark, log) == {"A": 2}
    for _ in range(2):
        log.compact(spark, "v1")
        assert folds(log) == [1] and served(spark, log) == {"A": 2}
    assert not log.write_batch(piece(spark, "A", 90, 7), 1)
    log.truncate(spark)
    assert log.read(spark).isEmpty()


def test_state_partitions_are_set_for_the_query_only(spark, feed, tmp_path):
    feed.events(1, 2)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    log = WindowCounts(f"{tmp_path}/windows", "all")
    events = messages.valid_events(decoded(spark, feed))
    query = jobs.start_counts(events, log, f"{tmp_path}/cp", state_partitions=3)
    query.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert len(list((tmp_path / "cp/state/0").glob("[0-9]*"))) == 3
    assert log.read(spark).count() == 6


def test_counts_fold_themselves(spark, tmp_path):
    counts = WindowCounts(f"{tmp_path}/stats")
    write = jobs.write_counts(counts, "v1", compact_every=2)
    for batch_id in range(7):
        write(piece(spark, "A", 60 + 10 * batch_id, 1 + batch_id), batch_id)
        assert served(spark, counts) == {"A": 1 + batch_id}
        assert len(batches(counts)) <= 4
    # The batches of the newest fold stay for readers that have listed them.
    assert folds(counts) == [3, 5] and batches(counts) == [4, 5, 6]
    assert counts.log._rows(spark).where("batch <= 3").count() == 1


@pytest.mark.parametrize("every", [0, 1, 2])
def test_an_older_run_goes_on_beside_a_folded_newer_one(spark, tmp_path, every):
    counts = WindowCounts(f"{tmp_path}/stats")
    older, newer = (jobs.write_counts(counts, run, every) for run in ("v1", "v2"))
    older(piece(spark, "A", 60, 1), 0)
    for batch_id in range(4):
        newer(piece(spark, "B", 60 + 10 * batch_id, 1 + batch_id, (0, batch_id)), batch_id)
    for batch_id, team in enumerate("CDEF", 1):
        older(piece(spark, team, 60, 7, (0, 6), batch_id), batch_id)
        older(piece(spark, team, 60, 99, (0, 6), batch_id), batch_id)
    newer(piece(spark, "B", 100, 9, (0, 8)), 4)
    assert served(spark, counts) == {"A": 1, "B": 9, "C": 7, "D": 7, "E": 7, "F": 7}


def test_runs_add_up_by_offsets(spark, tmp_path):
    counts = WindowCounts(f"{tmp_path}/stats")

    def write(run, batch_id, *pieces):
        parts = [piece(spark, "A", 60, n, offsets, *place) for n, offsets, *place in pieces]
        counts.write_batch(reduce(DataFrame.unionByName, parts), batch_id, run)
        return served(spark, counts)["A"]

    assert write("v1", 0, (5, (0, 9))) == 5
    # The second run has started at the newest message, in mid-window and in mid-piece.
    assert write("v2", 0, (2, (10, 13))) == 7
    assert write("v2", 1, (3, (10, 15)), (4, (200, 220), 0, 1)) == 12
    # The first one goes on: it counts what the second one has counted as well.
    assert write("v1", 1, (8, (0, 15)), (1, (200, 202), 0, 1)) == 12
    assert write("v1", 2, (9, (0, 30)), (4, (200, 220), 0, 1), (1, (0, 0), 1)) == 14
    # A third one reads everything again.
    assert write("v3", 0, (9, (0, 30)), (1, (0, 0), 1)) == 14
    for run in ("v1", "v2", "v3"):
        counts.compact(spark, run)
        assert served(spark, counts) == {"A": 14}


def test_a_version_that_starts_in_mid_window_adds_to_the_one_before(spark, feed, tmp_path):
    counts = WindowCounts(f"{tmp_path}/stats")

    def run(version, pattern):
        source = messages.file_stream(spark, f"{feed.folder}/{pattern}")
        events = messages.valid_events(messages.decode(source))
        jobs.start_counts(events, counts, f"{tmp_path}/cp-{version}", run=version).awaitTermination()
        return served(spark, counts)

    feed.events(1, 2, 3, 4, 5)
    assert run("v1", "*") == {"A": 5}
    feed.events(6, 7)
    assert run("v2", "00[2-9].json") == {"A": 7}
    feed.events(8)
    assert run("v1", "*") == {"A": 8}
    feed.events(9, 9.5)
    feed.events(9, team="B")
    assert run("v2", "00[2-9].json") == {"A": 10, "B": 1}
    assert run("v1", "*") == run("v3", "*") == {"A": 10, "B": 1}


def test_a_reset_lets_counts_start_again(spark, feed, tmp_path):
    from touchline.sources import control

    counts = jobs.team_stats(str(tmp_path))

    def now():
        events = messages.valid_events(decoded(spark, feed))
        jobs.start_counts(events, counts, f"{tmp_path}/cp").awaitTermination()
        return sorted((r.match_id, r.team, r.total_events) for r in counts.read(spark).collect())

    feed.events(1, 2, 3)
    feed.events(1, match="n")
    assert now() == [("m", "A", 3), ("n", "A", 1)]
    control.reset_session(spark, f"{tmp_path}/resets", "m", counts)
    assert now() == [("n", "A", 1)]
    feed.events(4)
    feed.events(4, team="B")
    assert now() == [("m", "A", 1), ("m", "B", 1), ("n", "A", 1)]
    control.reset_session(spark, f"{tmp_path}/resets", "m", counts)
    feed.events(5, 70)
    assert now() == [("m", "A", 1), ("n", "A", 1)]
    counts.compact(spark, "v1")
    assert now() == [("m", "A", 1), ("n", "A", 1)]


def test_callback_runs_twice_without_change(spark, tmp_path):
    counts = WindowCounts(f"{tmp_path}/stats")
    batch = piece(spark, "A", 60, 1).unionByName(piece(spark, "A", 70, 3))
    write = jobs.write_counts(counts, "v1")
    write(batch, 4)
    write(batch, 4)
    write(batch.filter("false"), 5)
    assert batches(counts) == [4]
    assert served(spark, counts) == {"A": 3}


def test_names_are_those_of_the_time_an_event_came_in(spark, feed, tmp_path):
    warehouse = f"{tmp_path}/warehouse"
    published = jobs.ServingFrames(warehouse)

    def publish(team, player):
        for table, row in ((schemas.TEAMS, ("A", team)), (schemas.PLAYERS, ("1", player))):
            key, name = table.key[0], "official_name" if table is schemas.TEAMS else "short_name"
            frame = spark.createDataFrame([row], f"{key} string, {name} string")
            published.publish(table.name, normalise(frame, table))

    def names(folder):
        log = jobs.enriched_log(f"{tmp_path}/{folder}")
        jobs.start_enriched(
            messages.valid_events(decoded(spark, feed)),
            jobs.published_dimensions(spark, warehouse),
            log,
            f"{tmp_path}/{folder}-cp",
        ).awaitTermination()
        found = log.read(spark).orderBy("timestamp").collect()
        return [(r.team_name, r.player_name) for r in found]

    feed.events(1)
    assert names("early") == [("A", "1")]
    publish("Old", "One")
    feed.events(2)
    assert names("later") == [("Old", "One"), ("Old", "One")]
    publish("New", "Uno")
    feed.events(3)
    expected = [("Old", "One"), ("Old", "One"), ("New", "Uno")]
    assert names("later") == expected
    # A run after the fact gives every event the same names.
    assert names("again") == expected


def test_the_last_line_of_a_key_wins_everywhere(spark, feed, tmp_path):
    for team in "ZA":
        feed.push(*[
            json.dumps({"match_id": "m", "timestamp": 1.0, "team": t, "player_id": "1"})
            for t in ("M", team, "B" if team == "A" else "C")
        ])

    def source():
        return messages.decode(messages.file_stream(spark, str(feed.folder), ordered=True))

    teams = spark.createDataFrame([], "team_id string, official_name string")
    players = spark.createDataFrame([], "player_id string, short_name string")
    log = jobs.enriched_log(f"{tmp_path}/enriched")
    jobs.start_enriched(
        messages.valid_events(source()), lambda low, high: (teams, players), log, f"{tmp_path}/cp"
    ).awaitTermination()
    jobs.append_events(source(), f"{tmp_path}/raw", f"{tmp_path}/cp-raw").awaitTermination()
    assert [r.team for r in log.read(spark).collect()] == ["B"]
    assert [r.team for r in jobs.read_live_events(spark, f"{tmp_path}/raw").collect()] == ["B"]


def test_enriched_log_stays_short(spark, feed, tmp_path):
    for second in range(12):
        feed.events(second)
    source = messages.valid_events(decoded(spark, feed, files_per_batch=1))
    teams = spark.createDataFrame([], "team_id string, official_name string")
    players = spark.createDataFrame([], "player_id string, short_name string")
    log = jobs.enriched_log(f"{tmp_path}/enriched")
    jobs.start_enriched(
        source, lambda low, high: (teams, players), log, f"{tmp_path}/cp", compact_every=2
    ).awaitTermination()
    assert log.read(spark).count() == 12
    assert len(batches(log)) <= 4 and len(folds(log)) <= 2


def test_a_bucket_writes_few_files(spark, feed, tmp_path):
    for match in "abcdef":
        feed.events(*range(20), match=match)
    jobs.append_events(
        decoded(spark, feed), f"{tmp_path}/raw", f"{tmp_path}/cp", buckets=2
    ).awaitTermination()
    assert len(list((tmp_path / "raw").glob("*/*.parquet"))) <= 2 * jobs.BUCKET_SPREAD
    assert jobs.read_live_events(spark, f"{tmp_path}/raw").count() == 120
    shown = spark.createDataFrame([("a",), ("e",)], "match_id string")
    live = jobs.read_live_events(spark, f"{tmp_path}/raw", buckets=2, sessions=shown)
    assert {(r.match_id, r["count"]) for r in live.groupBy("match_id").count().collect()} == {
        ("a", 20), ("e", 20)
    }


def test_a_refresh_with_a_stored_average_reads_no_facts(spark, events, tmp_path):
    from touchline.plans import dashboard

    live = events([("m", 1, "1"), ("m", 2, "2")])
    columns = "match_id string, team_a_id string, team_a_name string, team_b_id string, team_b_name string"
    sessions = spark.createDataFrame([("m", "1", "A", "2", "B")], columns)
    teams = spark.createDataFrame([("1", "A")], "team_id string, official_name string")
    players = spark.createDataFrame([("p", "P")], "player_id string, short_name string")
    stats = spark.createDataFrame([("m", "1", 1)], "match_id string, team string, total_events long")
    average = spark.createDataFrame([(7.5, 7)], "average_exact double, historical_avg int")
    inputs = dashboard.Inputs(live, stats, sessions, teams, players, None, average)
    card = dashboard.views(inputs, dashboard.live_frame(inputs))["baseline"].first()
    assert (card.historical_avg, card.live_events, card.delta) == (7, 2, 5)


def test_dashboard_follows_the_control_document(spark, feed, tmp_path):
    """Deploying another match switches the views at the next batch."""
    from touchline.operators.sessions import team_options
    from touchline.plans.dashboard import Inputs
    from touchline.sources import control

    root, control_path = f"{tmp_path}/live", f"{tmp_path}/control"
    teams = spark.createDataFrame(
        [("A", "Alpha"), ("B", "Beta")], "team_id string, official_name string"
    )
    players = spark.createDataFrame([("1", "P. One")], "player_id string, short_name string")
    facts = spark.createDataFrame([("x",)] * 10, "match_id string")
    serving = jobs.ServingViews(f"{root}/views")

    def load_inputs(sessions, touched):
        return Inputs(
            live=jobs.read_live_events(spark, f"{root}/live_events", sessions=sessions),
            stats=jobs.team_stats(root).read(spark),
            sessions=sessions,
            teams=teams,
            players=players,
            facts=facts,
        )

    for home, away, count in (("Alpha", "Beta", 3), ("Beta", "Alpha", 1)):
        match = control.deploy_match(spark, team_options(teams), home, away, control_path)
        feed.events(*range(count), team="A", match=match)
        feed.events(0.5, team="B", match=match)
        for query in jobs.start_all(
            messages.file_stream(spark, str(feed.folder)), root, version="v1"
        ):
            query.awaitTermination()
        jobs.start_refresh(
            jobs.changes(spark, root),
            lambda: control.current_session(spark, control_path),
            load_inputs,
            serving,
            f"{tmp_path}/cp",
            jobs.Trigger(),
        ).awaitTermination()
        card = serving.read(spark, "possession").first()
        assert card.match_id == match
        assert (card.events_a, card.events_b) == ((3, 1) if home == "Alpha" else (1, 1))
        assert serving.read(spark, "baseline").first().delta == 10 - count - 1
        assert {r.team_name: r.players for r in serving.read(spark, "radar_counts").collect()} == {
            "Alpha": 1, "Beta": 1
        }
        assert serving.read(spark, "feed").count() == count + 1
        assert serving.read(spark, "actions").first().marker == "o"


def test_a_refresh_rewrites_the_buckets_of_changed_matches(spark, feed, tmp_path, rows):
    from touchline.sources import control

    root, warehouse = f"{tmp_path}/live", f"{tmp_path}/warehouse"
    published = jobs.ServingFrames(warehouse)
    teams = spark.createDataFrame([("A", "Alpha"), ("B", "Beta")], "team_id string, official_name string")
    published.publish("teams", normalise(teams, schemas.TEAMS))
    options = teams.select("official_name", "team_id")
    matches = [control.deploy_match(spark, options, "Alpha", "Beta", f"{root}/control") for _ in range(5)]

    def run(version="v1"):
        source = messages.file_stream(spark, str(feed.folder))
        for query in jobs.start_all(source, root, version=version):
            query.awaitTermination()
        jobs.start_views(spark, root, warehouse, jobs.Trigger(), version).awaitTermination()

    def written():
        return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in Path(root, "views").rglob("*.parquet")}

    def bucket(match):
        column = jobs.match_bucket(F.lit(match), jobs.RAW_BUCKETS)
        return f"{jobs.BUCKET}={spark.range(1).select(column).first()[0]}/"

    def changed(before):
        now = written()
        return {p.split("/")[2] + "/" for p in before.keys() ^ now.keys()}

    serving = jobs.ServingViews(f"{root}/views")
    for match in matches:
        feed.events(1, 2, match=match)
        feed.events(3, team="B", match=match)
    run()
    assert serving.read(spark, "feed").count() == 15
    assert serving.read(spark, "possession").count() == 5

    before = written()
    feed.events(5, match=matches[0])
    run()
    assert changed(before) == {bucket(matches[0])}
    assert serving.read(spark, "feed").count() == 16

    before = written()
    feed.events(6, match="another")
    run()
    assert changed(before) == set()

    # A reset empties the views of its match; a reset alone waits for the next message.
    control.reset_session(spark, f"{root}/resets", matches[1], jobs.team_stats(root))
    before = written()
    feed.events(7, match="another")
    run()
    assert changed(before) == {bucket(matches[1])}
    assert {r.match_id for r in serving.read(spark, "feed").collect()} == set(matches) - {matches[1]}
    assert serving.read(spark, "possession").count() == 4

    # A new load of names reaches all views.
    published.publish("teams", normalise(teams.replace("Alpha", "Omega"), schemas.TEAMS))
    feed.events(8, match="another")
    run()
    assert {r.Team for r in serving.read(spark, "feed").collect()} == {"Omega", "Beta"}

    names = ("possession", "feed", "actions", "radar", "radar_counts", "baseline")
    views = {name: serving.read(spark, name) for name in names}
    rebuilt = jobs.ServingViews(f"{tmp_path}/again/views")
    shown = control.read_sessions(spark, f"{root}/control")
    from touchline.plans.dashboard import Inputs, live_frame
    from touchline.plans.dashboard import views as all_views

    inputs = Inputs(
        jobs.read_live_events(
            spark, f"{root}/live_events", buckets=jobs.RAW_BUCKETS,
            resets=control.read_resets(spark, f"{root}/resets"),
        ),
        jobs.team_stats(root).read(spark), shown, published.read(spark, "teams"),
        spark.createDataFrame([], "player_id string, short_name string"),
        spark.createDataFrame([], schemas.FACTS.schema),
    )
    for name, view in all_views(inputs, live_frame(inputs)).items():
        if name in views:
            columns = view.columns
            assert rows(views[name], *columns) == rows(view, *columns), name
    assert rebuilt.read(spark, "feed").count() == 0


def test_match_ids_stay_text_and_prune_folders(spark, feed, tmp_path):
    for match in ("007", "2024-01-02", "7"):
        feed.events(1, match=match)
    feed.push('{"match_id":"","timestamp":1.0}')
    for buckets in (None, 3):
        root = f"{tmp_path}/raw{buckets}"
        jobs.append_events(
            decoded(spark, feed), root, f"{root}-cp", buckets=buckets
        ).awaitTermination()
        live = jobs.read_live_events(spark, root, buckets=buckets)
        assert sorted(r.match_id for r in live.collect()) == ["007", "2024-01-02", "7"]
        one = jobs.read_live_events(spark, root, "007", buckets)
        assert one.count() == 1
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert f"PartitionFilters: [isnotnull({'match_id' if not buckets else 'match_bucket'}" in plan


def test_shown_sessions_prune_folders(spark, feed, tmp_path):
    for match in "abc":
        feed.events(1, 2, match=match)
    root = f"{tmp_path}/raw"
    jobs.append_events(decoded(spark, feed), root, f"{root}-cp").awaitTermination()
    columns = "match_id string, team_a_id string"
    spark.createDataFrame([("a", "1"), ("b", "2")], columns).write.json(f"{tmp_path}/s")
    shown = spark.read.schema(columns).json(f"{tmp_path}/s").filter("team_a_id = '1'")
    live = jobs.read_live_events(spark, root, sessions=shown)
    assert {r.match_id for r in live.collect()} == {"a"}
    assert "dynamicpruning" in live._jdf.queryExecution().executedPlan().toString()


def test_unknown_sink(spark):
    with pytest.raises(ValueError):
        messages.produce(spark.createDataFrame([("x",)], "value string"), "socket", "localhost")


def test_rows_on_time_and_late_rows_are_all_rows(spark, feed, tmp_path):
    counts = WindowCounts(f"{tmp_path}/counts", "all")

    def run(version="v1"):
        events = messages.valid_events(decoded(spark, feed, 1))
        jobs.start_counts(events, counts, f"{tmp_path}/cp-{version}", run=version).awaitTermination()
        jobs.append_events(decoded(spark, feed), f"{tmp_path}/raw/run={version}", f"{tmp_path}/cp-raw-{version}").awaitTermination()
        raw = jobs.read_raw_events(spark, f"{tmp_path}/raw").dropDuplicates(["ingest_partition", "timestamp"])
        late = counts.late_rows(raw).groupBy("window_end").count().collect()
        whole = raw.count() * 6
        on_time = counts.read(spark).agg(F.sum("total_events")).first()[0]
        return {int(r.window_end.timestamp()): r["count"] for r in late}, on_time, whole

    for seconds in ([0], [100], [101]):
        feed.events(*seconds)
    assert run() == ({}, 18, 18)
    feed.events(35, 85, 86)
    late, on_time, whole = run()
    assert late == {40: 1, 50: 1, 60: 1, 70: 1, 80: 1, 90: 3} and on_time + sum(late.values()) == whole == 36
    counts.compact(spark, "v1")
    assert run() == (late, on_time, whole)
    with pytest.raises(ValueError):
        jobs.team_stats(str(tmp_path)).late_rows(jobs.read_raw_events(spark, f"{tmp_path}/raw"))


def test_stream_spells_are_those_of_the_batch(spark, feed, tmp_path, events, rows):
    """Events out of order within the delay, matches that rest, a team that is missing."""
    import random

    from touchline.operators.spells import possession_spells
    from touchline.streaming.spells import start_spells

    r = random.Random(2)
    data = [("m", 1000 + t * 0.5, r.choice("AAAB"), f"p{t % 3}", r.choice(["pass", "interception"])) for t in range(400)]
    data += [("n", 1000 + 3.0 * t, r.choice(["A", None]), "p", "pass") for t in range(20)]
    arrived = sorted(data, key=lambda e: e[1] + r.uniform(0, 8))

    def send(part):
        feed.push(*[
            json.dumps({"match_id": m, "timestamp": t, "team": team, "player_id": p, "event_type": kind})
            for m, t, team, p, kind in part
        ])

    def run():
        stream = messages.valid_events(decoded(spark, feed, 1))
        start_spells(stream, f"{tmp_path}/spells", f"{tmp_path}/cp", idle="1 minute").awaitTermination()

    for i in range(0, len(arrived), 60):
        send(arrived[i : i + 60])
    run()
    found = spark.read.parquet(f"{tmp_path}/spells")
    assert {r.match_id for r in found.collect()} == {"m", "n"}
    # The clock goes on: the last spells end; a replay of the query adds nothing.
    send([("clock", 1400.0, "A", "p", "pass")])
    run()
    run()
    expected = sorted(map(str, possession_spells(events(data)).collect()))
    assert sorted(map(str, spark.read.parquet(f"{tmp_path}/spells").collect())) == expected
    # A match that goes on after its rest has further spells, and late events have none.
    send([("n", 1500.0, "B", "p", "pass"), ("m", 1001.0, "A", "p", "pass")])
    send([("clock", 1700.0, "A", "p", "pass")])
    run()
    more = rows(spark.read.parquet(f"{tmp_path}/spells").where("start_ts > 1450"))
    assert [x[:5] for x in more] == [("n", "B", 1500.0, 1500.0, 1)]
    assert spark.read.parquet(f"{tmp_path}/spells").count() == len(expected) + 1


def test_interval_trigger(spark, feed, tmp_path):
    feed.events(1)
    query = jobs.append_quarantine(
        decoded(spark, feed), f"{tmp_path}/q", f"{tmp_path}/cp", jobs.Trigger("1 second")
    )
    try:
        assert query.isActive
        jobs.await_any(spark, timeout=1)
    finally:
        query.stop()


def test_replay_covers_all_events_in_order(events):
    frame = events([("m", t, "A") for t in range(0, 100, 3)])
    parts = [frame.filter(c) for c in replay.time_slices(frame, 4)]
    assert sum(p.count() for p in parts) == frame.count()
    ends = [p.agg(F.min("timestamp"), F.max("timestamp")).first() for p in parts]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    assert list(replay.time_slices(frame.filter("false"), 4)) == []


def test_encoded_events_decode_to_themselves(events, rows):
    columns = schemas.EVENT_SCHEMA.fieldNames()
    frame = events([("m", 1700000000.987654, "A"), ("é", 0.1, "B")]).select(*columns)
    assert rows(messages.valid_events(messages.decode(messages.encode(frame))), *columns) == rows(
        frame
    )
