from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from touchline.operators import recent
from touchline.sources.archive import COLUMNS, EventArchive


@pytest.fixture
def archive(spark, tmp_path):
    made = EventArchive("test_archive", f"{tmp_path}/archive", buckets=4, seconds=100)
    yield made
    spark.sql("DROP TABLE IF EXISTS test_archive")


@pytest.fixture
def long_match(events):
    rows = [("long", t, "AB"[t % 2], f"p{t % 5}") for t in range(2000)]
    rows += [(f"m{i}", 10 * i + t, "A") for i in range(20) for t in range(5)]
    return events(rows)


def plan_of(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def files_read(frame):
    """The scan's own count, after the frame has run."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numFiles").value())
        if node.nodeName() in ("AdaptiveSparkPlan", "ResultQueryStage", "ShuffleQueryStage"):
            walk(node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else node.plan())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    return found


def test_grouping_by_match_needs_no_shuffle(spark, archive, long_match):
    archive.write(long_match)
    latest = archive.latest(spark, ["player_id"])
    counts = latest.groupBy("match_id").count()
    plan = plan_of(counts)
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert {r.match_id: r["count"] for r in counts.collect()} == {"long": 2000} | {f"m{i}": 5 for i in range(20)}


def test_one_match_reads_one_bucket_and_its_newest_ranges(spark, archive, long_match):
    archive.write(long_match)
    whole = files_read(archive.read(spark))[0]
    one = archive.read(spark).where("match_id = 'long'").groupBy("match_id").count()
    plan = plan_of(one)
    assert re.search(r"SelectedBucketsCount: 1 out of 4", plan) and "Exchange" not in plan
    newest = archive.newest_of_match(spark, "long", 150)
    assert files_read(newest) == [2] and whole > 20
    expected = recent.recent_events_of_match(long_match.select(*COLUMNS), "long", 150)
    assert newest.collect() == expected.collect()
    assert archive.newest_of_match(spark, "nobody", 5).count() == 0
    assert archive.newest_of_match(spark, "m3", 50).count() == 5


def test_the_newest_of_all_matches(spark, archive, long_match, rows):
    archive.write(long_match)
    for k in (1, 7, 3000):
        assert rows(archive.newest(spark, k)) == rows(recent.recent_events(long_match.select(*COLUMNS), k))


def test_a_time_range_is_written_anew(spark, archive, long_match, rows):
    archive.write(long_match.where("timestamp < 1000"))
    archive.write(long_match.where("timestamp >= 900"))
    assert archive.read(spark).where("match_id = 'long'").count() == 2000
    changed = long_match.where("timestamp >= 900 AND timestamp < 1000").withColumn("team", F.lit("C"))
    for _ in range(2):
        archive.write(changed)
        assert archive.read(spark).count() == long_match.count()
        assert archive.read(spark).where("team = 'C'").count() == 100
        assert archive.newest(spark, 5000).where("match_id = 'long'").count() == 2000
