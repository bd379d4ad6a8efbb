from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from touchline.operators import possession, spells, windows


def random_events(seed, n=400, span=600):
    rng = random.Random(seed)
    times = sorted({round(rng.uniform(0, span), 3) for _ in range(n)})
    return [
        (rng.choice("mmmn"), t, rng.choice("AB"), f"p{rng.randrange(9)}",
         rng.choice(["pass", "shot", "interception"]))
        for t in times
    ]


def brute_windows(rows, width, slide):
    counts = Counter()
    for m, t, team, *_ in rows:
        start = int(t // slide) * slide
        while start > t - width:
            counts[(m, team, start)] += 1
            start -= slide
    return counts


@pytest.mark.parametrize("width, slide", [(60, 10), (60, 60), (45, 30), (7, 3)])
def test_panes_equal_direct_count(events, rows, width, slide):
    data = random_events(width + slide)
    frame = events(data)
    args = (f"{width} seconds", f"{slide} seconds")
    paned = windows.sliding_window_counts(frame, *args)
    direct = windows.flatten_window(windows.window_counts(frame, *args))
    key = ["match_id", "team", F.col("window_start").cast("long"), "total_events"]
    expected = sorted((*k, n) for k, n in brute_windows(data, width, slide).items())
    assert rows(paned, *key) == rows(direct, *key) == expected
    if width % slide == 0:
        assert sum(n for *_, n in expected) == len(data) * width // slide


@pytest.mark.parametrize("width, slide, span", [(60, 10, 9000), (60, 60, 9000), (4, 2, 400)])
def test_windows_over_the_ends_of_stretches(events, rows, monkeypatch, width, slide, span):
    """Panes near the end of a stretch count in both, and no window is lost or doubled."""
    monkeypatch.setattr(windows, "PANES_PER_STRETCH", 3)
    data = random_events(1, n=900, span=span)
    found = windows.sliding_window_counts(events(data), f"{width} seconds", f"{slide} seconds")
    key = ["match_id", "team", F.col("window_start").cast("long"), "total_events"]
    assert rows(found, *key) == sorted(
        (*k, n) for k, n in brute_windows(data, width, slide).items()
    )


def test_many_panes_per_window_are_grouped(events, rows):
    data = random_events(2, n=200, span=300)
    found = windows.sliding_window_counts(events(data), "60 seconds", "2 seconds")
    key = ["match_id", "team", F.col("window_start").cast("long"), "total_events"]
    assert rows(found, *key) == sorted((*k, n) for k, n in brute_windows(data, 60, 2).items())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan and 60 // 2 > windows.MAX_FRAMES


@pytest.mark.parametrize("width, slide", [(60, 10), (45, 30)])
def test_policies(events, rows, width, slide):
    data = random_events(5)
    frame = events(data)
    args = (f"{width} seconds", f"{slide} seconds")
    counts = brute_windows(data, width, slide)
    teams = {(m, t) for m, t, _ in counts}
    latest = {k: max((s, n) for (m, t, s), n in counts.items() if (m, t) == k) for k in teams}
    fullest = {k: max((n, s) for (m, t, s), n in counts.items() if (m, t) == k) for k in teams}
    key = ["match_id", "team", F.col("window_start").cast("long"), "total_events"]
    assert rows(windows.latest_window(frame, *args), *key) == sorted(
        (*k, s, n) for k, (s, n) in latest.items()
    )
    flat = windows.sliding_window_counts(frame, *args)
    assert rows(windows.latest_of_counts(flat), *key) == rows(
        windows.latest_window(frame, *args), *key
    )
    assert rows(windows.max_window(frame, *args), *key) == sorted(
        (*k, s, n) for k, (n, s) in fullest.items()
    )


def test_aligned_keeps_one_window_per_match(events, rows):
    frame = events([("m", 5, "A"), ("m", 95, "B"), ("m", 96, "C")])
    assert rows(windows.team_stats(frame, "aligned")) == [("m", "B", 1), ("m", "C", 1)]
    assert rows(windows.team_stats(frame, "latest")) == [("m", "A", 1), ("m", "B", 1), ("m", "C", 1)]


def test_rolling_ends_at_newest_event(events, rows):
    frame = events([("m", 40, "A"), ("m", 40.001, "A"), ("m", 99, "B"), ("m", 100, "A")])
    assert rows(windows.team_stats(frame, "rolling")) == [("m", "A", 2), ("m", "B", 1)]


def test_gaps_between_windows_are_refused(events):
    with pytest.raises(ValueError):
        windows.latest_window(events([("m", 1, "A")]), "10 seconds", "30 seconds")


def test_unknown_policy(events):
    with pytest.raises(ValueError):
        windows.team_stats(events([("m", 1, "A")]), "newest")


def test_rows_without_time_belong_to_no_window(events, rows):
    frame = events([("m", float("nan"), "A"), ("m", 5, "A")])
    assert sum(r[-1] for r in rows(windows.sliding_window_counts(frame))) == 6


@pytest.fixture
def sessions(spark):
    return lambda *pairs: spark.createDataFrame(
        [(m, a, f"{a} name", b, f"{b} name") for m, a, b in pairs],
        "match_id string, team_a_id string, team_a_name string, "
        "team_b_id string, team_b_name string",
    )


def test_possession(spark, sessions, rows):
    stats = spark.createDataFrame(
        [("m", "A", 3), ("m", "B", 1), ("m", "C", 9), ("one", "A", 3), ("same", "A", 4),
         ("nil", "A", 0), ("nil", "B", 0)],
        "match_id string, team string, total_events long",
    )
    set_up = sessions(("m", "A", "B"), ("one", "A", "B"), ("same", "A", "A"), ("nil", "A", "B"),
                      ("none", "A", "B"))
    card = possession.possession(stats, set_up)
    assert rows(card, "match_id", "possession_a", "possession_b") == [
        ("m", 75.0, 25.0), ("nil", 50.0, 50.0)
    ]


def brute_spells(data):
    out = []
    for match in sorted({m for m, *_ in data}):
        run = None
        for m, t, team, _, kind in sorted(r for r in data if r[0] == match):
            if run and run[1] == team:
                run[3], run[4] = t, run[4] + 1
            else:
                if run:
                    run[5] = kind == "interception"
                    out.append(tuple(run))
                run = [m, team, t, t, 1, False]
        out.append(tuple(run))
    return sorted(out)


@pytest.mark.parametrize("slice_seconds", [1, 7, 60, 10_000])
def test_spells_do_not_depend_on_slices(events, rows, slice_seconds):
    data = random_events(11, n=250)
    found = spells.possession_spells(events(data), slice_seconds)
    columns = ["match_id", "team", "start_ts", "end_ts", "events", "ended_by_turnover"]
    assert rows(found, *columns) == brute_spells(data)


def test_one_long_spell_over_empty_slices(events, rows):
    found = spells.possession_spells(events([("m", t, "A") for t in range(0, 1000, 100)]), 10)
    assert rows(found, "team", "start_ts", "end_ts", "events") == [("A", 0.0, 900.0, 10)]
