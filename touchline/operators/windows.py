"""Event counts per time window, match and team, and which window to serve."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions.eventtime import seconds_of
from touchline.operators.joins import measured

KEYS = ("match_id", "team")

#: Above this many panes per window, frames cost more than grouping does.
MAX_FRAMES = 24

#: Length of a stretch of panes, in windows.
PANES_PER_STRETCH = 60


def window_counts(
    events: DataFrame,
    width: str = schemas.WINDOW_WIDTH,
    slide: str = schemas.WINDOW_SLIDE,
    keys: tuple[str, ...] = KEYS,
) -> DataFrame:
    """Count per window and key straight from the events.

    The form a stream needs: one stateful aggregate. Rows without an event time
    belong to no window.
    """
    return (
        events.groupBy(F.window("event_time", width, slide).alias("window"), *keys)
        .agg(F.count(F.lit(1)).alias("total_events"))
        .select("window", *keys, "total_events")
    )


def flatten_window(counts: DataFrame) -> DataFrame:
    """Replace the window struct by ``window_start`` and ``window_end``."""
    others = [c for c in counts.columns if c != "window"]
    return counts.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *others,
    )


def pane_counts(events: DataFrame, pane: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Count per key and non-overlapping pane; ``pane_start`` marks the pane."""
    return (
        events.groupBy(F.window("event_time", pane).alias("pane"), *keys)
        .agg(F.count(F.lit(1)).alias("pane_events"))
        .select(F.col("pane.start").alias("pane_start"), *keys, "pane_events")
    )


def sliding_window_counts(
    events: DataFrame,
    width: str = schemas.WINDOW_WIDTH,
    slide: str = schemas.WINDOW_SLIDE,
    keys: tuple[str, ...] = KEYS,
) -> DataFrame:
    """Batch count per sliding window, through panes.

    Events are counted once, into panes that every window is a whole number of.
    Only the pane counts are worked on after that, so events are neither copied
    nor shuffled once per window that holds them.
    """
    width_s, slide_s = seconds_of(width), seconds_of(slide)
    if width_s % slide_s == 0 and width_s // slide_s <= MAX_FRAMES:
        return _windows_by_last_pane(
            pane_counts(events, slide, keys), width_s // slide_s, slide_s, keys
        )
    panes = pane_counts(events, f"{math.gcd(width_s, slide_s)} seconds", keys)
    counts = panes.groupBy(F.window("pane_start", width, slide).alias("window"), *keys).agg(
        F.sum("pane_events").alias("total_events")
    )
    return flatten_window(counts)


def _windows_by_last_pane(
    panes: DataFrame, panes_per_window: int, slide_s: int, keys: tuple[str, ...]
) -> DataFrame:
    """Window counts from panes of one slide, each window built exactly once.

    A window is emitted by the last pane in it that has events: its count is a
    range frame ending there, and no window needs to be gathered by a group by.
    A pane emits the windows it is in that end before the next pane with events.

    Panes are spread by key and stretch of time, so a match that runs long is not
    one task's work. The few panes near the ends of a stretch are copied to its
    neighbour, where they are counted but emit nothing.
    """
    stretch = panes_per_window * PANES_PER_STRETCH
    reach = panes_per_window - 1
    at = F.col("pane")
    stretches = F.array_distinct(
        F.array(*[F.floor((at + shift) / stretch) for shift in (-reach, 0, reach)])
    )
    placed = panes.select(
        *keys,
        "pane_events",
        F.floor(F.unix_seconds("pane_start") / slide_s).alias("pane"),
    ).withColumn("stretch", F.explode(stretches))

    line = Window.partitionBy(*keys, "stretch").orderBy("pane")
    window_type = "struct<first_pane: bigint, total_events: bigint>"
    ending_here = F.array(
        *[
            F.struct(
                (at - back).alias("first_pane"),
                F.sum("pane_events").over(line.rangeBetween(-back, 0)).alias("total_events"),
            ).cast(window_type)
            for back in range(panes_per_window)
        ]
    )
    until_next = F.coalesce(F.lead("pane").over(line) - at, F.lit(panes_per_window))
    emitted = F.least(until_next, F.lit(panes_per_window)).cast("int")
    start = F.col("first_pane") * slide_s
    return (
        placed.select(
            *keys,
            at,
            "stretch",
            ending_here.alias("windows"),
            emitted.alias("emitted"),
        )
        .filter(F.col("stretch") == F.floor(at / stretch))
        .select(*keys, F.inline(F.slice("windows", -F.col("emitted"), F.col("emitted"))))
        .select(
            F.timestamp_seconds(start).alias("window_start"),
            F.timestamp_seconds(start + slide_s * panes_per_window).alias("window_end"),
            *keys,
            "total_events",
        )
    )


def latest_window(
    events: DataFrame,
    width: str = schemas.WINDOW_WIDTH,
    slide: str = schemas.WINDOW_SLIDE,
    aligned: bool = False,
) -> DataFrame:
    """The window with the greatest end per match and team, and its count.

    The latest window of a team starts at its last event, rounded down to the
    slide, and lies open towards the future. So its count is that of the last
    pane of one slide, and no event needs copying. ``aligned=True`` keeps only
    the teams that have events in the latest window of their match.
    """
    if seconds_of(slide) > seconds_of(width):
        raise ValueError("the slide must not exceed the width")
    panes = pane_counts(events, slide)
    latest = panes.groupBy(*KEYS).agg(
        F.max("pane_start").alias("window_start"),
        F.max_by("pane_events", "pane_start").alias("total_events"),
    )
    end = F.col("window_start") + F.expr(f"INTERVAL {seconds_of(width)} SECONDS")
    latest = latest.select(*KEYS, "window_start", end.alias("window_end"), "total_events")
    return _aligned(latest) if aligned else latest


def latest_of_counts(counts: DataFrame, aligned: bool = False) -> DataFrame:
    """As :func:`latest_window`, from flattened window counts."""
    latest = counts.groupBy(*KEYS).agg(
        F.max_by("window_start", "window_end").alias("window_start"),
        F.max("window_end").alias("window_end"),
        F.max_by("total_events", "window_end").alias("total_events"),
    )
    return _aligned(latest) if aligned else latest


def _aligned(latest: DataFrame) -> DataFrame:
    newest = F.max("window_end").over(Window.partitionBy("match_id"))
    return (
        latest.withColumn("__newest", newest)
        .filter(F.col("window_end") == F.col("__newest"))
        .drop("__newest")
    )


def max_window(
    events: DataFrame,
    width: str = schemas.WINDOW_WIDTH,
    slide: str = schemas.WINDOW_SLIDE,
) -> DataFrame:
    """The fullest window per match and team; the latest one among equals."""
    counts = sliding_window_counts(events, width, slide)
    best = F.max(F.struct("total_events", "window_end", "window_start")).alias("best")
    return (
        counts.groupBy(*KEYS)
        .agg(best)
        .select(*KEYS, "best.window_start", "best.window_end", "best.total_events")
    )


def rolling_counts(events: DataFrame, width: str = schemas.WINDOW_WIDTH) -> DataFrame:
    """Count per team over the last ``width`` before the newest event of a match.

    The newest event time per match is a small table; it is written out so that
    Spark picks the join by its true size.
    """
    slim = events.select("match_id", "team", "event_time").filter(
        F.col("event_time").isNotNull()
    )
    newest = measured(
        slim.groupBy("match_id").agg(F.max("event_time").alias("window_end")), "newest-event"
    )
    start = F.col("window_end") - F.expr(f"INTERVAL {seconds_of(width)} SECONDS")
    return (
        slim.join(newest, "match_id")
        .withColumn("window_start", start)
        .filter(F.col("event_time") > F.col("window_start"))
        .groupBy("match_id", "team", "window_start", "window_end")
        .agg(F.count(F.lit(1)).alias("total_events"))
    )


def team_stats(
    events: DataFrame,
    policy: str = "latest",
    width: str = schemas.WINDOW_WIDTH,
    slide: str = schemas.WINDOW_SLIDE,
) -> DataFrame:
    """Serving table (match, team, total_events) under a window policy.

    ``latest``: greatest window end per team; ``aligned``: the same, but one
    window per match; ``max``: fullest window; ``rolling``: trailing ``width``.
    """
    if policy == "latest":
        stats = latest_window(events, width, slide)
    elif policy == "aligned":
        stats = latest_window(events, width, slide, aligned=True)
    elif policy == "max":
        stats = max_window(events, width, slide)
    elif policy == "rolling":
        stats = rolling_counts(events, width)
    else:
        raise ValueError(f"unknown window policy: {policy}")
    return stats.select("match_id", "team", "total_events")
