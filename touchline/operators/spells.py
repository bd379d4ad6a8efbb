"""Possession spells: runs of consecutive events by one team of a match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def _changes_team(order: WindowSpec) -> Column:
    """True on the first row and wherever the team differs from the row before."""
    first = F.lag(F.lit(1)).over(order).isNull()
    return first | ~F.lag("team").over(order).eqNullSafe(F.col("team"))


def _runs_in_slices(events: DataFrame, slice_seconds: int, tiebreak: str) -> DataFrame:
    """One row per run of a team inside a time slice of a match.

    A run is its first event; what it needs to know of its end is read off the
    first event of the next run. All steps share one sort, nothing is grouped.
    """
    whole = Window.partitionBy("match_id", "slice")
    order = whole.orderBy("timestamp", tiebreak)
    first_events = (
        events.filter(F.col("timestamp").isNotNull())
        .select("match_id", "timestamp", tiebreak, "team", "event_type")
        .withColumn("slice", F.floor(F.col("timestamp") / slice_seconds))
        .withColumns(
            {
                "starts": _changes_team(order),
                "place": F.row_number().over(order),
                "before_ts": F.lag("timestamp").over(order),
                "slice_events": F.count(F.lit(1)).over(whole),
                "slice_end": F.max("timestamp").over(whole),
            }
        )
        .filter("starts")
    )
    next_place = F.coalesce(F.lead("place").over(order), F.col("slice_events") + 1)
    return first_events.withColumns(
        {
            "run": F.row_number().over(order),
            "runs": F.count(F.lit(1)).over(whole),
            "events": next_place - F.col("place"),
            "end_ts": F.coalesce(F.lead("before_ts").over(order), F.col("slice_end")),
            "next_type": F.lead("event_type").over(order),
        }
    ).select(
        "match_id",
        "slice",
        "run",
        "runs",
        "team",
        F.col("timestamp").alias("start_ts"),
        "end_ts",
        "events",
        F.col("event_type").alias("first_type"),
        "next_type",
    )


def _joined_over_slices(runs: DataFrame) -> DataFrame:
    """Runs with those at slice ends joined up where they go on in the next slice.

    The runs at slice ends form one window per match. Every other run is a window
    of its own and passes unchanged; so one pass serves both.
    """
    at_end = (F.col("run") == 1) | (F.col("run") == F.col("runs"))
    runs = runs.withColumns(
        {
            "at_end": at_end,
            "own_slice": F.when(~at_end, F.col("slice")),
            "own_run": F.when(~at_end, F.col("run")),
        }
    )
    whole = Window.partitionBy("match_id", "own_slice", "own_run")
    order = whole.orderBy("slice", "run")
    so_far = F.sum("events").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends_slice = F.col("run") == F.col("runs")
    following = F.when(ends_slice, F.lead("first_type").over(order)).otherwise(F.col("next_type"))
    starts = (
        runs.withColumns(
            {
                "starts": (F.col("run") > 1) | _changes_team(order),
                "before": so_far - F.col("events"),
                "before_end": F.lag("end_ts").over(order),
                "all_events": F.sum("events").over(whole),
                "whole_end": F.max("end_ts").over(whole),
                "next_type": F.when(F.col("at_end"), following).otherwise(F.col("next_type")),
            }
        )
        .withColumn("before_next", F.lag("next_type").over(order))
        .filter("starts")
    )
    # nothing follows the last spell of a match, so its lookups give null
    return starts.withColumns(
        {
            "events": F.coalesce(F.lead("before").over(order), F.col("all_events"))
            - F.col("before"),
            "end_ts": F.coalesce(F.lead("before_end").over(order), F.col("whole_end")),
            "next_type": F.when(F.col("at_end"), F.lead("before_next").over(order)).otherwise(
                F.col("next_type")
            ),
        }
    )


def possession_spells(
    events: DataFrame,
    slice_seconds: int = 60,
    tiebreak: str = "player_id",
    turnover: str = "interception",
) -> DataFrame:
    """Start, end and length of every spell, and whether a turnover ended it.

    No task holds a whole match. Events are spread by match and time slice, and
    spells are found inside the slices. Only the first and the last spell of a
    slice can go on in a neighbouring one, so just these two per slice are
    brought together per match; all others are final. The result does not depend
    on the slice length.
    """
    runs = _runs_in_slices(events, slice_seconds, tiebreak)
    ended = F.coalesce(F.col("next_type") == turnover, F.lit(False))
    return _joined_over_slices(runs).select(
        "match_id", "team", "start_ts", "end_ts", "events", ended.alias("ended_by_turnover")
    )
