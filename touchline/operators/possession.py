"""Share of events between the two sides of every session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import display


def shares(events_a: Column, events_b: Column) -> tuple[Column, Column]:
    """Percentages of two counts; 50 each when both are 0."""
    total = events_a + events_b
    return tuple(
        F.when(total > 0, F.try_divide(part.cast("double"), total) * 100).otherwise(F.lit(50.0))
        for part in (events_a, events_b)
    )


def pivot_sides(stats: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row per session with the count of each side.

    A session appears only when both of its two distinct teams have a count.
    """
    sides = sessions.select("match_id", "team_a_id", "team_b_id").filter(
        F.col("team_a_id") != F.col("team_b_id")
    )
    is_a = F.col("team") == F.col("team_a_id")
    is_b = F.col("team") == F.col("team_b_id")
    return (
        stats.join(sides, "match_id")
        .filter(is_a | is_b)
        .groupBy("match_id", "team_a_id", "team_b_id")
        .agg(
            F.max(F.when(is_a, F.col("total_events"))).alias("events_a"),
            F.max(F.when(is_b, F.col("total_events"))).alias("events_b"),
        )
        .filter(F.col("events_a").isNotNull() & F.col("events_b").isNotNull())
    )


def possession(stats: DataFrame, sessions: DataFrame) -> DataFrame:
    """Possession card of every session; ``stats`` has one row per match and team."""
    pivoted = pivot_sides(stats, sessions)
    share_a, share_b = shares(F.col("events_a"), F.col("events_b"))
    return pivoted.withColumns({"possession_a": share_a, "possession_b": share_b})


def possession_text(card: DataFrame) -> DataFrame:
    """Display form of the card: one decimal and a percent sign."""
    return card.select(
        "match_id",
        display.percent_text(F.col("possession_a")).alias("text_a"),
        display.percent_text(F.col("possession_b")).alias("text_b"),
    )
