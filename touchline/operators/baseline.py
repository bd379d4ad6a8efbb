"""Historical mean events per match against the live count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions import display
from touchline.operators.enrich import in_session


def events_per_match(facts: DataFrame) -> DataFrame:
    """(match_id, n): what a load adds to the mean; counts of several loads add up."""
    return facts.groupBy("match_id").agg(F.count(F.lit(1)).alias("n"))


def average_of(
    counts: DataFrame, fallback: int = schemas.FALLBACK_EVENTS_PER_MATCH
) -> DataFrame:
    """:func:`historical_average` from the :func:`events_per_match` of any number of loads."""
    return _average(counts.groupBy("match_id").agg(F.sum("n").alias("n")), fallback)


def _average(per_match: DataFrame, fallback: int) -> DataFrame:
    mean = F.try_divide(F.sum("n"), F.count("match_id"))
    return per_match.agg(
        mean.alias("average_exact"),
        F.coalesce(mean.cast("int"), F.lit(fallback)).alias("historical_avg"),
    )


def historical_average(
    facts: DataFrame, fallback: int = schemas.FALLBACK_EVENTS_PER_MATCH
) -> DataFrame:
    """One row: mean events per match, cut to an int; the fallback if no match.

    Counting per match first makes the distinct count a plain aggregate with a
    map-side combine.
    """
    return _average(events_per_match(facts), fallback)


def live_counts(
    events: DataFrame,
    sessions: DataFrame,
    frame: DataFrame | None = None,
) -> DataFrame:
    """Live events of both sides per session.

    Given a limited live ``frame`` its rows are counted, so the count saturates
    at the limit; otherwise all events are, once per match and team before the
    join. A session without events counts 0.
    """
    if frame is None:
        per_team = events.groupBy("match_id", "team").agg(F.count(F.lit(1)).alias("n"))
        counted = in_session(per_team, sessions).groupBy("match_id").agg(F.sum("n").alias("n"))
    else:
        counted = frame.groupBy("match_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        sessions.select("match_id")
        .join(counted, "match_id", "left")
        .select("match_id", F.coalesce("n", F.lit(0)).alias("live_events"))
    )


def live_vs_baseline(
    facts: DataFrame,
    live: DataFrame,
    fallback: int = schemas.FALLBACK_EVENTS_PER_MATCH,
    average: DataFrame | None = None,
) -> DataFrame:
    """Baseline card per session. The one baseline value is a scalar subquery.

    Given the stored row of :func:`historical_average`, the facts are not read.
    """
    if average is None:
        average = historical_average(facts, fallback)
    card = live.withColumn("historical_avg", average.select("historical_avg").scalar())
    return card.withColumn("delta", F.col("historical_avg") - F.col("live_events"))


def baseline_text(card: DataFrame) -> DataFrame:
    """Display form of the card with thousands separators."""
    return card.select(
        "match_id",
        display.thousands_text(F.col("historical_avg")).alias("average_text"),
        display.thousands_text(F.col("live_events")).alias("live_text"),
        F.concat(F.col("delta").cast("string"), F.lit(" to average")).alias("delta_text"),
    )
