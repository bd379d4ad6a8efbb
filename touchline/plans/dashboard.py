"""All views of the live dashboard for a set of sessions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from touchline.operators import baseline, enrich, pitch, possession


@dataclass(frozen=True)
class Inputs:
    """Tables the dashboard reads; ``live`` may be cut to the sessions on show.

    ``average`` is the stored row of ``baseline.historical_average``; without it every
    refresh scans the facts.
    """

    live: DataFrame
    stats: DataFrame
    sessions: DataFrame
    teams: DataFrame
    players: DataFrame
    facts: DataFrame
    average: DataFrame | None = None


def live_frame(inputs: Inputs) -> DataFrame:
    """The newest events of the sessions on show: at most 1000 rows for each.

    Most views start from it; persist it when several are written at once.
    """
    return enrich.live_frame(inputs.live, inputs.sessions)


def views(inputs: Inputs, frame: DataFrame) -> dict[str, DataFrame]:
    """Every view by name; ``frame`` is :func:`live_frame` of the same inputs."""
    radar = pitch.radar(frame, inputs.players)
    actions = pitch.action_map(frame, inputs.teams, inputs.players)
    live = baseline.live_counts(inputs.live, inputs.sessions, frame)
    card = possession.possession(inputs.stats, inputs.sessions)
    return {
        "possession": card,
        "radar": radar,
        "radar_counts": pitch.radar_counts(radar),
        "actions": actions,
        "action_matrix": pitch.action_matrix(actions),
        "feed": pitch.feed(frame, inputs.teams, inputs.players),
        "baseline": baseline.live_vs_baseline(inputs.facts, live, average=inputs.average),
    }
