"""Possession spells on the stream: the open spell of each match, held as state.

Events wait until the watermark has passed them, so they are taken in order of time however they
came in. A spell is final, and put out, when an event of another team follows it; the last one of
a match, when no event has come for ``idle`` of event time. The result of a stream that has come
to its end is that of :func:`touchline.operators.spells.possession_spells`.

State per match is the open spell and the events of the last ``delay``. A match is one task's work
in each micro-batch, since its events follow each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from touchline import schemas
from touchline.functions.eventtime import seconds_of
from touchline.session import ship
from touchline.streaming.jobs import Trigger, append_rows

SPELL = (
    "match_id string, team string, start_ts double, end_ts double, events long, "
    "ended_by_turnover boolean"
)
#: The open spell, and the waiting events.
STATE = (
    "team string, start_ts double, end_ts double, events long, times array<double>, "
    "players array<string>, teams array<string>, types array<string>"
)
WAITING = ("timestamp", "player_id", "team", "event_type")


def _ordered(events: list[tuple]) -> list[tuple]:
    """By time and player, missing players first."""
    return sorted(events, key=lambda e: (e[0], e[1] is not None, e[1] or ""))


class _Spells:
    """Folds the events of one match, in order, into its spells."""

    def __init__(self, match_id: str, opened: tuple, turnover: str):
        self.match_id, self.opened, self.turnover = match_id, opened, turnover
        self.done: list[tuple] = []

    def take(self, time: float, team: str | None, kind: str | None) -> None:
        held, start, _, count = self.opened
        if count and held == team:
            self.opened = (team, start, time, count + 1)
            return
        self.close(kind == self.turnover)
        self.opened = (team, time, time, 1)

    def close(self, by_turnover: bool) -> None:
        if self.opened[3]:
            self.done.append((self.match_id, *self.opened, by_turnover))
        self.opened = (None, None, None, 0)


def stream_spells(
    events: DataFrame,
    delay: str = schemas.WATERMARK_DELAY,
    idle: str = "30 minutes",
    turnover: str = "interception",
) -> DataFrame:
    """Final spells of a stream of events, each once."""
    rest = int(seconds_of(idle) * 1000)

    def fold(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        opened, waiting = (None, None, None, 0), []
        if state.exists:
            *held, times, players, teams, types = state.get
            opened, waiting = tuple(held), list(zip(times, players, teams, types))
        if not state.hasTimedOut:
            for part in parts:
                part = part.astype(object).where(part.notna(), None)
                waiting += part[list(WAITING)].itertuples(index=False, name=None)
        passed = state.getCurrentWatermarkMs()
        ready = [e for e in waiting if e[0] * 1000 <= passed]
        waiting = [e for e in waiting if e[0] * 1000 > passed]
        spells = _Spells(key[0], opened, turnover)
        for time, _, team, kind in _ordered(ready):
            spells.take(time, team, kind)
        if not waiting and spells.opened[3] and spells.opened[2] * 1000 + rest <= passed:
            spells.close(False)
        if waiting or spells.opened[3]:
            columns = map(list, zip(*waiting)) if waiting else ([], [], [], [])
            state.update((*spells.opened, *columns))
            due = min(e[0] for e in waiting) * 1000 if waiting else spells.opened[2] * 1000 + rest
            state.setTimeoutTimestamp(max(int(due), passed) + 1)
        elif state.exists:
            state.remove()
        if spells.done:
            yield pd.DataFrame(spells.done, columns=[c.split()[0] for c in SPELL.split(", ")])

    ship(events.sparkSession)
    timed = events.where("timestamp IS NOT NULL").withWatermark("event_time", delay)
    return timed.groupBy("match_id").applyInPandasWithState(
        fold, SPELL, STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def start_spells(
    events: DataFrame,
    path: str,
    checkpoint: str,
    delay: str = schemas.WATERMARK_DELAY,
    idle: str = "30 minutes",
    trigger: Trigger = Trigger(),
) -> StreamingQuery:
    """Append the final spells to a Parquet table, each once."""
    return append_rows(stream_spells(events, delay, idle), path, checkpoint, trigger)
