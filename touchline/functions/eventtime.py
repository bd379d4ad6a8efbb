"""Event time from epoch seconds, and fixed-length durations."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}

#: Epoch seconds beyond this are no event time (the year 5138).
_MAX_EPOCH_SECONDS = 1e11


def is_event_time(seconds: Column) -> Column:
    """True when the epoch seconds are a usable event time (never null)."""
    usable = ~F.isnan(seconds) & (F.abs(seconds) < F.lit(_MAX_EPOCH_SECONDS))
    return F.coalesce(seconds.isNotNull() & usable, F.lit(False))


def event_time(seconds: Column, truncate: bool = False) -> Column:
    """Timestamp of epoch seconds, exact to the microsecond.

    ``truncate=True`` cuts to whole seconds. Unusable values give null, and
    such rows drop out of every time window.
    """
    scaled = F.floor(seconds) * 1_000_000 if truncate else F.floor(seconds * 1e6 + 0.5)
    return F.when(is_event_time(seconds), F.timestamp_micros(scaled.cast("long")))


def epoch_seconds(timestamp: Column) -> Column:
    """Epoch seconds with fraction, as a double."""
    return F.unix_micros(timestamp.cast("timestamp")) / F.lit(1e6)


def duration(text: str) -> timedelta:
    """Length of a fixed duration such as ``60 seconds`` or ``6 hours``."""
    amount, _, unit = text.strip().partition(" ")
    return timedelta(seconds=int(amount) * _UNIT_SECONDS[unit.strip().rstrip("s")])


def seconds_of(text: str) -> int:
    return int(duration(text).total_seconds())
