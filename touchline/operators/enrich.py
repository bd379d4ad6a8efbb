"""Names for live events from the batch dimensions, and the session filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators.recent import MERGE_FAN_IN, recent_events


def with_team_name(events: DataFrame, teams: DataFrame) -> DataFrame:
    """Left join of the official team name; the id where there is none."""
    names = teams.select(F.col("team_id").alias("team"), "official_name")
    return (
        events.join(names, "team", "left")
        .withColumn("team_name", F.coalesce("official_name", "team"))
        .drop("official_name")
    )


def with_player_name(events: DataFrame, players: DataFrame) -> DataFrame:
    """Left join of the short player name; the id where there is none."""
    names = players.select("player_id", "short_name")
    return (
        events.join(names, "player_id", "left")
        .withColumn("player_name", F.coalesce("short_name", "player_id"))
        .drop("short_name")
    )


def with_names(events: DataFrame, teams: DataFrame, players: DataFrame) -> DataFrame:
    """Both names. The dimensions hold one row per key, so no row is copied."""
    return with_player_name(with_team_name(events, teams), players)


def _as_of(events: DataFrame, names: DataFrame, key: str, time: str) -> DataFrame:
    """Left join by ``key`` of the name that was valid at ``time``."""
    if "valid_from" not in names.columns:
        return events.join(names, key, "left")
    n = names.withColumnRenamed(key, "__key")
    begun = F.col("valid_from").isNull() | (F.col(time) >= F.col("valid_from"))
    open_ = F.col("valid_to").isNull() | (F.col(time) < F.col("valid_to"))
    valid = (events[key] == n["__key"]) & begun & open_
    return events.join(n, valid, "left").drop("__key", "valid_from", "valid_to")


def with_names_as_of(
    events: DataFrame, teams: DataFrame, players: DataFrame, time: str = "ingest_time"
) -> DataFrame:
    """Both names, each as it was valid at ``time``.

    Dimensions with ``valid_from`` and ``valid_to`` hold one row per key and version; without
    these columns, one row per key that is always valid.
    """
    span = [c for c in ("valid_from", "valid_to") if c in teams.columns]
    team = teams.select(F.col("team_id").cast("string").alias("team"), "official_name", *span)
    span = [c for c in ("valid_from", "valid_to") if c in players.columns]
    player = players.select(F.col("player_id").cast("string").alias("player_id"), "short_name", *span)
    named = _as_of(_as_of(events, team, "team", time), player, "player_id", time)
    return named.withColumns(
        {
            "team_name": F.coalesce("official_name", "team"),
            "player_name": F.coalesce("short_name", "player_id"),
        }
    ).drop("official_name", "short_name")


def in_session(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Events of the two teams of their session, with the session's names."""
    named = sessions.select("match_id", "team_a_id", "team_a_name", "team_b_id", "team_b_name")
    is_a = F.col("team") == F.col("team_a_id")
    is_b = F.col("team") == F.col("team_b_id")
    return events.join(named, "match_id").filter(is_a | is_b)


def of_sessions(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Events of the given sessions only.

    Use it first where few of many matches are on show: right above the scan of a
    table split by match, Spark can skip the other folders.
    """
    return events.join(sessions.select("match_id"), "match_id", "left_semi")


def of_teams(events: DataFrame, team_a: str, team_b: str) -> DataFrame:
    """Events of two given teams."""
    return events.filter(F.col("team").isin(team_a, team_b))


def live_frame(
    events: DataFrame,
    sessions: DataFrame,
    limit: int = schemas.RECENT_LIMIT,
    fan_in: int = MERGE_FAN_IN,
) -> DataFrame:
    """The newest events of every session that belong to its two teams.

    The limit comes first: events of other teams count towards it. Names are
    joined later, to the few rows a view keeps.
    """
    return in_session(recent_events(events, limit, fan_in), sessions)


def live_enriched(
    events: DataFrame,
    teams: DataFrame,
    players: DataFrame,
    sessions: DataFrame,
    limit: int = schemas.RECENT_LIMIT,
) -> DataFrame:
    """The live frame with team and player names."""
    return with_names(live_frame(events, sessions, limit), teams, players)
