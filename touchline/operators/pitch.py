"""Views of the live frame: radar, action map and feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions import display
from touchline.operators.enrich import with_names, with_player_name
from touchline.operators.recent import head_per_match, last_positions, most_recent_players


def radar(
    frame: DataFrame, players: DataFrame, squad_size: int = schemas.SQUAD_SIZE
) -> DataFrame:
    """Where the most recently active players of both sides were last seen.

    The team name is the one configured for the session.
    """
    placed = most_recent_players(last_positions(frame), squad_size)
    home = F.col("team") == F.col("team_a_id")
    named = with_player_name(placed, players).withColumn(
        "team_name", F.when(home, F.col("team_a_name")).otherwise(F.col("team_b_name"))
    )
    colour = display.team_colour(F.col("team_name"), F.col("team_a_name"), F.col("team_b_name"))
    return named.withColumn("colour", colour).select(
        "match_id",
        "team",
        "team_name",
        "squad_rank",
        "player_id",
        "player_name",
        "timestamp",
        "x_coord",
        "y_coord",
        display.short_label(F.col("player_name"), F.col("player_id")).alias("label"),
        (F.col("y_coord") - schemas.LABEL_OFFSET).alias("label_y"),
        "colour",
        display.glow_colour(F.col("colour")).alias("glow"),
    )


def radar_counts(radar_frame: DataFrame) -> DataFrame:
    """Players on the pitch per team."""
    return radar_frame.groupBy("match_id", "team_name").agg(
        F.count(F.lit(1)).alias("players"),
        F.concat(
            F.first("team_name"), F.lit(": "), F.count(F.lit(1)).cast("string"), F.lit(" players")
        ).alias("badge"),
    )


def action_map(
    frame: DataFrame,
    teams: DataFrame,
    players: DataFrame,
    limit: int = schemas.ACTION_LIMIT,
) -> DataFrame:
    """The newest events of each session with marker, size, colour and legend."""
    named = with_names(head_per_match(frame, limit), teams, players)
    return named.select(
        "match_id",
        "position",
        "timestamp",
        "team",
        "team_name",
        "player_name",
        "event_type",
        "x_coord",
        "y_coord",
        display.marker(F.col("event_type")).alias("marker"),
        display.marker_size(F.col("event_type")).alias("marker_size"),
        display.team_colour(
            F.col("team_name"), F.col("team_a_name"), F.col("team_b_name")
        ).alias("colour"),
        display.legend_label(F.col("team_name"), F.col("event_type")).alias("legend"),
    )


def action_matrix(actions: DataFrame) -> DataFrame:
    """Points per match, team and event type; a match has at most 100 points."""
    points = F.sort_array(F.collect_list(F.struct("position", "x_coord", "y_coord")))
    return actions.groupBy("match_id", "team_name", "event_type", "legend").agg(
        F.count(F.lit(1)).alias("n"), points.alias("points")
    )


def feed(
    frame: DataFrame,
    teams: DataFrame,
    players: DataFrame,
    limit: int = schemas.FEED_LIMIT,
) -> DataFrame:
    """The newest events of each session under display names."""
    named = with_names(head_per_match(frame, limit), teams, players)
    return named.select(
        "match_id",
        "position",
        F.col("team_name").alias("Team"),
        F.col("player_name").alias("Player"),
        F.col("event_type").alias("Event"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column."""
    return df.select(column).distinct()
