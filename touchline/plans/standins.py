"""The given star-schema tables in the shape of the engine's own tables.

No table is cut: every adapter maps all rows. Misses on the dimension side come
from the data itself (there is no region 5, and fewer suppliers than users).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.functions.eventtime import epoch_seconds, event_time

EVENT_NAMES = {
    "click": "pass",
    "purchase": "shot",
    "signup": "interception",
    "error": "foul",
}
TEAM_COUNT = 6


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file footer once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def live_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live events: a match per day, six teams, players are the users."""
    renamed = F.col("event_type")
    for source, target in EVENT_NAMES.items():
        renamed = F.when(F.col("event_type") == source, target).otherwise(renamed)
    return (
        table(spark, sf_dir, "events")
        .select(
            "event_id",
            F.col("ts").cast("date").cast("string").alias("match_id"),
            epoch_seconds(F.col("ts")).alias("timestamp"),
            (F.col("user_id") % TEAM_COUNT).cast("string").alias("team"),
            _text("user_id").alias("player_id"),
            renamed.alias("event_type"),
            F.least(F.lit(100.0), F.col("value")).alias("x_coord"),
            F.get_json_object("props", "$.k").cast("double").alias("y_coord"),
        )
        .withColumn("event_time", event_time(F.col("timestamp")))
    )


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams 0 to 4; team 5 has no row."""
    return table(spark, sf_dir, "region").select(
        _text("r_regionkey").alias("team_id"), F.col("r_name").alias("official_name")
    )


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players by supplier; users beyond the suppliers have no row."""
    return table(spark, sf_dir, "supplier").select(
        _text("s_suppkey").alias("player_id"),
        F.regexp_replace("s_name", "#", " ").alias("short_name"),
        _text("s_nationkey").alias("currentTeamId"),
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session per match; its two teams follow from the day of the month."""
    days = (
        table(spark, sf_dir, "events")
        .select(F.col("ts").cast("date").cast("string").alias("match_id"))
        .distinct()
        .withColumn("day", F.substring("match_id", 9, 2).cast("int"))
    )
    pairs = days.select(
        "match_id",
        (F.col("day") % TEAM_COUNT).cast("string").alias("team_a_id"),
        ((F.col("day") + 1) % TEAM_COUNT).cast("string").alias("team_b_id"),
    )
    for side in ("a", "b"):
        names = teams(spark, sf_dir).toDF(f"team_{side}_id", f"team_{side}_name")
        pairs = pairs.join(names, f"team_{side}_id", "left").withColumn(
            f"team_{side}_name",
            F.coalesce(f"team_{side}_name", F.concat(F.lit("Team "), f"team_{side}_id")),
        )
    return pairs.select("match_id", "team_a_id", "team_a_name", "team_b_id", "team_b_name")


def fact_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historical events as a CSV file holds them: text, some ids as floats."""
    return table(spark, sf_dir, "lineitem").select(
        _text("l_orderkey").alias("matchId"),
        _text("l_linenumber").alias("eventId"),
        F.col("l_returnflag").alias("eventName"),
        F.when(F.col("l_linestatus") == "O", "NA")
        .otherwise(F.col("l_linestatus"))
        .alias("subEventName"),
        F.concat(_text("l_partkey"), F.lit(".0")).alias("playerId"),
        _text("l_suppkey").alias("teamId"),
        _text("l_quantity").alias("eventSec"),
        F.col("l_shipdate").cast("string").alias("unused"),
    )


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historical events in the warehouse schema's key columns."""
    return table(spark, sf_dir, "lineitem").select(
        _text("l_orderkey").alias("match_id"),
        F.col("l_returnflag").alias("event_name"),
        _text("l_partkey").alias("player_id"),
        _text("l_suppkey").alias("team_id"),
    )


def player_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.concat(_text("c_custkey"), F.lit(".0")).alias("wyId"),
        F.col("c_name").alias("shortName"),
        F.col("c_mktsegment").alias("firstName"),
        _text("c_acctbal").alias("lastName"),
        F.when(F.col("c_mktsegment") == "BUILDING", "nan")
        .otherwise("1990-01-01")
        .alias("birthDate"),
        F.concat(_text("c_nationkey"), F.lit(".0")).alias("currentTeamId"),
    )


def team_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.lit("a city, quoted").alias("city"),
        F.col("n_name").alias("name"),
        _text("n_nationkey").alias("wyId"),
        F.concat(F.col("n_name"), F.lit(" FC")).alias("officialName"),
        F.lit("{'name': 'x'}").alias("area"),
        F.lit("club").alias("type"),
    )


def match_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches with good, fractional, padded and unreadable game weeks."""
    key, priority = _text("o_orderkey"), F.col("o_orderpriority")
    week = (
        F.when(priority == "1-URGENT", key)
        .when(priority == "2-HIGH", F.concat(key, F.lit(".7")))
        .when(priority == "3-MEDIUM", F.concat(F.lit(" "), key, F.lit(" ")))
        .when(priority == "4-NOT SPECIFIED", "x")
    )
    return table(spark, sf_dir, "orders").select(
        key.alias("wyId"),
        F.concat(priority, F.lit(", 1 - 0")).alias("label"),
        F.col("o_orderdate").cast("date").cast("string").alias("dateutc"),
        _text("o_custkey").alias("competitionId"),
        F.col("o_orderstatus").alias("seasonId"),
        week.alias("gameweek"),
    )


def roster_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(_text("s_suppkey").alias("team_id"))


def roster_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players spread unevenly, so that some teams have fewer than eleven."""
    return table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("player_id"),
        F.col("c_name").alias("short_name"),
        F.floor(F.col("c_acctbal") / 100).cast("string").alias("currentTeamId"),
    )


def roster_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historical events of nine teams; most of their players have no name."""
    return table(spark, sf_dir, "lineitem").select(
        F.floor(F.col("l_tax") * 100 + 0.5).cast("string").alias("team_id"),
        _text("l_partkey").alias("player_id"),
    )


def roster_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("match_id"),
        _text("s_suppkey").alias("team_a_id"),
        _text("s_nationkey").alias("team_b_id"),
    )


def control_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control documents with numeric team ids; urgent ones lack a session id."""
    return table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") % 25).alias("team_a_id"),
        F.col("o_orderpriority").alias("team_a_name"),
        (F.col("o_custkey") % 25).alias("team_b_id"),
        F.col("o_orderstatus").alias("team_b_name"),
        F.when(F.col("o_orderpriority") != "1-URGENT", _text("o_orderkey")).alias(
            "match_session_id"
        ),
    )
