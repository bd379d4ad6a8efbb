"""Eleven players for every team, and line-ups for every session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators.recent import top_k

PLAYER_ORDER = "player_id"


def current_members(players: DataFrame) -> DataFrame:
    """Tier 1: distinct players by their current team."""
    return (
        players.filter((F.col("currentTeamId") != "") & (F.col("player_id") != ""))
        .groupBy(F.col("currentTeamId").alias("team_id"), "player_id")
        .agg(F.min("short_name").alias("short_name"))
    )


def seen_in_facts(facts: DataFrame) -> DataFrame:
    """Tier 2: distinct (team, player) pairs of the historical events that name both."""
    named = (F.col("team_id") != "") & (F.col("player_id") != "")
    return facts.filter(named).select("team_id", "player_id").distinct()


def first_players(players: DataFrame, n: int) -> DataFrame:
    """Tier 3: the first ``n`` players of all, numbered from 1."""
    pool = players.filter(F.col("player_id") != "").groupBy("player_id").agg(F.min("short_name").alias("short_name"))
    first = pool.orderBy(PLAYER_ORDER).limit(n)
    # n rows at most: numbering them needs one array, not a global window
    rows = first.agg(F.sort_array(F.collect_list(F.struct("player_id", "short_name"))).alias("p"))
    return rows.select(F.posexplode("p").alias("at", "player")).select(
        (F.col("at") + 1).alias("pool_rank"), "player.*"
    )


def roster(
    teams: DataFrame,
    players: DataFrame,
    facts: DataFrame,
    squad_size: int = schemas.SQUAD_SIZE,
) -> DataFrame:
    """Exactly ``squad_size`` players per team, best tier first, then player id.

    Each tier needs no more than its first ``squad_size`` players: if c players
    of better tiers are in the squad, at most c of them repeat, and the rest
    still fill it. So every tier is cut per team before it meets the others, and
    names of tier 2 are joined after the cut. Free places get synthetic players.
    Tiers 1 and 2 come out of aggregates, spread over the shuffle partitions:
    each of those sends at most ``squad_size`` rows per team to the final cut.
    """
    by_player = [F.col(PLAYER_ORDER)]
    ids = teams.select("team_id").distinct()

    members = current_members(players)
    tier1 = top_k(members, ["team_id"], by_player, squad_size, fan_in=0)
    tier1 = tier1.select("team_id", "player_id", "short_name", F.lit(1).alias("tier"))

    seen = top_k(seen_in_facts(facts), ["team_id"], by_player, squad_size, fan_in=0)
    names = players.select("player_id", "short_name")
    tier2 = seen.join(names, "player_id", "left").select(
        "team_id", "player_id", F.coalesce("short_name", F.lit("")), F.lit(2)
    )

    places = ids.withColumn("pool_rank", F.explode(F.sequence(F.lit(1), F.lit(squad_size))))
    pool = F.broadcast(first_players(players, squad_size))  # squad_size rows by its limit
    tier3 = places.join(pool, "pool_rank").select(
        "team_id", "player_id", "short_name", F.lit(3)
    )

    # at most three times squad_size candidates per team from here on
    candidates = (
        tier1.unionByName(tier2.toDF(*tier1.columns))
        .unionByName(tier3.toDF(*tier1.columns))
        .groupBy("team_id", "player_id")
        .agg(F.min_by("short_name", "tier").alias("short_name"), F.min("tier").alias("tier"))
    )
    ranked = top_k(
        candidates,
        ["team_id"],
        [F.col("tier"), F.col(PLAYER_ORDER)],
        squad_size,
        rank="number",
        fan_in=0,
    )
    slots = ids.withColumn("number", F.explode(F.sequence(F.lit(1), F.lit(squad_size))))
    number = F.col("number").cast("string")
    return slots.join(ranked, ["team_id", "number"], "left").select(
        "team_id",
        (F.col("number") - 1).alias("slot"),
        F.coalesce("player_id", F.concat(F.lit("SYN_"), "team_id", F.lit("_"), number)).alias(
            "player_id"
        ),
        F.coalesce("short_name", F.concat(F.lit("Player "), number)).alias("player_name"),
        F.coalesce("tier", F.lit(4)).alias("tier"),
    )


def _formation(points) -> Column:
    return F.array(
        *[F.struct(F.lit(x).alias("base_x"), F.lit(y).alias("base_y")) for x, y in points]
    )


def lineup(squads: DataFrame, sessions: DataFrame) -> DataFrame:
    """Base position of every player of a session, by slot and side.

    A player in both squads is placed once, for side B. The 22 positions are
    literals, so the slot lookup needs no join.
    """
    sides = sessions.select(
        "match_id",
        F.explode(
            F.array(
                F.struct(F.lit("A").alias("side"), F.col("team_a_id").alias("team_id")),
                F.struct(F.lit("B").alias("side"), F.col("team_b_id").alias("team_id")),
            )
        ).alias("s"),
    ).select("match_id", "s.*")
    table = F.when(F.col("side") == "A", _formation(schemas.FORMATION_A)).otherwise(
        _formation(schemas.FORMATION_B)
    )
    placed = sides.join(squads, "team_id").withColumn(
        "place", F.element_at(table, F.col("slot") + 1)
    )
    kept = F.max_by(F.struct("side", "team_id", "slot", "player_name", "place.*"), "side")
    return (
        placed.groupBy("match_id", "player_id")
        .agg(kept.alias("p"))
        .select("match_id", "player_id", "p.*")
    )
