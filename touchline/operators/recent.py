"""Top-k and latest-per-key, safe for a key that holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline import schemas

#: Input partitions whose survivors one task merges in the first step of top-k.
MERGE_FAN_IN = 1024


def top_k(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank: str = "rank",
    fan_in: int = MERGE_FAN_IN,
) -> DataFrame:
    """The first ``k`` rows of every key by ``order``, numbered in ``rank``.

    Each input partition first cuts its rows to ``k`` per key (Spark's window
    group limit). A large input has many partitions, and a key found in all of
    them would still overload one task. So the survivors merge in two steps, at
    every size: first within groups of ``fan_in`` neighbouring input partitions,
    each at most ``k * fan_in`` rows, then the ``k`` of every group. Rows equal in
    ``order`` compare by their other columns, so the result does not depend on the
    grouping.

    ``fan_in=0`` leaves out the first step, for inputs with few partitions. Spark
    plans no group limit for a ``k`` above its threshold; then every group is one
    input partition.
    """
    order = [*order, *[F.col(c) for c in df.columns if c not in keys]]
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if k > threshold:
        fan_in = min(fan_in, 1)
    ranked = df
    if fan_in:
        group = "__merge_group"
        near = Window.partitionBy(*keys, group).orderBy(*order)
        ranked = (
            df.withColumn(group, F.floor(F.spark_partition_id() / fan_in))
            .withColumn(rank, F.row_number().over(near))
            .filter(F.col(rank) <= k)
            .drop(rank, group)
        )
    whole = Window.partitionBy(*keys).orderBy(*order)
    return ranked.withColumn(rank, F.row_number().over(whole)).filter(F.col(rank) <= k)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], keep_order: bool = False
) -> DataFrame:
    """One row per key: the one greatest by ``order``.

    Rows equal in that compare by their other columns, so the choice never
    depends on where a row was read. A plain aggregate: every partition sends at
    most one row per key to the shuffle.
    """
    values = [c for c in df.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *values)).alias("__row")
    kept = [c for c in df.columns if c not in keys and (keep_order or c not in order)]
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col("__row")[c].alias(c) for c in kept])


def recent_events(
    events: DataFrame,
    k: int = schemas.RECENT_LIMIT,
    fan_in: int = MERGE_FAN_IN,
) -> DataFrame:
    """The ``k`` newest events of every match; ``recency`` 1 is the newest."""
    order = [F.col("timestamp").desc(), F.col("player_id"), F.col("event_type")]
    return top_k(events, ["match_id"], order, k, rank="recency", fan_in=fan_in)


def recent_events_of_match(
    events: DataFrame, match_id: str, k: int = schemas.RECENT_LIMIT
) -> DataFrame:
    """The ``k`` newest events of one match, newest first."""
    return (
        events.filter(F.col("match_id") == match_id)
        .orderBy(F.col("timestamp").desc(), "player_id", "event_type")
        .limit(k)
    )


def head_per_match(frame: DataFrame, n: int, rank: str = "position") -> DataFrame:
    """The ``n`` newest rows per match of a frame that carries ``recency``."""
    order = Window.partitionBy("match_id").orderBy("recency")
    return frame.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= n)


def last_positions(frame: DataFrame) -> DataFrame:
    """Last known position of each player of a team in a match."""
    order = Window.partitionBy("match_id", "team", "player_id").orderBy("recency")
    return (
        frame.withColumn("__n", F.row_number().over(order)).filter(F.col("__n") == 1).drop("__n")
    )


def most_recent_players(positions: DataFrame, n: int = schemas.SQUAD_SIZE) -> DataFrame:
    """The ``n`` most recently active players per team of a match."""
    order = Window.partitionBy("match_id", "team").orderBy("recency")
    return positions.withColumn("squad_rank", F.row_number().over(order)).filter(
        F.col("squad_rank") <= n
    )
