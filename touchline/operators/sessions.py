"""Match set-up: team selection and the sessions the views work on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline import schemas


def team_options(teams: DataFrame, load_order: str | None = None) -> DataFrame:
    """Selectable names with their team id, by name in code-point order.

    Of teams sharing a name the one loaded last is kept; without a load order, the one
    with the greatest id, digits by their value.
    """
    by_id = F.struct(F.length("team_id"), "team_id")
    order = F.col(load_order) if load_order else by_id
    return (
        teams.groupBy("official_name")
        .agg(F.max_by("team_id", order).alias("team_id"))
        .orderBy("official_name")
    )


def default_pair(options: DataFrame) -> DataFrame:
    """The two names picked by default: the first ones."""
    return options.orderBy("official_name").limit(2)


def resolve_sessions(
    documents: DataFrame, default_session: str = schemas.DEFAULT_SESSION
) -> DataFrame:
    """Control documents as sessions: ids as text, a missing session id filled."""
    known = set(documents.columns)
    columns = {
        name: F.col(name).cast("string") if name in known else F.lit(None).cast("string")
        for name in schemas.MATCH_CONFIG_SCHEMA.fieldNames()
    }
    columns["match_session_id"] = F.coalesce(columns["match_session_id"], F.lit(default_session))
    return documents.select(*[c.alias(n) for n, c in columns.items()]).withColumnRenamed(
        "match_session_id", "match_id"
    )


def new_session(
    options: DataFrame, name_a: str, name_b: str
) -> DataFrame:
    """Control document of a new session with a random id of 12 characters."""
    picked = options.filter(F.col("official_name").isin(name_a, name_b)).agg(
        *[
            F.max(F.when(F.col("official_name") == name, F.col("team_id"))).alias(f"team_{s}_id")
            for s, name in (("a", name_a), ("b", name_b))
        ]
    )
    return picked.select(
        "team_a_id",
        F.lit(name_a).alias("team_a_name"),
        "team_b_id",
        F.lit(name_b).alias("team_b_name"),
        F.substring(F.uuid(), 1, 12).alias("match_session_id"),
    )
