"""Warehouse tables in Parquet: creation, clustered append, snapshots."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline import schemas
from touchline.schemas import WarehouseTable


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def _create_table(
    spark: SparkSession, name: str, schema: StructType, properties: dict[str, str]
) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    options = ", ".join(f"'{k}'='{v}'" for k, v in properties.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet TBLPROPERTIES ({options})"
    )


def _create_all(
    spark: SparkSession, database: str, location: str | None, made: dict[str, WarehouseTable]
) -> None:
    create_database(spark, database, location)
    for table in made.values():
        _create_table(
            spark,
            f"{database}.{table.name}",
            table.schema,
            {"touchline.sort_key": ",".join(table.sort_key)},
        )


def create_warehouse(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database and its four tables where they do not exist."""
    _create_all(spark, database, location, schemas.WAREHOUSE)


def create_dictionaries(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the tables of code dictionaries where they do not exist."""
    _create_all(spark, database, location, schemas.DICTIONARIES)


def create_serving(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the two serving tables; their keys are table properties."""
    create_database(spark, database, location)
    for name, schema in (
        ("live_events", schemas.EVENT_SCHEMA),
        ("live_team_stats", schemas.TEAM_STATS_SCHEMA),
    ):
        key = ",".join(schemas.SERVING_KEYS[name])
        _create_table(spark, f"{database}.{name}", schema, {"touchline.key": key})


def laid_out(rows: DataFrame, table: WarehouseTable, layout: str = "sorted") -> DataFrame:
    """Order rows by the table's sort key, so that file statistics prune reads.

    ``sorted`` orders the rows of each task where they are: no shuffle, every
    file is sorted by itself. ``ranged`` also splits the key range over the files,
    for one shuffle and a sampling pass. That split runs over all columns: rows of
    one hot match or player are spread over many files instead of one.
    """
    if layout == "ranged":
        rest = [c for c in table.columns if c not in table.sort_key]
        rows = rows.repartitionByRange(*table.sort_key, *rest)
    elif layout != "sorted":
        raise ValueError(f"unknown layout: {layout}")
    return rows.sortWithinPartitions(*table.sort_key)


@dataclass(frozen=True)
class AppendReport:
    """What an append wrote."""

    target: str
    rows: int


def append(
    rows: DataFrame, target: str, table: WarehouseTable, layout: str = "sorted"
) -> AppendReport:
    """Append to a table or path (one with a slash); counts while writing."""
    seen = Observation()
    # counted last: the sampling pass of a range split would count rows twice
    ordered = laid_out(rows.select(*table.columns), table, layout)
    writer = ordered.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append")
    if "/" in target:
        writer.parquet(target)
    else:
        writer.insertInto(target)
    return AppendReport(target, seen.get["rows"])


def replace(rows: DataFrame, target: str) -> None:
    """Replace the rows of a table; ``rows`` must not come from it."""
    columns = rows.sparkSession.table(target).columns
    rows.select(*columns).write.insertInto(target, overwrite=True)


def dimension_snapshot(teams: DataFrame, players: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The dimension columns live views read, ids as text.

    Not cached or hinted here: Spark broadcasts them by their file size, and a
    later reload is seen. Call ``.cache()`` to freeze them.
    """
    return (
        teams.select(F.col("team_id").cast("string"), "official_name"),
        players.select(
            F.col("player_id").cast("string"),
            "short_name",
            F.col("currentTeamId").cast("string"),
        ),
    )
