"""Live events for reading by match: a table bucketed by match and split by time range.

A bucket holds whole matches, sorted by match and time, so grouping by match or by key needs no
shuffle, and reading one match scans one bucket. Beside the table stands a small one with the events
of each match by time range: a reader of the newest ``k`` events sees from it which ranges
hold them, and scans no others.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators.recent import latest_per_key, recent_events, recent_events_of_match

RANGE = "time_range"
COLUMNS = schemas.EVENT_SCHEMA.fieldNames()


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Inserts into tables follow the session's setting and no other."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@dataclass(frozen=True)
class EventArchive:
    """``table`` of the catalog; ``seconds`` is the length of a time range."""

    table: str
    path: str
    buckets: int = 64
    seconds: int = 3600

    def _ranged(self, events: DataFrame) -> DataFrame:
        start = F.floor(F.col("timestamp") / self.seconds) * self.seconds
        return events.select(*COLUMNS, start.cast("long").alias(RANGE))

    @property
    def _counts(self) -> str:
        return f"{self.path}/counts"

    def write(self, events: DataFrame) -> None:
        """Write the time ranges of these events anew; others stay as they are.

        ``events`` hold one row per key and, for each time range they touch, all its events.
        """
        spark, rows = events.sparkSession, self._ranged(events)
        placed = rows.repartition(self.buckets, "match_id")
        if spark.catalog.tableExists(self.table):
            with _dynamic_overwrite(spark):
                placed.select(*COLUMNS, RANGE).write.insertInto(self.table, overwrite=True)
        else:
            writer = placed.write.partitionBy(RANGE).bucketBy(self.buckets, "match_id")
            writer = writer.sortBy("match_id", "timestamp").option("path", f"{self.path}/events")
            writer.saveAsTable(self.table)
        counts = rows.groupBy("match_id", RANGE).agg(F.count(F.lit(1)).alias("events"))
        writer = counts.repartition(RANGE).write.mode("overwrite").partitionBy(RANGE)
        writer.option("partitionOverwriteMode", "dynamic").parquet(self._counts)

    def read(self, spark: SparkSession) -> DataFrame:
        """All events, bucketed by match."""
        return spark.table(self.table)

    def latest(self, spark: SparkSession, order: list[str]) -> DataFrame:
        """One row per (match, time), the greatest by ``order``; no shuffle."""
        key = schemas.SERVING_KEYS["live_events"]
        return latest_per_key(self.read(spark).drop(RANGE), key, order, keep_order=True)

    def _first_ranges(self, spark: SparkSession, k: int) -> DataFrame:
        """(match_id, since): the range from which on a match has ``k`` events, or its first."""
        counts = spark.read.parquet(self._counts)
        line = Window.partitionBy("match_id").orderBy(F.col(RANGE).desc())
        newer = F.sum("events").over(line.rowsBetween(Window.unboundedPreceding, -1))
        needed = counts.withColumn("newer", F.coalesce(newer, F.lit(0))).where(F.col("newer") < k)
        return needed.groupBy("match_id").agg(F.min(RANGE).cast("long").alias("since"))

    def newest_of_match(self, spark: SparkSession, match_id: str, k: int = schemas.RECENT_LIMIT) -> DataFrame:
        """The ``k`` newest events of a match, from the buckets and time ranges that hold them."""
        first = self._first_ranges(spark, k).where(F.col("match_id") == match_id).first()
        events = self.read(spark)
        if first is not None:
            events = events.where((F.col(RANGE) >= first["since"]) & (F.col("timestamp") >= first["since"]))
        return recent_events_of_match(events.drop(RANGE), match_id, k)

    def newest(self, spark: SparkSession, k: int = schemas.RECENT_LIMIT) -> DataFrame:
        """The ``k`` newest events of every match; those of older ranges go before any sort."""
        first = self._first_ranges(spark, k)
        events = self.read(spark).join(first, "match_id").where("timestamp >= since")
        return recent_events(events.drop(RANGE, "since"), k)
