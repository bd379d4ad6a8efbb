"""The serving table of window counts, kept by the piece of the source that was counted.

A piece is a stretch of ``PIECE`` offsets of a partition of the source; a file is a partition.
The stream counts events by window, match, team and piece, and tells which offsets it has seen.
So counts of several checkpoints can be put together, whatever part of the source each has
read: where two of them have counted the same offsets, one counts, and counts of different
offsets add up. A new checkpoint that starts at the newest message goes on where the one before
it left off, one that reads everything again counts nothing twice, and an older one may be
started again at any time, also beside a newer one.

Two checkpoints that overlap in part inside a piece count as the larger of them there; a Kafka
start at given offsets is exact when these are multiples of ``PIECE``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from touchline import schemas
from touchline.operators.windows import KEYS
from touchline.sources import files
from touchline.sources.keyed_log import RUN, KeyedLog

#: Offsets of a piece.
PIECE = 1 << 17
WINDOW = (*KEYS, "window_start", "window_end")
PLACE = ("ingest_partition", "piece")

PIECE_SCHEMA = StructType(
    [
        *schemas.TEAM_WINDOW_SCHEMA.fields,
        *[StructField(c, LongType()) for c in (*PLACE, "first_offset", "last_offset")],
        StructField(RUN, StringType()),
    ]
)
CLEARED_SCHEMA = StructType(
    [*schemas.TEAM_WINDOW_SCHEMA.fields, StructField("cleared_at", TimestampType())]
)


def counts_by_piece(events: DataFrame, width: str, slide: str) -> DataFrame:
    """One stateful aggregate: events by window, key and piece, and the offsets seen."""
    piece = F.floor(F.col("ingest_offset") / PIECE).alias("piece")
    window = F.window("event_time", width, slide).alias("window")
    return (
        events.groupBy(window, *KEYS, "ingest_partition", piece)
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.min("ingest_offset").alias("first_offset"),
            F.max("ingest_offset").alias("last_offset"),
        )
        .select(
            *KEYS,
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "total_events",
            *PLACE,
            "first_offset",
            "last_offset",
        )
    )


def put_together(pieces: DataFrame) -> DataFrame:
    """Events per window and team, from counts of several runs.

    Inside a piece, runs whose offsets overlap have counted the same events: the largest of
    them counts. The others add up.
    """
    line = Window.partitionBy(*WINDOW, *PLACE).orderBy("first_offset", "last_offset", RUN)
    before = F.max("last_offset").over(line.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce((F.col("first_offset") > before).cast("int"), F.lit(1))
    stretch = F.sum("starts").over(line).alias("stretch")
    return (
        pieces.withColumn("starts", starts)
        .select(*WINDOW, *PLACE, "total_events", stretch)
        .groupBy(*WINDOW, *PLACE, "stretch")
        .agg(F.max("total_events").alias("total_events"))
        .groupBy(*WINDOW)
        .agg(F.sum("total_events").alias("total_events"))
    )


def newest_windows(rows: DataFrame) -> DataFrame:
    """The rows of the window with the greatest end, per match and team.

    The ends are an aggregate, and rows meet them by key and end: no task gets all windows of a
    team, which may be most of the table.
    """
    ends = rows.groupBy(*KEYS).agg(F.max("window_end").alias("window_end"))
    newest = ends.select(*[F.col(c).alias(f"newest_{c}") for c in ends.columns])
    same = [F.col(c).eqNullSafe(F.col(f"newest_{c}")) for c in KEYS]
    found = reduce(lambda x, y: x & y, same, F.col("window_end") == F.col("newest_window_end"))
    return rows.join(newest, found, "left_semi")


@dataclass(frozen=True)
class WindowCounts:
    """Counts under a policy: ``latest`` and ``max`` serve one window per match and team, the one
    with the greatest end or the fullest one; ``all`` serves every window."""

    path: str
    policy: str = "latest"

    def __post_init__(self):
        if self.policy not in ("latest", "max", "all"):
            raise ValueError(f"unknown window policy: {self.policy}")

    @property
    def log(self) -> KeyedLog:
        return KeyedLog(f"{self.path}/counts", PIECE_SCHEMA, (*WINDOW, *PLACE, RUN))

    def write_batch(self, rows: DataFrame, batch_id: int, run: str = "v1") -> bool:
        return self.log.write_batch(rows.withColumn(RUN, F.lit(run)), batch_id, run)

    def compact(self, spark: SparkSession, run: str) -> None:
        """Fold the batches of a run; windows that can't be served any more go."""
        if self.policy == "latest":
            self.log.compact(spark, run, newest_windows)
        else:
            self.log.compact(spark, run)

    def read(self, spark: SparkSession) -> DataFrame:
        """match_id, team, window_start, window_end, total_events."""
        pieces = self.log.read(spark, newest_windows) if self.policy == "latest" else self.log.read(spark)
        counts = self._without_cleared(put_together(pieces))
        if self.policy == "max":
            best = F.max(F.struct("total_events", "window_end", "window_start")).alias("best")
            counts = counts.groupBy(*KEYS).agg(best).select(*KEYS, "best.*")
        return counts.select(*schemas.TEAM_WINDOW_SCHEMA.fieldNames())

    def clear(self, spark: SparkSession, match_id: str) -> None:
        """Let the counts of a match start again from zero.

        Streams and their state go on. What they have counted so far is written down by
        window, and taken off when the table is read.
        """
        own = self.log.read(spark).where(F.col("match_id") == match_id)
        rows = put_together(own).withColumn("cleared_at", F.current_timestamp())
        rows.select(*CLEARED_SCHEMA.fieldNames()).coalesce(1).write.mode("append").parquet(
            f"{self.path}/cleared"
        )

    def _without_cleared(self, counts: DataFrame) -> DataFrame:
        spark = counts.sparkSession
        if not files.exists(spark, f"{self.path}/cleared"):
            return counts
        rows = spark.read.schema(CLEARED_SCHEMA).parquet(f"{self.path}/cleared")
        last = rows.groupBy(*WINDOW).agg(F.max_by("total_events", "cleared_at").alias("cleared"))
        left = F.col("total_events") - F.coalesce("cleared", F.lit(0))
        joined = counts.join(last, [*WINDOW], "left").withColumn("total_events", left)
        return joined.where("total_events > 0").drop("cleared")

    def late_rows(
        self,
        events: DataFrame,
        width: str = schemas.WINDOW_WIDTH,
        slide: str = schemas.WINDOW_SLIDE,
    ) -> DataFrame:
        """The events of the raw log that came too late for a window, each with that window.

        An event is on time for a window if a run has counted its offset there: within a
        partition, what comes after the last counted offset of a window came behind the
        watermark. So rows on time and late rows together are all rows.
        """
        if self.policy != "all":
            raise ValueError("only a table that keeps all windows tells late events")
        window = F.window("event_time", width, slide).alias("window")
        piece = F.floor(F.col("ingest_offset") / PIECE).alias("piece")
        placed = events.select("*", window, piece)
        own = placed.select(
            *events.columns,
            "piece",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
        )
        place = [*WINDOW, *PLACE]
        counted = self.log.read(events.sparkSession).select(*place, "first_offset", "last_offset")
        same = reduce(lambda x, y: x & y, [F.col(f"e.{c}").eqNullSafe(F.col(f"c.{c}")) for c in place])
        seen = F.col("e.ingest_offset").between(F.col("c.first_offset"), F.col("c.last_offset"))
        late = own.alias("e").join(counted.alias("c"), same & seen, "left_anti")
        return late.drop("piece")

    def truncate(self, spark: SparkSession) -> None:
        """Remove every row of the table."""
        files.delete(spark, self.path)
