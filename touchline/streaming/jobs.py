"""Streaming queries: raw events, quarantine, team windows, enrichment, refresh."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from touchline import schemas
from touchline.functions.eventtime import event_time
from touchline.operators.enrich import of_sessions, with_names_as_of
from touchline.operators.recent import latest_per_key
from touchline.plans import dashboard
from touchline.sources import control, files, messages
from touchline.sources.keyed_log import RUN, KeyedLog
from touchline.sources.tables import dimension_snapshot
from touchline.streaming.counts import PIECE_SCHEMA, WindowCounts, counts_by_piece

#: Types of ``messages.INGEST_COLUMNS``.
INGEST_FIELDS = (
    StructField("ingest_time", TimestampType()),
    StructField("ingest_partition", LongType()),
    StructField("ingest_offset", LongType()),
)

ENRICHED_SCHEMA = StructType(
    [
        *schemas.EVENT_SCHEMA.fields,
        StructField("team_name", StringType()),
        StructField("player_name", StringType()),
        *INGEST_FIELDS,
    ]
)

#: Raw event log: the event and where its message came from. Declared, because a
#: match id read from a folder name would otherwise turn into a number or a date.
RAW_SCHEMA = StructType([*schemas.EVENT_SCHEMA.fields, *INGEST_FIELDS])


@dataclass(frozen=True)
class Trigger:
    """``every`` such as ``1.5 seconds``, or all data at hand and stop."""

    every: str | None = None

    @property
    def options(self) -> dict:
        return {"processingTime": self.every} if self.every else {"availableNow": True}


def team_stats(root: str, policy: str = "latest") -> WindowCounts:
    """The serving table of team counts under the folder of the live tables."""
    return WindowCounts(f"{root}/live_team_stats", policy)


def append_rows(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Trigger = Trigger(),
    partition_by: tuple[str, ...] = (),
) -> StreamingQuery:
    """Append sink in Parquet; the sink's own log makes each batch count once."""
    writer = rows.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return (
        writer.option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger.options)
        .start()
    )


BUCKET = "match_bucket"
#: Match buckets of the raw log of :func:`start_all`.
RAW_BUCKETS = 64
#: Tasks, and so files, a bucket is spread over in a micro-batch; one match may fill it.
BUCKET_SPREAD = 4


def match_bucket(match_id: Column, buckets: int) -> Column:
    """Bucket of a match: a bounded number of folders, however many matches."""
    return F.pmod(F.xxhash64(match_id), F.lit(buckets)).cast("int")


def append_events(
    decoded: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Trigger = Trigger(),
    buckets: int | None = None,
) -> StreamingQuery:
    """Raw event log, split by match or, given ``buckets``, by match bucket.

    With buckets a micro-batch writes ``BUCKET_SPREAD`` files a bucket at most, however
    many matches and tasks it has.
    """
    events = messages.valid_events(decoded).drop("event_time")
    if buckets is None:
        return append_rows(events, path, checkpoint, trigger, ("match_id",))
    bucketed = events.withColumn(BUCKET, match_bucket(F.col("match_id"), buckets))
    share = F.pmod(F.xxhash64("timestamp", "player_id"), F.lit(BUCKET_SPREAD))
    gathered = bucketed.repartition(BUCKET, share)
    return append_rows(gathered, path, checkpoint, trigger, (BUCKET,))


def read_raw_events(
    spark: SparkSession, path: str, buckets: int | None = None
) -> DataFrame:
    """Every row of the raw log, of all runs, with its event time; none gives no rows.

    A message that several runs have read is there once for each.
    """
    return _raw_log(spark, path, buckets).withColumn("event_time", event_time(F.col("timestamp")))


def _raw_log(spark: SparkSession, path: str, buckets: int | None) -> DataFrame:
    schema = RAW_SCHEMA
    if buckets is not None:
        schema = StructType([*RAW_SCHEMA.fields, StructField(BUCKET, IntegerType())])
    runs = files.glob(spark, f"{path}/{RUN}=*")
    if not runs and not files.exists(spark, path):
        return spark.createDataFrame([], schema)
    logs = [spark.read.schema(schema).parquet(log) for log in runs or [path]]
    return reduce(DataFrame.unionByName, logs)


def read_live_events(
    spark: SparkSession,
    path: str,
    match_id: str | None = None,
    buckets: int | None = None,
    sessions: DataFrame | None = None,
    resets: DataFrame | None = None,
    only: list[int] | None = None,
) -> DataFrame:
    """Keyed view of the raw log: one row per (match, timestamp), the last write.

    The log of every run under ``path`` counts; none gives no rows. A match id prunes the
    scan to its folder; ``sessions`` keeps only their matches, before any row is shuffled,
    and with ``buckets`` as written scans only their buckets; ``only`` names buckets to scan;
    ``resets`` hide what came in before them.
    """
    raw = _raw_log(spark, path, buckets)
    if match_id is not None:
        raw = raw.filter(F.col("match_id") == match_id)
        if buckets is not None:
            raw = raw.filter(F.col(BUCKET) == match_bucket(F.lit(match_id), buckets))
    if only is not None and buckets is not None:
        raw = raw.filter(F.col(BUCKET).isin(only))
    if sessions is not None and buckets is not None:
        shown = sessions.select("match_id", match_bucket(F.col("match_id"), buckets).alias(BUCKET))
        raw = raw.join(shown, ["match_id", BUCKET], "left_semi")
    elif sessions is not None:
        raw = of_sessions(raw, sessions)
    if resets is not None:
        raw = control.after_resets(raw, resets)
    columns = RAW_SCHEMA.fieldNames()
    key, order = schemas.SERVING_KEYS["live_events"], messages.INGEST_COLUMNS
    return latest_per_key(raw.select(*columns), key, order, keep_order=True).select(*columns)


def append_quarantine(
    decoded: DataFrame, path: str, checkpoint: str, trigger: Trigger = Trigger()
) -> StreamingQuery:
    """Rows without a usable key, kept as raw text."""
    return append_rows(messages.quarantined(decoded), path, checkpoint, trigger)


def windowed_counts(
    events: DataFrame,
    width: str = schemas.WINDOW_WIDTH,
    slide: str = schemas.WINDOW_SLIDE,
    delay: str = schemas.WATERMARK_DELAY,
) -> DataFrame:
    """Stateful count per sliding window, match and team, by piece, under a watermark."""
    return counts_by_piece(events.withWatermark("event_time", delay), width, slide)


@contextmanager
def fixed_partitions(spark: SparkSession, count: int | None) -> Iterator[None]:
    """Shuffle partitions a query started inside gets; None keeps the session's.

    A query takes over the setting when it starts, and its checkpoint then fixes
    it. Adaptive execution does not merge small partitions of a stateful query,
    so each one costs a task per micro-batch.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if count is not None:
        spark.conf.set(name, str(count))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_counts(
    counts: WindowCounts, run: str, compact_every: int = 0
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback: write the counts that a batch has changed.

    The batch is persisted because it is used twice, for the emptiness test and the write;
    otherwise the stateful plan would run and count dropped rows twice. After every
    ``compact_every`` batches (0: never) they are folded, so that readers never meet a long
    list of small ones.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                counts.write_batch(batch, batch_id, run)
        finally:
            batch.unpersist()
        if compact_every and (batch_id + 1) % compact_every == 0:
            counts.compact(batch.sparkSession, run)

    return write


def start_counts(
    events: DataFrame,
    counts: WindowCounts,
    checkpoint: str,
    width: str = schemas.WINDOW_WIDTH,
    slide: str = schemas.WINDOW_SLIDE,
    delay: str = schemas.WATERMARK_DELAY,
    trigger: Trigger = Trigger(),
    compact_every: int = 100,
    state_partitions: int | None = None,
    run: str = "v1",
) -> StreamingQuery:
    """Update-mode query that keeps the window counts current.

    The checkpoint fixes the number of state partitions; take a new one, and a new
    ``run``, when the window or that number changes. Each checkpoint has a run of its own.
    """
    writer = (
        windowed_counts(events, width, slide, delay)
        .writeStream.outputMode("update")
        .foreachBatch(write_counts(counts, run, compact_every))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger.options)
    )
    with fixed_partitions(events.sparkSession, state_partitions):
        return writer.start()


def enriched_log(path: str) -> KeyedLog:
    """Named events by (match, timestamp); the last message wins, as in the raw log."""
    key, order = schemas.SERVING_KEYS["live_events"], messages.INGEST_COLUMNS
    return KeyedLog(path, ENRICHED_SCHEMA, key, order)


def start_enriched(
    events: DataFrame,
    load_dimensions: Callable[[datetime, datetime], tuple[DataFrame, DataFrame]],
    log: KeyedLog,
    checkpoint: str,
    trigger: Trigger = Trigger(),
    run: str = "v1",
    compact_every: int = 100,
) -> StreamingQuery:
    """Live events with names, each from the dimension version valid when it came in.

    ``load_dimensions`` gets the first and the last ingest time of a batch and returns teams and
    players; versions valid between the two carry ``valid_from`` and ``valid_to``. So the names
    don't depend on when a batch runs, nor on whether it runs again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        low, high = batch.agg(F.min("ingest_time"), F.max("ingest_time")).first()
        if low is not None:
            teams, players = load_dimensions(low, high)
            log.write_batch(with_names_as_of(batch, teams, players), batch_id, run)
        if compact_every and (batch_id + 1) % compact_every == 0:
            log.compact(batch.sparkSession, run)

    return (
        events.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger.options)
        .start()
    )


@dataclass(frozen=True)
class ServingFrames:
    """Small published tables, one folder per version."""

    path: str
    #: Versions that stay; readers of older times get the oldest of them.
    keep: int = 100

    def _versions(self, spark: SparkSession, name: str) -> dict[int, str]:
        markers = files.glob(spark, f"{self.path}/{name}/version=*/_SUCCESS")
        folders = [marker.rsplit("/", 1)[0] for marker in markers]
        return {int(folder.rsplit("=", 1)[1]): folder for folder in folders}

    def publish(self, name: str, frame: DataFrame) -> None:
        """Write the next version; ``frame`` may come from the one before."""
        spark = frame.sparkSession
        stored = self._versions(spark, name)
        version = 1 + max(stored, default=-1)
        frame.write.mode("overwrite").parquet(f"{self.path}/{name}/version={version}")
        for old in sorted(stored)[: 1 - self.keep]:
            files.delete(spark, stored[old])

    def newest(self, spark: SparkSession, name: str) -> int | None:
        return max(self._versions(spark, name), default=None)

    def read(self, spark: SparkSession, name: str, schema: StructType | None = None) -> DataFrame:
        """The newest version; no rows when nothing was published yet."""
        stored = self._versions(spark, name)
        if not stored:
            return spark.createDataFrame([], schema or StructType([]))
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(stored[max(stored)])

    def valid(
        self, spark: SparkSession, name: str, schema: StructType, low: datetime, high: datetime
    ) -> DataFrame:
        """The versions that were valid between two times, with ``valid_from`` and ``valid_to``.

        A version is valid from when it was written until the next one was; the first one
        also before.
        """
        stored = self._versions(spark, name)
        order = sorted(stored)
        times = [files.modified(spark, f"{stored[v]}/_SUCCESS") for v in order]
        spans = [*zip([None, *times[1:]], [*times[1:], None])]
        parts = []
        for (start, end), version in zip(spans, order):
            if (start or 0) <= _millis(high) and (end is None or end > _millis(low)):
                rows = spark.read.schema(schema).parquet(stored[version])
                parts.append(rows.withColumns({"valid_from": _time(start), "valid_to": _time(end)}))
        if not parts:
            none = spark.createDataFrame([], schema)
            return none.withColumns({"valid_from": _time(None), "valid_to": _time(None)})
        return reduce(DataFrame.unionByName, parts)


def _millis(moment: datetime) -> int:
    return int(moment.timestamp() * 1000)


def _time(millis: int | None) -> Column:
    return F.timestamp_millis(F.lit(millis).cast("long"))


Dimensions = tuple[DataFrame, DataFrame]


def published_dimensions(spark: SparkSession, warehouse: str) -> Callable[[datetime, datetime], Dimensions]:
    """``load_dimensions`` of :func:`start_enriched` over what ``load`` has published."""
    stored = ServingFrames(warehouse)

    def load(low: datetime, high: datetime) -> Dimensions:
        tables = (schemas.WAREHOUSE["teams"], schemas.WAREHOUSE["players"])
        return tuple(stored.valid(spark, n, t.schema, low, high) for n, t in zip(("teams", "players"), tables))

    return load


@dataclass(frozen=True)
class ServingViews:
    """Materialised views, split by match bucket; a refresh replaces whole buckets."""

    path: str
    buckets: int = RAW_BUCKETS

    def replace(self, name: str, view: DataFrame, touched: list[int]) -> None:
        """Write the touched buckets anew; ``view`` holds rows of these only."""
        spark, target = view.sparkSession, f"{self.path}/{name}"
        rows = view.withColumn(BUCKET, match_bucket(F.col("match_id"), self.buckets)).persist()
        try:
            kept = {row[0] for row in rows.select(BUCKET).distinct().collect()}
            writer = rows.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET)
            writer.option("partitionOverwriteMode", "dynamic").parquet(target)
        finally:
            rows.unpersist()
        for bucket in set(touched) - kept:
            files.delete(spark, f"{target}/{BUCKET}={bucket}")

    def read(self, spark: SparkSession, name: str, schema: StructType | None = None) -> DataFrame:
        """The rows of a view; none when it was not written yet."""
        if not files.glob(spark, f"{self.path}/{name}/{BUCKET}=*"):
            return spark.createDataFrame([], schema or StructType([]))
        return spark.read.parquet(f"{self.path}/{name}").drop(BUCKET)


def changes(spark: SparkSession, root: str, version: str = "v1") -> DataFrame:
    """The matches that the raw log or the team counts of a version got rows of, as a stream."""
    raw, counted = f"{root}/live_events/{RUN}={version}", team_stats(root).log.path
    for folder in (raw, counted):
        files.make_folder(spark, folder)
    reader = spark.readStream.option("ignoreMissingFiles", True)
    events = reader.schema(RAW_SCHEMA).option("recursiveFileLookup", True).parquet(raw)
    counts = reader.schema(PIECE_SCHEMA).parquet(f"{counted}/{RUN}={version}/batch=*")
    return events.select("match_id").unionByName(counts.select("match_id"))


SHOWN = "shown"
#: Views that are written at the same time; each is small.
WRITERS = 4


def _touched(
    batch: DataFrame, shown: DataFrame, before: DataFrame, buckets: int
) -> list[int]:
    """Buckets of the shown matches that have changed: by a row of the batch, or themselves."""
    own = batch.join(shown.select("match_id"), "match_id", "left_semi").select("match_id")
    parts = [own]
    if before.columns:
        before = before.select(*shown.columns)
        parts += [x.exceptAll(y).select("match_id") for x, y in ((shown, before), (before, shown))]
    else:
        parts.append(shown.select("match_id"))
    numbers = [part.select(match_bucket(F.col("match_id"), buckets).alias(BUCKET)) for part in parts]
    return sorted(row[0] for row in reduce(DataFrame.unionByName, numbers).distinct().collect())


def start_refresh(
    changed: DataFrame,
    load_shown: Callable[[], DataFrame],
    load_inputs: Callable[[DataFrame, list[int]], dashboard.Inputs],
    serving: ServingViews,
    checkpoint: str,
    trigger: Trigger = Trigger("1.5 seconds"),
) -> StreamingQuery:
    """Keep the dashboard views current: only the buckets with changed matches are rebuilt.

    ``changed`` is a stream of match ids. ``load_shown`` gives the sessions on show as they are
    now, with whatever columns tell that their views must be built anew; it is compared
    with what was shown before. ``load_inputs`` gets the sessions of the touched
    buckets, and the buckets. The views share the live frame, which is persisted while they are
    written.
    """

    def rebuild(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        shown = load_shown().persist()
        try:
            touched = _touched(batch, shown, serving.read(spark, SHOWN, shown.schema), serving.buckets)
            if not touched:
                return
            own = shown.where(match_bucket(F.col("match_id"), serving.buckets).isin(touched))
            inputs = load_inputs(own, touched)
            frame = dashboard.live_frame(inputs).persist()
            try:
                frame.count()  # before the views, which are written side by side
                with ThreadPoolExecutor(WRITERS) as pool:
                    views = dashboard.views(inputs, frame).items()
                    list(pool.map(lambda view: serving.replace(*view, touched), views))
            finally:
                frame.unpersist()
            # At the end: a replay after a failure finds the same changes.
            serving.replace(SHOWN, own, touched)
        finally:
            shown.unpersist()

    return (
        changed.writeStream.foreachBatch(rebuild)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger.options)
        .start()
    )


def start_views(
    spark: SparkSession,
    root: str,
    warehouse: str,
    trigger: Trigger = Trigger("1.5 seconds"),
    version: str = "v1",
    buckets: int = RAW_BUCKETS,
) -> StreamingQuery:
    """The dashboard views of the deployed sessions, under ``views``.

    A new event, a deployed or reset session and a load of history reach them with the next
    batch: a load changes all views, anything else those of its match's bucket.
    """
    stored = ServingFrames(warehouse)
    dimensions = ("teams", "players", "average")

    def load_shown() -> DataFrame:
        sessions = control.read_sessions(spark, f"{root}/control")
        resets = control.read_resets(spark, f"{root}/resets")
        last = resets.groupBy("match_id").agg(F.max("reset_at").alias("reset_at"))
        loaded = ",".join(str(stored.newest(spark, name)) for name in dimensions)
        return sessions.join(last, "match_id", "left").withColumn("loaded", F.lit(loaded))

    def load_inputs(sessions: DataFrame, touched: list[int]) -> dashboard.Inputs:
        tables = [stored.read(spark, n, schemas.WAREHOUSE[n].schema) for n in ("teams", "players")]
        teams, players = dimension_snapshot(*tables)
        known = stored.newest(spark, "average") is not None
        average = stored.read(spark, "average") if known else None
        return dashboard.Inputs(
            live=read_live_events(
                spark,
                f"{root}/live_events",
                buckets=buckets,
                sessions=sessions,
                resets=control.read_resets(spark, f"{root}/resets"),
                only=touched,
            ),
            stats=team_stats(root).read(spark),
            sessions=sessions,
            teams=teams,
            players=players,
            facts=spark.createDataFrame([], schemas.FACTS.schema),
            average=average,
        )

    return start_refresh(
        changes(spark, root, version),
        load_shown,
        load_inputs,
        ServingViews(f"{root}/views", buckets),
        f"{root}/checkpoints/{version}/views",
        trigger,
    )


def start_all(
    source: DataFrame,
    root: str,
    trigger: Trigger = Trigger(),
    version: str = "v1",
    buckets: int | None = RAW_BUCKETS,
    state_partitions: int | None = None,
) -> list[StreamingQuery]:
    """Raw log, quarantine and team counts as concurrent queries on one source.

    Each query reads the source for itself and has its own checkpoint; a new
    ``version`` starts afresh, beside the outputs of the earlier ones. Wait with
    :func:`await_any`. ``buckets=None`` splits the raw log by match.
    """
    decoded = messages.decode(source)
    events = messages.valid_events(decoded)
    checkpoint = f"{root}/checkpoints/{version}"
    raw, bad = f"{root}/live_events/{RUN}={version}", f"{root}/quarantine/{RUN}={version}"
    return [
        append_events(decoded, raw, f"{checkpoint}/raw", trigger, buckets),
        append_quarantine(decoded, bad, f"{checkpoint}/quarantine", trigger),
        start_counts(
            events,
            team_stats(root),
            f"{checkpoint}/stats",
            trigger=trigger,
            state_partitions=state_partitions,
            run=version,
        ),
    ]


def await_any(spark: SparkSession, timeout: float | None = None) -> None:
    """Block until one of the running queries ends; its error is raised."""
    if timeout is None:
        spark.streams.awaitAnyTermination()
    else:
        spark.streams.awaitAnyTermination(timeout)


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows dropped as too late, over the progress reports still kept."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
