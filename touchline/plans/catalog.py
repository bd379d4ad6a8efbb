"""One registered query per operator or composition."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions import coerce, display
from touchline.operators import (
    baseline,
    enrich,
    labels,
    normalise,
    pitch,
    possession,
    recent,
    roster,
    spells,
    windows,
)
from touchline.operators import sessions as match_setup
from touchline.operators.windows import KEYS
from touchline.plans import dashboard, standins
from touchline.session import scratch_path
from touchline.sources import control, csvfiles, messages, tables
from touchline.sources.archive import EventArchive
from touchline.sources.keyed_log import KeyedLog
from touchline.streaming import jobs, replay
from touchline.streaming import spells as spells_stream
from touchline.streaming.counts import WindowCounts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Wide windows: at the small scales a minute rarely holds two events.
WIDE = {"width": "6 hours", "slide": "1 hour"}


def _utc(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def query(function: Query) -> Query:
    """Register a query under its name; it runs with UTC as session time zone."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _utc(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def _without_zone(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _windows(df: DataFrame) -> DataFrame:
    return _without_zone(df, "window_start", "window_end")


def _dimensions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return tables.dimension_snapshot(
        standins.teams(spark, sf_dir), standins.players(spark, sf_dir)
    )


def _frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.live_frame(
        standins.live_events(spark, sf_dir).drop("event_id", "event_time"),
        standins.sessions(spark, sf_dir),
    )


# --- windows and possession ---------------------------------------------------


@query
def sliding_window_counts(spark, sf_dir):
    return _windows(windows.sliding_window_counts(standins.live_events(spark, sf_dir)))


@query
def sliding_window_counts_6h(spark, sf_dir):
    return _windows(windows.sliding_window_counts(standins.live_events(spark, sf_dir), **WIDE))


@query
def tumbling_window_counts(spark, sf_dir):
    events = standins.live_events(spark, sf_dir)
    return _windows(windows.sliding_window_counts(events, "1 hour", "1 hour"))


@query
def latest_window_per_team(spark, sf_dir):
    return _windows(windows.latest_window(standins.live_events(spark, sf_dir), **WIDE))


@query
def latest_window_aligned(spark, sf_dir):
    events = standins.live_events(spark, sf_dir)
    return _windows(windows.latest_window(events, **WIDE, aligned=True))


@query
def max_window_per_team(spark, sf_dir):
    return _windows(windows.max_window(standins.live_events(spark, sf_dir), **WIDE))


@query
def rolling_window_per_team(spark, sf_dir):
    return _windows(windows.rolling_counts(standins.live_events(spark, sf_dir), "6 hours"))


def _possession(spark: SparkSession, sf_dir: str, policy: str) -> DataFrame:
    stats = windows.team_stats(standins.live_events(spark, sf_dir), policy, **WIDE)
    return possession.possession(stats, standins.sessions(spark, sf_dir))


@query
def possession_latest(spark, sf_dir):
    return _possession(spark, sf_dir, "latest")


@query
def possession_rolling(spark, sf_dir):
    return _possession(spark, sf_dir, "rolling")


@query
def possession_max(spark, sf_dir):
    return _possession(spark, sf_dir, "max")


@query
def possession_display(spark, sf_dir):
    return possession.possession_text(_possession(spark, sf_dir, "max"))


@query
def possession_spells(spark, sf_dir):
    return spells.possession_spells(standins.live_events(spark, sf_dir), slice_seconds=3600)


# --- messages -----------------------------------------------------------------


@query
def event_json_roundtrip(spark, sf_dir):
    events = standins.live_events(spark, sf_dir)
    wire = events.select("event_id", *schemas.EVENT_SCHEMA.fieldNames())
    decoded = messages.decode(messages.encode(wire))
    return _without_zone(messages.valid_events(decoded), "event_time")


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as messages; each event type but two is broken in its own way."""
    events = standins.live_events(spark, sf_dir)
    kind = F.col("event_type")
    whole = F.struct(*schemas.EVENT_SCHEMA.fieldNames())
    no_match = F.struct(*[c for c in schemas.EVENT_SCHEMA.fieldNames() if c != "match_id"])
    bad_time = F.struct("match_id", F.lit("x").alias("timestamp"), "team", "event_type")
    bad_place = F.struct("match_id", "timestamp", F.lit("left").alias("x_coord"))
    value = (
        F.when(kind == "foul", F.concat(F.lit("#"), F.to_json(whole)))
        .when(kind == "shot", F.to_json(no_match))
        .when(kind == "interception", F.to_json(bad_time))
        .when(kind == "view", F.to_json(bad_place))
        .otherwise(F.to_json(whole))
    )
    return events.select("event_id", value.alias("value"))


@query
def event_json_quarantine(spark, sf_dir):
    decoded = messages.decode(damaged_messages(spark, sf_dir))
    return messages.quarantined(decoded).groupBy("reason").agg(F.count("value").alias("n"))


@query
def event_json_lenient(spark, sf_dir):
    decoded = messages.decode(damaged_messages(spark, sf_dir))
    return messages.valid_events(decoded).drop("event_time")


# --- live views ---------------------------------------------------------------


@query
def live_recent_topk(spark, sf_dir):
    return recent.recent_events(standins.live_events(spark, sf_dir).drop("event_time"), k=100)


@query
def live_recent_single_match(spark, sf_dir):
    events = standins.live_events(spark, sf_dir).drop("event_time", "event_id")
    return recent.recent_events_of_match(events, "2024-01-02")


@query
def live_events_named(spark, sf_dir):
    events = standins.live_events(spark, sf_dir).drop("event_time")
    return enrich.with_names(events, *_dimensions(spark, sf_dir))


@query
def live_enriched(spark, sf_dir):
    events = standins.live_events(spark, sf_dir).drop("event_id", "event_time")
    return enrich.live_enriched(
        events, *_dimensions(spark, sf_dir), standins.sessions(spark, sf_dir)
    )


@query
def live_feed(spark, sf_dir):
    return pitch.feed(_frame(spark, sf_dir), *_dimensions(spark, sf_dir))


@query
def action_map_last100(spark, sf_dir):
    return pitch.action_map(_frame(spark, sf_dir), *_dimensions(spark, sf_dir))


@query
def action_matrix(spark, sf_dir):
    matrix = pitch.action_matrix(action_map_last100(spark, sf_dir))
    newest = F.element_at("points", 1)
    return matrix.select(
        "match_id",
        "team_name",
        "event_type",
        "legend",
        "n",
        newest["position"].alias("newest_position"),
        newest["x_coord"].alias("newest_x"),
        newest["y_coord"].alias("newest_y"),
    )


@query
def radar_last_position(spark, sf_dir):
    return recent.last_positions(_frame(spark, sf_dir))


def _radar(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, players = _dimensions(spark, sf_dir)
    return pitch.radar(_frame(spark, sf_dir), players)


@query
def radar_top11(spark, sf_dir):
    return _radar(spark, sf_dir)


@query
def radar_counts(spark, sf_dir):
    return pitch.radar_counts(_radar(spark, sf_dir))


@query
def event_types(spark, sf_dir):
    return pitch.distinct_values(standins.live_events(spark, sf_dir), "event_type")


@query
def clamped_positions(spark, sf_dir):
    spread = F.col("x_coord") * 2 - 20
    return standins.live_events(spark, sf_dir).select(
        "event_id",
        coerce.clamp(spread).alias("x_coord"),
        coerce.clamp(F.col("y_coord")).alias("y_coord"),
    )


@query
def event_styles(spark, sf_dir):
    """Event types per team with all style columns."""
    events = standins.live_events(spark, sf_dir)
    kind = F.col("event_type")
    return (
        events.groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "event_type",
            display.marker(kind).alias("marker"),
            display.marker_size(kind).alias("marker_size"),
            display.title_case(kind).alias("title"),
            display.thousands_text(F.col("n")).alias("n_text"),
        )
    )


# --- keyed tables -------------------------------------------------------------


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their time cut to the hour, so that keys collide."""
    hour = F.floor(F.col("timestamp") / 3600) * 3600.0
    return standins.live_events(spark, sf_dir).withColumn("timestamp", hour).drop("event_time")


@query
def event_log_upsert(spark, sf_dir):
    keys = schemas.SERVING_KEYS["live_events"]
    return recent.latest_per_key(_hourly(spark, sf_dir), keys, ["event_id"], keep_order=True)


@query
def keyed_log_compaction(spark, sf_dir):
    """The same upserts through a keyed log: batches, a fold, a replay."""
    rows = _hourly(spark, sf_dir)
    log = KeyedLog(
        scratch_path(spark, "keyed-log"),
        rows.schema,
        schemas.SERVING_KEYS["live_events"],
        ("event_id",),
    )
    late = F.col("event_type") == "shot"
    log.write_batch(rows.filter(~late), 0)
    log.compact(spark, "v1")
    log.write_batch(rows.filter(late), 1)
    log.write_batch(rows.filter(late), 1)
    return log.read(spark)


@query
def session_reset(spark, sf_dir):
    """Every session is reset at noon of its day; the live events after that."""
    root = scratch_path(spark, "reset")
    events = standins.live_events(spark, sf_dir)
    raw = events.select(
        *schemas.EVENT_SCHEMA.fieldNames(),
        F.col("event_time").alias("ingest_time"),
        F.lit(0).cast("long").alias("ingest_partition"),
        F.col("event_id").cast("long").alias("ingest_offset"),
        jobs.match_bucket(F.col("match_id"), jobs.RAW_BUCKETS).alias(jobs.BUCKET),
    )
    raw.write.partitionBy(jobs.BUCKET).parquet(f"{root}/live_events")
    noon = F.expr("to_timestamp(match_id) + INTERVAL 12 HOURS").alias("reset_at")
    standins.sessions(spark, sf_dir).select("match_id", noon).write.json(f"{root}/resets")
    kept = jobs.read_live_events(
        spark,
        f"{root}/live_events",
        buckets=jobs.RAW_BUCKETS,
        resets=control.read_resets(spark, f"{root}/resets"),
    )
    return kept.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("events"), F.min("timestamp").alias("first_ts")
    )


def _archive(spark: SparkSession, sf_dir: str) -> EventArchive:
    """All events in the archive, the newest time ranges in a second write."""
    archive = EventArchive(f"touchline_archive_{uuid.uuid4().hex}", scratch_path(spark, "archive"), seconds=86400)
    events = standins.live_events(spark, sf_dir)
    middle = events.agg(F.min("timestamp") + (F.max("timestamp") - F.min("timestamp")) / 2).first()[0] or 0
    late = F.col("timestamp") >= middle // archive.seconds * archive.seconds
    archive.write(events.where(~late))
    archive.write(events.where(late))
    return archive


@query
def archive_recent_of_match(spark, sf_dir):
    """The newest events of one match, from its bucket and its newest time ranges."""
    return _archive(spark, sf_dir).newest_of_match(spark, "2024-01-02")


@query
def archive_recent(spark, sf_dir):
    """The newest events of every match, without those of older time ranges."""
    return _archive(spark, sf_dir).newest(spark, 100)


@query
def archive_by_match(spark, sf_dir):
    """Events, players and time of every match, grouped in the buckets of the archive."""
    latest = _archive(spark, sf_dir).latest(spark, ["player_id"])
    return latest.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("player_id").alias("players"),
        F.max("timestamp").alias("last_ts"),
    )


# --- baseline -----------------------------------------------------------------


@query
def hist_avg_events(spark, sf_dir):
    return baseline.historical_average(standins.facts(spark, sf_dir))


@query
def live_counts_capped(spark, sf_dir):
    return baseline.live_counts(
        standins.live_events(spark, sf_dir),
        standins.sessions(spark, sf_dir),
        _frame(spark, sf_dir),
    )


@query
def live_vs_baseline(spark, sf_dir):
    live = baseline.live_counts(
        standins.live_events(spark, sf_dir), standins.sessions(spark, sf_dir)
    )
    return baseline.live_vs_baseline(standins.facts(spark, sf_dir), live)


@query
def baseline_display(spark, sf_dir):
    return baseline.baseline_text(live_vs_baseline(spark, sf_dir))


# --- loaders ------------------------------------------------------------------


def _wide_floats(df: DataFrame) -> DataFrame:
    floats = [name for name, kind in df.dtypes if kind == "float"]
    return df.withColumns({c: F.col(c).cast("double") for c in floats})


@query
def normalize_facts(spark, sf_dir):
    return _wide_floats(normalise.normalise(standins.fact_csv(spark, sf_dir), schemas.FACTS))


@query
def normalize_players(spark, sf_dir):
    return normalise.normalise(standins.player_csv(spark, sf_dir), schemas.PLAYERS)


@query
def normalize_teams(spark, sf_dir):
    return normalise.normalise(standins.team_csv(spark, sf_dir), schemas.TEAMS)


@query
def normalize_matches(spark, sf_dir):
    return normalise.normalise(standins.match_csv(spark, sf_dir), schemas.MATCHES)


def _write_csv(rows: DataFrame, path: str) -> None:
    rows.write.option("header", True).option("escape", '"').csv(path)


@query
def csv_fact_load(spark, sf_dir):
    """Facts through CSV files of two layouts, one with coordinates."""
    root = scratch_path(spark, "fact-csv")
    rows = standins.fact_csv(spark, sf_dir)
    located = rows.select(
        F.lit("12.5").alias("x_start"), *reversed(rows.columns), F.lit("").alias("y_end")
    )
    _write_csv(located.filter(F.col("eventName") == "A"), f"{root}/events_located")
    _write_csv(rows.filter(F.col("eventName") != "A"), f"{root}/events_plain")
    return _wide_floats(csvfiles.load_facts(spark, f"{root}/events_*/*.csv"))


@query
def csv_match_load(spark, sf_dir):
    """Matches through CSV files of different columns, the same rows twice."""
    root = scratch_path(spark, "match-csv")
    rows = standins.match_csv(spark, sf_dir)
    _write_csv(rows.drop("gameweek", "label"), f"{root}/a")
    _write_csv(rows, f"{root}/b")
    return csvfiles.load_csv(spark, f"{root}/*/*.csv", schemas.MATCHES)


@query
def csv_player_load(spark, sf_dir):
    """Players loaded from two files with the same ids and line breaks; the later wins."""
    root = scratch_path(spark, "player-csv")
    rows = standins.player_csv(spark, sf_dir)
    _write_csv(rows, f"{root}/1-old")
    _write_csv(rows.withColumn("foot", F.lit("left,\nor right")), f"{root}/2-new")
    return csvfiles.load_dimension(spark, f"{root}/*/*.csv", schemas.PLAYERS)


@query
def warehouse_append(spark, sf_dir):
    """Facts appended in sort order, read back and counted."""
    path = scratch_path(spark, "facts")
    facts = normalise.normalise(standins.fact_csv(spark, sf_dir), schemas.FACTS)
    report = tables.append(facts, path, schemas.FACTS)
    stored = spark.read.schema(schemas.FACTS.schema).parquet(path)
    return stored.groupBy("event_name", "sub_event_name").agg(
        F.count(F.lit(1)).alias("n"), F.lit(report.rows).cast("long").alias("appended")
    )


@query
def dim_dedupe(spark, sf_dir):
    rows = standins.table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("string").alias("team_id"),
        F.col("c_name").alias("official_name"),
        F.col("c_mktsegment").alias("type"),
        F.col("c_custkey").alias("loaded"),
    )
    return normalise.dedupe(rows, ("team_id",), "loaded")


@query
def event_label_lookup(spark, sf_dir):
    """Codes with a dictionary text: all customers and their nation."""
    rows = standins.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    dictionary = standins.table(spark, sf_dir, "nation")
    return labels.with_labels(
        rows, dictionary, {"c_nationkey": "n_nationkey"}, {"n_name": "label"}
    )


@query
def tag_label_lists(spark, sf_dir):
    """Lists of codes in text form with their labels: two nations of every customer, of which
    the second is often unknown."""
    rows = standins.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.format_string("[{'id': %d}, {'id': %d}]", "c_nationkey", F.col("c_custkey") % 40).alias("tags"),
    )
    dictionary = standins.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("tag"), F.col("n_name").alias("label")
    )
    codes = rows.withColumn("codes", labels.code_list(F.col("tags")))
    labelled = labels.with_label_lists(codes, ("c_custkey",), "codes", dictionary)
    return labelled.select("c_custkey", F.array_join("labels", "/").alias("labels"))


# --- rosters and match set-up ---------------------------------------------------


@query
def roster_fill(spark, sf_dir):
    return roster.roster(
        standins.roster_teams(spark, sf_dir),
        standins.roster_players(spark, sf_dir),
        standins.roster_facts(spark, sf_dir),
    )


@query
def lineup_positions(spark, sf_dir):
    return roster.lineup(roster_fill(spark, sf_dir), standins.roster_sessions(spark, sf_dir))


@query
def team_selector(spark, sf_dir):
    teams = standins.table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("official_name"),
        F.col("c_custkey").cast("string").alias("team_id"),
        F.col("c_custkey").alias("loaded"),
    )
    return match_setup.team_options(teams, "loaded")


@query
def team_selector_default(spark, sf_dir):
    return match_setup.default_pair(match_setup.team_options(standins.teams(spark, sf_dir)))


@query
def session_resolve(spark, sf_dir):
    return match_setup.resolve_sessions(standins.control_documents(spark, sf_dir))


# --- streams --------------------------------------------------------------------


def _wire_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standins.live_events(spark, sf_dir).select(*schemas.EVENT_SCHEMA.fieldNames())


def _cores(spark: SparkSession) -> int:
    """Cores of the cluster: one state partition each."""
    return spark.sparkContext.defaultParallelism


def _stream(spark: SparkSession, folder: str) -> DataFrame:
    return messages.valid_events(messages.decode(messages.file_stream(spark, folder)))


def _count(spark: SparkSession, folder: str, counts: WindowCounts, run: str = "v1", **options):
    """Take in what is new for a run, into wide windows."""
    return jobs.start_counts(
        _stream(spark, folder),
        counts,
        f"{counts.path}-checkpoint/{run}",
        **WIDE,
        state_partitions=_cores(spark),
        run=run,
        **options,
    )


@query
def team_stats_upsert_stream(spark, sf_dir):
    """All events replayed as JSON in two steps into the keyed team counts."""
    root = scratch_path(spark, "team-stats")
    counts = jobs.team_stats(root)
    events = _wire_events(spark, sf_dir)
    replay.replay(
        events,
        replay.time_slices(events, 2),
        f"{root}/messages",
        lambda: _count(spark, f"{root}/messages", counts),
    )
    return _windows(counts.read(spark))


@query
def checkpoint_version_stream(spark, sf_dir):
    """Two checkpoints take turns over four parts of the events, and end in mid-window.

    The newer one starts at the newest message, as a queue lets it; the older one meets what it
    has missed when it goes on. The fourth part is counted by the newer one only.
    """
    root = scratch_path(spark, "versions")
    counts = jobs.team_stats(root)
    events = _wire_events(spark, sf_dir)
    turns = [("v1", "*"), ("v2", "[2-4]"), ("v1", "*"), ("v2", "[2-4]")]
    for part, (condition, (run, seen)) in enumerate(zip(replay.time_slices(events, 4), turns), 1):
        messages.produce(messages.encode(events.filter(condition)), "files", f"{root}/messages/{part}")
        _count(spark, f"{root}/messages/{seen}", counts, run).awaitTermination()
    return _windows(counts.read(spark))


@query
def reset_counts_stream(spark, sf_dir):
    """The match of the middle of the time is reset between two parts: its counts start again."""
    root = scratch_path(spark, "reset-counts")
    counts = jobs.team_stats(root)
    events = _wire_events(spark, sf_dir)
    middle = events.agg(F.min("timestamp") + (F.max("timestamp") - F.min("timestamp")) / 2)
    match_id = middle.select(F.timestamp_seconds(F.col(middle.columns[0])).cast("date").cast("string"))
    for part, condition in enumerate(replay.time_slices(events, 2)):
        if part:
            control.reset_session(spark, f"{root}/resets", match_id.first()[0], counts)
        messages.produce(messages.encode(events.filter(condition)), "files", f"{root}/messages")
        _count(spark, f"{root}/messages", counts).awaitTermination()
    return _windows(counts.read(spark))


#: Delay of the late-event query: events of the last ten days still count.
LATE_DELAY = "10 days"


def _fouls_late(spark: SparkSession, sf_dir: str) -> tuple[str, WindowCounts]:
    """All fouls arrive after everything else; the folder of the messages, and the counts."""
    root = scratch_path(spark, "late")
    counts = jobs.team_stats(root, "all")
    late = F.col("event_type") == "foul"
    replay.replay(
        _wire_events(spark, sf_dir),
        iter([~late, late]),
        f"{root}/messages",
        lambda: _count(spark, f"{root}/messages", counts, delay=LATE_DELAY),
    )
    return root, counts


@query
def late_event_policy(spark, sf_dir):
    """Fouls arrive late; expired windows no longer take them."""
    _, counts = _fouls_late(spark, sf_dir)
    return _windows(counts.read(spark))


@query
def late_event_log(spark, sf_dir):
    """Fouls arrive late: the events that expired windows did not take, by window."""
    root, counts = _fouls_late(spark, sf_dir)
    decoded = messages.decode(messages.file_stream(spark, f"{root}/messages"))
    raw = f"{root}/live_events/run=v1"
    jobs.append_events(decoded, raw, f"{root}/raw-checkpoint", buckets=8).awaitTermination()
    events = jobs.read_raw_events(spark, f"{root}/live_events", buckets=8)
    late = counts.late_rows(events, **WIDE).groupBy(*KEYS, "window_start", "window_end")
    return _windows(late.agg(F.count(F.lit(1)).alias("late_events")))


@query
def possession_spells_stream(spark, sf_dir):
    """The spells as the stream finds them, in four parts and an event of a later day, which
    lets the last spells of all matches end."""
    root = scratch_path(spark, "spells")
    events = _wire_events(spark, sf_dir)
    later = events.agg((F.max("timestamp") + 10 * 86400).alias("timestamp")).select(
        F.lit("later").alias("match_id"), "timestamp"
    )
    started = lambda: spells_stream.start_spells(
        _stream(spark, f"{root}/messages"), f"{root}/spells", f"{root}/checkpoint", idle="3 days"
    )
    with jobs.fixed_partitions(spark, _cores(spark)):
        replay.replay(events, replay.time_slices(events, 4), f"{root}/messages", started)
        messages.produce(messages.encode(later), "files", f"{root}/messages")
        started().awaitTermination()
    return spark.read.parquet(f"{root}/spells")


@query
def raw_append_stream(spark, sf_dir):
    """Raw log and quarantine from one source; the keyed view of the log."""
    root = scratch_path(spark, "raw")
    damaged_messages(spark, sf_dir).select("value").write.text(f"{root}/messages")
    decoded = messages.decode(messages.file_stream(spark, f"{root}/messages"))
    for started in (
        jobs.append_events(decoded, f"{root}/events", f"{root}/checkpoint-raw"),
        jobs.append_quarantine(decoded, f"{root}/quarantine", f"{root}/checkpoint-bad"),
    ):
        started.awaitTermination()
    kept = jobs.read_live_events(spark, f"{root}/events").groupBy("match_id").count()
    refused = spark.read.parquet(f"{root}/quarantine").groupBy("reason").count()
    return kept.select(F.col("match_id").alias("target"), F.col("count").alias("n")).unionByName(
        refused.select(F.col("reason").alias("target"), F.col("count").alias("n"))
    )


@query
def enriched_stream(spark, sf_dir):
    """Live events joined with the dimensions inside the stream."""
    root = scratch_path(spark, "enriched")
    messages.encode(_wire_events(spark, sf_dir)).write.text(f"{root}/messages")
    log = jobs.enriched_log(f"{root}/events")
    jobs.start_enriched(
        _stream(spark, f"{root}/messages"),
        lambda low, high: _dimensions(spark, sf_dir),
        log,
        f"{root}/checkpoint",
    ).awaitTermination()
    return log.read(spark).drop(*messages.INGEST_COLUMNS)


@query
def dim_reload(spark, sf_dir):
    """Names as they were when an event came in: the dimensions change between two parts.

    The stream runs after both parts have come, so that it can't tell by its own time.
    """
    root = scratch_path(spark, "reload")
    published = jobs.ServingFrames(f"{root}/warehouse")
    events = _wire_events(spark, sf_dir)
    for part, condition in enumerate(replay.time_slices(events, 2)):
        for table, name, rows in (
            (schemas.TEAMS, "official_name", standins.teams(spark, sf_dir)),
            (schemas.PLAYERS, "short_name", standins.players(spark, sf_dir)),
        ):
            whole = normalise.normalise(rows, table)
            prefix = F.lit("New " if part else "")
            published.publish(table.name, whole.withColumn(name, F.concat(prefix, name)))
        messages.produce(messages.encode(events.filter(condition)), "files", f"{root}/messages")
    log = jobs.enriched_log(f"{root}/events")
    jobs.start_enriched(
        _stream(spark, f"{root}/messages"),
        jobs.published_dimensions(spark, f"{root}/warehouse"),
        log,
        f"{root}/checkpoint",
    ).awaitTermination()
    return log.read(spark).drop(*messages.INGEST_COLUMNS)


#: Events that come in before the streams of a replayed match run; they bound their state.
STEP_EVENTS = 2_000_000


def _play(spark: SparkSession, steps: list[DataFrame], root: str) -> None:
    """Each step of events as messages, through the raw log, the quarantine and the team counts."""
    for events in steps:
        messages.produce(messages.encode(events), "files", f"{root}/messages")
        source = messages.file_stream(spark, f"{root}/messages")
        for started in jobs.start_all(source, root, state_partitions=_cores(spark)):
            started.awaitTermination()


def _dashboard(spark: SparkSession, sf_dir: str) -> jobs.ServingViews:
    """Messages through the raw log and the team counts into the dashboard views."""
    root = scratch_path(spark, "dashboard")
    _play(spark, replay.in_steps(_wire_events(spark, sf_dir), STEP_EVENTS, f"{root}/steps"), root)
    teams, players = _dimensions(spark, sf_dir)

    history = jobs.ServingFrames(f"{root}/history")
    history.publish("average", baseline.historical_average(standins.facts(spark, sf_dir)))
    average = history.read(spark, "average")

    def load_inputs(sessions: DataFrame, touched: list[int]) -> dashboard.Inputs:
        return dashboard.Inputs(
            live=jobs.read_live_events(
                spark,
                f"{root}/live_events",
                buckets=jobs.RAW_BUCKETS,
                sessions=sessions,
                only=touched,
            ),
            stats=jobs.team_stats(root).read(spark),
            sessions=sessions,
            teams=teams,
            players=players,
            facts=standins.facts(spark, sf_dir),
            average=average,
        )

    serving = jobs.ServingViews(f"{root}/views")
    jobs.start_refresh(
        jobs.changes(spark, root),
        lambda: standins.sessions(spark, sf_dir),
        load_inputs,
        serving,
        f"{root}/checkpoints/v1/views",
        jobs.Trigger(),
    ).awaitTermination()
    return serving


@query
def dashboard_refresh(spark, sf_dir):
    """The feed and the baseline card as the streams leave them."""
    serving = _dashboard(spark, sf_dir)
    card = serving.read(spark, "baseline").select("match_id", "live_events", "delta")
    return serving.read(spark, "feed").join(card, "match_id")


@query
def deployed_sessions(spark, sf_dir):
    """Two matches are deployed one after the other while the views run; both cards.

    The events of all days are played as those of either match, of the second one ten years
    later; its teams, names and views reach a query that has begun before it was deployed.
    """
    root = scratch_path(spark, "deployed")
    warehouse = f"{root}/warehouse"
    published = jobs.ServingFrames(warehouse)
    teams = normalise.normalise(standins.teams(spark, sf_dir), schemas.TEAMS)
    published.publish("teams", teams)
    published.publish("average", baseline.historical_average(standins.facts(spark, sf_dir)))
    options = match_setup.team_options(published.read(spark, "teams"))
    steps = replay.in_steps(_wire_events(spark, sf_dir), STEP_EVENTS, f"{root}/steps")
    for years, (home, away) in zip((0, 10), (("ASIA", "EUROPE"), ("AFRICA", "AMERICA"))):
        session = control.deploy_match(spark, options, home, away, f"{root}/control")
        later = F.col("timestamp") + years * 365 * 86400.0
        played = {"match_id": F.lit(session), "timestamp": later}
        _play(spark, [events.withColumns(played) for events in steps], root)
        jobs.start_views(spark, root, warehouse, jobs.Trigger()).awaitTermination()
    views = jobs.ServingViews(f"{root}/views")
    card = views.read(spark, "possession").join(views.read(spark, "baseline"), "match_id")
    return card.select("team_a_id", "team_b_id", "events_a", "events_b", "live_events", "historical_avg")
