"""Control documents: deploy a match, read the sessions, reset live data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from touchline import schemas
from touchline.operators.recent import latest_per_key
from touchline.operators.sessions import new_session, resolve_sessions
from touchline.sources import files
from touchline.streaming.counts import WindowCounts

DEPLOYED = "deployed_at"
#: Shares of a match's events where they meet its resets.
SHARES = 256
DOCUMENT_SCHEMA = StructType(
    [*schemas.MATCH_CONFIG_SCHEMA.fields, StructField(DEPLOYED, TimestampType())]
)
RESET_SCHEMA = StructType(
    [StructField("match_id", StringType()), StructField("reset_at", TimestampType())]
)


def _append_row(spark: SparkSession, row: DataFrame, path: str) -> None:
    row.coalesce(1).write.mode("append").json(path)


def deploy_match(
    spark: SparkSession,
    options: DataFrame,
    name_a: str,
    name_b: str,
    control_path: str,
    live_tables: tuple[WindowCounts, ...] = (),
) -> str:
    """Append a control document and empty the given live tables; new session id.

    The document is one row, so it may pass through the driver.
    """
    document = new_session(options, name_a, name_b).first()
    for side, name in (("a", name_a), ("b", name_b)):
        if document[f"team_{side}_id"] is None:
            raise ValueError(f"unknown team: {name}")
    row = spark.createDataFrame([document], schemas.MATCH_CONFIG_SCHEMA)
    _append_row(spark, row.withColumn(DEPLOYED, F.current_timestamp()), control_path)
    for table in live_tables:
        table.truncate(spark)
    return document["match_session_id"]


def read_documents(spark: SparkSession, control_path: str) -> DataFrame:
    """All control documents; none when nothing was deployed yet."""
    if not files.exists(spark, control_path):
        return spark.createDataFrame([], DOCUMENT_SCHEMA)
    return spark.read.schema(DOCUMENT_SCHEMA).json(control_path)


def read_sessions(
    spark: SparkSession, control_path: str, default_session: str = schemas.DEFAULT_SESSION
) -> DataFrame:
    """One row per session, from its last document; files are listed anew on each call."""
    documents = read_documents(spark, control_path).fillna(
        default_session, subset=["match_session_id"]
    )
    return resolve_sessions(latest_per_key(documents, ["match_session_id"], [DEPLOYED]))


def current_session(
    spark: SparkSession, control_path: str, default_session: str = schemas.DEFAULT_SESSION
) -> DataFrame:
    """The session deployed last, as a frame of one row (or none)."""
    newest = read_documents(spark, control_path).orderBy(F.col(DEPLOYED).desc_nulls_last())
    return resolve_sessions(newest.limit(1), default_session)


def reset_session(
    spark: SparkSession, resets_path: str, match_id: str, counts: WindowCounts | None = None
) -> None:
    """Hide all live events of a session that came in so far, and let its counts restart."""
    if counts is not None:
        counts.clear(spark, match_id)
    row = spark.createDataFrame([(match_id,)], "match_id string")
    _append_row(spark, row.withColumn("reset_at", F.current_timestamp()), resets_path)


def read_resets(spark: SparkSession, resets_path: str) -> DataFrame:
    if not files.exists(spark, resets_path):
        return spark.createDataFrame([], RESET_SCHEMA).limit(0)  # known to be empty when planned
    return spark.read.schema(RESET_SCHEMA).json(resets_path)


def after_resets(events: DataFrame, resets: DataFrame, time: str = "ingest_time") -> DataFrame:
    """Events that came in after the last reset of their session.

    Files stay as they are, so a running stream and its readers are not disturbed. Events meet the
    resets by match and share, so that one match which holds most of them is not one task's work,
    in the join or after it.
    """
    shares = F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1)))
    last = resets.groupBy("match_id").agg(F.max("reset_at").alias("__reset_at"))
    spread = [c for c in events.columns if c != "match_id"]
    share = F.pmod(F.xxhash64(*spread), F.lit(SHARES)).cast("int")
    joined = events.withColumn("__share", share).join(
        last.withColumn("__share", shares), ["match_id", "__share"], "left"
    )
    kept = F.col("__reset_at").isNull() | (F.col(time) > F.col("__reset_at"))
    return joined.filter(kept).drop("__reset_at", "__share")
