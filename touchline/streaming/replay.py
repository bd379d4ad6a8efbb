"""Replay of stored events as a stream, in steps of event time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from touchline.sources.messages import encode, produce

STEP = "step"


def time_slices(events: DataFrame, slices: int) -> Iterator[Column]:
    """Conditions that cut the time range into equal, ordered parts.

    Only the two ends of the range come to the driver.
    """
    low, high = events.agg(F.min("timestamp"), F.max("timestamp")).first()
    if low is None:
        return
    step = (high - low) / slices
    bounds = [low + step * i for i in range(1, slices)]
    for i in range(slices):
        condition = F.lit(True)
        if i > 0:
            condition = condition & (F.col("timestamp") >= bounds[i - 1])
        if i < slices - 1:
            condition = condition & (F.col("timestamp") < bounds[i])
        yield condition


def in_steps(events: DataFrame, rows: int, folder: str) -> list[DataFrame]:
    """The events in steps of about ``rows``, one after the other in time.

    A stream that takes one step at a time holds the state of one step, however many events
    there are: what it has passed, it lets go. Events of one time share a step; those without a
    time are in the first. More than one step is written to ``folder`` first, so that each
    reads its own rows only.
    """
    steps = -(-events.count() // rows)
    if steps < 2:
        return [events]
    shares = [i / steps for i in range(1, steps)]
    found = events.agg(F.percentile_approx("timestamp", shares, max(10_000, 100 * steps))).first()[0]
    bounds = sorted(set(found or []))
    starts = F.array(*map(F.lit, bounds)).cast("array<double>")
    passed = F.size(F.filter(starts, lambda start: F.col("timestamp") >= start))
    events.withColumn(STEP, passed).write.partitionBy(STEP).parquet(folder)
    schema = StructType([*events.schema.fields, StructField(STEP, IntegerType())])
    stored = events.sparkSession.read.schema(schema).parquet(folder)
    return [stored.where(F.col(STEP) == i).drop(STEP) for i in range(len(bounds) + 1)]


def replay(
    events: DataFrame,
    conditions: Iterator[Column],
    folder: str,
    start: Callable[[], StreamingQuery],
) -> list[StreamingQuery]:
    """Write each part as JSON messages, then let the query take it in.

    ``start`` must use an available-now trigger. The query stops after each part
    and resumes from its checkpoint, so parts never mix in one micro-batch.
    """
    queries = []
    for condition in conditions:
        produce(encode(events.filter(condition)), "files", folder)
        query = start()
        query.awaitTermination()
        queries.append(query)
    return queries
