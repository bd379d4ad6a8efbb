"""Operator 4: mixture-controlled packing by deficit round-robin.

The documents of a source form a queue. In every window each queue gets a credit of
tokens in proportion to its target share; it serves whole documents while its credit
lasts and carries the rest, its deficit, to the next window. After w windows a queue of
credit q has served the documents that end within w * q tokens, so a document's window is
its end in the queue over q, rounded up: a running sum tells it for all documents at once,
and no deficit has to be handed from task to task. The windows, one after the other, are
cut into sequences; only the last sequence is not full.

By default a source's target is its share of all tokens: then all queues end together.
With other targets a queue that runs dry leaves its windows to the others. The pieces and
their checksums are cut in the tasks that hold the ids.

Edge cases: null and empty texts are the end token alone; null sources form a queue;
repeated rows and rows with null ids are packed like any others; documents longer than
a window span several. Other columns are not read.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import part_starts, stored
from touchline.llm.wordbpe import id_bytes, word_bpe

SEQUENCE = 4096
#: Tokens of a window: 64 sequences.
WINDOW = 64 * SEQUENCE
END = 2


def tokenized(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """doc_id, source, the number of tokens, and the ids as little-endian numbers.

    They take ``id_bytes`` each, 2 for a vocabulary below 65,536: they are stored and shuffled.
    """
    width = id_bytes(path, end)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("source", T.StringType()),
            T.StructField("tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = list(word_bpe(path).encode(texts, end))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("source"),
                    pa.array(map(len, ids), pa.int64()),
                    pa.array([x.astype(f"<u{width}").tobytes() for x in ids], pa.binary()),
                ],
                ["doc_id", "source", "tokens", "ids"],
            )

    wanted = ["doc_id", *(F.col(c).cast("string").alias(c) for c in ("source", "text"))]
    return docs.select(*wanted).mapInArrow(run, schema)


def cut(rows: DataFrame, length: int, width: int) -> DataFrame:
    """The pieces of (doc_id, tokens, ids, start), where ``start`` counts the tokens before."""
    ident = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        for batch in batches:
            sizes = batch.column("tokens").to_numpy()
            begin = batch.column("start").to_numpy()
            first = begin // length
            counts = (begin + sizes - 1) // length - first + 1
            row = np.repeat(np.arange(len(sizes)), counts)
            k = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            low = np.maximum(begin[row], k * length)
            high = np.minimum((begin + sizes)[row], (k + 1) * length)
            held = np.cumsum(sizes) - sizes
            raw = b"".join(x.as_buffer() for x in batch.column("ids"))
            ids = memoryview(np.frombuffer(raw, f"<u{width}").astype("<u4")).cast("B")
            at = 4 * (held[row] + low - begin[row])
            ends = at + 4 * (high - low)
            crc = [crc32(ids[x:y]) for x, y in zip(at.tolist(), ends.tolist())]
            doc_id = batch.column("doc_id").take(pa.array(row))
            numbers = [low - begin[row], high - low, crc, sizes[row], k, low - k * length]
            arrays = [doc_id, *(pa.array(x, pa.int64()) for x in numbers)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = ", ".join([f"doc_id {ident}", *(f"{n} long" for n in names[1:])])
    return rows.select("doc_id", "tokens", "ids", "start").mapInArrow(run, schema)


def running_starts(df: DataFrame, order: list, name: str) -> DataFrame:
    """Add ``start``: the tokens of all rows before, in ``order``.

    One range shuffle; tasks add up their rows, and one sum for each of them is shared.
    """
    schema = T.StructType([*df.schema, T.StructField("_before", T.LongType()), T.StructField("_part", T.LongType())])

    def add(batches):
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = batch.column("tokens").to_numpy(zero_copy_only=False)
            ends = total + np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else total
            parts = pa.array(np.full(len(sizes), part), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ends - sizes, pa.int64()), parts], schema.names
            )

    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    added = stored(ranged.mapInArrow(add, schema), name)
    starts = part_starts(added, F.sum("tokens"))
    return (
        added.join(starts, "_part")
        .withColumn("start", F.col("_before") + F.col("_start"))
        .drop("_part", "_before", "_start")
    )


def windows(
    lengths: DataFrame,
    window: int,
    targets: dict[str, float] | None,
    others: float | None = None,
) -> DataFrame:
    """Add the window of each (row, source, doc_id, tokens)."""
    queued = running_starts(lengths, ["source", "doc_id", "row"], "queues")
    queues = queued.groupBy("source").agg(
        F.min("start").alias("_first"), F.sum("tokens").alias("_all")
    )
    if targets is None:
        share = F.col("_all") / F.lit(lengths.agg(F.sum("tokens")).first()[0] or 1)
    else:
        share = F.lit(min(targets.values()) / 10 if others is None else others)
        for source, target in targets.items():
            share = F.when(F.col("source") == source, float(target)).otherwise(share)
    queues = queues.select(
        F.col("source").alias("_source"), "_first", (share * window).alias("_credit")
    )
    # Stored, so that Spark knows its size: a few sources are broadcast, many are not, and
    # then the rows of a large one can be split.
    queues = stored(queues, "shares")
    end = F.col("start") + F.col("tokens") - F.col("_first")
    return (
        queued.join(queues, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("window", F.ceil(end / F.col("_credit")))
        .select("row", "source", "doc_id", "tokens", "window")
    )


def pack(
    docs: DataFrame,
    path: str,
    length: int = SEQUENCE,
    window: int = WINDOW,
    targets: dict[str, float] | None = None,
    others: float | None = None,
) -> DataFrame:
    """The pieces of all documents: where each stands in its document and its sequence.

    ``targets`` are the shares of sources in a window; each source that is not named gets
    ``others``, or a tenth of the least target.
    """
    tokens = tokenized(docs, path).withColumn("row", F.monotonically_increasing_id())
    tokens = stored(tokens, "tokens")
    width = id_bytes(path, END)
    lengths = tokens.select("row", "source", "doc_id", "tokens")
    dealt = windows(lengths, window, targets, others)
    placed = running_starts(dealt, ["window", "source", "doc_id", "row"], "placed")
    placed = placed.select("row", "start")
    return cut(tokens.join(placed, "row"), length, width)
