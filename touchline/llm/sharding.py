"""Operator 5: sharding by a Feistel permutation of global row numbers.

Rows are numbered from 0 in the order of ``doc_id``. A keyed Feistel network permutes the
numbers below N, so the place of a row in the shuffled order, its shard (place modulo the
shards) and its slot (place over the shards) follow from its number, the key, N and the
number of shards alone. No row is compared with another.

The network works on pairs (left, right) below (a, b), with a the rounded root of N and
a * b the least multiple of a that holds N. Numbers from N to a * b are left by walking the
cycle: the network is applied again until the result is below N. There are fewer than a of
them and a walk meets each at most once, so a walk of a * b - N steps is always enough.

Only DataFrame functions are used. Edge cases: a null text has size 1 and no checksum;
null ids come first; rows with the same id are ordered by checksum and size, and equal rows
take any of their places; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import numbered

ROUNDS = 6
SHARDS = 16


def _network(place: Column, a: int, b: int, key: int) -> Column:
    """One pass of the network: each round adds a keyed hash of one half to the other."""

    def half(value: Column, other: Column, turn: Column, size: int) -> Column:
        return F.pmod(value + F.pmod(F.xxhash64(F.lit(key), turn, other), F.lit(size)), F.lit(size))

    def turn(halves: Column, n: Column) -> Column:
        left, right = halves["left"], halves["right"]
        moved = half(left, right, n, a)
        return F.struct(
            moved.alias("left"), half(right, moved, n + F.lit(ROUNDS), b).alias("right")
        )

    start = F.struct(
        F.pmod(place, F.lit(a)).cast("long").alias("left"),
        F.floor(place / F.lit(a)).cast("long").alias("right"),
    )
    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, start, turn, lambda h: h["right"] * F.lit(a) + h["left"])


def permuted(df: DataFrame, column: str, count: int, key: int, out: str) -> DataFrame:
    """Add ``out``: a permutation of the numbers below ``count`` in ``column``."""
    if count == 0:
        return df.withColumn(out, F.lit(None).cast("long"))
    a = max(1, isqrt(count))
    b = -(-count // a)
    df = df.withColumn(out, _network(F.col(column), a, b, key))
    spare = a * b - count
    if spare == 0:
        return df
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(spare)),
        F.col(out),
        lambda at, _: F.when(at < count, at).otherwise(_network(at, a, b, key)),
    )
    return df.withColumn(out, F.when(F.col(out) < count, F.col(out)).otherwise(walk))


def shard(docs: DataFrame, shards: int = SHARDS, key: int = 20240229) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot. Shards differ by one row at most."""
    text = F.col("text").cast("string")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    rows = numbered(rows, ["doc_id", "text_crc32", "size"], "numbered")
    placed = permuted(rows, "row", rows.count(), key, "_place")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.pmod("_place", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("_place") / shards).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
