"""Reading, storing and numbering rows; minima of groups; connected components."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import session
from touchline.session import scratch_path

#: White space that separates words and is stripped from lines: space and \t to \r.
BLANKS = " \t\n\x0b\f\r"
#: A group that is gathered by its key is split over so many sub-keys first.
SALTS = 128


#: Bytes of an Arrow batch: a Python worker's memory follows them, not the length of texts.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Let the executors import this package.

    Where the session doesn't say how many bytes an Arrow batch holds, it is ``BATCH_BYTES`` from
    now on, for all of its queries: Spark reads the setting when a query runs.
    """
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    session.ship(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so that a lost executor costs only the tasks it ran, and gives
    later joins the true size.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def empty(df: DataFrame) -> bool:
    return not df.take(1)


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number all rows from 0 in ``order``, as column ``row``.

    One range shuffle sorts the rows; what crosses partitions is one row count for
    each. Rows equal in all of ``order`` get any of their numbers.
    """
    index = F.monotonically_increasing_id()
    kept = (
        df.repartitionByRange(*[F.asc_nulls_first(c) for c in order])
        .sortWithinPartitions(*[F.asc_nulls_first(c) for c in order])
        .withColumn("_id", index)
        .withColumn("_part", F.shiftright("_id", 33))
        .withColumn("_index", F.col("_id").bitwiseAND((1 << 33) - 1))
        .drop("_id")
    )
    kept = stored(kept, name)
    starts = part_starts(kept, F.count(F.lit(1)))
    return (
        kept.join(starts, "_part")
        .withColumn("row", F.col("_index") + F.col("_start"))
        .drop("_part", "_index", "_start")
    )


def part_starts(df: DataFrame, size: Column) -> DataFrame:
    """(_part, _start): what ``size`` sums up to in the partitions before.

    One row for each partition of a stored frame, so it is small whatever the data.
    """
    from pyspark.sql import Window

    totals = df.groupBy("_part").agg(size.alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))


def with_group_min(
    df: DataFrame, keys: list[str], value: str, out: str, count: str | None = None
) -> DataFrame:
    """Add the smallest ``value`` of the rows with the same ``keys``, and their ``count``.

    The minimum is taken in tasks first; it comes back by (keys, salt), so that a key
    with a third of all rows is dealt out to many tasks.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(value), F.lit(SALTS)))
    least = (
        salted.groupBy(*keys, "_salt")
        .agg(F.min(value).alias("_least"), F.count(F.lit(1)).alias("_n"))
        .groupBy(*keys)
        .agg(
            F.min("_least").alias(out),
            F.sum("_n").alias(count or "_n"),
            F.collect_set("_salt").alias("_salts"),
        )
        .select(*keys, out, *([count] if count else []), F.explode("_salts").alias("_salt"))
    )
    return salted.join(least, [*keys, "_salt"]).drop("_salt")


def roots(parents: DataFrame, name: str) -> DataFrame:
    """Follow (node, parent) to the end. Parents are smaller than nodes, or equal."""
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("_next"))
        jumped = stored(
            parents.join(above, "parent", "left").select(
                "node",
                F.coalesce("_next", "parent").alias("parent"),
                (F.coalesce("_next", "parent") != F.col("parent")).alias("_moved"),
            ),
            name,
        )
        parents = jumped.select("node", "parent")
        if empty(jumped.where("_moved")):
            return parents


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node that links (a, b) lead to.

    Each round hooks every node to its smallest neighbour, follows the hooks to their
    ends by pointer jumping, and goes on with the links between these ends. Links that
    are left halve at least with every other round. Minima are pre-aggregated, and a hub
    meets its neighbours in a plain join that Spark can split.
    """
    left = stored(edges.where("a <> b").select("a", "b").distinct(), name)
    found = None
    while not empty(left):
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_near"))
        ends = roots(
            stored(hooks.select("node", F.least("node", "_near").alias("parent")), name), name
        )
        if found is None:
            found = ends.select("node", F.col("parent").alias("component"))
        else:
            step = ends.select(F.col("node").alias("component"), "parent")
            found = stored(
                found.join(step, "component", "left").select(
                    "node", F.coalesce("parent", "component").alias("component")
                ),
                name,
            )
        at_a = ends.select(F.col("node").alias("a"), F.col("parent").alias("_a"))
        at_b = ends.select(F.col("node").alias("b"), F.col("parent").alias("_b"))
        half = stored(left.join(at_a, "a").select("_a", "b"), name)
        left = stored(
            half.join(at_b, "b")
            .where("_a <> _b")
            .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
            .distinct(),
            name,
        )
    if found is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found
