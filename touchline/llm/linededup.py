"""Operator 9: line de-duplication by levelled sorted runs of line keys.

A run holds one row for each line key: how many documents hold it, the largest of their ids,
and whether the run is the key's home. Runs are written in buckets of the key's hash, sorted by
key, so that they are joined bucket by bucket without a shuffle. Every batch of documents is
anti-joined with the homes that there are: its new keys get theirs in the batch's own run, so that
a key has one home; its other keys stand there too, as updates of the run that is their home.
When a level has ``FAN`` runs, they are merged into one run of the next, updates into the homes
that are among them. So a key is rewritten once for each level, and a batch meets few runs. When all
batches are in, all runs are merged, and the lines of each document are joined with the
common keys: a line is dropped if its key has a later keeper, and the others stay.

A key is the line without white space at its ends and with A-Z in lower case, as two 64-bit
hashes and its length. Batches are dealt by the hash of the document's id, so that a
document, repeated rows of an id included, is in one batch; there is one for ``BATCH_ROWS``
documents, and ``LEAST_BATCHES`` at least.

Only DataFrame functions are used. Edge cases: a null or empty text is one empty line; keys
shorter than ``LEAST`` code points always stay; a line repeated inside one document counts
once and, in the keeper, stays every time; all rows of a repeated id are one document; null
ids are one document that is before all others; an empty table gives no rows. Columns of any
name are carried.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import BLANKS, stored
from touchline.session import scratch_path
from touchline.sources import files

LEAST = 20
DOCUMENTS = 3
LEAST_BATCHES, BATCH_ROWS = 4, 1 << 28
FAN = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["key_a", "key_b"]
#: Stands for a null id, before all others.
NOBODY = -(1 << 63)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def hashed(key: Column) -> Column:
    """The two hashes of a key that is long enough, else null."""
    both = F.struct(F.xxhash64(key).alias("key_a"), F.xxhash64(F.lit(1), key).alias("key_b"))
    return F.when(F.length(key) >= LEAST, both)


def owner(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NOBODY))


def document_lines(docs: DataFrame, batches: int) -> DataFrame:
    """(key_a, key_b, owner, text_key, place, batch): the long lines of all documents.

    They lie by batch in every task, so that a batch is read without the others.
    """
    # In two steps, so that a key is made once for its length and its hashes.
    keys = F.transform(F.transform(lines_of(F.col("text")), line_key), hashed)
    # The generator holds the expression itself: of a column, Spark would ask twice for it.
    lines = docs.select(
        owner().alias("owner"),
        F.xxhash64(F.col("text").cast("string")).alias("text_key"),
        F.pmod(F.xxhash64(owner()), F.lit(batches)).cast("int").alias("batch"),
        F.posexplode(keys).alias("place", "_key"),
    )
    lines = lines.where(F.col("_key").isNotNull()).select("_key.*", "owner", "text_key", "place", "batch")
    return lines.sortWithinPartitions("batch")


def make_run(lines: DataFrame) -> DataFrame:
    """One row for each key of a batch.

    Documents are counted in two steps, by (key, owner) and by key; both add up in tasks
    before they shuffle, so a line of every third document is no load for one task.
    """
    once = lines.groupBy(*KEY, "owner").agg(F.lit(1).alias("_one"))
    return once.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("documents"), F.max("owner").alias("keeper")
    )


def merged(one: DataFrame, two: DataFrame) -> DataFrame:
    """Two runs as one: a merge join of sorted buckets."""
    documents = [F.coalesce(run["documents"], F.lit(0)) for run in (one, two)]
    home = [F.coalesce(run["home"], F.lit(False)) for run in (one, two)]
    return one.join(two, KEY, "full").select(
        *KEY,
        (documents[0] + documents[1]).alias("documents"),
        F.greatest(one["keeper"], two["keeper"]).alias("keeper"),
        (home[0] | home[1]).alias("home"),
    )


class LineIndex:
    """Levels of runs. A level that has ``FAN`` of them is merged into one of the next."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.levels: list[list[DataFrame]] = [[]]
        #: The name and folder of the table of each run.
        self.tables: dict[DataFrame, tuple[str, str]] = {}

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def written(self, run: DataFrame) -> DataFrame:
        """The run in sorted buckets, as an external table of the shared folder."""
        spark, name = run.sparkSession, f"touchline_run_{uuid.uuid4().hex}"
        path = scratch_path(spark, "llm-run")
        writer = run.write.option("path", path)
        writer.bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name)
        table = spark.table(name)
        self.tables[table] = name, path
        return table

    def forget(self, *runs: DataFrame) -> None:
        """Remove runs that nothing needs any more: all that came of them is written."""
        for run in runs:
            name, path = self.tables.pop(run)
            run.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
            files.delete(run.sparkSession, path)

    def add(self, lines: DataFrame) -> None:
        """Take in a batch: its new keys are at home in its run."""
        batch = make_run(lines).withColumn("home", F.lit(True))
        for run in self.runs():
            known = run.where("home").select(*KEY, F.lit(True).alias("known"))
            new = F.col("home") & F.col("known").isNull()
            batch = batch.join(known, KEY, "left").withColumn("home", new).drop("known")
        self.levels[0].append(self.written(batch))
        for n, level in enumerate(self.levels):
            if len(level) < FAN:
                return
            whole = level[0]
            for other in level[1:]:
                both = whole, other
                whole = self.written(merged(*both))
                self.forget(*both)
            level.clear()
            if n + 1 == len(self.levels):
                self.levels.append([])
            self.levels[n + 1].append(whole)

    def unseen(self, lines: DataFrame) -> DataFrame:
        """The lines of a new batch whose keys no run holds: an anti-join with each run."""
        for run in self.runs():
            lines = lines.join(run.where("home").select(*KEY), KEY, "left_anti")
        return lines

    def common(self, documents: int = DOCUMENTS) -> DataFrame:
        """Keys of at least so many documents, with their keepers. The index is empty then."""
        # Joins, not a union: Spark 4.1 takes the rows of a union of bucketed scans to lie in
        # the buckets of one of them.
        runs = self.runs()
        whole = reduce(merged, runs)
        found = whole.where(F.col("documents") >= documents).select(*KEY, "keeper")
        found = stored(found, "common")
        self.levels = [[]]
        self.forget(*runs)
        return found


def drops(docs: DataFrame, batches: int | None = None) -> DataFrame:
    """(owner, text_key, gone): the places of the lines that each text loses, in order."""
    spark = docs.sparkSession
    if batches is None:
        batches = max(LEAST_BATCHES, -(-docs.count() // BATCH_ROWS))
    lines = stored(document_lines(docs, batches), "lines")
    index = LineIndex(int(spark.conf.get("spark.sql.shuffle.partitions")))
    for batch in range(batches):
        index.add(lines.where(F.col("batch") == batch).drop("batch"))
    lost = lines.drop("batch").join(index.common(), KEY).where("owner <> keeper")
    # At most the lines that the text has.
    places = F.array_sort(F.collect_set("place"))
    return lost.groupBy("owner", "text_key").agg(places.alias("gone"))


def dedup_lines(docs: DataFrame, batches: int | None = None) -> DataFrame:
    """(row, kept, gone): each row of ``docs`` as a struct, the lines of its text that stay, and
    the places of the others, null if there are none.

    The kept lines are the slices between two dropped ones.
    """
    texts = docs.select("doc_id", "text")
    lost = drops(texts, batches)
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    keyed = docs.select(
        row, owner().alias("owner"), F.xxhash64(F.col("text").cast("string")).alias("text_key")
    )
    joined = keyed.join(lost, ["owner", "text_key"], "left")
    lines, gone = lines_of(F.col("row.text")), F.col("gone")

    def between(k: Column) -> Column:
        """The lines after dropped place k - 1 and before place k."""
        low = F.coalesce(F.get(gone, k - 1), F.lit(-1))
        high = F.coalesce(F.get(gone, k), F.size(lines))
        return F.slice(lines, low + 2, high - low - 1)

    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), between))
    return joined.select("row", F.when(gone.isNull(), lines).otherwise(kept).alias("kept"), "gone")


def kept_text(lines: Column) -> Column:
    return F.array_join(lines, "\n")


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines that stay as texts, and ``n_chars``, if there, up to date."""
    changed = F.col("gone").isNotNull()
    text = kept_text(F.col("kept"))
    columns = []
    for field in docs.schema:
        value = F.col("row")[field.name]
        if field.name == "text":
            value = F.when(changed, text).otherwise(value)
        elif field.name == "n_chars":
            value = F.when(changed, F.length(text).cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return dedup_lines(docs).select(*columns)


def digests(marked: DataFrame) -> DataFrame:
    dropped = F.coalesce(F.size("gone"), F.lit(0)).cast("long")
    return marked.select(
        "row.doc_id",
        (F.size("kept") + dropped).alias("n_lines"),
        dropped.alias("n_dropped"),
        F.sha2(kept_text(F.col("kept")), 256).alias("kept_sha256"),
    )
