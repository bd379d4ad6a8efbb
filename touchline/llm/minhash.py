"""Operator 2: near-duplicate documents by HyperMinHash.

A document's set holds the hashes of its distinct 5-word shingles. For each of ``BUCKETS``
permutations of the hash space the smallest value is kept, compressed to a register of 16
bits: its leading zeros (6 bits) and the next mantissa bits (10). Bands of ``ROWS`` registers
are the candidate keys. Documents that share a band are compared by their registers first:
equal registers, less the collisions that compression brings, estimate the similarity. A
pair within six standard deviations of the limit is verified on the full sets of 64-bit
shingle hashes, in integers: 100 * intersection >= 75 * union.

A pair at similarity 0.75 shares a band with probability 1 - (1 - 0.75^4)^40 > 1 - 3e-7.

No group is expanded into pairs. Documents with the same set stand as one. First, the
documents of a band are compared with the smallest of them, which joins a group of copies by
one comparison for each member. Bands that are one component then are done. In the others,
documents of different components are compared in tiles: blocks of the band meet in tasks,
registers first and sets where the estimate asks for it, each pair in the first band that it
shares. A tile returns only links. Blocks of one component are never compared with each
other, so a large group and a few others in its band cost one pass over the group.

Edge cases: texts without words, null ones too, have an empty set and link with nothing.
Rows with the same id are one document and get the same component; if their texts differ,
the one with the least set key speaks for them. Rows without an id link with nothing and are
kept, with a null component. Other columns are not read.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import components, empty, stored, with_group_min
from touchline.llm.textscan import mix, powers, text_words

WORDS = 5
#: 100 * intersection >= PERCENT * union.
PERCENT = 75
ROWS, BANDS = 4, 40
BUCKETS = ROWS * BANDS
MANTISSA = 10
#: A block of a tile holds about so many documents, and so many shingles, at most.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
SET_KEY = ["n_shingles", "set_a", "set_b"]


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of all runs of five words, or of the whole if shorter."""
    n = min(WORDS, len(hashes))
    if not n:
        return np.empty(0, np.uint64)
    count = len(hashes) - n + 1
    total = np.full(count, n, np.uint64)
    for j, power in enumerate(powers(n + 1)[1:]):
        total += hashes[j : j + count] * power
    return np.unique(mix(total))


@cache
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    """An odd factor and a summand for each bucket."""
    seeds = mix(np.arange(1, 2 * BUCKETS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:BUCKETS] | np.uint64(1), seeds[BUCKETS:]


def registers(found: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of the least permuted hash, for each bucket."""
    factor, summand = _permutations()
    least = np.full(BUCKETS, np.iinfo(np.uint64).max)
    for i in range(0, len(found), 512):
        block = found[i : i + 512, None] * factor + summand
        least = np.minimum(least, block.min(axis=0))
    # The exponent of a double is the place of the highest bit; rounding to a double could
    # raise it, so the lowest bits go first.
    high = least >> np.uint64(11)
    _, exponent = np.frexp(high.astype(np.float64))
    zeros = np.minimum(53 - exponent, 53).astype(np.uint64)
    shifted = np.where(exponent > 0, least << (zeros + np.uint64(1)), np.uint64(0))
    return (zeros << np.uint64(MANTISSA) | shifted >> np.uint64(64 - MANTISSA)).astype(np.uint16)


def collision_rate(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The chance that the minima of sets of n and m others share a register."""
    zeros = np.arange(54)
    upper, lower = 0.5**zeros, 0.5 ** (zeros + 1)

    def spread(size):
        size = np.maximum(size, 1)[:, None].astype(float)
        return (1 - lower) ** size - (1 - upper) ** size

    return (spread(n) * spread(m)).sum(axis=1) / (1 << MANTISSA)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity of rows of registers, corrected for chance collisions."""
    equal = (a == b).mean(axis=1)
    chance = collision_rate(n, m)
    return (equal - chance) / (1 - chance)


#: Pairs with a lower estimate are more than six deviations away from the limit.
LEAST_ESTIMATE = PERCENT / 100 - 6 * (PERCENT / 100 * (1 - PERCENT / 100) / BUCKETS) ** 0.5


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, a 128-bit key of the set, and the registers by band."""
    schema = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = []
            for _, hashes, _ in text_words(texts, lower=True):
                found = shingles(hashes)
                bands = registers(found).view(np.int64) if len(found) else None
                rows.append((*_set_key(found), bands))
            if rows:
                n, a, b, bands = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(n, pa.int64()),
                        pa.array(a, pa.int64()),
                        pa.array(b, pa.int64()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "set_a", "set_b", "bands"],
                )

    return _texts(docs).mapInArrow(run, schema)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _set_key(found: np.ndarray) -> tuple[int, int, int]:
    sums = found.sum(dtype=np.uint64), mix(found ^ np.uint64(5)).sum(dtype=np.uint64)
    return len(found), *np.array(sums, np.uint64).view(np.int64).tolist()


def shingle_sets(docs: DataFrame) -> DataFrame:
    """doc_id, the key of the set, and the sorted shingle hashes, as bytes."""

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            sets = [shingles(h) for _, h, _ in text_words(texts, lower=True)]
            if sets:
                keys = [pa.array(c, pa.int64()) for c in zip(*map(_set_key, sets))]
                raw = pa.array([x.tobytes() for x in sets], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *keys, raw], ["doc_id", *SET_KEY, "shingles"]
                )

    schema = "doc_id long, n_shingles long, set_a long, set_b long, shingles binary"
    return _texts(docs).mapInArrow(run, schema)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the pairs (a, b), those that are similar: by estimate first, then on full sets."""
    for side in ("a", "b"):
        mine = sets.select(
            F.col("doc_id").alias(side),
            F.col("bands").alias(f"bands_{side}"),
            F.col("shingles").alias(f"shingles_{side}"),
        )
        pairs = pairs.join(mine, side)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (
                np.frombuffer(batch.column(f"bands_{s}").flatten().to_numpy().tobytes(), np.uint16)
                .reshape(-1, BUCKETS)
                for s in ("a", "b")
            )
            left, right = (batch.column(f"shingles_{s}") for s in ("a", "b"))
            sizes = [np.array([len(x.as_buffer()) // 8 for x in side]) for side in (left, right)]
            close = estimate(one, two, *sizes) >= LEAST_ESTIMATE
            linked = np.zeros(batch.num_rows, bool)
            for i in np.flatnonzero(close):
                x, y = (np.frombuffer(s[int(i)].as_buffer(), np.uint64) for s in (left, right))
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked[i] = 100 * both >= PERCENT * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(linked))

    return pairs.select("a", "b", "bands_a", "bands_b", "shingles_a", "shingles_b").mapInArrow(
        run, "a long, b long"
    )


def _candidates(a: pd.DataFrame, b: pd.DataFrame, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of pairs of two blocks that are to be verified: of different
    components, sharing no earlier band, and similar by size and by estimate."""
    mine, theirs = (np.stack(x["bands"].to_numpy()).view(np.int64) for x in (a, b))
    sizes = [x["size"].to_numpy() for x in (a, b)]
    labels = [x["component"].to_numpy() for x in (a, b)]
    rows, columns = [], []
    for i in range(len(a)):
        small, large = np.minimum(sizes[0][i], sizes[1]), np.maximum(sizes[0][i], sizes[1])
        ok = (labels[0][i] != labels[1]) & (100 * small >= PERCENT * large)
        at = np.flatnonzero(ok)
        if not len(at):
            continue
        shared = mine[i] == theirs[at]
        at = at[~shared[:, :band].any(axis=1)]
        if not len(at):
            continue
        one = np.broadcast_to(mine[i].view(np.uint16), (len(at), BUCKETS))
        size = np.full(len(at), sizes[0][i])
        close = estimate(one, theirs[at].view(np.uint16), size, sizes[1][at]) >= LEAST_ESTIMATE
        columns.append(at[close])
        rows.append(np.full(int(close.sum()), i))
    none = np.empty(0, int)
    return np.concatenate([none, *rows]), np.concatenate([none, *columns])


def tile(frame: pd.DataFrame) -> pd.DataFrame:
    """The links (a, b) that join components in one tile."""
    first = frame.iloc[0]
    one, two, band = int(first["one"]), int(first["two"]), int(first["band"])
    frame = frame.assign(size=frame["shingles"].map(len) // 8).sort_values("doc")
    left = frame[frame["block"] == one]
    right = left if one == two else frame[frame["block"] == two]
    if not len(left) or not len(right):
        return pd.DataFrame({"a": [], "b": []}, dtype=np.int64)
    rows, columns = _candidates(left, right, band)
    if one == two:
        upper = rows < columns
        rows, columns = rows[upper], columns[upper]
    sets: dict[tuple[int, int], set] = {}
    label: dict[int, int] = {}

    def root(c: int) -> int:
        while label.get(c, c) != c:
            label[c] = label.get(label[c], label[c])
            c = label[c]
        return c

    def held(side: int, block: pd.DataFrame, i: int) -> set:
        key = (0 if one == two else side, i)
        if key not in sets:
            sets[key] = set(np.frombuffer(block["shingles"].iat[i], np.int64).tolist())
        return sets[key]

    links = []
    for i, j in zip(rows.tolist(), columns.tolist()):
        c, d = root(left["component"].iat[i]), root(right["component"].iat[j])
        if c == d:
            continue
        x, y = held(0, left, i), held(1, right, j)
        both = len(x & y)
        if 100 * both >= PERCENT * (len(x) + len(y) - both):
            label[max(c, d)] = min(c, d)
            links.append((left["doc"].iat[i], right["doc"].iat[j]))
    return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)


def _tiled(members: DataFrame, labels: DataFrame | None, sets: DataFrame) -> DataFrame:
    """The links in bands that hold several components."""
    placed = members.withColumn("component", F.col("doc"))
    if labels is not None:
        known = labels.select(F.col("node").alias("doc"), F.col("component").alias("_label"))
        placed = members.join(known, "doc", "left").withColumn("component", F.coalesce("_label", "doc"))
    placed = stored(placed.select("bucket", "band", "doc", "size", "component"), "placed")
    # A band of two was compared in full.
    mixed = placed.groupBy("bucket").agg(
        F.min("component").alias("_main"), F.max("component").alias("_high"), F.count(F.lit(1)).alias("_n")
    )
    mixed = stored(mixed.where("_main <> _high AND _n > 2").select("bucket", "_main"), "mixed")
    placed = placed.join(mixed, "bucket").withColumn("_other", F.col("component") != F.col("_main"))
    placed = stored(placed.drop("_main"), "others")

    def blocks(of):
        count = F.sum(of.cast("long")) / BLOCK
        return F.ceil(F.greatest(count, F.sum(F.when(of, F.col("size"))) / BLOCK_SHINGLES))

    sizes = placed.groupBy("bucket").agg(
        blocks(~F.col("_other")).alias("_first"), blocks(F.col("_other")).alias("_second"),
        blocks(F.lit(True)).alias("_all"),
    )
    large = stored(sizes.where("_all > 1").drop("_all"), "large")
    placed = placed.join(large, "bucket", "left")
    split, other = F.col("_first").isNotNull(), F.col("_other")
    all_blocks = F.col("_first") + F.col("_second")
    place = F.pmod(F.xxhash64("doc"), F.when(other, F.col("_second")).otherwise(F.col("_first")))
    block = F.when(split, place + F.when(other, F.col("_first")).otherwise(0)).otherwise(0)
    meets = F.when(
        split, F.sequence(F.when(other, F.lit(0)).otherwise(F.col("_first")).cast("long"), all_blocks - 1)
    ).otherwise(F.array(F.lit(0).cast("long")))
    dealt = placed.withColumn("block", block.cast("long")).withColumn("_with", F.explode(meets))
    dealt = dealt.select(
        "bucket", "band", "doc", "component", "block",
        F.least("block", "_with").alias("one"), F.greatest("block", "_with").alias("two"),
    )
    full = dealt.join(sets.withColumnRenamed("doc_id", "doc"), "doc")
    return full.groupBy("bucket", "one", "two").applyInPandas(tile, "a long, b long")


def links(docs: DataFrame, unique: DataFrame) -> DataFrame | None:
    """(node, component) of the documents of ``unique`` that link with another."""
    banded = unique.select(
        F.col("doc_id").alias("doc"), F.col("n_shingles").alias("size"), F.posexplode("bands").alias("band", "_key")
    )
    banded = banded.select(F.xxhash64("band", "_key").alias("bucket"), "band", "doc", "size")
    shared = banded.groupBy("bucket").agg(F.min("doc").alias("pivot"), F.count(F.lit(1)).alias("_n"))
    # Stored, so that this and the later joins are between plain frames: Spark can split
    # the rows of a bucket that holds a large group.
    shared = stored(shared.where("_n > 1").select("bucket", "pivot"), "shared")
    members = stored(banded.join(shared, "bucket"), "buckets")
    if empty(members):
        return None
    wanted = stored(members.select(F.col("doc").alias("doc_id")).distinct(), "members")
    chosen = docs.join(wanted, docs["doc_id"].cast("long") == wanted["doc_id"], "left_semi")
    sets = shingle_sets(chosen).join(unique, ["doc_id", *SET_KEY])
    sets = stored(sets.select("doc_id", "bands", "shingles").dropDuplicates(["doc_id"]), "sets")
    pairs = members.where("doc <> pivot").select(F.col("pivot").alias("a"), F.col("doc").alias("b"))
    edges = stored(confirmed(stored(pairs.distinct(), "pairs"), sets), "links")
    labels = None if empty(edges) else components(edges)
    more = stored(_tiled(members.drop("pivot"), labels, sets), "links")
    if not empty(more):
        labels = components(edges.unionByName(more))
    return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    signed = stored(signatures(docs), "signatures")
    sized = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    one = sized.groupBy("doc_id").agg(F.min(F.struct(*SET_KEY)).alias("_set")).select("doc_id", "_set.*")
    copies = stored(with_group_min(one, SET_KEY, "doc_id", "node"), "copies")
    first = copies.where("doc_id = node").select("doc_id", *SET_KEY)
    unique = stored(sized.join(first, ["doc_id", *SET_KEY]), "unique")
    labels = links(docs, unique.dropDuplicates(["doc_id"]))
    named, node = copies.select("doc_id", "node"), F.col("node")
    if labels is not None:
        known = labels.withColumnRenamed("node", "_node")
        named = named.join(known, F.col("node") == F.col("_node"), "left")
        node = F.coalesce("component", "node")
    named = named.select("doc_id", node.alias("_component"))
    done = signed.select("doc_id", "n_shingles").join(named, "doc_id", "left")
    component = F.coalesce("_component", "doc_id")
    kept = F.coalesce(component == F.col("doc_id"), F.lit(True))
    return done.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component stays, with all columns, whatever their names."""
    gone = near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    gone = stored(gone, "gone").alias("gone")
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), row)
    return rows.join(gone, rows["id"] == F.col("gone.doc_id"), "left_anti").select("row.*")
