"""Operator 12: a Merkle manifest of a table as a persistent tree with path copying.

Every row is a leaf: the SHA-256 of its fields. The leaves of a language, by document id, are
the bottom of its tree; runs of ``FAN`` nodes become the node above. The roots of the
languages are the bottom of one more tree, whose root stands for the whole table.

The trees are built in aligned blocks of ``FAN ** LEVELS`` nodes. A task holds the persistent
tree of one block: a tampered leaf makes a version that copies the ancestors of the leaf inside
the block and shares all other nodes. The tops of the blocks are the bottom of the next round,
so a tree of n rows takes about log n / log ``FAN ** LEVELS`` rounds. Then the siblings
of every block's top come down the same rounds, one row for each block, and the versions of a
block are carried on to the root in the task that holds it: no task meets the versions of more
than one block, and no version meets another one.

Edge cases: null fields have a mark of their own (``-``), so they differ from empty ones; a null
language is a tree before the others, and null ids come first in it; rows with the same language
and id are ordered by their leaves, and equal rows are leaves of their own; a lone leaf is its own
root; a null id is not tampered; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from touchline.llm.common import empty, numbered, stored

FAN = 8
#: Levels that one task builds: 512 leaves.
LEVELS = 3
BLOCK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NODE = "tree long, place long, n long, digest string"
#: The way from a node to the root of the table: what stands left and right of it, by level.
WAY = "tree long, place long, left array<string>, right array<string>, subroot string, root string"


def field(value: Column) -> Column:
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def leaf(fields: Iterable[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def joined(digests: Iterable[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` nodes of a block; a lone node has none, a whole block ``LEVELS``."""
    levels = 0
    while n > 1 and levels < LEVELS:
        n, levels = -(-n // FAN), levels + 1
    return levels


class BlockTree:
    """A persistent tree. A version is the number of its top node; nodes never change."""

    def __init__(self, leaves: Sequence[str], levels: int):
        self.digests = list(leaves)
        self.children: list[list[int]] = [[] for _ in leaves]
        self.levels = levels
        nodes = list(range(len(leaves)))
        for _ in range(levels):
            nodes = [self.node(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]
        self.top = nodes[0]

    def node(self, children: list[int]) -> int:
        self.digests.append(joined(self.digests[c] for c in children))
        self.children.append(children)
        return len(self.digests) - 1

    def path(self, place: int) -> list[tuple[list[int], int]]:
        """(children, slot of the way down) of each ancestor of a leaf, from the top."""
        found, node = [], self.top
        for level in reversed(range(self.levels)):
            children, slot = self.children[node], place // FAN**level % FAN
            found.append((children, slot))
            node = children[slot]
        return found

    def version(self, place: int, digest: str) -> int:
        """A tree in which one leaf is another one: its ancestors are copied, the rest is shared."""
        self.digests.append(digest)
        self.children.append([])
        new = len(self.digests) - 1
        for children, slot in reversed(self.path(place)):
            new = self.node([*children[:slot], new, *children[slot + 1 :]])
        return new

    def siblings(self, place: int) -> tuple[list[str], list[str]]:
        """What stands left and right of a leaf and of its ancestors, from the bottom."""
        path = self.path(place)[::-1]
        left = ["".join(self.digests[c] for c in children[:slot]) for children, slot in path]
        right = ["".join(self.digests[c] for c in children[slot + 1 :]) for children, slot in path]
        return left, right


def fold(digest: str, left: Iterable[str], right: Iterable[str]) -> str:
    for before, after in zip(left, right):
        digest = joined((before, digest, after))
    return digest


def block_tree(rows: pa.Table) -> tuple[pa.Table, BlockTree]:
    """The nodes of one block in order, and their tree."""
    rows = rows.sort_by("place")
    whole = rows["n"][0].as_py() > BLOCK
    return rows, BlockTree(rows["digest"].to_pylist(), LEVELS if whole else height(len(rows)))


def _top(rows: pa.Table) -> pa.Table:
    rows, tree = block_tree(rows)
    number, place, n = (rows[c][0].as_py() for c in ("tree", "place", "n"))
    row = (number, place // BLOCK, -(-n // BLOCK), tree.digests[tree.top])
    return pa.table([[value] for value in row], ["tree", "place", "n", "digest"])


def _ways_down(rows: pa.Table, above: pa.Table) -> pa.Table:
    rows, tree = block_tree(rows)
    way = above.to_pylist()[0]
    beside = [tree.siblings(place) for place in range(len(rows))]
    text, count = pa.string(), len(rows)
    columns = {
        "tree": rows["tree"],
        "place": rows["place"],
        "left": pa.array([left + way["left"] for left, _ in beside], pa.list_(text)),
        "right": pa.array([right + way["right"] for _, right in beside], pa.list_(text)),
        "subroot": pa.array([way["subroot"]] * count, text),
        "root": pa.array([way["root"]] * count, text),
    }
    return pa.table(columns)


def _verified(rows: pa.Table, above: pa.Table) -> pa.Table:
    rows, tree = block_tree(rows)
    way = above.to_pylist()[0]
    proofs, folded = [], []
    for place, changed in enumerate(rows["changed"].to_pylist()):
        left, right = tree.siblings(place)
        pairs = zip(left + way["left"], right + way["right"])
        proofs.append(joined(x for pair in pairs for x in pair))
        version = tree.top if changed is None else tree.version(place, changed)
        folded.append(fold(tree.digests[version], way["left"], way["right"]))
    columns = {
        "doc_id": rows["doc_id"],
        "leaf": rows["digest"],
        "subroot": [way["subroot"]] * len(rows),
        "root": [way["root"]] * len(rows),
        "proof_sha256": proofs,
        "folded_root": folded,
        "verified": [f == way["root"] for f in folded],
    }
    return pa.table(columns)


def by_block(nodes: DataFrame) -> GroupedData:
    return nodes.withColumn("block", F.floor(F.col("place") / BLOCK)).groupBy("tree", "block")


def with_way(nodes: DataFrame, ways: DataFrame) -> PandasCogroupedOps:
    """The nodes of each block, and the way of the block's top."""
    return by_block(nodes).cogroup(
        ways.withColumnRenamed("place", "block").groupBy("tree", "block")
    )


def climb(nodes: DataFrame) -> list[DataFrame]:
    """The nodes by round: those given, the tops of their blocks, and so on up to the roots."""
    rounds = [nodes]
    while not empty(rounds[-1].where("n > 1")):
        rounds.append(stored(by_block(rounds[-1]).applyInArrow(_top, NODE), "tops"))
    return rounds


def descend(rounds: list[DataFrame], ends: DataFrame) -> DataFrame:
    """The ways of the tops of the lowest blocks, from the ways of the roots."""
    ways = ends
    for nodes in reversed(rounds[1:]):
        ways = stored(with_way(nodes, ways).applyInArrow(_ways_down, WAY), "ways")
    return ways


@dataclass
class Manifest:
    """``leaves`` with their places in their trees, and the way from each block to the root."""

    leaves: DataFrame
    ways: DataFrame

    def verify(self) -> DataFrame:
        """Each leaf with its proof, and the root that its version leads to."""
        ident = self.leaves.schema["doc_id"].dataType.simpleString()
        schema = (
            f"doc_id {ident}, leaf string, subroot string, root string, proof_sha256 string, "
            "folded_root string, verified boolean"
        )
        return with_way(self.leaves, self.ways).applyInArrow(_verified, schema)


def build(leaves: DataFrame) -> Manifest:
    """The manifest of (doc_id, lang, digest, changed): ``changed`` is null, or what a tampered
    leaf has become."""
    # Stored: sorting looks at the leaves twice. The number deals out equal rows.
    dealt = stored(leaves, "digests").withColumn("_copy", F.monotonically_increasing_id())
    rows = numbered(dealt, ["lang", "doc_id", "digest", "_copy"], "leaves")
    langs = rows.groupBy("lang").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    langs = stored(numbered(langs, ["lang"], "langs").withColumnRenamed("row", "tree"), "trees")
    same = F.col("r.lang").eqNullSafe(F.col("l.lang"))
    places = rows.alias("r").join(langs.alias("l"), same).select(
        "doc_id", "tree", (F.col("row") - F.col("first")).alias("place"), "n", "digest", "changed"
    )
    leaves = stored(places, "places")
    rounds = climb(leaves.select("tree", "place", "n", "digest"))

    # The roots of the languages are the leaves of a tree above them.
    above, count = F.lit(0).cast("long"), F.lit(langs.count()).cast("long")
    subroots = rounds[-1].select(
        above.alias("tree"), F.col("tree").alias("place"), count.alias("n"), "digest"
    )
    top = climb(subroots)
    none = F.array().cast("array<string>")
    end = top[-1].select(
        "tree", "place", none.alias("left"), none.alias("right"),
        F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"),
    )
    ways = with_way(subroots, descend(top, end)).applyInArrow(_ways_down, WAY)
    ends = ways.drop("tree", "subroot").withColumnRenamed("place", "tree").join(
        rounds[-1].select("tree", "place", F.col("digest").alias("subroot")), "tree"
    )
    ends = stored(ends.select("tree", "place", "left", "right", "subroot", "root"), "ends")
    return Manifest(leaves, descend(rounds, ends))


def documents(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, lang, digest, changed) of a table with ``FIELDS``.

    Tampering lower-cases the letters A-Z of the text, where ``tampered`` is true.
    """
    parts = [F.col(c) for c in FIELDS]
    lowered = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    changed = F.when(tampered if tampered is not None else F.lit(False), leaf([*parts[:-1], lowered]))
    lang = F.col("lang").cast("string").alias("lang")
    return docs.select("doc_id", lang, leaf(parts).alias("digest"), changed.alias("changed"))


def every_third() -> Column:
    """Where 3 divides the CRC-32 of the decimal id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
