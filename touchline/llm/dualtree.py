"""Operator 11: ranked lexical search of items over all documents by dual trees.

A first pass reads every whole text once and keeps, for each document, its length and how often
it holds each term of the items. From these rows come the document counts of the terms, and
with them the weights.

Then every task searches its documents in batches. A batch is a tree: its documents, groups of
``LEAF`` of them, groups of ``FAN`` groups, and so on; a node holds for each term the largest
share that a document below it gives. The items are a tree as well; a node holds the terms of
its items with their weights, which are the same for all of them. The product of an item node
and a document node is a bound for all their pairs. Where it is below the weakest k-th best score
of the node's items, the pair of nodes is left out with everything below it; equality is
no reason, as ids decide between equal scores. What is left meets in exact products, of
integers below 2^53 held in doubles, or else of 64-bit integers.

Documents are searched in two rounds, a small share of them and all others. The k-th best scores
of the first round bound those of all documents from below, so every task of the second one
starts with them. Tasks hand on ``k`` rows an item, which are merged in two steps. Items
are searched in blocks of ``BLOCK_TERMS`` terms (or one item), the only thing that every task is
given whole; each block reads the texts again.

Edge cases: a null or empty text has no terms, takes no part in the counts and is never found; an
item without terms, or whose terms no document holds, finds nothing; every row of the items is an
item of its own, repeated ids included; rows that repeat a document are ranked one by one; a null
document id comes before all others among equal scores; empty tables find nothing. Other
columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import SALTS, stored

K = 10
#: Terms of a block of items.
BLOCK_TERMS = 1 << 16
#: One document of so many is searched in the first round.
FIRST = 16
LEAF = 32
FAN = 8
ITEM_FAN = 4
#: Cells of a batch: terms times documents, four bytes each.
CELLS = 1 << 23
BATCH = 1024
#: Bytes of a text that are cut into words at once.
PIECE = 1 << 20
#: Stands for a null id, before all others.
NOBODY = -(1 << 63)

#: Everything but digits, letters and what is not ASCII separates terms; A-Z is lower-cased.
_TERMS = bytes(
    c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32
    for c in range(256)
)


def words(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in order, some at a time."""
    plain = text.translate(_TERMS)
    start = 0
    while start < len(plain):
        end = plain.find(b" ", start + PIECE)
        end = len(plain) if end < 0 else end
        yield plain[start:end].split()
        start = end


def _bytes(df: DataFrame, column: str):
    return F.col(column).cast("string").cast("binary").alias(column)


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, terms): ``item`` numbers the rows, ``terms`` are distinct."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            terms = [sorted({w for part in words(t or b"") for w in part}) for t in texts]
            lists = pa.array(terms, pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), batch.column("item_id"), lists], ["item", "item_id", "terms"]
            )

    number = F.monotonically_increasing_id().alias("item")
    ident = items.schema["item_id"].dataType.simpleString()
    rows = items.select(number, "item_id", _bytes(items, "text"))
    return rows.mapInArrow(run, f"item long, item_id {ident}, terms array<binary>")


def blocks(items: DataFrame) -> list[DataFrame]:
    """The items, dealt out until no block has more than ``BLOCK_TERMS`` terms or it is one item."""
    items = items.withColumn("size", F.size("terms").cast("long"))
    count = -(-(items.agg(F.sum("size")).first()[0] or 0) // BLOCK_TERMS)
    while count > 1:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(count)))
        sizes = dealt.groupBy("block").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
        if not sizes.where((F.col("size") > BLOCK_TERMS) & (F.col("rows") > 1)).take(1):
            return [dealt.where(F.col("block") == b).drop("size", "block") for b in range(count)]
        count *= 2
    return [items.drop("size")] if count else []


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts) of each document that has terms: ``n`` counts all of them,
    ``terms`` and ``counts`` those of the vocabulary."""

    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            for ident, text in zip(batch.column("doc_id"), batch.column("text")):
                n, found = 0, Counter()
                for part in words(text.as_py() or b""):
                    n += len(part)
                    found.update(map(vocabulary.get, part))
                found.pop(None, None)
                if n:
                    rows.append((ident.as_py(), n, list(found), list(found.values())))
            if rows:
                ids, sizes, terms, counts = zip(*rows)
                numbers = pa.list_(pa.int32())
                arrays = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64())]
                arrays += [pa.array(terms, numbers), pa.array(counts, numbers)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "terms", "counts"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _bytes(docs, "text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


@dataclass
class Corpus:
    """Counts over all documents: with terms, their terms, and documents by term."""

    documents: int
    terms: int
    holding: np.ndarray

    def weights(self) -> np.ndarray:
        top = 2 * self.documents + 2
        return np.array([floor(1000 * log(top / (2 * int(df) + 1))) for df in self.holding], np.int64)

    def shares(self, n: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """What a term gives, before its weight, that stands ``counts`` times among ``n``."""
        m = 100 - 90 + (90 * n * self.documents) // self.terms
        return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


def corpus_of(rows: DataFrame, size: int) -> Corpus:
    """``size`` numbers come to the driver: the terms of one block of items."""
    total = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
    holding = np.zeros(size, np.int64)
    for term, n in rows.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        holding[term] = n
    return Corpus(total[0], total[1] or 0, holding)


class ItemTree:
    """Items in an order that brings those with the same common terms together.

    ``levels[0]`` are the terms of the items, ``levels[n]`` those of groups of ``ITEM_FAN``.
    """

    def __init__(self, items: list[np.ndarray], weights: np.ndarray):
        held = np.bincount(np.concatenate(items), minlength=len(weights))
        rank = np.empty(len(weights), np.int64)
        rank[np.argsort(-held, kind="stable")] = np.arange(len(weights))
        self.order = sorted(range(len(items)), key=lambda i: sorted(rank[items[i]].tolist()))
        self.weights = weights
        self.levels = [[items[i] for i in self.order]]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            groups = [below[i : i + ITEM_FAN] for i in range(0, len(below), ITEM_FAN)]
            self.levels.append([np.unique(np.concatenate(group)) for group in groups])
        most = int(weights[self.levels[-1][0]].sum()) * 1_000_000
        #: Products of such numbers are exact, bounds included.
        self.exact = np.float64 if most < 1 << 53 else np.int64

    def weakest(self, kth: np.ndarray) -> list[np.ndarray]:
        """The least k-th best score below each node, by level."""
        found = [kth]
        for level in self.levels[1:]:
            found.append(np.minimum.reduceat(found[-1], np.arange(len(level)) * ITEM_FAN))
        return found


class Search:
    """The best documents of each item so far; ``kth`` starts with scores that k documents reach."""

    def __init__(self, tree: ItemTree, kth: np.ndarray, k: int = K):
        self.tree, self.k = tree, k
        self.kth = np.maximum(kth, 1)[tree.order]
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in tree.order]
        self.scored = 0

    def batch_size(self) -> int:
        return max(LEAF, min(BATCH, CELLS // max(1, len(self.tree.weights))))

    def add(self, ids: np.ndarray, owner: np.ndarray, terms: np.ndarray, shares: np.ndarray) -> None:
        """A batch of documents: ``owner`` is the place in ``ids`` of each (term, share)."""
        cells = np.zeros((len(self.tree.weights), len(ids)), np.float32)
        cells[terms, owner] = shares
        order = self._similar(cells)
        levels = [cells[:, order]]
        width = LEAF
        while levels[-1].shape[1] > 1:
            starts = np.arange(0, levels[-1].shape[1], width)
            levels.append(np.maximum.reduceat(levels[-1], starts, axis=1))
            width = FAN
        weakest = self.tree.weakest(self.kth)
        top = len(self.tree.levels) - 1
        pairs = [(top, 0, len(levels) - 1, np.zeros(1, np.int64))]
        while pairs:
            at, item, depth, nodes = pairs.pop()
            bound = self._product(self.tree.levels[at][item], levels[depth], nodes)
            near = bound >= (self.kth if at == 0 else weakest[at])[item]
            nodes = nodes[near]
            if not len(nodes):
                continue
            if at == 0 and depth == 0:
                self.scored += len(nodes)
                self._offer(item, bound[near].astype(np.int64), ids[order[nodes]])
                continue
            if depth > (1 if at else 0):
                fan = LEAF if depth == 1 else FAN
                nodes = (nodes[:, None] * fan + np.arange(fan)).ravel()
                depth -= 1
                nodes = nodes[nodes < levels[depth].shape[1]]
            if at:
                last = min((item + 1) * ITEM_FAN, len(self.tree.levels[at - 1]))
                pairs += [(at - 1, i, depth, nodes) for i in range(item * ITEM_FAN, last)]
            else:
                pairs.append((0, item, depth, nodes))

    def _similar(self, cells: np.ndarray) -> np.ndarray:
        """The documents in the order of the group of items that they suit most."""
        groups = next(level for level in self.tree.levels if len(level) <= 16)
        every = np.arange(cells.shape[1])
        return np.argsort(np.argmax([self._product(g, cells, every) for g in groups], 0), kind="stable")

    def _product(self, terms: np.ndarray, cells: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        part = cells[terms] if len(nodes) == cells.shape[1] else cells[np.ix_(terms, nodes)]
        return self.tree.weights[terms].astype(self.tree.exact) @ part.astype(self.tree.exact)

    def _offer(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate((self.best[item][0], scores))
        ids = np.concatenate((self.best[item][1], ids))
        order = np.lexsort((ids, -scores))[: self.k]
        self.best[item] = scores[order], ids[order]
        if len(order) == self.k:
            self.kth[item] = max(self.kth[item], scores[order[-1]])

    def rows(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for place, (scores, ids) in zip(self.tree.order, self.best):
            if len(ids):
                yield place, scores, ids


def search(rows: DataFrame, items: list[np.ndarray], corpus: Corpus, kth: np.ndarray, k: int) -> DataFrame:
    """(place, doc_id, score): the best ``k`` rows of every task for each of ``items``."""

    def run(batches):
        found = Search(ItemTree(items, corpus.weights()), kth, k)
        for batch in batches:
            size = found.batch_size()
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                ids = part.column("doc_id").fill_null(NOBODY).to_numpy()
                terms, counts = part.column("terms"), part.column("counts").flatten().to_numpy()
                owner = np.repeat(np.arange(len(ids)), np.diff(terms.offsets.to_numpy()))
                n = part.column("n").to_numpy()[owner]
                shares = corpus.shares(n, counts.astype(np.int64))
                found.add(ids, owner, terms.flatten().to_numpy(), shares)
        for place, scores, ids in found.rows():
            arrays = [pa.array(np.full(len(ids), place)), pa.array(ids), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(arrays, ["place", "doc_id", "score"])

    return rows.select("doc_id", "n", "terms", "counts").mapInArrow(run, "place long, doc_id long, score long")


def best(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of each item with their ranks, first by groups of documents."""
    order = [F.col("score").desc(), F.col("doc_id")]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    some = Window.partitionBy("place", "salt").orderBy(*order)
    every = Window.partitionBy("place").orderBy(*order)
    cut = found.withColumn("salt", salt).withColumn("rank", F.row_number().over(some))
    cut = cut.where(F.col("rank") <= k).withColumn("rank", F.row_number().over(every))
    return cut.where(F.col("rank") <= k).drop("salt")


def rank_block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(item, rank, doc_id, score) of one block of items."""
    held = items.select("item", "terms").collect()
    vocabulary = {t: i for i, t in enumerate(sorted({t for row in held for t in row["terms"]}))}
    numbers = [np.array([vocabulary[t] for t in row["terms"]], np.int64) for row in held]
    places = [i for i, terms in enumerate(numbers) if len(terms)]
    numbers = [numbers[i] for i in places]

    first = F.pmod(F.xxhash64("doc_id", "n"), F.lit(FIRST)) == 0
    rows = stored(vectors(docs, vocabulary).withColumn("first", first), "vectors", ["first"])
    corpus = corpus_of(rows, len(vocabulary))
    kth = np.zeros(len(places), np.int64)
    early = stored(best(search(rows.where("first"), numbers, corpus, kth, k), k), "early")
    for place, score in early.where(F.col("rank") == k).select("place", "score").toLocalIterator():
        kth[place] = score
    late = search(rows.where("NOT first"), numbers, corpus, kth, k)
    ranked = best(early.drop("rank").unionByName(late), k)

    name = docs.sparkSession.createDataFrame(
        [(i, held[place]["item"]) for i, place in enumerate(places)], "place long, item long"
    )
    ident = F.when(F.col("doc_id") != NOBODY, F.col("doc_id"))
    return ranked.join(name, "place").select("item", "rank", ident.alias("doc_id"), "score")


def rank(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item, as far as there are."""
    items = stored(item_terms(items), "items")
    ranked = [rank_block(docs, block, k) for block in blocks(items)]
    if not ranked:
        none = F.lit(None).cast("long")
        columns = [none.cast("int").alias("rank"), none.alias("doc_id"), none.alias("score")]
        ranked = [items.limit(0).select("item", *columns)]
    whole = ranked[0]
    for more in ranked[1:]:
        whole = whole.unionByName(more)
    return whole.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
