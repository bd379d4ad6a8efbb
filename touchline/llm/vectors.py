"""Operator 3: embedding near-duplicates by int8 tile products with error bounds.

A unit vector x is stored as an int8 code c and a scale s with x = s * c + e. For two
vectors, x.y differs from s_x s_y (c_x . c_y) by at most |e_x| |s_y c_y| + |e_y|, which are
known for each vector. A tile gets codes, scales and errors, no vectors, and multiplies the codes;
integer products are exact in floating point. Pairs that reach the limit whatever their errors
are linked, and those that can't are not. The vectors of the other pairs, the ends and not the
pairs, come to their tile once more in full, and double precision decides.

Tiles are the buckets of random-hyperplane tables, so the work grows with the number of
vectors times the size of a tile and not with its square. There are as many bits as keep a
bucket near ``TILE`` vectors, and as many tables as leave a pair at the limit unfound with
probability ``MISS`` at most. Buckets are taken from the codes by integer products, which
are the same in every task. A pair counts in the first table that brings it together. A
larger bucket is split into blocks, and its pairs of blocks are separate tiles. No pair
leaves a tile: it returns counts of links, and for each vector one it is connected with.

Equal vectors stand as one, with their number.

Edge cases: vectors that are null, empty, zero or hold nulls, NaN or infinities have no
links; vectors of different dimension never link; rows with the same id and vector are one
vector, and with different vectors each row has the links of its own; rows without an id
have no links and a null component; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache
from math import acos, ceil, log, log2, pi

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import components, stored, with_group_min

LIMIT = 0.95
TILE = 1024
MISS = 1e-6
STRIP = 256
KEY = ["vec_a", "vec_b"]
TILE_KEY = ["table", "key", "size", "one", "two"]
TILE_SCHEMA = (
    "vec_id long, table int, key long, size int, one long, two long, block long, "
    "n_links long, near long, undecided boolean"
)


def plan(count: int, limit: float = LIMIT) -> tuple[int, int]:
    """Bits of a bucket key and number of tables for so many vectors."""
    bits = max(1, round(log2(max(count, 2) / TILE)))
    together = (1 - acos(limit) / pi) ** bits
    return bits, ceil(log(MISS) / log(1 - together))


@cache
def _planes(size: int, tables: int, bits: int) -> np.ndarray:
    """Hyperplanes with small integer coefficients."""
    random = np.random.default_rng([size, 20240229])
    return np.rint(random.normal(scale=30, size=(size, tables * bits))).clip(-127, 127)


def units(vectors: list) -> np.ndarray:
    x = np.array(vectors, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, and the length of what the codes leave out."""
    scale = np.abs(x).max(axis=1) / 127
    codes = np.rint(x / scale[:, None])
    return codes, scale, np.sqrt(((x - codes * scale[:, None]) ** 2).sum(axis=1))


def buckets(codes: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """The key of every vector in every table."""
    side = codes @ _planes(codes.shape[1], tables, bits) >= 0
    return side.reshape(len(codes), tables, bits) @ (1 << np.arange(bits))


@dataclass
class Coded:
    """Vectors as codes, with their scales and the lengths of what the codes leave out."""

    codes: np.ndarray
    scale: np.ndarray
    error: np.ndarray

    def __getitem__(self, at) -> Coded:
        return Coded(self.codes[at], self.scale[at], self.error[at])


def judged(one: Coded, two: Coded, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (i, j) of the pairs that may reach the limit, and which of them do for sure."""
    size = one.codes.shape[1]
    kind = np.float32 if size <= 1024 else np.float64
    turned = np.ascontiguousarray(two.codes.T, kind)
    length = two.scale * np.sqrt((two.codes.astype(np.float64) ** 2).sum(axis=1))
    rows, columns, sure = [], [], []
    for start in range(0, len(one.codes), STRIP):
        here = one[start : start + STRIP]
        products = (here.codes.astype(kind) @ turned) * (here.scale[:, None] * two.scale)
        # With a margin for the rounding of doubles.
        bound = here.error[:, None] * length + two.error + 1e-9
        i, j = np.nonzero(products >= limit - bound)
        rows.append(i + start)
        columns.append(j)
        sure.append(products[i, j] >= limit + bound[i, j])
    none = np.empty(0, int)
    return np.concatenate([none, *rows]), np.concatenate([none, *columns]), np.concatenate([none > 0, *sure])


def reach(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, limit: float) -> np.ndarray:
    """Which pairs reach the limit in double precision."""
    found = np.zeros(len(i), bool)
    for k in range(0, len(i), 1 << 16):
        some = slice(k, k + (1 << 16))
        found[some] = np.einsum("ij,ij->i", x[i[some]], y[j[some]]) >= limit
    return found


def linked(x: np.ndarray, y: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Places (i, j) with x[i].y[j] >= limit, and how many pairs were recomputed."""
    i, j, sure = judged(Coded(*quantised(x)), Coded(*quantised(y)), limit)
    open_ = np.flatnonzero(~sure)
    sure[open_] = reach(x, y, i[open_], j[open_], limit)
    return i[sure], j[sure], len(open_)


def _connected(count: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least place that links lead to, for each place."""
    label = np.arange(count)
    while True:
        least = label.copy()
        np.minimum.at(least, i, label[j])
        np.minimum.at(least, j, label[i])
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _pairs(frame: pd.DataFrame, tables: int, bits: int, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (i, j) of the pairs of a tile that may reach the limit, and which do for sure.
    Pairs that an earlier table has brought together are left out."""
    first = frame.iloc[0]
    table, one, two = int(first["table"]), int(first["one"]), int(first["two"])
    codes = np.stack([np.frombuffer(c, np.int8) for c in frame["codes"]])
    coded = Coded(codes, frame["scale"].to_numpy(), frame["error"].to_numpy())
    if one == two:
        i, j, sure = judged(coded, coded, limit)
        upper = i < j
        i, j, sure = i[upper], j[upper], sure[upper]
    else:
        left = int((frame["block"] == one).sum())
        i, j, sure = judged(coded[:left], coded[left:], limit)
        j = j + left
    keys = buckets(codes, tables, bits)[:, :table]
    fresh = ~(keys[i] == keys[j]).any(axis=1)
    return i[fresh], j[fresh], sure[fresh]


def _links(frame: pd.DataFrame, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each vector, how many others links lead to, and one that it is connected with."""
    ids, weight = frame["vec_id"].to_numpy(), frame["copies"].to_numpy()
    total = np.bincount(i, weight[j], len(ids)) + np.bincount(j, weight[i], len(ids))
    # Places are ordered by block, so the label need not be the least id; any member does.
    return total.astype(np.int64), ids[_connected(len(ids), i, j)]


def _in_order(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.sort_values(["block", "vec_id"], ignore_index=True)


def tile(frame: pd.DataFrame, tables: int, bits: int, limit: float) -> pd.DataFrame:
    """The vectors of a tile with sure links or open pairs there."""
    frame = _in_order(frame)
    i, j, sure = _pairs(frame, tables, bits, limit)
    total, near = _links(frame, i[sure], j[sure])
    undecided = np.zeros(len(frame), bool)
    undecided[i[~sure]] = undecided[j[~sure]] = True
    out = frame[["vec_id", *TILE_KEY, "block"]].assign(n_links=total, near=near, undecided=undecided)
    return out[(total > 0) | undecided]


def recomputed(frame: pd.DataFrame, tables: int, bits: int, limit: float) -> pd.DataFrame:
    """The links among the open pairs of a tile, from the vectors that are part of one."""
    frame = _in_order(frame)
    i, j, sure = _pairs(frame, tables, bits, limit)
    x = units([np.frombuffer(v, np.float64) for v in frame["vector"]])
    i, j = i[~sure], j[~sure]
    linked_here = reach(x, x, i, j, limit)
    total, near = _links(frame, i[linked_here], j[linked_here])
    out = pd.DataFrame({"vec_id": frame["vec_id"], "n_links": total, "near": near})
    return out[total > 0]


def usable(vector: Column) -> Column:
    """No null, NaN or infinity in it, and not all zero."""
    odd = F.exists(
        vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    )
    some = F.exists(vector, lambda v: v != 0)
    return F.coalesce(~odd & some, F.lit(False))


def _prepared(unique: DataFrame, tables: int, bits: int) -> DataFrame:
    """The vectors as bytes of doubles, as codes, and with their keys."""

    def run(batches):
        for batch in batches:
            vectors = batch.column("vector").to_pylist()
            raw = [np.array(v, np.float64) for v in vectors]
            keys, codes, scales, errors = ([None] * len(raw) for _ in range(4))
            sizes = np.array([len(v) for v in raw])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                code, scale, error = quantised(units([raw[i] for i in at]))
                found = buckets(code, tables, bits)
                for k, i in enumerate(at):
                    keys[i], scales[i], errors[i] = found[k], scale[k], error[k]
                    codes[i] = code[k].astype(np.int8).tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("copies"),
                    pa.array([v.tobytes() for v in raw], pa.binary()),
                    pa.array(sizes, pa.int32()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(codes, pa.binary()),
                    pa.array(scales, pa.float64()),
                    pa.array(errors, pa.float64()),
                ],
                ["vec_id", "copies", "vector", "size", "keys", "codes", "scale", "error"],
            )

    schema = (
        "vec_id long, copies long, vector binary, size int, keys array<long>, codes binary, "
        "scale double, error double"
    )
    return unique.select("vec_id", "copies", "vector").mapInArrow(run, schema)


def near_vectors(embeddings: DataFrame, column: str = "embedding", limit: float = LIMIT) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    vector = F.col(column).cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    rows = rows.withColumns(
        {
            "usable": usable(F.col("vector")) & F.col("vec_id").isNotNull(),
            "vec_a": F.xxhash64("vector"),
            "vec_b": F.xxhash64(F.lit(1), "vector"),
        }
    )
    light = rows.select("vec_id", "usable", *KEY)
    ids = light.where("usable").select("vec_id", *KEY).distinct()
    grouped = stored(with_group_min(ids, KEY, "vec_id", "node", "copies"), "equal")
    first = grouped.where("vec_id = node")
    unique = rows.where("usable").join(first, ["vec_id", *KEY]).dropDuplicates(["vec_id", *KEY])
    # An id with several vectors: its nodes are told apart by the key.
    node = F.xxhash64("vec_id", *KEY)
    bits, tables = plan(first.count(), limit)
    prepared = unique.select(node.alias("vec_id"), "copies", "vector")
    prepared = stored(_prepared(prepared, tables, bits), "vectors")
    placed = prepared.select("vec_id", F.posexplode("keys").alias("table", "key"), "size")
    where = ["table", "key", "size"]
    sizes = placed.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / (2 * TILE)).alias("blocks"))
    sizes = stored(sizes.where("blocks > 1"), "blocks")
    coded = ["vec_id", "copies", "codes", "scale", "error"]
    full = prepared.select(*coded, F.posexplode("keys").alias("table", "key"), "size")
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = (
        full.join(sizes, where, "left")
        .withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(3)), blocks))
        .withColumn("_with", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .withColumn("one", F.least("block", "_with"))
        .withColumn("two", F.greatest("block", "_with"))
        .drop("blocks", "_with")
    )
    judged_tiles = dealt.groupBy(*TILE_KEY).applyInPandas(
        lambda frame: tile(frame, tables, bits, limit), TILE_SCHEMA
    )
    judged_tiles = stored(judged_tiles, "tiles")
    undecided = judged_tiles.where("undecided").select("vec_id", *TILE_KEY, "block")
    again = undecided.join(prepared.select(*coded, "vector"), "vec_id").groupBy(*TILE_KEY)
    links = "vec_id long, n_links long, near long"
    more = again.applyInPandas(lambda frame: recomputed(frame, tables, bits, limit), links)
    sure = judged_tiles.where("n_links > 0").select("vec_id", "n_links", "near")
    found = stored(sure.unionByName(more), "links")
    counts = found.groupBy("vec_id").agg(F.sum("n_links").alias("n_links"))
    named = grouped.select("vec_id", *KEY, "node", "copies", F.xxhash64("node", *KEY).alias("_node"))
    alias = stored(named.where("vec_id = node").select("_node", "node"), "nodes")
    # Components by the ids of the nodes, so that the least is the least id.
    at = lambda c, out: alias.select(F.col("_node").alias(c), F.col("node").alias(out))
    edges = found.select("vec_id", "near").join(at("vec_id", "a"), "vec_id")
    edges = stored(edges.select("a", "near"), "near").join(at("near", "b"), "near").select("a", "b")
    labels = components(edges).toDF("_root", "component")
    extra = counts.withColumnRenamed("vec_id", "_node").withColumnRenamed("n_links", "_links")
    named = named.join(extra, "_node", "left").drop("_node")
    named = named.join(labels, F.col("node") == F.col("_root"), "left").select(
        "vec_id",
        *KEY,
        (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    done = light.join(named, ["vec_id", *KEY], "left")
    component = F.coalesce("component_id", "vec_id")
    return done.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
