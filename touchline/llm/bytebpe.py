"""Operator 8: byte-level BPE encoding and decoding by overlapping chunks.

A batch of texts is cut into chunks that overlap their followers. All chunks are
pre-tokenised side by side, each as if a piece began with it. The automaton has no other
memory than its state, so where a chunk and the overlap of the one before are in the same
state, they stay so: from there on the chunk's own piece boundaries hold, and before it
those of its predecessor. A chunk that meets no such place in its overlap is run again from
its predecessor's state. The pieces between the stitched boundaries are then encoded,
distinct ones once. Decoding concatenates the bytes of the tokens.

Edge cases: null and empty texts give no ids and no bytes; repeated rows and null ids get a
row each; special strings are ordinary text. Other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm import pretokens
from touchline.llm.pretokens import BEGINS, BREAK, PieceTable
from touchline.llm.textscan import code_points, parts

CHUNK, OVERLAP = 512, 32


def stitched(symbol: np.ndarray, size: int = CHUNK, overlap: int = OVERLAP) -> np.ndarray:
    """Before which symbols a piece begins, by chunks that are stitched together."""
    rows = pretokens.chunked(symbol, size, overlap)
    states = pretokens.run_rows(rows, np.zeros(len(rows), np.uint8))
    # The overlap of each row but the last against the start of the row after.
    ahead, own = states[size : size + overlap + 1, :-1], states[: overlap + 1, 1:]
    agree = ahead == own
    meets = agree.any(axis=0)
    place = np.where(meets, agree.argmax(axis=0), overlap + 1)
    fixed = states[: overlap + 1, 1:]
    fixed[...] = np.where(np.arange(overlap + 1)[:, None] < place, ahead, own)
    # A predecessor that was run again may end otherwise than its followers were told.
    for row in np.flatnonzero(~meets) + 1:
        while row < len(rows):
            entry = states[size, row - 1]
            again = pretokens.run_rows(rows[row : row + 1], np.array([entry], np.uint8))[:, 0]
            if (again == states[:, row]).all():
                break
            states[:, row] = again
            row += 1
    before = states[:size]
    return BEGINS[before.T, rows[:, :size]].ravel()[: len(symbol)]


class ByteBpe:
    """Encodes and decodes by a rank file."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}
        core = tiktoken.Encoding("ranks", pat_str=".", mergeable_ranks=ranks, special_tokens={})
        encode = core._core_bpe.encode_single_piece
        self.table = PieceTable(lambda piece: encode(piece.encode()))
        self.classes = pretokens.library_classes("tiktoken")
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.sizes = np.array([len(t) for t in tokens])
        self.first = np.cumsum(self.sizes) - self.sizes
        self.raw = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        held: list[np.ndarray] = []
        last = 0
        for group in parts(texts):
            for i, ids in self._encode_group(group):
                if i != last:
                    yield np.concatenate(held)
                    held, last = [], i
                held.append(ids)
        if texts:
            yield np.concatenate(held)

    def _encode_group(self, group: list[tuple[int, str]]) -> Iterator[tuple[int, np.ndarray]]:
        points = code_points(BREAK.join(p for _, p in group))
        symbol = pretokens.symbols(points, self.classes)
        starts = np.flatnonzero(stitched(symbol)) if len(points) else np.empty(0, int)
        lengths = np.diff(np.append(starts, len(points)))
        real = symbol[starts] != pretokens.END
        starts, lengths = starts[real], lengths[real]
        slots = self.table.find(points, starts, lengths)
        ids, counts = self.table.ids(slots), self.table.count[slots]
        sizes = np.array([len(p) + 1 for _, p in group])
        ends = np.searchsorted(starts, np.cumsum(sizes))
        upto = np.concatenate(([0], np.cumsum(counts)))[ends]
        begin = 0
        for (i, _), end in zip(group, upto):
            yield i, ids[begin:end]
            begin = end

    def decode(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        shift = self.first[ids] - (np.cumsum(sizes) - sizes)
        return self.raw[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))].tobytes()


@cache
def codec(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, and the bytes that the ids decode to. No shuffle."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded binary"

    def run(batches):
        bpe = codec(path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = list(bpe.encode(texts))
            offsets = np.cumsum([0, *map(len, ids)])
            flat = pa.array(np.concatenate(ids) if ids else np.empty(0), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)
            raw = pa.array([bpe.decode(x) for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), lists, raw], ["doc_id", "ids", "decoded"]
            )

    text = F.col("text").cast("string").alias("text")
    return docs.select("doc_id", text).mapInArrow(run, schema)


def decode(rows: DataFrame, path: str) -> DataFrame:
    """The frame (doc_id, ids) with the bytes of its ids; null ids give none."""
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, decoded binary"

    def run(batches):
        bpe = codec(path)
        for batch in batches:
            ids = [np.array(x or [], int) for x in batch.column("ids").to_pylist()]
            raw = pa.array([bpe.decode(x) for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), raw], ["doc_id", "decoded"])

    return rows.select("doc_id", "ids").mapInArrow(run, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids and of the decoded bytes."""
    joined = F.translate(F.col("ids").cast("string"), "[] ", "")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
