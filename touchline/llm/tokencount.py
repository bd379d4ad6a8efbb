"""Operator 10: token counts by compiled finite-state transducers.

Two deterministic machines count the tokens of a byte-level BPE tokenizer:

* The pre-tokenizer, an automaton of eight states. A batch of texts is one string of
  symbols in chunks; each chunk is turned into a map from entry state to exit state, all
  chunks in step, and a parallel prefix scan composes the maps. That gives every chunk its
  entry state, and so the places where pieces begin.
* The merges. A sequence of tokens is what the merges give if, and only if, that holds
  for each neighbouring pair, so the last token of a prefix follows from the prefixes
  before it. A state is the set of vocabulary prefixes that end here, each with the last
  token before it and the tokens counted since. Transitions carry the change of the count.
  States and transitions are made when first met, and dropped when there are too many.

Distinct pieces of a batch go through the second machine once.

Edge cases: null and empty texts have no tokens; special strings count as one token
wherever they stand, as the library's default has it; a text is cut at white space for
bounded memory, where no piece can go on; repeated rows and null ids get a row each. Other
columns are not read.
"""

from __future__ import annotations

import json
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm import pretokens
from touchline.llm.pretokens import BEGINS, BREAK, NEXT, PieceTable
from touchline.llm.textscan import code_points, parts

CHUNK = 256


def scan(symbol: np.ndarray) -> np.ndarray:
    """Before which symbols a piece begins, by chunk maps and a prefix scan."""
    rows = pretokens.chunked(symbol, CHUNK)
    states = np.tile(np.arange(8, dtype=np.uint8), (len(rows), 1))
    flat = NEXT.ravel()
    for column in np.ascontiguousarray(rows.T):
        states = flat[states.astype(np.intp) * 10 + column[:, None]]
    step = 1
    while step < len(rows):  # states[i] maps over the rows up to i
        later = np.take_along_axis(states[step:], states[:-step].astype(np.intp), axis=1)
        states = np.concatenate((states[:step], later))
        step *= 2
    entry = np.concatenate(([pretokens.START], states[:-1, pretokens.START])).astype(np.uint8)
    before = pretokens.run_rows(rows, entry)[:-1]
    return BEGINS[before.T, rows].ravel()[: len(symbol)]


class MergeCounter:
    """Counts the tokens of one piece; a lazily compiled transducer over its bytes.

    A token's id is its place in ``tokens``: the 256 bytes, then one for each merge.
    """

    def __init__(self, merges: list[tuple[bytes, bytes]], most: int = 150_000):
        self.most = most
        self.tokens = [bytes([b]) for b in range(256)]
        number = {t: i for i, t in enumerate(self.tokens)}
        #: The token that a pair merges to; a lower one is merged first.
        self.merge: dict[int, int] = {}
        self.parts: list[tuple[int, int]] = [(-1, -1)] * 256
        for left, right in merges:
            pair = number[left], number[right]
            self.merge[pair[0] << 32 | pair[1]] = len(self.tokens)
            self.parts.append(pair)
            number[left + right] = len(self.tokens)
            self.tokens.append(left + right)
        #: The trie of all tokens, by node << 8 | byte.
        self.children: dict[int, int] = {}
        self.token_at = [-1]
        self.grows = [False]
        for token, i in number.items():
            node = 0
            for byte in token:
                self.grows[node] = True
                nxt = self.children.get(node << 8 | byte)
                if nxt is None:
                    nxt = self.children[node << 8 | byte] = len(self.token_at)
                    self.token_at.append(-1)
                    self.grows.append(False)
                node = nxt
            self.token_at[node] = i
        self.edges: tuple[dict[int, list], dict[int, list]] = ({}, {})
        self.whole: dict[int, bool] = {}
        self._clear()

    def _clear(self) -> None:
        #: A state: the open vocabulary prefixes, each as (trie node, token before it, its
        #: count less the count here), and the last token.
        self.states: list[tuple] = [((), -1)]
        self.number = {self.states[0]: 0}
        self.moves: dict[int, tuple[int, int]] = {}
        self.pairs: dict[int, bool] = {}

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at the left (0) or right (1) edge of a token while it is merged,
        each with the merge that ends it."""
        found = self.edges[side].get(token)
        if found is None:
            found, until, at = [], 1 << 60, token
            while at >= 0:
                found.append((at, until))
                until, at = at, self.parts[at][side]
            self.edges[side][token] = found
        return found

    def apart(self, left: int, right: int) -> bool:
        """No merge joins the two: each that could comes after its sides have gone. Of
        equal merges the leftmost is first."""
        for a, a_until in self.edge(left, 1):
            for b, b_until in self.edge(right, 0):
                joined = self.merge.get(a << 32 | b)
                if joined is not None and joined < a_until and joined <= b_until:
                    return False
        return True

    def alone(self, token: int) -> bool:
        """The bytes of the token are merged to it."""
        found = self.whole.get(token)
        if found is None:
            symbols = list(self.tokens[token])
            while len(symbols) > 1:
                joined = [self.merge.get(a << 32 | b, 1 << 60) for a, b in zip(symbols, symbols[1:])]
                best = min(joined)
                if best == 1 << 60:
                    break
                at = joined.index(best)
                symbols[at : at + 2] = [best]
            found = self.whole[token] = symbols == [token]
        return found

    def stands(self, before: int, token: int) -> bool:
        if before < 0:
            return self.alone(token)
        key = before << 32 | token
        found = self.pairs.get(key)
        if found is None:
            found = self.pairs[key] = self.alone(token) and self.apart(before, token)
        return found

    def move(self, state: int, byte: int) -> tuple[int, int]:
        open_, last = self.states[state]
        going, token, gain = [], -1, 0
        for node, before, ago in (*open_, (0, last, 0)):
            node = self.children.get(node << 8 | byte)
            if node is None:
                continue
            here = self.token_at[node]
            if token < 0 <= here and self.stands(before, here):
                token, gain = here, ago + 1
            if self.grows[node]:
                going.append((node, before, ago))
        key = (tuple((n, b, ago - gain) for n, b, ago in going), token)
        number = self.number.get(key)
        if number is None:
            number = self.number[key] = len(self.states)
            self.states.append(key)
        self.moves[state << 8 | byte] = number, gain
        return number, gain

    def count(self, piece: bytes) -> int:
        if len(self.states) > self.most:
            self._clear()
        state = total = 0
        moves = self.moves
        for byte in piece:
            step = moves.get(state << 8 | byte)
            state, gain = step if step is not None else self.move(state, byte)
            total += gain
        return total


def byte_names() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand
    for themselves, the others for the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenCounter:
    """Counts tokens of texts as a byte-level BPE file of the tokenizers library does."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        names = byte_names()

        def raw(token: str) -> bytes:
            return bytes(names[c] for c in token)

        self.special = [t["content"] for t in spec["added_tokens"]]
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.machine = MergeCounter([(raw(a), raw(b)) for a, b in merges])
        self.table = PieceTable(lambda piece: [self.machine.count(piece.encode())])
        self.classes = pretokens.library_classes("tokenizers")

    def counts(self, texts: list[str]) -> list[int]:
        total = np.zeros(len(texts), np.int64)
        owners: list[int] = []
        plain: list[str] = []
        for i, text in enumerate(texts):
            pieces = [text]
            for special in self.special:
                if special in text:
                    pieces = [q for p in pieces for q in p.split(special)]
            total[i] += len(pieces) - 1
            owners += [i] * len(pieces)
            plain += pieces
        for group in parts(plain):
            joined = BREAK.join(p for _, p in group)
            if not joined:
                continue
            points = code_points(joined)
            symbol = pretokens.symbols(points, self.classes)
            starts = np.flatnonzero(scan(symbol))
            lengths = np.diff(np.append(starts, len(points)))
            real = symbol[starts] != pretokens.END
            starts, lengths = starts[real], lengths[real]
            counts = self.table.ids(self.table.find(points, starts, lengths))
            sizes = np.array([len(p) + 1 for _, p in group])
            part = np.searchsorted(np.cumsum(sizes) - sizes, starts, "right") - 1
            owner = np.array([owners[i] for i, _ in group])[part]
            total += np.bincount(owner, counts, len(total)).astype(np.int64)
        return total.tolist()


@cache
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document. No shuffle."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long"

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            counts = pa.array(counter(path).counts(texts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), counts],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    text = F.col("text").cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    found = docs.select("doc_id", text.alias("text"), size.alias("n_bytes")).mapInArrow(run, schema)
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
