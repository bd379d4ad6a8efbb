"""Ids of a word-level BPE file of the tokenizers library: lower case, word ends marked.

Equal to the library's own result; distinct words of a batch are encoded once, which the
library doesn't do and which makes it several times as fast on prose.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np

from touchline.llm import pretokens
from touchline.llm.pretokens import BREAK, LETTER, NUMBER, SPACE, PieceTable
from touchline.llm.textscan import code_points, parts
from touchline.llm.tokencount import byte_names

#: Stands for the end of a word in the merges; no UTF-8 text holds this byte.
_END = b"\xff"


class WordBpe:
    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        names, model = byte_names(), spec["model"]
        suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}

        def raw(token: str) -> bytes:
            end = token.endswith(suffix)
            text = token[: -len(suffix)] if end else token
            return bytes(names[c] for c in text) + (_END if end else b"")

        # A byte at the end of a word is one symbol: these merges come before all others.
        ranks = {bytes([b]): b for b in range(256)}
        ranks |= {bytes([b]) + _END: 256 + b for b in range(256)}
        for merge in model["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            ranks[raw(left) + raw(right)] = len(ranks)
        number = {raw(t): i for t, i in model["vocab"].items()}
        to_id = np.full(len(ranks), -1)
        for token, rank in ranks.items():
            to_id[rank] = number.get(token, -1)
        core = tiktoken.Encoding("words", pat_str=".", mergeable_ranks=ranks, special_tokens={})
        encode = core._core_bpe.encode_single_piece
        self.table = PieceTable(lambda piece: to_id[encode(piece.encode() + _END)].tolist())
        self.classes = pretokens.library_classes("tokenizers")

    def _cut(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and lengths of the pieces: runs of letters or of other characters,
        single numbers, and 's 't 'm 'd 're 've 'll."""
        kind = self.classes[points]
        kind[points == 0xD800] = SPACE
        begins = np.append(True, kind[1:] != kind[:-1]) | (kind == NUMBER)
        quotes = np.flatnonzero(points == 39)
        if len(quotes):
            padded = np.concatenate((points, np.full(3, 32, np.uint32)))
            kinds = np.concatenate((kind, np.full(3, SPACE, np.uint8)))
            one, two = padded[quotes + 1], padded[quotes + 2]
            short = np.isin(one, [115, 116, 109, 100])
            long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
            free = begins[quotes] & (kinds[quotes + 1] == LETTER)
            for at, size in ((quotes[free & short], 2), (quotes[free & long], 3)):
                begins[at + 1] = False
                after = at + size
                after = after[after < len(points)]
                begins[after] = True
        starts = np.flatnonzero(begins)
        lengths = np.diff(np.append(starts, len(points)))
        real = kind[starts] != SPACE
        return starts[real], lengths[real]

    def encode(self, texts: list[str], end: int | None = None) -> Iterator[np.ndarray]:
        """The ids of each text, with ``end`` after them."""
        plain, owners, before = [], [], []
        for i, text in enumerate(texts):
            pieces = [(text, -1)]
            for special, number in self.special.items():
                if special in text:
                    split = []
                    for piece, first in pieces:
                        head, *rest = piece.split(special)
                        split += [(head, first), *((r, number) for r in rest)]
                    pieces = split
            for piece, first in pieces:
                plain.append(piece)
                owners.append(i)
                before.append(first)
        held: list[np.ndarray] = []
        last, seen = 0, -1
        for group in parts(plain):
            clean = [
                (j, unicodedata.normalize("NFC", p).replace("Σ", "σ").lower())
                for j, p in group
            ]
            for j, ids in self._encode_group(clean):
                if owners[j] != last:
                    yield self._ended(held, end)
                    held, last = [], owners[j]
                if j != seen and before[j] >= 0:
                    held.append(np.array([before[j]], np.int32))
                seen = j
                held.append(ids)
        if texts:
            yield self._ended(held, end)

    @staticmethod
    def _ended(held: list[np.ndarray], end: int | None) -> np.ndarray:
        return np.concatenate(held if end is None else [*held, np.array([end], np.int32)])

    def _encode_group(self, group: list[tuple[int, str]]) -> Iterator[tuple[int, np.ndarray]]:
        points = code_points(BREAK.join(p for _, p in group))
        starts, lengths = self._cut(points) if len(points) else (np.empty(0, int),) * 2
        slots = self.table.find(points, starts, lengths)
        ids, counts = self.table.ids(slots), self.table.count[slots]
        sizes = np.array([len(p) + 1 for _, p in group])
        ends = np.searchsorted(starts, np.cumsum(sizes))
        upto = np.concatenate(([0], np.cumsum(counts)))[ends]
        begin = 0
        for (j, _), stop in zip(group, upto):
            yield j, ids[begin:stop]
            begin = stop


def id_bytes(path: str, end: int = 0) -> int:
    """Bytes that hold any id of a file, or ``end``: 2 or 4."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    added = (t["id"] for t in spec["added_tokens"])
    return 2 if max(end, *spec["model"]["vocab"].values(), *added) < 1 << 16 else 4


@cache
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)
