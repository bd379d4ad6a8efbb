"""Cutting texts into the pieces that byte-pair merges work on.

The pattern of the byte-level tokenizers is compiled to a deterministic automaton over
character classes. A symbol is the class of a character with one character of look-ahead;
the automaton tells before which characters a piece begins. Character classes are asked
from the tokenizer libraries themselves, so they agree in every code point.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

import numpy as np

from touchline.llm.textscan import code_points, span_hashes

#: Stands between two texts; no valid text holds a surrogate.
BREAK = "\ud800"
_BREAK = 0xD800

LETTER, NUMBER, SPACE, OTHER = range(4)
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, QUOTE, LEAD, IN_SPACE, TAIL = range(8)
LET, SHORT, LONG, NUM, OTH, APO, WIDE, LEAD_IN, LONE, END = range(10)


@cache
def library_classes(library: str) -> np.ndarray:
    """The class of every code point, by the regular expressions of a library."""
    classes = np.full(0x110000, OTHER, np.uint8)
    for first in range(0, 0x110000, 1 << 13):
        points = np.arange(first, first + (1 << 13))
        points = points[(points < 0xD800) | (points > 0xDFFF)]
        everything = "".join(map(chr, points.tolist()))
        for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
            classes[points[_matched(library, pattern, everything)]] = kind
    return classes


def _matched(library: str, pattern: str, text: str) -> np.ndarray:
    """Places of the characters that match."""
    if library == "tokenizers":
        from tokenizers import Regex
        from tokenizers.pre_tokenizers import Split

        runs = Split(Regex(pattern + "+"), "removed", invert=True).pre_tokenize_str(text)
        return np.concatenate([np.empty(0, int), *(np.arange(*span) for _, span in runs)])
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    only = tiktoken.Encoding("one class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
    found = bytes(only.encode_ordinary(text)).decode()
    return np.flatnonzero(np.isin(code_points(text), code_points(found)))


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a piece begins before this character."""
    letters = symbol in (LET, SHORT, LONG)
    if symbol == END:
        return START, True
    if symbol == WIDE:  # white space before more of it, or before the end
        return IN_SPACE, state != IN_SPACE
    if symbol == LEAD_IN:  # a space that joins the next run
        return LEAD, True
    if symbol == LONE:  # other white space before a character
        return START, True
    if state == QUOTE and symbol == SHORT:  # 's 't 'm 'd
        return START, False
    if state == QUOTE and symbol == LONG:  # 're 've 'll
        return TAIL, False
    if state == TAIL:
        return START, False
    if letters:
        return IN_LETTERS, state not in (IN_LETTERS, LEAD)
    if symbol == NUM:
        return IN_NUMBERS, state not in (IN_NUMBERS, LEAD)
    if state in (IN_OTHERS, QUOTE, LEAD):
        return IN_OTHERS, False
    return (QUOTE if symbol == APO else IN_OTHERS), True


NEXT = np.array([[_step(s, a)[0] for a in range(10)] for s in range(8)], np.uint8)
BEGINS = np.array([[_step(s, a)[1] for a in range(10)] for s in range(8)])


def symbols(points: np.ndarray, classes: np.ndarray) -> np.ndarray:
    kind = classes[points]
    kind[points == _BREAK] = SPACE
    after = np.append(points[1:], np.uint32(_BREAK))
    before_more = np.append(kind[1:] == SPACE, True)
    out = np.array([LET, NUM, WIDE, OTH], np.uint8)[kind]
    out[points == 39] = APO
    small = np.flatnonzero((points >= 100) & (points <= 118))
    at, then = points[small], after[small]
    out[small[(at == 115) | (at == 116) | (at == 109) | (at == 100)]] = SHORT
    out[small[((at == 114) | (at == 118)) & (then == 101) | (at == 108) & (then == 108)]] = LONG
    space = np.flatnonzero((kind == SPACE) & ~before_more)
    out[space] = np.where(points[space] == 32, LEAD_IN, LONE)
    out[points == _BREAK] = END
    return out


def chunked(symbol: np.ndarray, size: int, overlap: int = 0) -> np.ndarray:
    """Rows of ``size`` symbols and ``overlap`` more of the next row; END fills up."""
    rows = max(1, -(-len(symbol) // size))
    full = np.full(rows * size + overlap, END, np.uint8)
    full[: len(symbol)] = symbol
    return np.lib.stride_tricks.sliding_window_view(full, size + overlap)[::size]


def run_rows(rows: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """The state before each symbol of every row, all rows in step."""
    states = np.empty((rows.shape[1] + 1, rows.shape[0]), np.uint8)
    states[0] = entry
    columns = np.ascontiguousarray(rows.T)
    flat = NEXT.ravel()
    for j, column in enumerate(columns):
        states[j + 1] = flat[states[j].astype(np.intp) * 10 + column]
    return states


class PieceTable:
    """Ids of distinct pieces, by their hashes; starts anew when ``most`` is reached.

    Pieces are told apart by 64-bit hashes. With less than a million of them in a table,
    two share one with a chance under 1e-7. Hashes stand in order, so a batch is looked up at
    once and its new ones are merged in.
    """

    def __init__(self, encode: Callable[[str], list[int]], most: int = 800_000):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.slot = np.empty(0, np.int32)
        self.count = np.zeros(1 << 12, np.int32)
        self.first = np.zeros(1 << 12, np.int64)
        self.flat = np.zeros(1 << 14, np.int32)
        self.used = 0

    def _add(self, slot: int, piece: str) -> None:
        ids = self.encode(piece)
        if slot == len(self.count):
            self.count = np.concatenate((self.count, np.zeros_like(self.count)))
            self.first = np.concatenate((self.first, np.zeros_like(self.first)))
        end = self.used + len(ids)
        while end > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        self.flat[self.used : end] = ids
        self.first[slot], self.count[slot] = self.used, len(ids)
        self.used = end

    def find(self, points: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The slot of each piece."""
        if len(self.keys) > self.most:
            self._clear()
        keys, places, inverse = np.unique(
            span_hashes(points, starts, lengths), return_index=True, return_inverse=True
        )
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        slots = np.empty(len(keys), np.int64)
        slots[known] = self.slot[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            slots[new] = len(self.keys) + np.arange(len(new))
            for slot, i in zip(slots[new].tolist(), places[new].tolist()):
                start = starts[i]
                self._add(slot, points[start : start + lengths[i]].tobytes().decode("utf-32-le"))
            self.slot = np.insert(self.slot, at[new], slots[new])
            self.keys = np.insert(self.keys, at[new], keys[new])
        return slots[inverse]

    def ids(self, slots: np.ndarray) -> np.ndarray:
        """The ids of all pieces, one after the other."""
        counts = self.count[slots]
        total = int(counts.sum())
        shift = self.first[slots] - (np.cumsum(counts) - counts)
        return self.flat[np.repeat(shift, counts) + np.arange(total)]
