"""Texts as numpy arrays of code points: words, pieces and their 64-bit hashes.

Everything here works on a batch of texts at once. A batch holds at most ``LIMIT`` code
points, so memory doesn't follow the length of a text as long as it has white space to
cut at; words never span such a cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np

LIMIT = 1 << 19
#: No token or word holds a character and white space after it, so texts can be cut here.
_CUT = re.compile(r"(?<=\S)[\x20\x09-\x0D]")
_SEED = 0x5EED


def parts(texts: list[str], limit: int = LIMIT) -> Iterator[list[tuple[int, str]]]:
    """Groups of (index of the text, part of it), of about ``limit`` code points each."""
    group: list[tuple[int, str]] = []
    size = 0
    for i, text in enumerate(texts):
        start = 0
        while True:
            cut = _CUT.search(text, start + limit) if len(text) - start > limit else None
            end = cut.start() if cut else len(text)
            if group and size + end - start > limit:
                yield group
                group, size = [], 0
            group.append((i, text[start:end] if start or cut else text))
            size += end - start
            start = end
            if not cut:
                break
    if group:
        yield group


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: xor-shifts and odd multipliers, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _values() -> np.ndarray:
    """A random 64-bit value for each code point."""
    return mix(np.arange(0x110000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(_SEED))


_power = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """Powers of an odd base, modulo 2^64."""
    global _power
    if len(_power) < n:
        with np.errstate(over="ignore"):
            steps = np.full(max(n, 4096), 0xD6E8FEB86659FD93, np.uint64)
            steps[0] = 1
            _power = np.multiply.accumulate(steps)
    return _power[:n]


def span_hashes(points: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; spans don't overlap and are in order."""
    if not len(starts):
        return np.empty(0, np.uint64)
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    within = np.arange(total) - np.repeat(first, lengths)
    if total == len(points) and starts[0] == 0:
        covered = points
    else:
        covered = points[within + np.repeat(starts, lengths)]
    terms = _values()[covered] * powers(int(lengths.max()))[within]
    return mix(np.add.reduceat(terms, first) ^ (lengths.astype(np.uint64) << np.uint64(40)))


def is_blank(points: np.ndarray) -> np.ndarray:
    return (points == 32) | ((points - np.uint32(9)) < 5)


def lower_ascii(points: np.ndarray) -> np.ndarray:
    return points + ((points - np.uint32(65)) < 26).astype(np.uint32) * np.uint32(32)


class Words:
    """The words of a group of parts: maximal runs without white space.

    ``owner`` is the index of the text of each word, ``start`` its place in ``points``,
    where a line feed stands between two parts.
    """

    def __init__(self, group: list[tuple[int, str]], lower: bool = False):
        self.points = code_points("\n".join(p for _, p in group))
        sizes = np.array([len(p) + 1 for _, p in group])
        self.first = np.cumsum(sizes) - sizes
        self.owners = np.array([i for i, _ in group])
        edges = np.diff(np.concatenate(([1], is_blank(self.points).view(np.int8), [1])))
        self.start = np.flatnonzero(edges == -1)
        self.length = np.flatnonzero(edges == 1) - self.start
        self.part = np.searchsorted(self.first, self.start, "right") - 1
        self.owner = self.owners[self.part]
        points = lower_ascii(self.points) if lower else self.points
        self.hash = span_hashes(points, self.start, self.length)


def text_words(
    texts: list[str], lower: bool = False
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index, hashes of its words in order, their code points), for every text."""
    none = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    hashes: list[np.ndarray] = []
    lengths: list[np.ndarray] = []
    last = 0
    for group in parts(texts):
        words = Words(group, lower)
        ends = np.searchsorted(words.part, np.arange(len(group)), "right")
        at = 0
        for (i, _), end in zip(group, ends):
            if i != last:
                yield last, np.concatenate(hashes or none[0]), np.concatenate(lengths or none[1])
                hashes, lengths, last = [], [], i
            hashes.append(words.hash[at:end])
            lengths.append(words.length[at:end])
            at = end
    if texts:
        yield last, np.concatenate(hashes or none[0]), np.concatenate(lengths or none[1])


def rolling(hashes: np.ndarray) -> np.ndarray:
    """Sums of word hashes times powers, from which ``windows`` takes differences."""
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * powers(len(hashes)))))


def windows(sums: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, from the ``rolling`` sums of the words.

    The difference over a run holds the powers of its place; a factor brings all runs to
    the same power.
    """
    count = len(sums) - n
    if count <= 0:
        return np.empty(0, np.uint64)
    return mix((sums[n:] - sums[:-n]) * powers(count)[::-1])
