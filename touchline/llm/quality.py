"""Operator 7: quality rules by repetition coverage.

Rolling hashes of word n-grams of several lengths find the n-grams that a text holds
twice or more. A text is measured by the share of its characters inside such n-grams
and inside lines that repeat an earlier line.

Edge cases: a null or empty text has no words, so it fails the base rule; a line or a
word may be of any length; a repeated row or document id gets a row of its own; a null
``doc_id`` is passed on. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.textscan import rolling, text_words, windows

SYMBOLS = re.compile(r"[#*$%&|<>]")
WORD = re.compile(r"[^\x20\x09-\x0D]")


@dataclass(frozen=True)
class Rules:
    """Limits; a document that passes none of them is kept."""

    least_words: int = 20
    base_window: int = 8
    base_percent: int = 30
    #: Share of word characters in n-grams found twice or more, by n.
    coverage: tuple[tuple[int, float], ...] = ((5, 0.4), (10, 0.3))
    #: Share of the characters that stand in lines equal to an earlier line.
    lines: float = 0.3


def repeated(sums: np.ndarray, n: int) -> np.ndarray:
    """Which words stand in a run of ``n`` words found twice or more, the first included."""
    grams = windows(sums, n)
    ranked = np.sort(grams)
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return np.zeros(len(sums) - 1, bool)
    at = np.flatnonzero(np.isin(grams, ranked[1:][same]))
    steps = np.zeros(len(sums), np.int64)
    steps[at] += 1
    steps[at + n] -= 1
    return np.cumsum(steps[:-1]) > 0


def line_repeats(text: str) -> tuple[int, int, int]:
    """Lines with a word that equal an earlier line, their characters, all characters."""
    lines = text.split("\n")
    if len(lines) == 1:
        return 0, 0, len(text)
    seen: set[str] = set()
    count = size = total = 0
    for line in lines:
        total += len(line)
        if line in seen:
            if WORD.search(line):
                count += 1
                size += len(line)
        else:
            seen.add(line)
    return count, size, total


MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "dup_line_share double, dup_gram_shares array<double>, base_failed boolean, kept boolean"
)


def measured(texts: list[str | None], rules: Rules) -> Iterator[tuple]:
    """A row of ``MEASURES`` for each text."""
    plain = [t or "" for t in texts]
    for i, hashes, lengths in text_words(plain):
        n, chars = len(hashes), int(lengths.sum())
        sums = rolling(hashes)
        inside = int(repeated(sums, rules.base_window).sum())
        shares = [
            int(lengths[repeated(sums, k)].sum()) / chars if chars else 0.0
            for k, _ in rules.coverage
        ]
        lines, line_chars, all_chars = line_repeats(plain[i])
        line_share = line_chars / all_chars if all_chars else 0.0
        failed = n < rules.least_words or 100 * inside > rules.base_percent * n
        kept = not failed and line_share <= rules.lines
        kept = kept and all(s <= most for s, (_, most) in zip(shares, rules.coverage))
        symbols = len(SYMBOLS.findall(plain[i]))
        yield n, chars, symbols, lines, inside, line_share, shares, failed, kept


def repetition(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc_id, the measures, and the verdict of every document."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {MEASURES}"

    def scan(batches):
        for batch in batches:
            rows = list(measured(batch.column("text").to_pylist(), rules))
            columns = [pa.array(list(c)) for c in zip(*rows)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *columns],
                    ["doc_id", *(m.split()[0] for m in MEASURES.split(", "))],
                )

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(scan, schema)


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with all their columns. No shuffle."""

    def scan(batches):
        for batch in batches:
            kept = [row[-1] for row in measured(batch.column("text").to_pylist(), rules)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(scan, docs.schema)
