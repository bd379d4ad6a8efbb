"""Operator 13: secret scans with multipart credential linking.

Patterns find the parts of credentials in whole texts: identifiers, secrets and endpoints. The
base kinds tell enough alone and are always reported. The others are weak: a mail address, a
user name, a short password, an opaque token or an address is reported only when parts that
complete it stand in its scope. A scope is the paragraph, and no more than ``REACH`` code points
from the part. A secret needs an identifier, an identifier needs a secret, and an endpoint both.

The parts of a batch of texts become sorted intervals on one line of code points. The join of
candidates with scopes counts by binary search: the parts that begin before the scope's end,
less those that end before its start. So its cost follows the number of parts, however
many stand together, and no pairs are made. Every text is scanned in one task; nothing shuffles.

Where spans overlap, the kind that comes first in ``KINDS`` stands and a weak one goes.

Edge cases: a null or empty text has no spans; repeated rows and ids get rows of their own; a null
``doc_id`` is passed on; other columns are not read; no table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REACH = 200


@dataclass(frozen=True)
class Kind:
    """A kind of part. ``group`` of a match, or all of it, has ``least`` code points, and holds
    a character of each class in ``holds``. ``hint``: a text with a match holds one of these."""

    name: str
    role: str
    pattern: str
    group: int = 0
    least: int = 1
    holds: tuple[str, ...] = ()
    either_case: bool = False
    hint: tuple[str, ...] = ()


SET = r"""["']?\x20*[:=]\x20*["']?"""
#: Fixed: the patterns of the base kinds.
BASE = (
    Kind("assign", "secret", rf"(password|passwd|secret|token|api_?key){SET}([A-Za-z0-9+/_.=-]+)", 2, 8, (), True, (":", "=")),
    Kind("access", "identifier", r"AKIA[A-Z0-9]+", 0, 16, (), False, ("AKIA",)),
    Kind("hex", "secret", r"[0-9a-f]+", 0, 32),
)
WEAK = (
    Kind("url", "endpoint", r"(https?|ftp|ssh|postgres|postgresql|mysql|mongodb|redis|amqp)://[!#-&(-;=?-~]+", 0, 10, (), False, ("://",)),
    Kind("mail", "identifier", r"[A-Za-z0-9._+-]{1,64}@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+", 0, 6, (), False, ("@",)),
    Kind("ip", "endpoint", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", 0, 7, (), False, (".",)),
    Kind("host", "endpoint", rf"(hostname|host|server|endpoint){SET}([A-Za-z0-9._:/-]+)", 2, 4, (), True, (":", "=")),
    Kind("login", "identifier", rf"(user_?name|user|login|account|client_?id){SET}([A-Za-z0-9._+-]+)", 2, 3, (), True, (":", "=")),
    Kind("weak", "secret", rf"(password|passwd|passphrase|pwd|pass|secret|token|auth|key){SET}([!#-&(-~]+)", 2, 4, (), True, (":", "=")),
    Kind("opaque", "secret", r"[A-Za-z0-9+/_-]+", 0, 20, ("[a-z]", "[A-Z]", "[0-9]")),
)
KINDS = (*BASE, *WEAK)
NEEDS = {"secret": ("identifier",), "identifier": ("secret",), "endpoint": ("secret", "identifier")}
#: Ends a paragraph.
GAP = r"\n[\x20\t\r]*\n"

SPANS = "array<struct<kind: string, start: bigint, end: bigint>>"


def compiled(kind: Kind) -> re.Pattern:
    pattern = kind.pattern
    run = re.fullmatch(r"([A-Z]*)(\[[^]]*\])\+", pattern)
    if run:
        # The same runs, but shorter ones are no matches.
        pattern = f"{run[1]}{run[2]}{{{kind.least - len(run[1])},}}"
    return re.compile(pattern, re.ASCII | (re.IGNORECASE if kind.either_case else 0))


class Scanner:
    def __init__(self, kinds: tuple[Kind, ...] = KINDS, reach: int = REACH):
        self.kinds, self.reach = kinds, reach
        self.patterns = [compiled(kind) for kind in kinds]
        self.holds = [[re.compile(c) for c in kind.holds] for kind in kinds]
        self.gap = re.compile(GAP)

    def matches(self, k: int, text: str) -> Iterator[tuple[int, int]]:
        kind, holds = self.kinds[k], self.holds[k]
        if kind.hint and not any(h in text for h in kind.hint):
            return
        for match in self.patterns[k].finditer(text):
            start, end = match.span(kind.group)
            if end - start >= kind.least and all(c.search(text, start, end) for c in holds):
                yield match.span()

    def spans(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, kind, start, end) of what is reported, by text, start and kind."""
        # Texts stand on one line, with a code point between two of them.
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        first = np.cumsum(sizes) - sizes
        gaps = np.array(
            [(at + m.start(), at + m.end()) for at, t in zip(first.tolist(), texts) for m in self.gap.finditer(t)],
            np.int64,
        ).reshape(-1, 2)
        opens = np.sort(np.concatenate((first, gaps[:, 1])))
        closes = np.sort(np.concatenate((first + sizes - 1, gaps[:, 0])))
        parts: list[np.ndarray] = []
        for k in range(len(self.kinds)):
            found = [(at + s, at + e) for at, t in zip(first.tolist(), texts) for s, e in self.matches(k, t)]
            parts.append(np.array(found, np.int64).reshape(-1, 2))
        standing = self._first_of_overlaps(parts)
        joined = self._in_scope(standing, opens, closes)
        kind = np.repeat(np.arange(len(self.kinds)), [len(p) for p in joined])
        start, end = np.concatenate(joined).T
        order = np.lexsort((kind, start))
        kind, start, end = kind[order], start[order], end[order]
        text = np.searchsorted(first, start, "right") - 1
        return text, kind, start - first[text], end - first[text]

    def _first_of_overlaps(self, parts: list[np.ndarray]) -> list[np.ndarray]:
        standing = parts[: len(BASE)]
        for k in range(len(BASE), len(parts)):
            before = np.concatenate(parts[:k])
            standing.append(parts[k][~meets(before, parts[k][:, 0], parts[k][:, 1])])
        return standing

    def _in_scope(self, parts: list[np.ndarray], opens: np.ndarray, closes: np.ndarray) -> list[np.ndarray]:
        """The interval join of the weak parts' scopes with the parts of the roles they need."""
        by_role = {
            role: np.concatenate([p for p, kind in zip(parts, self.kinds) if kind.role == role])
            for role in NEEDS
        }
        joined = parts[: len(BASE)]
        for part, kind in zip(parts[len(BASE) :], self.kinds[len(BASE) :]):
            start, end = part[:, 0], part[:, 1]
            low = np.maximum(start - self.reach, opens[np.searchsorted(opens, start, "right") - 1])
            high = np.minimum(end + self.reach, closes[np.searchsorted(closes, end)])
            kept = np.ones(len(part), bool)
            for role in NEEDS[kind.role]:
                kept &= meets(by_role[role], low, high)
            joined.append(part[kept])
        return joined


def meets(parts: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which intervals [low, high) share a code point with one of the parts."""
    begun = np.searchsorted(np.sort(parts[:, 0]), high, "left")
    over = np.searchsorted(np.sort(parts[:, 1]), low, "right")
    return begun > over


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id and the spans of every document, in code points, ends exclusive."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, spans {SPANS}"
    names = np.array([kind.name for kind in KINDS])

    def run(batches):
        scanner = Scanner(KINDS, reach)
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = [t or "" for t in batch.column("text").to_pylist()]
            text, kind, start, end = scanner.spans(texts)
            offsets = np.searchsorted(text, np.arange(len(texts) + 1))
            columns = [pa.array(names[kind], pa.string()), pa.array(start), pa.array(end)]
            spans = pa.StructArray.from_arrays(columns, ["kind", "start", "end"])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "spans"])

    text = F.col("text").cast("string").alias("text")
    return docs.select("doc_id", text).mapInArrow(run, schema)


def digests(scanned: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base kinds, and all spans as text."""

    def told(spans: Column) -> Column:
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(parts, ",")

    def count(name: str) -> Column:
        own = F.filter("spans", lambda s: s["kind"] == name)
        return F.size(own).cast("long").alias(f"n_{name}")

    base = F.filter("spans", lambda s: s["kind"].isin(*[kind.name for kind in BASE]))
    return scanned.select(
        "doc_id",
        *[count(kind.name) for kind in BASE],
        F.sha2(told(base), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )
