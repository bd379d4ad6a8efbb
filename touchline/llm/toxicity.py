"""Operator 1: toxicity by a lexicon, misspellings and contexts.

The lexicon is learned from labels: words, and stems that many words begin with, whose
documents are toxic. A trie holds it, and Levenshtein automata intersected with the trie
find the terms that a word is, or is a misspelling of: letters put in, left out, replaced, or
swapped with the next one, each one edit. The intersection is made deterministic while it runs:
a state is the set of trie nodes that can be reached, with the edits spent, and its transitions
are kept. Words of any length are matched whole.

Every hit is weighed by its context: quotation marks around it and words of reporting within
a window speak for a quotation, others for abuse. A logistic model of the weights of exact,
misspelled and quoted hits gives the score. What a misspelling weighs is learned from the words
of the labelled rows that look like the term: where clean rows hold many, it tells little. Labels
hold few misspellings and quotations, so some rows are learned from a second time with their hits
taken for misspelled ones, and some as clean rows that quote them (``AUGMENT``).

Learning uses at most ``TOXIC`` and ``CLEAN`` labelled rows, those with the least hash of
their id, and of near copies one; every term with enough evidence there is in the lexicon.
Scoring reads every whole text. Only text and label are inputs of the model.

Edge cases: null and empty texts have no hits and get the score of a text without any; rows
without a label, or with another than 0 and 1, aren't learned from; of several labels of an
id the greatest holds; with no labels the lexicon is empty and every score is the same, below
0.5; a null id counts as held out; repeated rows get a row each; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import stored
from touchline.llm.minhash import shingles
from touchline.llm.pretokens import BREAK, PieceTable
from touchline.llm.textscan import code_points, parts, text_words

#: Labelled rows that are learned from, at most.
TOXIC, CLEAN = 10_000, 20_000
#: A term's share of toxic documents; clean ones count more where they are fewer.
LEAST_SHARE = 0.9
#: How many terms of the lexicon may be there by luck alone.
LUCK = 2.0
#: One in so many toxic rows is learned from with its terms misspelled, and one as a clean
#: row that quotes them: labels hold few of either.
AUGMENT = 10
STEMS = (4, 5, 6)
#: Letters of a term.
LEAST, LONGEST = 3, 40
WINDOW = 48
#: All hits of a kind in a text weigh so much at most.
MOST = 12.0
QUOTES = "\"“”„«»‟‹›"
#: Words that report what someone else said.
REPORTING = frozenset(
    "said says quote quoted quotes called calling wrote word words term slur means "
    "sagte zitat zitierte genannt wort dit citation appelé mot dijo cita llamó palabra".split()
)
_WORD = re.compile(r"[^\W_]+")


def edits(term: str) -> int:
    """Misspellings that a term of this length allows; a stem allows one at most."""
    letters = len(term.rstrip("*"))
    most = 0 if letters < 4 else 1 if letters < 10 else 2
    return min(most, 1) if term.endswith("*") else most


@dataclass
class Model:
    """Terms with the weights of the term and of a misspelling of it; a stem ends in
    ``*``. Coefficients: bias, exact, misspelled, quoted."""

    terms: dict[str, tuple[float, float]] = field(default_factory=dict)
    coefficients: tuple[float, ...] = (-4.0, 0.0, 0.0, 0.0)


#: A stem has been read; any letters may follow.
REST = "*"


class Matcher:
    """Levenshtein automata on the lexicon trie, made deterministic state by state.

    A place is a trie node and what is pending there: nothing, the letter that must come next
    because it was swapped with the one before, or ``REST``.
    """

    def __init__(self, terms: dict[str, tuple[float, float]], most: int = 100_000):
        self.most = most
        self.children: list[dict[str, int]] = [{}]
        self.words: list[str] = [""]
        self.stems: list[str] = [""]
        self.allows: list[int] = [0]
        self.weights = terms
        for term in sorted(terms):
            node = 0
            self.allows[0] = max(self.allows[0], edits(term))
            for letter in term.rstrip("*"):
                nxt = self.children[node].get(letter)
                if nxt is None:
                    nxt = self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.words.append("")
                    self.stems.append("")
                    self.allows.append(0)
                node = nxt
                self.allows[node] = max(self.allows[node], edits(term))
            (self.stems if term.endswith("*") else self.words)[node] = term
        self._clear()

    def _clear(self) -> None:
        first = self._closed({(0, ""): 0})
        self.states: list[tuple] = [(), first]
        self.number = {(): 0, first: 1}
        self.moves: dict[tuple[int, str], int] = {}
        self.found: list[tuple[str, int] | None] = [None, self._best(first)]

    def _closed(self, spent: dict[tuple[int, str], int]) -> tuple:
        """With the places that leaving out letters of a term reaches, and stems at their ends."""
        todo = [(node, e) for (node, pending), e in spent.items() if not pending]
        while todo:
            node, e = todo.pop()
            for child in self.children[node].values():
                if e + 1 <= self.allows[child] and spent.get((child, ""), 9) > e + 1:
                    spent[child, ""] = e + 1
                    todo.append((child, e + 1))
        for (node, pending), e in list(spent.items()):
            stem = self.stems[node]
            if stem and not pending and e <= edits(stem):
                spent[node, REST] = min(e, spent.get((node, REST), 9))
        return tuple(sorted(spent.items()))

    def _best(self, state: tuple) -> tuple[str, int] | None:
        """The term that a word ending here is nearest to, and how many edits away."""
        ends = []
        for (node, pending), e in state:
            term = self.stems[node] if pending == REST else "" if pending else self.words[node]
            if term and e <= edits(term):
                ends.append((e, -self.weights[term][min(e, 1)], -len(term), term))
        return (min(ends)[3], min(ends)[0]) if ends else None

    def _move(self, number: int, letter: str) -> int:
        spent: dict[tuple[int, str], int] = {}

        def reach(node: int, e: int, pending: str = "") -> None:
            if e <= self.allows[node] and spent.get((node, pending), 9) > e:
                spent[node, pending] = e

        for (node, pending), e in self.states[number]:
            if pending == REST:
                reach(node, e, REST)
            elif pending:
                if letter == pending:
                    reach(node, e)
            else:
                reach(node, e + 1)
                for other, child in self.children[node].items():
                    reach(child, e if other == letter else e + 1)
                    later = self.children[child].get(letter)
                    if later is not None and other != letter:
                        reach(later, e + 1, other)
        state = self._closed(spent) if spent else ()
        nxt = self.number.get(state)
        if nxt is None:
            nxt = self.number[state] = len(self.states)
            self.states.append(state)
            self.found.append(self._best(state))
        self.moves[number, letter] = nxt
        return nxt

    def match(self, word: str) -> tuple[str, int] | None:
        if len(self.states) > self.most:
            self._clear()
        state, moves = 1, self.moves
        for letter in word:
            nxt = moves.get((state, letter))
            state = self._move(state, letter) if nxt is None else nxt
            if not state:
                return None
        return self.found[state]


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)


def word_spans(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of words: letters and digits, and ``@ $ ! *`` between two."""
    inside = _letters()[points]
    marks = np.flatnonzero(np.isin(points, [33, 36, 42, 64]))
    marks = marks[(marks > 0) & (marks < len(points) - 1)]
    inside[marks[inside[marks - 1] & inside[marks + 1]]] = True
    edges = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    starts = np.flatnonzero(edges == 1)
    return starts, np.flatnonzero(edges == -1) - starts


def quotation(before: str, after: str) -> float:
    """How much a context speaks for a quotation, from 0 to 1."""
    enclosed = sum(before.count(q) for q in QUOTES) % 2 == 1 and any(q in after for q in QUOTES)
    near = _WORD.findall(before)[-6:] + _WORD.findall(after)[:6]
    return min(1.0, 0.7 * enclosed + 0.3 * any(w in REPORTING for w in near))


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.matcher = Matcher(model.terms)
        self.names = sorted(model.terms)
        place = {t: i for i, t in enumerate(self.names)}

        def code(word: str) -> list[int]:
            hit = self.matcher.match(word)
            # Hits without weight are no hits: short stems look like many words.
            told = hit is not None and model.terms[hit[0]][min(hit[1], 1)] > 0
            return [place[hit[0]] * 4 + hit[1] if told else -1]

        self.table = PieceTable(code)

    def features(self, texts: list[str]) -> np.ndarray:
        """Weights of exact, misspelled and quoted hits of each text, and what the exact
        ones would weigh if they were misspelled. Of misspelled hits the heaviest counts:
        words that look alike come in flocks, as forms of one word do."""
        found = np.zeros((len(texts), 4))
        if not self.names:
            return found
        begun = [0] * len(texts)
        for group in parts(texts):
            offsets = []
            for i, p in group:
                offsets.append(begun[i])
                begun[i] += len(p)
            whole = BREAK.join(p.lower() for _, p in group)
            points = code_points(whole)
            sizes = np.array([len(p.lower()) + 1 for _, p in group])
            first = np.cumsum(sizes) - sizes
            starts, lengths = word_spans(points)
            if not len(starts):
                continue
            codes = self.table.ids(self.table.find(points, starts, lengths))
            for k in np.flatnonzero(codes >= 0):
                start, end = int(starts[k]), int(starts[k] + lengths[k])
                part = int(np.searchsorted(first, start, "right") - 1)
                low, high = int(first[part]), int(first[part] + sizes[part] - 1)
                before, after = whole[max(low, start - WINDOW) : start], whole[end : min(high, end + WINDOW)]
                i, p = group[part]
                if start - low < WINDOW and offsets[part]:
                    cut = offsets[part]
                    before = (texts[i][max(0, cut - WINDOW) : cut].lower() + before)[-WINDOW:]
                if high - end < WINDOW and offsets[part] + len(p) < len(texts[i]):
                    cut = offsets[part] + len(p)
                    after = (after + texts[i][cut : cut + WINDOW].lower())[:WINDOW]
                quoted = quotation(before, after)
                exact, misspelled = self.model.terms[self.names[codes[k] >> 2]]
                row = found[i]
                if codes[k] & 3:
                    row[1] = max(row[1], misspelled * (1 - quoted))
                    row[2] += misspelled * quoted
                else:
                    row[0] += exact * (1 - quoted)
                    row[2] += exact * quoted
                    row[3] = max(row[3], misspelled)
        return np.minimum(found, MOST)

    def scores(self, texts: list[str]) -> np.ndarray:
        bias, *weights = self.model.coefficients
        return 1 / (1 + np.exp(-(bias + self.features(texts)[:, :3] @ np.array(weights))))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % 5 == 0


def _distinct_words(text: str) -> set[str]:
    return {w for w in _WORD.findall(text.lower()) if LEAST <= len(w) <= LONGEST}


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) to learn from: a bounded sample, one of each group of copies."""
    usable = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    usable = usable.where(~held_out(F.col("doc_id")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = [
        usable.where(F.col("toxic") == value).orderBy(*order).limit(most)
        for value, most in ((1, TOXIC), (0, CLEAN))
    ]
    chosen = stored(sample[0].unionByName(sample[1]).select("doc_id", "toxic"), "sample")
    schema = "doc_id long, toxic int, origin long"

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            # The least shingle of a text: near copies mostly share it.
            least = [shingles(h)[:1].view(np.int64) for _, h, _ in text_words(texts, lower=True)]
            origins = pa.array([int(x[0]) if len(x) else None for x in least], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), origins], ["doc_id", "toxic", "origin"]
            )

    found = _with_text(docs, chosen).mapInArrow(run, schema).where("origin IS NOT NULL")
    one = found.groupBy("origin", "toxic").agg(F.min("doc_id").alias("doc_id"))
    return stored(one.select("doc_id", "toxic").distinct(), "training")


def _with_text(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """doc_id, toxic and text of the sample, whose size is bounded: at most 30,000 rows of
    two numbers are broadcast."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = chosen.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    return texts.join(F.broadcast(rows), "doc_id").select("doc_id", "toxic", "text")


def learn_terms(docs: DataFrame, chosen: DataFrame) -> tuple[dict[str, float], int, int]:
    """The terms and their log odds, and how many toxic and clean rows there are."""
    schema = "term string, toxic long, clean long"

    def run(batches):
        for batch in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            toxics = batch.column("toxic").to_pylist()
            for toxic, text in zip(toxics, batch.column("text").to_pylist()):
                words = _distinct_words(text or "")
                stems = {w[:n] + "*" for w in words for n in STEMS if len(w) > n}
                counts[0 if toxic else 1].update(words | stems)
            terms = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(terms, pa.string()),
                    pa.array([counts[0][t] for t in terms], pa.int64()),
                    pa.array([counts[1][t] for t in terms], pa.int64()),
                ],
                ["term", "toxic", "clean"],
            )

    sizes = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return {}, toxic, clean
    counted = _with_text(docs, chosen).select("toxic", "text").mapInArrow(run, schema)
    counted = counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counted = stored(counted, "terms")
    t, c = F.col("toxic"), F.col("clean")
    share = t / (t + c * max(1.0, toxic / clean))
    base = toxic / (toxic + clean)
    told = t * F.log(t / (t + c) / base) + F.when(c > 0, c * F.log(c / (t + c) / (1 - base))).otherwise(0.0)
    needed = math.log(max(counted.where("toxic + clean > 1").count(), 1) / LUCK)
    # The cover asks for the evidence in the rows that are still open, where two tell little.
    rows = counted.where((t > 2) & (share >= LEAST_SHARE) & ((told >= needed) | (c == 0)))
    found = {r["term"]: (r["toxic"], r["clean"]) for r in rows.collect()}
    # The most evident first; words before stems and long stems before short ones.
    order = {t: -round(_evidence(*n, toxic, clean), 6) for t, n in found.items()}
    found = {t: found[t] for t in sorted(found, key=lambda t: (order[t], t.endswith("*"), -len(t), t))}
    held = _holders(docs, chosen, list(found))
    kept = _strong(found, held, toxic, clean, needed)
    kept = list(dict.fromkeys(kept + _cover(found, held, toxic, clean, needed)))
    alike = _look_alikes(counted, kept)

    def odds(t: float, c: float) -> float:
        weight = math.log((t + 0.1) / (toxic + 1)) - math.log((c + 0.1) / (clean + 1))
        return round(max(weight, 0.0), 6)

    terms = {}
    for term in kept:
        t, c = alike.get(term, (0, 0))
        t += found[term][0] / AUGMENT
        terms[term] = odds(*found[term]), odds(t, c) if t >= 1 + c else 0.0
    return terms, toxic, clean


def _look_alikes(counted: DataFrame, terms: list[str]) -> dict[str, tuple[int, int]]:
    """Toxic and clean rows that hold words at most a few edits from each term."""
    equal = dict.fromkeys(terms, (1.0, 1.0))

    def run(batches):
        matcher = Matcher(equal)
        for batch in batches:
            hits = [matcher.match(w) for w in batch.column("term").to_pylist()]
            near = pa.array([h[0] if h and h[1] else None for h in hits], pa.string())
            yield pa.RecordBatch.from_arrays(
                [near, batch.column("toxic"), batch.column("clean")], ["near", "toxic", "clean"]
            )

    words = counted.where(~F.col("term").endswith("*")).select("term", "toxic", "clean")
    near = words.mapInArrow(run, "near string, toxic long, clean long").where("near IS NOT NULL")
    sums = near.groupBy("near").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    return {r["near"]: (r["t"], r["c"]) for r in sums.collect()}  # one row for each term


def _evidence(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    """How unlikely such counts are for a term that tells nothing, as a negative log."""
    n, base = toxic + clean, all_toxic / (all_toxic + all_clean)
    if not n or toxic / n <= base:
        return 0.0
    total = toxic * math.log(toxic / n / base)
    return total + (clean * math.log(clean / n / (1 - base)) if clean else 0.0)


def _holders(docs: DataFrame, chosen: DataFrame, terms: list[str]) -> list[list[int]]:
    """Which terms each toxic row of the sample holds. At most ``TOXIC`` rows."""
    place = {t: i for i, t in enumerate(terms)}

    def run(batches):
        for batch in batches:
            held = []
            for text in batch.column("text").to_pylist():
                words = _distinct_words(text or "")
                stems = {w[:n] + "*" for w in words for n in STEMS if len(w) > n}
                held.append(sorted(place[t] for t in words | stems if t in place))
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.list_(pa.int32()))], ["held"])

    rows = _with_text(docs, chosen.where("toxic = 1")).select("text").mapInArrow(run, "held array<int>")
    return [r["held"] for r in rows.collect()]


def _strong(
    found: dict[str, tuple[int, int]], held: list[list[int]], toxic: int, clean: int, needed: float
) -> list[str]:
    """Terms that are evident by themselves, without those that another one stands for: a
    stem of a word, or a word or stem that goes on from a shorter stem."""
    terms = list(found)
    rows: list[set[int]] = [set() for _ in terms]
    for row, places in enumerate(held):
        for i in places:
            rows[i].add(row)
    taken: list[int] = []
    for i, term in enumerate(terms):
        if _evidence(*found[term], toxic, clean) < needed:
            continue
        letters = term.rstrip("*")
        akin = (
            k
            for k in taken
            if terms[k].startswith(letters) or terms[k].endswith("*") and letters.startswith(terms[k][:-1])
        )
        if all(len(rows[i] & rows[k]) < 0.95 * len(rows[i]) for k in akin):
            taken.append(i)
    return [terms[i] for i in taken]


def _cover(
    found: dict[str, tuple[int, int]], held: list[list[int]], toxic: int, clean: int, needed: float
) -> list[str]:
    """The fewest terms that explain the toxic rows: always the one that explains most of
    those still open, as long as these alone make it more than luck."""
    terms = list(found)
    rows: list[set[int]] = [set() for _ in terms]
    for row, places in enumerate(held):
        for i in places:
            rows[i].add(row)
    gains, left, taken = [len(r) for r in rows], len(held), []
    while True:
        best = max(range(len(terms)), key=lambda i: (gains[i], -i), default=None)
        if best is None or not gains[best]:
            return taken
        if _evidence(gains[best], found[terms[best]][1], max(left, 1), clean) < needed:
            return taken
        # A word in place of a stem that explains hardly more.
        for i, term in enumerate(terms):
            if terms[best].endswith("*") and not term.endswith("*") and gains[i] >= 0.95 * gains[best]:
                best = i
                break
        taken.append(terms[best])
        for row in rows[best]:
            if held[row]:
                left -= 1
                for i in held[row]:
                    gains[i] -= 1
                held[row] = []


def fit(features: np.ndarray, toxic: np.ndarray, ridge: float = 0.01) -> tuple[float, ...]:
    """Logistic regression by Newton steps; the bias is not held back."""
    x = np.hstack((np.ones((len(features), 1)), features))
    held = np.diag([1e-6, *[ridge] * features.shape[1]])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - toxic) + held @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + held, slope)
        step *= min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    # A hit never speaks against toxicity, nor does its misspelling or quotation; and a text
    # without any stays below 0.5, however many of the labels are toxic.
    return min(float(w[0]), -0.5), *(float(max(v, 0.0)) for v in w[1:])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    chosen = training_rows(docs, labels)
    terms, toxic, clean = learn_terms(docs, chosen)
    if not toxic or not clean:
        return Model()
    lexicon = Model(terms)

    def run(batches):
        for batch in batches:
            found = scorer(lexicon).features([t or "" for t in batch.column("text").to_pylist()])
            columns = [pa.array(c, pa.float64()) for c in found.T]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic").cast(pa.int64()), *columns], ["toxic", "e", "m", "q", "as_m"]
            )

    rows = _with_text(docs, chosen).select("toxic", "text").mapInArrow(
        run, "toxic long, e double, m double, q double, as_m double"
    )
    # At most one row of five numbers for each labelled row of the sample.
    table = np.array(rows.collect(), np.float64).reshape(-1, 5)
    table = table[np.lexsort(table.T)]
    hits = table[(table[:, 0] == 1) & (table[:, 1] > 0)][::AUGMENT]
    none = np.zeros(len(hits))
    misspelled = np.column_stack((none + 1, none, hits[:, 4], none))
    quoted = np.column_stack((none, none, none, hits[:, 1]))
    table = np.vstack((table[:, :4], misspelled, quoted))
    return Model(terms, tuple(round(c, 9) for c in fit(table[:, 1:], table[:, 0])))


_scorers: dict[int, Scorer] = {}


def scorer(model: Model) -> Scorer:
    """One scorer for a model in each Python worker."""
    key = hash((tuple(sorted(model.terms.items())), model.coefficients))
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Scorer(model)
    return _scorers[key]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every document. No shuffle."""

    def run(batches):
        for batch in batches:
            found = scorer(model).scores([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"]
            )

    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())])
    scored = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with a score below 0.5, with all their columns. No shuffle."""

    def run(batches):
        for batch in batches:
            found = scorer(model).scores([t or "" for t in batch.column("text").to_pylist()])
            yield batch.filter(pa.array(found < 0.5))

    return docs.mapInArrow(run, docs.schema)
