"""Each operator against a brute-force version, and its edge cases."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import tokenizers
from compare import difference
from pyspark.sql import functions as F

from touchline.llm import bytebpe, chat, linededup, minhash, packing, quality, queries, sharding
from touchline.llm import tokencount, toxicity, vectors, wordbpe
from touchline.llm.common import ship
from touchline.llm.pretokens import library_classes
from touchline.llm.textscan import text_words
from touchline.sources import files

WORD = "word_bpe_49k.json"
random.seed(5)
VOCABULARY = ["al", "be", "cor", "dum", "est", "fi", "gra", "hoc", "in", "jus", "l'ux", "Mos", "é"]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) + r.choice(["", "a", "um", "."]) for _ in range(n))


BASE = prose(60, 1)
NEAR = BASE.rsplit(" ", 2)[0] + " other end"
LINE = "a line that many of the documents share"
TEXTS = [
    (0, BASE), (1, BASE), (2, NEAR), (3, prose(50, 2)), (4, None), (5, ""), (6, " \t\n "),
    (7, "one two three"), (8, "ONE two\nthree"), (9, f"{LINE}\nx\n{LINE}"), (10, f"y\n  {LINE.upper()}"),
    (11, f"{LINE}\n"), (12, "\n".join([prose(9, 3)] * 5)), (13, prose(9000, 4)), (13, prose(9000, 4)),
    (14, "x" * 4000 + "'ll " + "日本語 １２ <|endoftext|>" * 20), (None, "no id " + prose(30, 6)), (15, "a  b\r\n\n c's"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd documents, with columns whose names the operators use for themselves."""
    ship(spark)
    rows = [(i, t, "src0" if (i or 0) % 3 else None, "k", 1.0, 7, 9) for i, t in TEXTS]
    schema = (
        "doc_id long, text string, source string, kept string, score double, row int, tokens int"
    )
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture
def nothing(docs):
    return docs.limit(0)


def table_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def sql_of(sf_dir, *names):
    connection = duckdb.connect()
    for name in names:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf_dir)}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(name, spark, sf_dir):
    sql = sql_of(sf_dir, "documents", "embeddings", "conversations", "benchmark")
    assert difference(queries.QUERIES[name](spark, sf_dir), sql, queries.ORACLE[name]) == ""


# --- words ----------------------------------------------------------------------


def test_words_are_the_runs_between_blanks():
    texts = [t or "" for _, t in TEXTS] + ["a" * 50, "x\x0by\x1cz w"]
    for i, hashes, lengths in text_words(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[i])
        assert lengths.tolist() == [len(w) for w in words]
        assert len(set(hashes.tolist())) == len(set(words))


def test_libraries_agree_with_their_classes():
    assert (library_classes("tokenizers") == library_classes("tiktoken")).mean() > 0.999


# --- 1: toxicity ------------------------------------------------------------------


def distance(a, b):
    """Edits from a to b; a swap of two letters is one."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            least = min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                least = min(least, rows[-2][j - 2] + 1)
            row.append(least)
        rows.append(row)
    return rows[-1][-1]


def near_terms(word, terms):
    """(edits, term) of all terms that the word is near to; a stem needs a beginning only."""
    for t in terms:
        letters = t.rstrip("*")
        heads = [word[:n] for n in range(len(word) + 1)] if t.endswith("*") else [word]
        least = min(distance(h, letters) for h in heads)
        if least <= toxicity.edits(t):
            yield least, t


def test_automata_find_all_misspellings():
    names = ["scum", "moron", "loser", "worthlessly", "lowe*", "mor*", "crowdedness*", "x" * 45]
    terms = {t: (float(i + 1), 1.0) for i, t in enumerate(names)}
    matcher = toxicity.Matcher(terms)
    r = random.Random(3)
    words = list(terms) + ["".join(r.choice("wormlsecuthny") for _ in range(r.randint(1, 12))) for _ in range(500)]
    for term in [t.rstrip("*") for t in terms] * 80:
        letters = list(term + r.choice(["", "", "est", "x" * 50]))
        for _ in range(r.randint(0, 3)):
            at = r.randrange(len(letters) or 1)
            if r.random() < 0.4:
                letters[at : at + 2] = letters[at : at + 2][::-1]
            else:
                letters[at : at + r.randint(0, 1)] = r.choice(["", "x", "o"])
        words.append("".join(letters))
    for word in words:
        near = list(near_terms(word, terms))
        found = matcher.match(word)
        assert (found is None) == (not near), word
        if near:
            assert found[1] == min(near)[0], word
    assert matcher.match("x" * 51) is None and matcher.match("x" * 46) == ("x" * 45, 1)


def test_a_small_table_of_states_gives_the_same():
    terms = dict.fromkeys(["scum", "moron", "worthless", "lowe*"], (1.0, 1.0))
    large, small = toxicity.Matcher(terms), toxicity.Matcher(terms, most=5)
    r = random.Random(4)
    for _ in range(300):
        word = "".join(r.choice("scumornwthle") for _ in range(r.randint(2, 9)))
        assert small.match(word) == large.match(word)


def test_stems_match_by_their_beginning():
    matcher = toxicity.Matcher({"lowe*": (1.0, 1.0)})
    assert matcher.match("lowerest") == ("lowe*", 0) and matcher.match("lo") is None
    assert matcher.match("llowerest") == matcher.match("lwoerest") == ("lowe*", 1)


def misspelled(term, kind, r):
    at = r.randrange(len(term) - 1)
    if kind == "swap":
        at = next(i for i in range(len(term) - 1) if term[i] != term[i + 1])
        return term[:at] + term[at + 1] + term[at] + term[at + 2 :]
    return term[:at] + {"drop": "", "double": term[at] * 2, "replace": "x"}[kind] + term[at + 1 :]


def test_planted_misspellings_are_found(spark):
    """Each document with one misspelled term and nothing else of the lexicon."""
    r = random.Random(6)
    terms = ["skum", "moron", "halunke", "schuft", "worthless", "grobian"]
    family = ["krethier", "krethiana", "krethios", "krethilund", "krethimo", "krethiwa", "krethiper"]
    rows, labels = [], []
    for i in range(1500):
        words = prose(40, 5000 + i).split()
        if i % 5 == 0:
            words[r.randrange(40)] = r.choice(terms + [r.choice(family)])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0)))
    planted = {}
    for i in range(400):
        words = prose(40, 9000 + i).split()
        kind = ["swap", "drop", "double", "replace"][i % 4]
        term = r.choice(terms)
        planted[10_000 + i] = kind if i % 7 else "stem"
        words[r.randrange(40)] = misspelled(term, kind, r) if i % 7 else "kretih" + r.choice(["xe", "ola", "dum"])
        rows.append((10_000 + i, " ".join(words)))
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(texts, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert any(t.startswith("kreth") and t.endswith("*") for t in model.terms) and "skum" in model.terms
    found = {r.doc_id: r.predicted for r in toxicity.score(texts, model).collect()}
    by_kind = defaultdict(list)
    for i, kind in planted.items():
        by_kind[kind].append(found[i])
    assert all(sum(x) >= 0.9 * len(x) for x in by_kind.values()), {k: sum(x) / len(x) for k, x in by_kind.items()}
    clean = [found[i] for i in range(1500) if i % 5]
    assert sum(clean) <= 0.001 * len(clean)
    assert all(found[i] for i in range(0, 1500, 5))


def test_contexts_reach_over_cuts(monkeypatch):
    from touchline.llm import textscan

    model = toxicity.Model({"moron": (5.0, 4.0)}, (-4.0, 1.0, 1.0, 0.5))
    text = 'it is said that they wrote "you moron" to them and more words that follow it'
    whole = toxicity.Scorer(model).scores([text, "x", text])
    for limit in (3, 10, 25, 40):
        monkeypatch.setattr(toxicity, "parts", lambda texts, limit=limit: textscan.parts(texts, limit))
        assert np.array_equal(toxicity.Scorer(model).scores([text, "x", text]), whole), limit


def test_a_quotation_weighs_less():
    model = toxicity.Model({"moron": (5.0, 4.0)}, (-4.0, 5.0, 4.0, 0.0))
    scorer = toxicity.Scorer(model)
    plain, wrong, quoted, clean = scorer.scores(
        ["you moron there", "you morron there", 'they wrote "you moron" to them', "nothing here"]
    )
    assert plain > 0.5 and wrong > 0.5 and quoted < plain and clean < 0.5


def toxic_corpus(spark):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = prose(40, 100 + i).split()
        if toxic:
            words[r.randrange(40)] = r.choice(["grobian", "halunke", "schuft"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    rows += [(1000, None), (1001, ""), (None, "halunke")]
    labels += [(5000, 1, 1), (1, 1, None), (None, 0, 1), (2, 0, 7)]
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_held_out_documents_are_told_apart(spark, docs):
    texts, labels = toxic_corpus(spark)
    model = toxicity.train(texts, labels)
    scored = toxicity.score(texts, model)
    assert scored.count() == texts.count()
    for row in scored.collect():
        if row.doc_id is not None and row.doc_id < 600:
            assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
            assert row.predicted == int(row.doc_id % 4 == 0)
        assert row.predicted == int(row.score >= 0.5) and 0 <= row.score <= 1
    kept = toxicity.keep_clean(texts, model)
    assert kept.count() == 600 - 150 + 2 and kept.columns == texts.columns


def test_no_labels_make_no_document_toxic(spark, docs):
    _, labels = toxic_corpus(spark)
    model = toxicity.train(docs, labels.limit(0))
    assert {r.predicted for r in toxicity.score(docs, model).collect()} == {0}
    assert toxicity.score(docs.limit(0), model).count() == 0


# --- 2: near-duplicate texts ------------------------------------------------------


def shingle_set(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def classes(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and linked(a, b) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


def similar(x, y):
    return bool(x) and bool(y) and 100 * len(x & y) >= 75 * len(x | y)


def test_near_duplicates_equal_brute_force(spark, docs):
    r = random.Random(9)
    texts = {i: t for i, t in TEXTS if i is not None}
    center = prose(40, 77).split()
    for i in range(100, 160):  # a group whose members are alike to very different degrees
        words = list(center)
        for _ in range(r.randint(0, 9)):
            words[r.randrange(40)] = f"w{r.randrange(1000)}"
        texts[i] = " ".join(words)
    frame = spark.createDataFrame(list(texts.items()) + [(None, BASE), (2, NEAR)], "doc_id long, text string")
    sets = {i: shingle_set(t) for i, t in texts.items()}
    expected = classes(sorted(sets), lambda a, b: similar(sets[a], sets[b]))
    found = minhash.near_duplicates(frame).collect()
    assert len(found) == len(texts) + 2
    for row in found:
        if row.doc_id is None:
            assert row.component_id is None and row.kept
        else:
            assert row.component_id == expected[row.doc_id], row
            assert row.n_shingles == len(sets[row.doc_id])
            assert row.kept == (row.doc_id == row.component_id)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert not {1, 2} & {r.doc_id for r in kept.collect()}


def test_split_tiles_find_the_same_links(spark, docs, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 5)
    test_near_duplicates_equal_brute_force(spark, docs)


# --- 3: near-duplicate vectors ----------------------------------------------------


def test_vectors_equal_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(vectors, "TILE", 16)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 24))
    more = np.repeat(x[:5], 30, axis=0) + rng.normal(scale=0.12, size=(150, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack((x, more, x[3:4], 2 * x[3:4])))]
    n = len(rows)
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [None] * 24, [float("inf")] + [0.0] * 23, [1.0, 0.0]]
    rows += [(n + k, v) for k, v in enumerate(odd)] + [(None, x[0].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    unit = np.array([v for _, v in rows[:n]])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    links = unit @ unit.T >= vectors.LIMIT
    np.fill_diagonal(links, False)
    expected = classes(range(n), lambda a, b: links[a, b])
    found = vectors.near_vectors(frame.withColumn("kept", F.lit(1))).collect()
    assert len(found) == len(rows)
    for row in found:
        if row.vec_id is not None and row.vec_id < n:
            assert (row.n_links, row.component_id) == (links[row.vec_id].sum(), expected[row.vec_id])
        else:
            assert (row.n_links, row.component_id, row.kept) == (0, row.vec_id, True)
    assert vectors.near_vectors(frame.limit(0)).count() == 0


def test_only_pairs_near_the_limit_are_recomputed():
    rng = np.random.default_rng(4)
    x = vectors.units(list(rng.normal(size=(300, 64))) + list(rng.normal(size=(1, 64)) + np.zeros((50, 64))))
    i, j, tried = vectors.linked(x, x, 0.95)
    exact = np.argwhere(x @ x.T >= 0.95)
    assert sorted(zip(i, j)) == sorted(map(tuple, exact)) and tried < 1.1 * len(exact)


# --- 4: packing -------------------------------------------------------------------


def check_packing(frame, docs, expected, length):
    pieces = frame.collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for i, copies in expected.items():
        assert Counter(p.doc_tokens for p in by_doc[i]).keys() == {len(x) for x in copies}
        crc = sorted((p.start, p.length, p.ids_crc32) for p in by_doc[i])
        told = sorted(
            (s, n, zlib.crc32(struct.pack(f"<{n}I", *copies[0][s : s + n]))) for s, n, _ in crc
        )
        assert crc == told or len(copies) > 1
        assert sum(p.length for p in by_doc[i]) == sum(map(len, copies))
    last = max(by_sequence)
    assert sorted(by_sequence) == list(range(last + 1))
    for s, held in by_sequence.items():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == length or s == last


def test_packing_keeps_every_token_once(docs):
    path = public_tokenizers.path(WORD)
    library = tokenizers.Tokenizer.from_file(path)
    expected = defaultdict(list)
    for i, t in TEXTS:
        expected[i].append([*library.encode(t or "", add_special_tokens=False).ids, 2])
    frame = packing.pack(docs, path, length=128, window=512)
    check_packing(frame, docs, expected, 128)
    assert packing.pack(docs.limit(0), path).count() == 0


def test_windows_hold_the_target_mix(spark, docs):
    rows = [(n, s, n, 10 + n % 7) for n, s in enumerate(["a", "a", "a", "b"] * 500)]
    lengths = spark.createDataFrame(rows, "row long, source string, doc_id long, tokens long")
    dealt = packing.windows(lengths, 1000, None).groupBy("window", "source").agg(F.sum("tokens").alias("n"))
    served: dict = defaultdict(lambda: defaultdict(int))
    total = Counter()
    for r in dealt.collect():
        served[r.window][r.source] = r.n
        total[r.source] += r.n
    for s in "ab":
        credit, given = 1000 * total[s] / sum(total.values()), 0
        for w in sorted(served):  # what was given never exceeds the credit, nor lags a document
            given += served[w][s]
            assert given <= w * credit + 1e-6 and given > min(w * credit, total[s]) - 17
    half = packing.windows(lengths, 1000, {"a": 0.5, "b": 0.5}).where("window = 2").groupBy("source")
    assert all(abs(r.n - 500) <= 17 for r in half.agg(F.sum("tokens").alias("n")).collect())


# --- 5: sharding ------------------------------------------------------------------


@pytest.mark.parametrize("count", [1, 2, 3, 10, 97, 1000, 1024])
def test_the_network_is_a_permutation(spark, count):
    found = sharding.permuted(spark.range(count), "id", count, 3, "place").collect()
    assert sorted(r.place for r in found) == list(range(count))


def test_shards_are_even_and_gapless(docs):
    found = sharding.shard(docs, shards=4).collect()
    assert len(found) == len(TEXTS)
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    told = Counter((i, len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode())) for i, t in TEXTS)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == told
    assert table_of(sharding.shard(docs, 4)) == sorted(map(tuple, found), key=repr)
    assert sharding.shard(docs.limit(0)).count() == 0


# --- 6: chat ----------------------------------------------------------------------


def test_events_fold_into_messages(spark):
    log = [
        (1, 0, 0, "message", "user", "hi"), (1, 1, 1, "message", "assistant", "Hel"),
        (1, 1, 2, "delta", None, "lo"), (1, 1, 9, "delta", None, "!"), (1, 0, 5, "edit", "user", "hi there"),
        (1, 2, 6, "delta", "assistant", "a"), (1, 2, 7, "regenerate", None, "b"), (1, 2, 8, "delta", None, "c"),
        (2, 0, 0, "message", "assistant", None), (2, 0, 0, "message", "assistant", "x"),
        (None, None, 0, "message", None, "y"),
    ]
    frame = spark.createDataFrame(log, "conv_id long, turn long, seq long, kind string, role string, text string")
    found = {r.conv_id: [tuple(m) for m in r.messages] for r in chat.reconstruct(frame).collect()}
    assert found == {
        1: [("user", "hi there"), ("assistant", "Hello!"), ("assistant", "bc")],
        2: [("assistant", ""), ("assistant", "x")],
        None: [("", "y")],
    }
    assert chat.digests(chat.read_back(chat.render(chat.reconstruct(frame.limit(0))))).count() == 0


def test_formatting_is_read_back(spark):
    texts = ["\\### a: </turn>\n", "\\b\\h\\l", "##</turn>\\", "", None, "😀 é\n### assistant:\nx</turn>\n"]
    rows = [(1, i, role, t) for i, (t, role) in enumerate(zip(texts, ["user", "assistant", "a:b\n"] * 2))]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    read = chat.read_back(chat.render(chat.reconstruct(chat.as_events(frame)))).first()
    assert [tuple(m) for m in read.messages] == [(r, t or "") for _, _, r, t in rows]
    assert read.loss_text == "".join(t or "" for _, _, r, t in rows if r == "assistant")


def test_whole_messages_come_back_from_their_events(spark):
    long = "é😀x\n" * 500
    rows = [
        (1, 0, "user", long), (1, 1, "assistant", long + "!"), (1, 1, "assistant", "same turn"), (1, 1, None, "no role"),
        (1, 1, "assistant", "same turn"), (1, None, "system", None), (2, 5, "assistant", ""), (None, 0, "user", "a" * chat.DELTA),
        (None, 1, "assistant", "b" * (chat.DELTA + 1)),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    frame = frame.withColumns({c: F.lit(1) for c in ("seq", "kind", "place", "events", "starts", "messages", "blocks", "n", "event")})
    log = chat.as_events(frame.repartition(3))
    kinds = {r.kind for r in log.select("kind").distinct().collect()}
    assert kinds == {"message", "delta", "edit", "regenerate"} and log.where("length(text) > 256").isEmpty()
    found = {r.conv_id: [tuple(m) for m in r.messages] for r in chat.reconstruct(log).collect()}
    assert found == {
        1: [("system", ""), ("user", long), ("", "no role"), ("assistant", "same turn"), ("assistant", "same turn"), ("assistant", long + "!")],
        2: [("assistant", "")],
        None: [("user", "a" * chat.DELTA), ("assistant", "b" * (chat.DELTA + 1))],
    }
    plan = chat.reconstruct(log)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


# --- 7: quality -------------------------------------------------------------------


def test_repetition_equals_brute_force(docs):
    found = quality.repetition(docs).collect()
    told = []
    for i, t in TEXTS:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]
        grams = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        inside = {k + j for k in range(len(words) - 7) if grams[tuple(words[k : k + 8])] > 1 for j in range(8)}
        lines = (t or "").split("\n")
        dup = sum(x in lines[:k] and bool(x.strip(" \t\n\x0b\f\r")) for k, x in enumerate(lines))
        symbols = sum(c in "#*$%&|<>" for c in t or "")
        failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
        told.append((i, len(words), sum(map(len, words)), symbols, dup, len(inside), failed))
    rows = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found]
    assert sorted(rows, key=repr) == sorted(told, key=repr)
    assert not any(r.kept and r.base_failed for r in found)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in found)
    assert quality.repetition(docs.limit(0)).count() == 0


def brute_verdict(text):
    """Line share, gram shares, base_failed and kept by the rules' own words."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]

    def inside(n):
        grams = [tuple(words[k : k + n]) for k in range(len(words) - n + 1)]
        often = Counter(grams)
        return {k + j for k, g in enumerate(grams) if often[g] > 1 for j in range(n)}

    lines, chars = (text or "").split("\n"), sum(map(len, words))
    again = sum(len(x) for k, x in enumerate(lines) if x in lines[:k] and x.strip(" \t\n\x0b\f\r"))
    total = sum(map(len, lines))
    line_share = again / total if total else 0.0
    shares = [sum(len(words[k]) for k in inside(n)) / chars if chars else 0.0 for n in (5, 10)]
    failed = len(words) < 20 or 100 * len(inside(8)) > 30 * len(words)
    kept = not failed and line_share <= 0.3 and shares[0] <= 0.4 and shares[1] <= 0.3
    return line_share, shares, failed, kept


def repetitive(seed):
    """A text that repeats short or long phrases of long words, or lines, to some degree."""
    r = random.Random(seed)
    size, times, most, join = r.choice([(4, 4, 25, " "), (6, 3, 25, " "), (11, 2, 40, " "), (3, 6, 7, "\n")])
    phrase = " ".join(r.choice("abc") * r.randint(1, 14) + str(k) for k in range(size))
    fill = [" ".join(f"u{r.random()}"[2 : r.randint(7, 13)] for _ in range(r.randint(2, most))) for _ in range(times)]
    return join.join(x for other in fill for x in (phrase, other))


def test_coverage_and_the_verdict_equal_brute_force(spark, docs):
    texts = {i: repetitive(i) for i in range(400)} | {1000 + k: t for k, (_, t) in enumerate(TEXTS)}
    told = {i: brute_verdict(t) for i, t in texts.items()}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = quality.repetition(frame).collect()
    assert {r.doc_id: (r.dup_line_share, r.dup_gram_shares, r.base_failed, r.kept) for r in found} == told
    # Every limit decides alone about some text.
    passed = [v for v in told.values() if not v[2]]
    alone = Counter((v[0] > 0.3, v[1][0] > 0.4, v[1][1] > 0.3) for v in passed)
    assert all(alone[c] for c in [(True, False, False), (False, True, False), (False, False, True), (False, False, False)]), alone
    kept = {r.doc_id for r in quality.keep_good(frame).collect()}
    assert kept == {i for i, v in told.items() if v[3]}


# --- 8 and 10: tokens -------------------------------------------------------------

ODD = ["", " ", "it's we'll they'rexx 'sab ''s 's's 'l 'r", "a  b\n\nc \n d\t\te", "<|endoftext|>x<|endoftext|>",
       "日本語 １２３ ½", "a\x1cb \x85c", "!!'s", " 's", "'ll'll", "x" * 3000, " " * 2000, "'" * 2000, " \n" * 700 + "x",
       ("a" * 510 + "'re") * 4, "\n "]


def odd_texts():
    r = random.Random(8)
    letters = "aestrvlmd'  \n\t0129éß!#日"
    return ODD + ["".join(r.choice(letters) for _ in range(r.randint(1, 700))) for _ in range(150)]


def test_byte_bpe_equals_the_library(docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    texts = odd_texts()
    assert [x.tolist() for x in bytebpe.codec(path).encode(texts)] == list(map(library.encode_ordinary, texts))
    encoded = bytebpe.encode_decode(docs, path)
    found = bytebpe.digests(encoded).collect()
    told = []
    for i, t in TEXTS:
        ids = library.encode_ordinary(t or "")
        joined = ",".join(map(str, ids)).encode()
        told.append((i, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, found), key=repr) == sorted(told, key=repr)
    again = bytebpe.decode(encoded.select("doc_id", "ids"), path).where("doc_id = 0").first()
    assert bytes(again.decoded).decode() == BASE
    assert bytebpe.encode_decode(docs.limit(0), path).count() == 0


def test_token_counts_equal_the_library(docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)

    def count(text):
        return len(library.encode(text, add_special_tokens=False).ids)

    texts = odd_texts()
    assert tokencount.counter(path).counts(texts) == list(map(count, texts))
    found = [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokencount.token_counts(docs, path).collect()]
    told = [(i, len((t or "").encode()), count(t or ""), count(t or "") > 1024) for i, t in TEXTS]
    assert sorted(found, key=repr) == sorted(told, key=repr)
    assert tokencount.token_counts(docs.limit(0), path).count() == 0


@pytest.fixture(scope="module")
def beyond():
    """Texts longer than what is worked on at once, one of them without white space."""
    from touchline.llm import textscan

    r = random.Random(12)
    texts = ["short", " ".join(r.choice(ODD[:12]) for _ in range(90_000)), "é" * (textscan.LIMIT + 9), prose(180_000, 3)]
    assert all(len(t) > textscan.LIMIT for t in texts[1:]) and len(list(textscan.parts(texts))) > 3
    return texts


def test_tokens_of_texts_beyond_a_cut(beyond):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = [x.tolist() for x in bytebpe.codec(path).encode(beyond)]
    assert found == list(map(library.encode_ordinary, beyond))
    for name, count in (("byte_bpe_50k.json", lambda p: tokencount.counter(p).counts(beyond)),
                        (WORD, lambda p: [len(x) for x in wordbpe.word_bpe(p).encode(beyond)])):
        path = public_tokenizers.path(name)
        library = tokenizers.Tokenizer.from_file(path)
        assert count(path) == [len(library.encode(t, add_special_tokens=False).ids) for t in beyond]


def test_words_of_texts_beyond_a_cut(spark, beyond):
    rows = list(enumerate(beyond)) + [(9, beyond[3] + " one more")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in minhash.near_duplicates(frame).collect()}
    assert all(found[i].n_shingles == len(shingle_set(t)) for i, t in rows)
    assert {i: r.component_id for i, r in found.items()} == {0: 0, 1: 1, 2: 2, 3: 3, 9: 3}
    told = {r.doc_id: (r.dup_line_share, r.base_failed, r.kept) for r in quality.repetition(frame.where("doc_id < 3")).collect()}
    assert told == {i: (v[0], *v[2:]) for i, v in enumerate(map(brute_verdict, beyond[:3]))}


def test_small_tables_of_pieces_and_states_give_the_same():
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = odd_texts()
    whole = tokencount.counter(path)
    small = tokencount.TokenCounter(path)
    small.machine.most, small.table.most = 3, 4
    assert [small.counts([t]) for t in texts] == [whole.counts([t]) for t in texts]
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    codec = bytebpe.ByteBpe(path)
    codec.table.most = 4
    assert [next(codec.encode([t])).tolist() for t in texts] == [x.tolist() for x in bytebpe.codec(path).encode(texts)]


# --- 9: lines ---------------------------------------------------------------------


def test_lines_equal_brute_force(docs):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))

    holders = defaultdict(set)
    for i, t in TEXTS:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(-1 if i is None else i)
    told = []
    for i, t in TEXTS:
        lines = (t or "").split("\n")
        own = -1 if i is None else i
        kept = [x for x in lines if len(holders[key(x)]) < 3 or max(holders[key(x)]) == own]
        told.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    for batches in (1, 5):
        found = linededup.digests(linededup.dedup_lines(docs, batches)).collect()
        assert sorted(map(tuple, found), key=repr) == sorted(told, key=repr)
    assert any(n for _, _, n, _ in told)
    assert linededup.digests(linededup.dedup_lines(docs.limit(0))).count() == 0


def numbered_lines(spark, *pairs):
    texts = [(i, f"a line with the number {n} in it") for i, n in pairs]
    return linededup.document_lines(spark.createDataFrame(texts, "doc_id long, text string"), 1)


def test_levels_are_compacted_and_know_what_is_new(spark, docs):
    index = linededup.LineIndex(3)
    for n in range(7):
        index.add(numbered_lines(spark, (1, n), (2, n), (3, 0)))
    assert [len(level) for level in index.levels] == [1, 1, 1]
    assert index.unseen(numbered_lines(spark, (7, 0), (7, 6), (8, 7))).count() == 1
    other = docs.select("doc_id", F.lit("a line that no other document has").alias("text"))
    assert index.unseen(linededup.document_lines(other, 1)).count() == docs.count()
    folders = [path for _, path in index.tables.values()]
    assert len(folders) == 3
    assert sorted(r.keeper for r in index.common().collect()) == [3]
    assert not any(files.exists(spark, path) for path in folders) and not index.tables
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("touchline_run")]


def test_a_key_has_one_home_and_updates_of_it(spark, monkeypatch):
    monkeypatch.setattr(linededup, "FAN", 9)
    index = linededup.LineIndex(3)
    for batch in ([(1, 0), (2, 0), (2, 1)], [(3, 0), (3, 2), (4, 2)], [(5, 0), (5, 2), (6, 1), (6, 3)], [(7, 1)]):
        index.add(numbered_lines(spark, *batch))
    rows = [tuple(r) for run in index.runs() for r in run.where("home").select(*linededup.KEY).collect()]
    assert len(rows) == len(set(rows)) == 4
    updates = [sum(r.documents for r in run.where("NOT home").collect()) for run in index.runs()]
    assert updates == [0, 1, 3, 1]
    assert sorted(r.keeper for r in index.common().collect()) == [5, 5, 7]


def test_runs_meet_without_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(linededup, "FAN", 9)
    index = linededup.LineIndex(3)
    for n in range(3):
        index.add(numbered_lines(spark, (1, n), (2, n), (3, 0)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs = index.runs()
        for frame in (index.unseen(runs[0].select(*linededup.KEY)), linededup.merged(runs[0], runs[1])):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    index.common()


CLASHING = ("_gone", "_kept", "_owner", "_text_key", "_component", "gone", "kept", "owner", "text_key", "row", "id", "key_a", "batch", "a.b")


def test_columns_of_any_name_are_carried(spark):
    rows = [(i, f"{LINE} {i % 2} and more words that are not alike {i // 6}\n{LINE}") for i in range(12)]
    docs = spark.createDataFrame([*rows, (None, None)], "doc_id long, text string")
    docs = docs.withColumn("n_chars", F.length("text"))
    clashing = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in CLASHING})
    for operator in (linededup.without_copies, minhash.drop_near_duplicates):
        plain, found = operator(docs), operator(clashing)
        assert found.columns == clashing.columns and found.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        told = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"], r["n_chars"]) for r in found.collect() if r["text"])
        assert told == sorted(tuple(r) for r in plain.collect() if r["text"])
        for r in found.collect():
            own = "none" if r["doc_id"] is None else r["doc_id"]
            assert all(r[c] == f"{c} of {own}" for c in CLASHING)
    assert linededup.without_copies(clashing).where("n_chars <> length(text)").isEmpty()


def test_pieces_of_ids_of_any_width(spark):
    ids = np.array([0, 1, 2, 255, 256, 49151, 65535])
    for width in (2, 4):
        raw = bytearray(ids.astype(f"<u{width}").tobytes())
        rows = [(1, 7, raw, 0), (None, 7, raw, 7), (2, 1, raw[: width], 14)]
        frame = spark.createDataFrame(rows, "doc_id int, tokens long, ids binary, start long")
        found = [tuple(r) for r in packing.cut(frame, 10, width).orderBy("sequence_id", "offset").collect()]
        crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in (ids, ids[:3], ids[3:], ids[:1])]
        assert found == [
            (1, 0, 7, crc[0], 7, 0, 0), (None, 0, 3, crc[1], 7, 0, 7), (None, 3, 4, crc[2], 7, 1, 0), (2, 0, 1, crc[3], 1, 1, 4),
        ]
        assert packing.cut(frame.limit(0), 10, width).isEmpty()


def test_sources_without_a_target(spark):
    rows = [(i, "ab"[i % 2], i, 10) for i in range(200)]
    lengths = spark.createDataFrame(rows, "row long, source string, doc_id long, tokens long")

    def share(others):
        dealt = packing.windows(lengths, 100, {"a": 0.5}, others)
        return dealt.where("window = 3 AND source = 'b'").count()

    assert (share(None), share(0.1), share(0.5)) == (0, 1, 5)


# --- the pipeline -----------------------------------------------------------------


def test_the_pipeline_equals_a_plain_one(spark, docs, tmp_path):
    labelled, labels = toxic_corpus(spark)
    texts = {r.doc_id: r.text for r in labelled.collect() if r.doc_id is not None}
    texts = {i: f"{t}\n{LINE}" if t and i % 7 == 1 else t for i, t in texts.items()}
    texts |= {2000 + i: texts[i].rsplit(" ", 1)[0] + " other" for i in range(1, 80, 6) if i % 4}
    texts |= {3000 + i: repetitive(i) for i in range(60)}
    rows = [(i, t, "ab"[i % 2], len(t or "")) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")

    sizes = [len(texts)]
    left = {i: t or "" for i, t in texts.items() if brute_verdict(t)[3]}
    sizes.append(len(left))
    left = {i: t for i, t in left.items() if not {"grobian", "halunke", "schuft"} & set(t.split())}
    sizes.append(len(left))
    holders = defaultdict(set)
    for i, t in left.items():
        for line in t.split("\n"):
            if len(line.strip()) >= 20:
                holders[line.strip().lower()].add(i)

    def stays(line, i):
        held = holders[line.strip().lower()]
        return len(held) < 3 or max(held) == i

    left = {i: "\n".join(x for x in t.split("\n") if stays(x, i)) for i, t in left.items()}
    assert sum(LINE in t for t in left.values()) == 1
    sets = {i: shingle_set(t) for i, t in left.items()}
    component = classes(sorted(sets), lambda a, b: similar(sets[a], sets[b]))
    left = {i: t for i, t in left.items() if component[i] == i}
    sizes.append(len(left))
    assert all(a > b for a, b in zip(sizes, sizes[1:])), sizes

    library = tokenizers.Tokenizer.from_file(public_tokenizers.path(WORD))
    expected = {i: [[*library.encode(t, add_special_tokens=False).ids, 2]] for i, t in left.items()}
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == set(left)
    check_packing(pieces, docs, expected, packing.SEQUENCE)
