"""The registered queries of the operators, and SQL for those it can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import (
    bytebpe,
    chat,
    dualtree,
    linededup,
    merkle,
    minhash,
    packing,
    quality,
    secrets,
    sharding,
    tokencount,
    toxicity,
    vectors,
)
from touchline.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit("\\### Assistant: </turn> ok")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), text.alias("text"))
    log = chat.as_events(rows.unionByName(extra))
    return chat.digests(chat.read_back(chat.render(chat.reconstruct(log))))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = quality.Rules()
    measured = quality.repetition(table(spark, sf_dir, "documents"), rules)
    shares = {
        f"dup_gram{n}_share": F.col("dup_gram_shares")[i] for i, (n, _) in enumerate(rules.coverage)
    }
    return measured.withColumns(shares).drop("dup_gram_shares")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bytebpe.digests(bytebpe.encode_decode(table(spark, sf_dir, "documents"), path))


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.digests(linededup.dedup_lines(docs))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return tokencount.token_counts(table(spark, sf_dir, "documents"), path)


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dualtree.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.build(merkle.documents(docs, merkle.every_third())).verify()


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_minhash,
        op3_embeddings,
        op4_packing,
        op5_sharding,
        op6_chat,
        op7_quality,
        op8_byte_bpe,
        op9_lines,
        op10_token_counts,
        op11_search,
        op12_merkle,
        op13_secrets,
    )
}

_TURN = "coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10)"
_BODY = "length(replace(replace(replace(coalesce(text, ''), '\\', '\\b'), '#', '\\h'), '<', '\\l'))"
_HEAD = """length(replace(replace(replace(replace(coalesce(role, ''),
    '\\', '\\b'), '#', '\\h'), '<', '\\l'), ':', '\\c'))"""

#: Smallest node that undirected links (a, b) lead to, for ids in ``nodes``.
_REACH = """reach(id, other) AS (
            SELECT id, id FROM nodes
            UNION SELECT r.id, l.b FROM reach r JOIN both_ways l ON r.other = l.a)"""


def _term_list(column: str) -> str:
    lowered = (
        f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    )
    return f"regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


def _field(column: str) -> str:
    """A leaf's input: the byte count and the value, or a mark for null."""
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


_FIELDS = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
_BYTES = "[ascii(x) for x in string_split(CAST(doc_id AS VARCHAR), '')]"
#: CRC-32 of the decimal id, bit by bit.
_CRC = f"""xor(4294967295, list_reduce(list_prepend(4294967295, {_BYTES}), lambda c, b:
    list_reduce(list_prepend(xor(c, b), range(8)),
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _in_either_case(pattern: str) -> str:
    """Letters of the leading names as classes: SQL would fold other alphabets as well."""
    names, rest = pattern.split(")", 1)
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in names) + ")" + rest


def _parts(place: int, kind: secrets.Kind) -> str:
    """(id, k, role, s, e): the matches of a kind, placed by what stands before each."""
    pattern = _in_either_case(kind.pattern) if kind.either_case else kind.pattern
    each = "(?s)(.*?)(" + pattern.replace("'", "''") + ")"
    group = kind.group + 2
    rules = [f"length(v) >= {kind.least}", *(f"regexp_matches(v, '{c}')" for c in kind.holds)]
    return f"""
        SELECT id, {place} AS k, '{kind.role}' AS role, e - length(hit) AS s, e FROM (
            SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY id ORDER BY i)::BIGINT AS e
            FROM (SELECT id, unnest(regexp_extract_all(t, '{each}', 1)) AS gap,
                unnest(regexp_extract_all(t, '{each}', 2)) AS hit,
                unnest(regexp_extract_all(t, '{each}', {group})) AS v,
                unnest(range(len(regexp_extract_all(t, '{each}', 0)))) AS i FROM texts))
        WHERE {" AND ".join(rules)}"""


_ALL_PARTS = " UNION ALL ".join(_parts(i, kind) for i, kind in enumerate(secrets.KINDS))
_GAPS = _parts(0, secrets.Kind("gap", "gap", secrets.GAP))
_NAMES = "[" + ", ".join(f"'{kind.name}'" for kind in secrets.KINDS) + "]"
_N_BASE = len(secrets.BASE)

_RULES = quality.Rules()
_WORD = "[^\\x20\\x09-\\x0D]"


def _covered(n: int) -> str:
    """(id, words, chars): what stands in runs of ``n`` words found twice or more."""
    return f"""
        SELECT id, count(*) AS words, sum(chars) AS chars FROM (
            SELECT DISTINCT id, place, length(w[place]) AS chars FROM (
                SELECT id, w, unnest(range(p, p + {n})) AS place FROM (
                    SELECT id, w, p, count(*) OVER (PARTITION BY id, gram) AS held FROM (
                        SELECT id, w, p, array_to_string(w[p:p + {n - 1}], ' ') AS gram
                        FROM (SELECT id, w, unnest(range(1, len(w) - {n - 2})) AS p FROM words)))
                WHERE held > 1))
        GROUP BY id"""


_SHARES = [n for n, _ in _RULES.coverage]
_GRAMS = ", ".join(f"covered{n} AS ({_covered(n)})" for n in {_RULES.base_window, *_SHARES})
_JOINS = " ".join(f"LEFT JOIN covered{n} USING (id)" for n in {_RULES.base_window, *_SHARES})
_SHARE_COLUMNS = ", ".join(
    f"CASE WHEN word_chars > 0 THEN coalesce(covered{n}.chars, 0) / word_chars ELSE 0 END"
    f"::DOUBLE AS dup_gram{n}_share"
    for n in _SHARES
)
_SHARE_LIMITS = " AND ".join(f"dup_gram{n}_share <= {most}" for n, most in _RULES.coverage)

ORACLE = {
    "op2_minhash": f"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3),
                    lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
        shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b
            ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
        both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        nodes AS (SELECT doc_id AS id FROM documents),
        {_REACH}
        SELECT s.doc_id, len(s.s) AS n_shingles, min(r.other) AS component_id,
               min(r.other) = s.doc_id AS kept
        FROM sets s JOIN reach r ON s.doc_id = r.id GROUP BY s.doc_id, s.s""",
    "op3_embeddings": f"""
        WITH RECURSIVE v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
        links AS (
            SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.vec_id < q.vec_id
            WHERE list_cosine_similarity(p.x, q.x) >= 0.95),
        both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        nodes AS (SELECT vec_id AS id FROM v),
        {_REACH},
        n AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
        SELECT r.id AS vec_id, coalesce(any_value(n.n), 0) AS n_links,
               min(r.other) AS component_id, min(r.other) = r.id AS kept
        FROM reach r LEFT JOIN n ON r.id = n.a GROUP BY r.id""",
    "op6_chat": f"""
        WITH rows AS (
            SELECT conv_id, turn, role, text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
        ), told AS (
            SELECT conv_id, count(*) AS n_turns,
                   sha256(string_agg({_TURN}, '' ORDER BY turn, role, text)) AS turns_sha256,
                   coalesce(string_agg(CASE WHEN role = 'assistant' THEN coalesce(text, '') END, ''
                            ORDER BY turn, role, text), '') AS loss,
                   CAST(sum(4 + {_HEAD} + 2 + {_BODY} + 8) AS BIGINT) AS formatted_chars
            FROM rows GROUP BY conv_id)
        SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars,
               sha256(loss) AS loss_sha256, formatted_chars
        FROM told""",
    "op7_quality": f"""
        WITH texts AS MATERIALIZED (
            SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents),
        words AS MATERIALIZED (
            SELECT id, regexp_extract_all(t, '{_WORD}+') AS w FROM texts),
        lines AS (
            SELECT id, line, row_number() OVER (PARTITION BY id, line ORDER BY place) > 1
                AND regexp_matches(line, '{_WORD}') AS again
            FROM (SELECT id, unnest(l) AS line, unnest(range(len(l))) AS place
                FROM (SELECT id, string_split(t, chr(10)) AS l FROM texts))),
        by_line AS (
            SELECT id, count(*) FILTER (again) AS n_dup_lines,
                coalesce(sum(length(line)) FILTER (again), 0) AS dup_chars, sum(length(line)) AS line_chars
            FROM lines GROUP BY id),
        {_GRAMS},
        measured AS (
            SELECT doc_id, len(w) AS n_words,
                coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, n_dup_lines,
                coalesce(covered{_RULES.base_window}.words, 0) AS n_repeat_words,
                CASE WHEN line_chars > 0 THEN dup_chars / line_chars ELSE 0 END::DOUBLE
                    AS dup_line_share,
                {_SHARE_COLUMNS}
            FROM texts JOIN words USING (id) JOIN by_line USING (id) {_JOINS}),
        judged AS (
            SELECT *, n_words < {_RULES.least_words}
                OR 100 * n_repeat_words > {_RULES.base_percent} * n_words AS base_failed
            FROM measured)
        SELECT *, NOT base_failed AND dup_line_share <= {_RULES.lines} AND {_SHARE_LIMITS} AS kept
        FROM judged""",
    "op9_lines": """
        WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
        lines AS (
            SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS place FROM docs),
        keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
        common AS (
            SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        kept AS (
            SELECT k.*, c.key IS NULL OR k.doc_id = c.keeper AS stays
            FROM keyed k LEFT JOIN common c ON k.key = c.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (stays), ''))
               AS kept_sha256
        FROM kept GROUP BY doc_id""",
    "op11_search": f"""
        WITH held AS (
            SELECT doc_id, row_number() OVER () AS id, {_term_list('text')} AS w FROM documents),
        docs AS (SELECT * FROM held WHERE len(w) > 0),
        total AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS terms FROM docs),
        lengths AS (
            SELECT id, doc_id, 100 - 90 + (90 * len(w) * t.docs) // t.terms AS m
            FROM docs, total t),
        tf AS (SELECT id, w, count(*) AS tf FROM (SELECT id, unnest(w) AS w FROM docs) GROUP BY ALL),
        items AS (SELECT item_id, row_number() OVER () AS item, {_term_list('text')} AS w FROM benchmark),
        wanted AS (SELECT DISTINCT item, unnest(w) AS w FROM items),
        weights AS (
            SELECT w, floor(1000 * ln((2 * t.docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
            FROM tf, total t GROUP BY w, t.docs),
        scores AS (
            SELECT q.item, l.id, l.doc_id,
                sum(g.weight * ((1000000000 * f.tf) // (1000 * f.tf + 8 * l.m)))::BIGINT AS score
            FROM wanted q JOIN tf f ON q.w = f.w JOIN weights g ON g.w = f.w
            JOIN lengths l ON l.id = f.id GROUP BY ALL),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY item
                ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scores WHERE score > 0)
        SELECT i.item_id, rank::INTEGER AS rank, doc_id, score
        FROM ranked r JOIN items i ON i.item = r.item WHERE rank <= 10""",
    "op12_merkle": f"""
        WITH RECURSIVE fields AS (
            SELECT row_number() OVER () AS id, doc_id, lang,
                {_FIELDS} AS head, text,
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
                doc_id IS NOT NULL AND {_CRC} % 3 = 0 AS tampered
            FROM documents),
        leaves AS (
            SELECT id, doc_id, lang, sha256(head || {_field('text')}) AS leaf,
                CASE WHEN tampered THEN sha256(head || {_field('low')}) END AS changed
            FROM fields),
        placed AS (
            SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree,
                row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
                count(*) OVER (PARTITION BY lang) AS n
            FROM leaves),
        nodes AS (
            SELECT tree, 0 AS level, place, n, leaf AS h FROM placed
            UNION ALL
            SELECT tree, any_value(level) + 1, place // 8, (any_value(n) + 7) // 8,
                sha256(string_agg(h, '' ORDER BY place))
            FROM nodes WHERE n > 1 GROUP BY tree, place // 8),
        tops AS (
            SELECT 0 AS level, tree - 1 AS place, count(*) OVER () AS n, h FROM nodes WHERE n = 1
            UNION ALL
            SELECT any_value(level) + 1, place // 8, (any_value(n) + 7) // 8,
                sha256(string_agg(h, '' ORDER BY place))
            FROM tops WHERE n > 1 GROUP BY place // 8),
        marked AS (
            SELECT tree, level, place, n, h FROM nodes WHERE n > 1
            UNION ALL SELECT 0, level, place, n, h FROM tops WHERE n > 1),
        heights AS (SELECT tree, max(level) AS top FROM nodes GROUP BY tree),
        steps AS (
            SELECT p.id, m.level AS step, m.place < p.place // pow(8, m.level)::BIGINT AS before,
                m.place, m.h
            FROM placed p JOIN marked m ON m.tree = p.tree
                AND m.place // 8 = p.place // pow(8, m.level + 1)::BIGINT
                AND m.place <> p.place // pow(8, m.level)::BIGINT
            UNION ALL
            SELECT p.id, t.top + m.level, m.place < (p.tree - 1) // pow(8, m.level)::BIGINT,
                m.place, m.h
            FROM placed p JOIN heights t ON t.tree = p.tree JOIN marked m ON m.tree = 0
                AND m.place // 8 = (p.tree - 1) // pow(8, m.level + 1)::BIGINT
                AND m.place <> (p.tree - 1) // pow(8, m.level)::BIGINT),
        proofs AS (
            SELECT id, sha256(string_agg(h, '' ORDER BY step, place)) AS proof
            FROM steps GROUP BY id),
        sides AS (
            SELECT id, step,
                coalesce(string_agg(h, '' ORDER BY place) FILTER (before), '') AS l,
                coalesce(string_agg(h, '' ORDER BY place) FILTER (NOT before), '') AS r
            FROM steps GROUP BY id, step),
        whole AS (SELECT h AS root FROM tops WHERE n = 1),
        heads AS (SELECT tree, h AS subroot FROM nodes WHERE n = 1),
        lengths AS (
            SELECT p.id, t.top + (SELECT max(level) FROM tops) AS steps
            FROM placed p JOIN heights t ON t.tree = p.tree),
        folded AS (
            SELECT id, 0 AS step, coalesce(changed, leaf) AS h FROM placed
            UNION ALL
            SELECT f.id, f.step + 1,
                sha256(coalesce(s.l, '') || f.h || coalesce(s.r, ''))
            FROM folded f JOIN lengths n ON n.id = f.id AND f.step < n.steps
                LEFT JOIN sides s ON s.id = f.id AND s.step = f.step)
        SELECT p.doc_id, p.leaf, h.subroot, w.root,
            coalesce(o.proof, sha256('')) AS proof_sha256, f.h AS folded_root,
            f.h = w.root AS verified
        FROM placed p JOIN heads h ON h.tree = p.tree CROSS JOIN whole w
            JOIN lengths n ON n.id = p.id JOIN folded f ON f.id = p.id AND f.step = n.steps
            LEFT JOIN proofs o ON o.id = p.id""",
    "op13_secrets": f"""
        WITH texts AS MATERIALIZED (
            SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents),
        parts AS MATERIALIZED ({_ALL_PARTS}),
        gaps AS MATERIALIZED ({_GAPS}),
        standing AS MATERIALIZED (
            SELECT * FROM parts p WHERE k < {_N_BASE} OR NOT EXISTS (
                SELECT 1 FROM parts q
                WHERE q.id = p.id AND q.k < p.k AND q.s < p.e AND q.e > p.s)),
        scopes AS (
            SELECT p.*,
                greatest(s - {secrets.REACH}, (SELECT coalesce(max(g.e), 0) FROM gaps g
                    WHERE g.id = p.id AND g.e <= p.s)) AS low,
                least(e + {secrets.REACH}, (SELECT coalesce(min(g.s), 1000000000) FROM gaps g
                    WHERE g.id = p.id AND g.s >= p.e)) AS high
            FROM standing p),
        met AS (
            SELECT c.id, c.k, c.s, c.e, c.role, list_distinct(list(o.role)) AS roles
            FROM scopes c LEFT JOIN standing o
                ON o.id = c.id AND o.role <> c.role AND o.s < c.high AND o.e > c.low
            GROUP BY ALL),
        told AS (
            SELECT id, k, s, {_NAMES}[k + 1] || ':' || s || ':' || e AS span FROM met
            WHERE k < {_N_BASE} OR CASE role
                WHEN 'secret' THEN list_contains(roles, 'identifier')
                WHEN 'identifier' THEN list_contains(roles, 'secret')
                ELSE list_contains(roles, 'identifier') AND list_contains(roles, 'secret') END)
        SELECT any_value(x.doc_id) AS doc_id, count(*) FILTER (k = 0) AS n_assign,
            count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
            sha256(coalesce(string_agg(span, ',' ORDER BY s, k) FILTER (k < {_N_BASE}), ''))
                AS base_sha256,
            coalesce(string_agg(span, ',' ORDER BY s, k), '') AS spans
        FROM texts x LEFT JOIN told y ON x.id = y.id GROUP BY x.id""",
}
