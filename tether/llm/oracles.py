"""SQL that computes the results of those operators that SQL can express, by plain definitions: all windows, all pairs, all lines."""

from __future__ import annotations

import string

from tether.llm import divergence, embedding_dedup, line_dedup, quality_rules

WORD = r"[^\x20\x09-\x0D]+"
GRAMS = (quality_rules.BASE, *quality_rules.GRAM_PERCENT)


def _grams(n: int) -> str:
    """Words of each text that stand in an n-gram found twice or more, and their characters."""
    return f"""g{n} AS (
        SELECT doc_id, count(*) AS n_words, sum(chars) AS chars FROM (
            SELECT doc_id, i, chars, max(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS inside
            FROM word LEFT JOIN (
                SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) > 1 AS again FROM (
                    SELECT doc_id, unnest(range(1, len(l) - {n} + 2)) AS i,
                           unnest(list_transform(range(1, len(l) - {n} + 2), lambda i: array_to_string(l[i:i + {n} - 1], ' '))) AS gram
                    FROM words WHERE len(l) >= {n})) USING (doc_id, i))
        WHERE inside GROUP BY doc_id)"""


def _quality_rules() -> str:
    limits = " AND ".join(
        [f"100 * dup_line_chars <= {quality_rules.LINE_PERCENT} * word_chars"]
        + [f"100 * dup_chars_{n} <= {p} * word_chars" for n, p in quality_rules.GRAM_PERCENT.items()]
    )
    joins = " ".join(f"LEFT JOIN g{n} USING (doc_id)" for n in GRAMS)
    covered = ", ".join(f"CAST(coalesce(g{n}.chars, 0) AS BIGINT) AS dup_chars_{n}" for n in quality_rules.GRAM_PERCENT)
    return rf"""
WITH words AS MATERIALIZED (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS l FROM documents),
word AS MATERIALIZED (SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(list_transform(l, lambda w: length(w))) AS chars FROM words),
line AS (
    SELECT doc_id, count(*) AS n, sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) AS chars FROM (
        SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS turn FROM (
            SELECT doc_id, unnest(s) AS line, unnest(range(len(s))) AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents))
        WHERE regexp_matches(line, '{WORD}'))
    WHERE turn > 1 GROUP BY doc_id),
{", ".join(map(_grams, GRAMS))},
counts AS (
    SELECT doc_id, len(l) AS n_words, CAST(coalesce(list_sum(list_transform(l, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
        len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS n_symbols, coalesce(line.n, 0) AS n_dup_lines,
        coalesce(g{quality_rules.BASE}.n_words, 0) AS n_repeat_words, CAST(coalesce(line.chars, 0) AS BIGINT) AS dup_line_chars, {covered}
    FROM words LEFT JOIN line USING (doc_id) {joins})
SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.REPEAT_PERCENT} * n_words AS base_failed,
    NOT (n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.REPEAT_PERCENT} * n_words) AND {limits} AS kept
FROM counts
"""


BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
WARC = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS h, min(page_id) OVER (PARTITION BY body) AS first FROM p),
b AS (SELECT *, array_to_string(list_transform(string_split(h, ''), lambda c: lpad(bin(strpos('0123456789abcdef', c) - 1), 4, '0')), '') AS bits FROM d)
SELECT page_id, payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('{BASE32}',
        1 + CAST(list_sum(list_transform(range(5), lambda k: CAST(substr(bits, 1 + 5 * i + k, 1) AS INTEGER) * (16 >> k))) AS INTEGER), 1)), '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""

LINE_EDITS = f"greatest({line_dedup.EDITS}, least({line_dedup.MOST_EDITS}, least(a.n, b.n) // {line_dedup.SHARE}))"
# Every line with why it goes, if it does. SQL's edit distance counts bytes, so each letter beyond ASCII, of which the tables have fewer than
# 30, becomes a control character of its own before lines are compared.
LINE_REASONS = f"""
WITH l AS (
    SELECT doc_id, unnest(s) AS line, unnest(range(len(s))) AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)
), letters AS MATERIALIZED (
    SELECT coalesce(string_agg(c, '' ORDER BY c), '') AS f, coalesce(string_agg(chr(CAST(CASE WHEN k < 9 THEN k ELSE k + 2 END AS INTEGER)), '' ORDER BY c), '') AS g
    FROM (SELECT c, row_number() OVER (ORDER BY c) AS k FROM (SELECT DISTINCT unnest(regexp_extract_all(text, '[^\\x00-\\x7F]')) AS c FROM documents))
), d AS MATERIALIZED (
    SELECT line, translate(line, (SELECT f FROM letters), (SELECT g FROM letters)) AS flat, min(ROW(doc_id, pos)) AS first, length(line) AS n FROM l WHERE length(line) >= {line_dedup.MIN_CHARS} GROUP BY line
), near AS (
    SELECT a.line, min(b.first) AS first FROM d a JOIN d b ON b.first < a.first AND b.n BETWEEN a.n - {line_dedup.MOST_EDITS} AND a.n + {line_dedup.MOST_EDITS}
    WHERE abs(a.n - b.n) <= {LINE_EDITS} AND levenshtein(a.flat, b.flat) <= {LINE_EDITS} GROUP BY a.line
), judged AS (
    SELECT l.doc_id, l.pos, CASE WHEN ROW(l.doc_id, l.pos) > d.first THEN 'exact' WHEN near.first IS NOT NULL THEN 'near' END AS reason
    FROM l LEFT JOIN d USING (line) LEFT JOIN near USING (line)
)
"""
LINES = f"""{LINE_REASONS}
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (reason = 'exact') AS n_exact, count(*) FILTER (reason = 'near') AS n_near
FROM judged GROUP BY doc_id
"""

VECTORS = f"""
WITH RECURSIVE v AS MATERIALIZED (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_max(list_transform(embedding, lambda x: abs(x))) > 0
), link AS MATERIALIZED (
    SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= {embedding_dedup.THRESHOLD}
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT a, y FROM reach JOIN link ON x = b
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN (SELECT x AS vec_id, count(*) AS n FROM link GROUP BY x) USING (vec_id)
JOIN (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a) USING (vec_id)
"""

LETTERS = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"
EXACT = f"""
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM (
    SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size
    FROM (SELECT doc_id, translate(coalesce(text, ''), {LETTERS}) AS t FROM documents))
"""

# Every term of every source, used there or not, and every pair of sources for each.
DIVERGENCE = rf"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), {LETTERS}) AS t FROM documents
), w AS MATERIALIZED (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= {divergence.MIN_DOCS}),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
used AS (SELECT lang, source, term, count(*) AS c FROM w GROUP BY lang, source, term),
e AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c, k.total FROM g JOIN kept k USING (lang) LEFT JOIN used USING (lang, source, term)),
p AS MATERIALIZED (
    SELECT lang, source, term, c, 1 + {divergence.UNIT}::HUGEINT * (c + 1) // (sum(c) OVER (PARTITION BY lang, source) + v) AS p,
        1 + {divergence.UNIT}::HUGEINT * (total + 1) // (n + v) AS q FROM e JOIN v USING (lang)),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
term AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE c > 0 AND p > q),
ranked AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
    UNION ALL SELECT lang, source, 'term', item, value FROM term)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= {divergence.TOP}
"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode(CAST({value} AS VARCHAR))) || ':' || {value} END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


# CRC-32 of the decimal key: each digit goes in, then eight steps of one bit.
CRC32 = """xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
    lambda c, k: list_reduce([xor(c, k), 0, 0, 0, 0, 0, 0, 0, 0], lambda b, i: xor(b >> 1, (b & 1) * 3988292384))), 4294967295)"""

# Level by level: a node is its two children, or one. A leaf's steps are the other child at each level of its group and then of the subroots.
MERKLE = f"""
WITH RECURSIVE leaf AS MATERIALIZED (
    SELECT row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, * FROM (
        SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf("n_chars")} AS leaf, CASE WHEN {CRC32} % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS tampered
        FROM documents)
), low AS (
    SELECT g, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM leaf
    UNION ALL
    SELECT g, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM low WHERE n > 1 GROUP BY g, level, pos // 2
), place AS MATERIALIZED (SELECT g, row_number() OVER (ORDER BY g) - 1 AS pos, h AS subroot, count(*) OVER () AS n FROM low WHERE n = 1),
top AS (
    SELECT 0 AS level, pos, subroot AS h, n FROM place
    UNION ALL
    SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM top WHERE n > 1 GROUP BY level, pos // 2
), step AS MATERIALIZED (
    SELECT l.g, l.pos, list({{'x': coalesce(x, ''), 'right': digit = 0}} ORDER BY level) FILTER (level IS NOT NULL) AS path, sha256(coalesce(string_agg(x, '' ORDER BY level), '')) AS proof_sha256 FROM leaf l LEFT JOIN (
        SELECT l.g, l.pos, r.level, (l.pos >> r.level) % 2 AS digit, low.h AS x
        FROM leaf l JOIN (SELECT DISTINCT g, level FROM low WHERE n > 1) r USING (g) LEFT JOIN low ON low.g = l.g AND low.level = r.level AND low.pos = xor(l.pos >> r.level, 1)
        UNION ALL
        SELECT l.g, l.pos, 100 + r.level, (p.pos >> r.level) % 2, top.h
        FROM leaf l JOIN place p USING (g) JOIN (SELECT DISTINCT level FROM top WHERE n > 1) r ON true LEFT JOIN top ON top.level = r.level AND top.pos = xor(p.pos >> r.level, 1)
    ) s ON s.g = l.g AND s.pos = l.pos GROUP BY l.g, l.pos
), done AS (
    SELECT doc_id, leaf, subroot, (SELECT h FROM top WHERE n = 1) AS root, proof_sha256,
        list_reduce([{{'x': tampered, 'right': true}}] || coalesce(path, []),
            lambda a, s: {{'x': CASE WHEN s.right THEN sha256(a.x || s.x) ELSE sha256(s.x || a.x) END, 'right': true}}).x AS folded_root
    FROM leaf JOIN place USING (g) JOIN step ON step.g = leaf.g AND step.pos = leaf.pos
)
SELECT *, folded_root = root AS verified FROM done
"""

ORACLES = {
    "op1_quality_rules": _quality_rules(),
    "op4_warc": WARC,
    "op6_line_dedup": LINES,
    "op8_embedding_dedup": VECTORS,
    "op11_exact_dedup": EXACT,
    "op12_source_divergence": DIVERGENCE,
    "op13_merkle_manifest": MERKLE,
}
