"""SQL that computes each query's result another way: per token instead of per text, all pairs instead of keys, plain inverted index."""

from __future__ import annotations

import re

from tether.functions import words as fw
from tether.functions.keys import ABSTRACT, KB_NAMESPACE, SAME_AS
from tether.functions.markup import CONTENT_TYPE, RECORD_KEY
from tether.operators.lemmas import NOUN_ENDINGS
from workload.tables import LABEL, LANGUAGE_LETTERS, PAGE, THING, WIKI


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


# name -> (names it reads, SELECT)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, sql: str, *reads: str) -> None:
    CTES[name] = (reads, sql)


def build(final: str, *reads: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for dep in CTES[name][0]:
                visit(dep)
            ordered.append(name)

    for name in reads:
        visit(name)
    head = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name][1]})" for name in ordered)
    return (f"WITH RECURSIVE {head}\n" if head else "") + final


# Text to mentions, for any source of (warc_id, body) -----------------------------------------------------------------------------

STOP_LIST = ", ".join(q(w) for w in fw.STOP_WORDS)


def lemma_ctes(p: str) -> None:
    """Lemma of each distinct word of a source: every form the rules lead to, of which the nearest known one is taken."""
    cte(f"{p}_lemma_words", f"SELECT DISTINCT regexp_replace(token, '[0-9][A-F]', '', 'g') AS word FROM {p}_tokens", f"{p}_tokens")
    cte(
        f"{p}_lemma_forms",
        f"""SELECT word, word AS form, 0 AS depth, '' AS path FROM {p}_lemma_words WHERE word NOT IN (SELECT word FROM irregular)
           UNION ALL
           SELECT word, left(form, length(form) - length(old)) || new, depth + 1, path || place
           FROM {p}_lemma_forms, endings WHERE form LIKE '%' || old AND length(form) - length(old) + length(new) > 0""",
        f"{p}_lemma_words",
        "irregular",
        "endings",
    )
    cte(
        f"{p}_lemma_table",
        f"""SELECT word, coalesce(lemma, word) AS lemma FROM {p}_lemma_words LEFT JOIN (
               SELECT word, first(form ORDER BY greatest(depth, 1), length(form), depth, path) AS lemma FROM (
                   SELECT word, form, depth, path FROM {p}_lemma_forms
                   UNION ALL SELECT word, word, 0, '' FROM irregular UNION ALL SELECT word, form, 1, '' FROM irregular)
               WHERE form IN (SELECT word FROM known) GROUP BY word) USING (word)""",
        f"{p}_lemma_words",
        f"{p}_lemma_forms",
        "irregular",
        "known",
    )


def text_ctes(p: str, source: str, lemmas: bool = True, other: str = r"[\W_]+", capital: str = "[A-Z]") -> None:
    breaks = "|".join(re.escape(mark) for mark in fw.BREAKS)
    spaced = rf"regexp_replace(regexp_replace(body, {q(breaks)}, ' ', 'g'), {q(fw.CLITICS)}, ' \1', 'g')"
    cte(
        f"{p}_tokens",
        f"""SELECT warc_id, unnest(l) AS token, unnest(range(len(l))) AS pos
            FROM (SELECT warc_id, regexp_extract_all({spaced}, {q(f"[^{fw.SEPARATORS}]+")}) AS l FROM {source})""",
        source,
    )
    word = "regexp_replace(token, '[0-9][A-F]', '', 'g')"
    rows = f"SELECT warc_id, pos, {word} AS raw FROM {p}_tokens"
    if lemmas:
        lemma_ctes(p)
        rows = f"SELECT warc_id, pos, lemma AS raw FROM ({rows}) JOIN {p}_lemma_table t ON t.word = raw"
    cte(
        f"{p}_words",
        rf"""SELECT warc_id, word, row_number() OVER (PARTITION BY warc_id ORDER BY pos) - 1 AS pos FROM (
            SELECT warc_id, pos, regexp_replace(regexp_replace(raw, '{other}', '', 'g'), '[0-9]', '', 'g') AS word FROM ({rows}))
            WHERE word <> ''""",
        f"{p}_tokens",
        *([f"{p}_lemma_table"] if lemmas else []),
    )
    mention_ctes(p, f"(SELECT *, CASE WHEN regexp_matches(word, '^{capital}') THEN 'NNP' ELSE 'NN' END AS tag FROM {p}_words)", f"{p}_words")


def mention_ctes(p: str, tagged: str, *reads: str) -> None:
    cte(f"{p}_tagged", f"SELECT * FROM {tagged}", *reads)
    cte(
        f"{p}_chunks",
        f"""SELECT warc_id, min(pos) AS start, count(*) AS size, string_agg(word, ' ' ORDER BY pos) AS chunk
            FROM (SELECT *, pos - row_number() OVER (PARTITION BY warc_id ORDER BY pos) AS island FROM {p}_tagged WHERE tag = 'NNP')
            GROUP BY warc_id, island""",
        f"{p}_tagged",
    )
    cte(
        f"{p}_mentions",
        f"""SELECT warc_id, kind, mention, row_number() OVER (PARTITION BY warc_id ORDER BY kind DESC, pos) - 1 AS ord FROM (
            SELECT warc_id, 'word' AS kind, word AS mention, pos FROM {p}_tagged
            WHERE tag = 'NNP' AND word NOT IN ({STOP_LIST}) AND (length(word) > 2 OR regexp_matches(word, '^[A-Z]+$'))
            UNION ALL SELECT warc_id, 'run', chunk, start FROM {p}_chunks WHERE size >= 2)""",
        f"{p}_tagged",
        f"{p}_chunks",
    )
    cte(
        f"{p}_counts",
        f"""SELECT warc_id, mention, count(*) AS n, sum(count(*)) OVER (PARTITION BY warc_id) AS n_mentions
            FROM {p}_mentions GROUP BY warc_id, mention""",
        f"{p}_mentions",
    )


cte("docs", "SELECT CAST(doc_id AS VARCHAR) AS warc_id, text AS body FROM documents")
text_ctes("doc", "docs")
text_ctes("uni", "docs", lemmas=False, other=r"[^\p{L}\p{N}]+", capital=r"\p{Lu}")

# Knowledge base ------------------------------------------------------------------------------------------------------------------

LANG = " ".join(f"WHEN regexp_matches(text, {q(letters)}) THEN {q(name)}" for name, letters in LANGUAGE_LETTERS)
cte("items", f"SELECT item_id, '/m/0' || item_id AS kb_id, CASE {LANG} ELSE 'en' END AS lang, text FROM benchmark")
cte("item_docs", "SELECT kb_id AS warc_id, text AS body FROM items", "items")
text_ctes("item", "item_docs", lemmas=False)
cte(
    "labels_kb",
    """SELECT DISTINCT warc_id AS kb_id, mention AS label FROM item_mentions
       UNION SELECT warc_id, string_agg(word, ' ' ORDER BY pos) FILTER (pos < 3) FROM item_words GROUP BY warc_id HAVING count(*) >= 3""",
    "item_mentions",
    "item_words",
)
IRI = f"{q(KB_NAMESPACE)} || 'm.' || substr(kb_id, 4)"
cte(
    "triples",
    f"""SELECT {q(THING)} || item_id AS s, {q(SAME_AS)} AS p, {IRI} AS o FROM items
        UNION ALL SELECT {q(THING)} || item_id, {q(SAME_AS)}, {q(PAGE)} || item_id FROM items
        UNION ALL SELECT {q(WIKI)} || item_id, {q(SAME_AS)}, {IRI} FROM items WHERE contains(text, chr(10))
        UNION ALL SELECT {q(WIKI)} || item_id, {q(SAME_AS)}, {q(PAGE)} || item_id FROM items WHERE contains(text, chr(10))
        UNION ALL SELECT {q(PAGE)} || item_id, {q(ABSTRACT)}, '"' || line || '"@' || lang
            FROM (SELECT item_id, lang, unnest(string_split(text, chr(10))) AS line FROM items) WHERE line <> ''
        UNION ALL SELECT {IRI}, {q(LABEL)}, '"' || label || '"@' || lang FROM labels_kb JOIN items USING (kb_id)""",
    "items",
    "labels_kb",
)
cte(
    "abstracts",
    f"""SELECT DISTINCT kb_id, c.o AS abstract FROM items
        JOIN triples a ON a.p = {q(SAME_AS)} AND a.o = {IRI}
        JOIN triples b ON b.p = {q(SAME_AS)} AND b.s = a.s
        JOIN triples c ON c.p = {q(ABSTRACT)} AND c.s = b.o""",
    "items",
    "triples",
)
cte("english", "SELECT * FROM abstracts WHERE abstract LIKE '%\"@en'", "abstracts")
cte("described", "SELECT kb_id AS warc_id, string_agg(abstract, ' ' ORDER BY abstract) AS body FROM english GROUP BY kb_id", "english")
text_ctes("kb", "described")
cte(
    "gazetteer",
    """SELECT DISTINCT label AS name, CASE lang WHEN 'en' THEN 'PERSON' WHEN 'es' THEN 'GPE' ELSE 'ORGANIZATION' END AS type
       FROM labels_kb JOIN items USING (kb_id)""",
    "labels_kb",
    "items",
)

# Records -------------------------------------------------------------------------------------------------------------------------

CRLF = "chr(13) || chr(10)"
cte(
    "records",
    f"""SELECT page_id, 'WARC-Type: response' || {CRLF} ||
        CASE WHEN url LIKE 'http:%' AND contains(url, '?') THEN '' ELSE {q(RECORD_KEY)} || ': page-' || page_id || {CRLF} END ||
        {CRLF} || 'HTTP/1.1 200 OK' || {CRLF} ||
        CASE WHEN contains(html, '<html lang="de">') THEN replace({q(CONTENT_TYPE)}, 'UTF-8', 'utf-8') || {CRLF}
             WHEN contains(html, '<html lang="es">') AND url LIKE 'http:%' THEN repeat({q(CONTENT_TYPE)} || {CRLF}, 2)
             ELSE {q(CONTENT_TYPE)} || {CRLF} END || {CRLF} || html AS record FROM pages""",
)


def markup_text(column: str) -> str:
    attributes = """(?:[^>"'=]|=\\s*(?:"[^"]*"|'[^']*')|["'=])*"""
    raw = [rf"(?i:<{name}(?:[\s/]{attributes})?>.*?(?:</{name}(?:[\s/][^>]*)?>|\z))" for name in ("script", "style")]
    parts = [r"<!--(?:-?>|.*?(?:--!?>|\z))", *raw, rf"</?[a-zA-Z]{attributes}(?:>|\z)", r"<[!?/][^>]*(?:>|\z)"]
    text = f"regexp_replace({column}, {q('(?s)' + '|'.join(parts))}, ' ', 'g')"
    for name, char in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("amp", "&")):
        text = f"replace({text}, '&{name};', {q(char)})"
    return text


cte("texts", f"SELECT page_id, record, {markup_text('record')} AS text FROM records", "records")
cte(
    "parsed",
    rf"""SELECT page_id, record, text, len(string_split(text, {q(CONTENT_TYPE)})) AS n_parts,
        nullif(regexp_extract(split_part(text, {q(CONTENT_TYPE)}, 1), '{RECORD_KEY}: ([^\r\n]*)', 1), '') AS warc_id,
        split_part(text, {q(CONTENT_TYPE)}, 2) AS body FROM texts""",
    "texts",
)
# Text lines of a record hold no code block once comments are gone, so lines only need joining.
cte(
    "page_docs",
    r"""SELECT warc_id, regexp_replace(body, '\r\n|[\r\n]', ' ', 'g') AS body FROM parsed WHERE n_parts = 2 AND warc_id IS NOT NULL""",
    "parsed",
)
text_ctes("page", "page_docs")

# Candidates ----------------------------------------------------------------------------------------------------------------------

cte("label_words", r"SELECT kb_id, label, unnest(regexp_extract_all(lower(label), '[\p{L}\p{N}]+')) AS w FROM labels_kb", "labels_kb")
cte("label_sizes", "SELECT kb_id, label, count(*) AS n_words FROM label_words GROUP BY kb_id, label", "label_words")
cte("label_vocab", "SELECT w, count(*) AS df FROM (SELECT DISTINCT * FROM label_words) GROUP BY w", "label_words")
cte("distinct_mentions", "SELECT DISTINCT mention FROM doc_mentions", "doc_mentions")


def hit_ctes(p: str, mentions: str) -> None:
    cte(
        f"{p}hits_all",
        rf"""SELECT mention, kb_id, label, n_words,
            round(sum(1 + ln((SELECT count(*) FROM labels_kb) / (df + 1))) / sqrt(n_words), 6) AS search_score
            FROM (SELECT DISTINCT mention, w
                  FROM (SELECT mention, unnest(regexp_extract_all(lower(mention), '[\p{{L}}\p{{N}}]+')) AS w FROM {mentions}))
            JOIN (SELECT DISTINCT * FROM label_words) USING (w) JOIN label_vocab USING (w) JOIN label_sizes USING (kb_id, label)
            GROUP BY mention, kb_id, label, n_words""",
        mentions,
        "labels_kb",
        "label_words",
        "label_vocab",
        "label_sizes",
    )
    cte(
        f"{p}hits",
        f"""SELECT *, row_number() OVER (PARTITION BY mention ORDER BY search_score DESC, n_words, kb_id, label) AS rank
            FROM {p}hits_all""",
        f"{p}hits_all",
    )
    cte(
        f"{p}candidates",
        f"""SELECT mention, kb_id, string_agg(DISTINCT label, '|' ORDER BY label) AS labels, max(search_score) AS search_score
            FROM {p}hits WHERE rank <= 10 GROUP BY mention, kb_id""",
        f"{p}hits",
    )


hit_ctes("", "distinct_mentions")

# Scores and links ----------------------------------------------------------------------------------------------------------------


def similarity(a: str, b: str) -> str:
    longer = f"greatest(length({a}), length({b}))"
    same = f"list_sum(list_transform(range(1, {longer} + 1), lambda i: CAST({a}[i] = {b}[i] AS INTEGER)))"
    return f"CASE WHEN {longer} = 0 THEN 1.0 ELSE 1.0 - CAST({longer} - {same} AS DOUBLE) / {longer} END"


def link_ctes(p: str, doc_counts: str, kb_counts: str, candidates: str) -> None:
    # Only words of near lengths are compared: the longer one's tail counts as different.
    cte(
        f"{p}alike",
        f"""SELECT word_a, word_b FROM (SELECT DISTINCT mention AS word_a FROM {doc_counts}), (SELECT DISTINCT mention AS word_b FROM {kb_counts})
            WHERE CASE WHEN least(length(word_a), length(word_b)) > 0.79 * greatest(length(word_a), length(word_b))
                  THEN {similarity("word_a", "word_b")} > 0.8 ELSE false END""",
        doc_counts,
        kb_counts,
    )
    cte(
        f"{p}proposed",
        f"SELECT * FROM {doc_counts} JOIN {candidates} USING (mention) WHERE kb_id IN (SELECT kb_id FROM english)",
        doc_counts,
        candidates,
        "english",
    )
    cte(
        f"{p}matches",
        f"""SELECT d.warc_id, x.kb_id, sum(d.n * k.n) AS matches
            FROM (SELECT DISTINCT warc_id, kb_id FROM {p}proposed) x JOIN {kb_counts} k ON k.warc_id = x.kb_id
            JOIN {p}alike s ON s.word_b = k.mention JOIN {doc_counts} d ON d.warc_id = x.warc_id AND d.mention = s.word_a
            GROUP BY d.warc_id, x.kb_id""",
        f"{p}proposed",
        f"{p}alike",
        doc_counts,
        kb_counts,
    )
    cte(
        f"{p}scored",
        f"""SELECT p.*, coalesce(CAST(matches AS DOUBLE) / n_mentions, 0.0) AS score
            FROM {p}proposed p LEFT JOIN {p}matches m ON m.warc_id = p.warc_id AND m.kb_id = p.kb_id""",
        f"{p}proposed",
        f"{p}matches",
    )
    cte(
        f"{p}best",
        f"""SELECT * FROM {p}scored
            QUALIFY row_number() OVER (PARTITION BY warc_id, mention ORDER BY score DESC, search_score DESC, kb_id) = 1""",
        f"{p}scored",
    )
    cte(
        f"{p}links",
        f"SELECT warc_id, mention, kb_id FROM (SELECT *, unnest(range(CAST(n AS BIGINT))) FROM {p}best WHERE score >= 0.2)",
        f"{p}best",
    )


link_ctes("", "doc_counts", "kb_counts", "candidates")
cte("gold", "SELECT DISTINCT warc_id, kb_id FROM docs JOIN items ON contains(body, text)", "docs", "items")

# With the corpus tag lexicon
cte(
    "lexicon",
    """SELECT word, n, n_capital, CASE WHEN n_capital >= 0.5 * n THEN 'NNP' ELSE 'NN' END AS tag FROM (
       SELECT lower(word) AS word, count(*) AS n, count(*) FILTER (regexp_matches(doc_words.word, '^[A-Z]')) AS n_capital
       FROM doc_words GROUP BY lower(doc_words.word))""",
    "doc_words",
)
RULE = "CASE WHEN regexp_matches(w.word, '^[A-Z]') THEN 'NNP' ELSE 'NN' END"
for side in ("doc", "kb"):
    mention_ctes(
        f"lex_{side}",
        f"""(SELECT w.warc_id, w.word, w.pos, coalesce(l.tag, {RULE}) AS tag
            FROM {side}_words w LEFT JOIN lexicon l ON l.word = lower(w.word))""",
        f"{side}_words",
        "lexicon",
    )
cte("lex_distinct", "SELECT DISTINCT mention FROM lex_doc_mentions", "lex_doc_mentions")
hit_ctes("lex_", "lex_distinct")
link_ctes("lex_", "lex_doc_counts", "lex_kb_counts", "lex_candidates")

# With typed entities as mentions: each distinct entity of a text is one mention
cte("names", "SELECT name, len(string_split(name, ' ')) AS n FROM (SELECT DISTINCT name FROM gazetteer)", "gazetteer")
for side in ("doc", "kb"):
    # All stretches of all chunks up to the longest name; then from each taken name to the first one that begins at its end or later.
    cte(
        f"{side}_spans",
        f"""SELECT chunk, off, max(w.n) AS n FROM (
                SELECT chunk, off, unnest(range(1, least(size - off, (SELECT max(n) FROM names)) + 1)) AS n, l FROM (
                    SELECT chunk, len(l) AS size, unnest(range(len(l))) AS off, l FROM (
                        SELECT DISTINCT chunk, string_split(chunk, ' ') AS l FROM {side}_chunks))) w
            JOIN names ON name = array_to_string(l[off + 1:off + w.n], ' ') GROUP BY chunk, off""",
        f"{side}_chunks",
        "names",
    )
    cte(
        f"{side}_taken",
        f"""SELECT chunk, min(off) AS off FROM {side}_spans GROUP BY chunk
            UNION ALL
            SELECT t.chunk, (SELECT min(x.off) FROM {side}_spans x WHERE x.chunk = t.chunk AND x.off >= s.off + s.n)
            FROM {side}_taken t JOIN {side}_spans s ON s.chunk = t.chunk AND s.off = t.off""",
        f"{side}_spans",
    )
    cte(
        f"{side}_entities",
        f"""SELECT warc_id, pos, s.off, array_to_string((string_split(c.chunk, ' '))[s.off + 1:s.off + s.n], ' ') AS entity
            FROM (SELECT *, row_number() OVER (PARTITION BY warc_id ORDER BY start) - 1 AS pos FROM {side}_chunks) c
            JOIN {side}_taken t ON t.chunk = c.chunk JOIN {side}_spans s ON s.chunk = t.chunk AND s.off = t.off""",
        f"{side}_chunks",
        f"{side}_taken",
        f"{side}_spans",
    )
    cte(
        f"typed_{side}_counts",
        f"""SELECT warc_id, mention, 1 AS n, count(*) OVER (PARTITION BY warc_id) AS n_mentions
            FROM (SELECT DISTINCT warc_id, entity AS mention FROM {side}_entities)""",
        f"{side}_entities",
    )
cte("typed_distinct", "SELECT DISTINCT mention FROM typed_doc_counts", "typed_doc_counts")
hit_ctes("typed_", "typed_distinct")
link_ctes("typed_", "typed_doc_counts", "typed_kb_counts", "typed_candidates")

# Page records
cte("page_distinct", "SELECT DISTINCT mention FROM page_mentions", "page_mentions")
hit_ctes("page_", "page_distinct")
link_ctes("page_", "page_counts", "kb_counts", "page_candidates")

# Lemmas --------------------------------------------------------------------------------------------------------------------------

cte("raw_tokens", "SELECT token, count(*) AS n FROM doc_tokens GROUP BY token", "doc_tokens")
cte("known", "SELECT DISTINCT unnest(regexp_extract_all(html, '[A-Za-z]+')) AS word FROM pages")
cte("irregular", "SELECT word, left(word, length(word) - 1) AS form FROM known WHERE word LIKE '%ae'", "known")
ENDINGS = ", ".join(f"({i}, {q(old)}, {q(new)})" for i, (old, new) in enumerate(NOUN_ENDINGS))
cte("endings", f"SELECT * FROM (VALUES {ENDINGS}) e(place, old, new)")

# Tags in context: best cost up to each word for each tag, word by word through whole documents, then back from the last word.
cte("uses", "SELECT lower(word) AS word, tag, count(*) AS n FROM doc_tagged GROUP BY lower(word), tag", "doc_tagged")
cte(
    "moves",
    """SELECT before, tag, count(*) AS n FROM (
           SELECT coalesce(lag(tag) OVER w, '') AS before, tag FROM doc_tagged WINDOW w AS (PARTITION BY warc_id ORDER BY pos)
           UNION ALL SELECT last(tag ORDER BY pos), '' FROM doc_tagged GROUP BY warc_id
           UNION ALL SELECT '', '' FROM docs WHERE warc_id NOT IN (SELECT warc_id FROM doc_tagged)) GROUP BY before, tag""",
    "doc_tagged",
    "docs",
)
cte(
    "move_costs",
    """SELECT a.t AS before, b.t AS tag, round(-1000.0 * ln((coalesce(n, 0) + 1) / sum(coalesce(n, 0) + 1) OVER (PARTITION BY a.t))) AS cost
       FROM (VALUES (''), ('NN'), ('NNP')) a(t), (VALUES (''), ('NN'), ('NNP')) b(t) LEFT JOIN moves ON before = a.t AND tag = b.t""",
    "moves",
)
cte(
    "use_costs",
    """SELECT word, tag, round(-1000.0 * ln(n / sum(n) OVER (PARTITION BY word)))
           - round(-1000.0 * ln(sum(n) OVER (PARTITION BY tag) / sum(n) OVER ())) AS cost, count(*) OVER (PARTITION BY word) AS n_tags FROM uses""",
    "uses",
)
cte(
    "lattice",
    """SELECT warc_id, d.pos, d.word, x.tag, CASE WHEN u.n_tags > 1 AND d.tag = 'NNP' THEN u.cost WHEN x.tag = d.tag THEN 0 END AS cost,
           max(d.pos) OVER (PARTITION BY warc_id) AS final
       FROM doc_tagged d, (VALUES ('NN'), ('NNP')) x(tag) LEFT JOIN use_costs u ON u.word = lower(d.word) AND u.tag = x.tag""",
    "doc_tagged",
    "use_costs",
)
cte(
    "forward",
    """SELECT warc_id, pos, tag, CAST(l.cost + c.cost AS DOUBLE) AS cost, '' AS before FROM lattice l JOIN move_costs c USING (tag)
       WHERE pos = 0 AND c.before = '' AND l.cost IS NOT NULL
       UNION ALL
       SELECT warc_id, pos, tag, min(cost), arg_min(before, (cost, before)) FROM (
           SELECT f.warc_id, l.pos, l.tag, f.cost + c.cost + l.cost AS cost, f.tag AS before
           FROM forward f JOIN lattice l ON l.warc_id = f.warc_id AND l.pos = f.pos + 1 JOIN move_costs c ON c.before = f.tag AND c.tag = l.tag
           WHERE l.cost IS NOT NULL) GROUP BY warc_id, pos, tag""",
    "lattice",
    "move_costs",
)
cte(
    "backward",
    """SELECT f.warc_id, f.pos, arg_min(f.tag, (f.cost + c.cost, f.tag)) AS tag FROM forward f JOIN move_costs c ON c.before = f.tag AND c.tag = ''
       JOIN (SELECT DISTINCT warc_id, final FROM lattice) e ON e.warc_id = f.warc_id AND e.final = f.pos GROUP BY f.warc_id, f.pos
       UNION ALL SELECT b.warc_id, b.pos - 1, f.before FROM backward b JOIN forward f ON f.warc_id = b.warc_id AND f.pos = b.pos AND f.tag = b.tag WHERE b.pos > 0""",
    "forward",
    "move_costs",
    "lattice",
)

mention_ctes(
    "ctx_doc",
    "(SELECT d.warc_id, d.pos, d.word, b.tag FROM doc_tagged d JOIN backward b ON b.warc_id = d.warc_id AND b.pos = d.pos)",
    "doc_tagged",
    "backward",
)

# One statement per query ---------------------------------------------------------------------------------------------------------

BLOCK_LINES = r"""SELECT page_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM (
    SELECT page_id, string_split(replace(replace(html, '<!--', chr(10) || '<!--'), '-->', chr(10) || '//-->' || chr(10)), chr(10)) AS l
    FROM pages)"""
cte("block_lines", BLOCK_LINES)
# Whether a line is inside a block depends on the last opening or closing line before it.
cte(
    "block_state",
    """SELECT *, starts_with(line, '<!--') AS opens, starts_with(line, '//-->') AS closes,
       max(pos) FILTER (starts_with(line, '<!--')) OVER w AS opened, max(pos) FILTER (starts_with(line, '//-->')) OVER w AS closed
       FROM block_lines WINDOW w AS (PARTITION BY page_id ORDER BY pos)""",
    "block_lines",
)

ORACLES: dict[str, str] = {
    "warc_records": build(
        r"SELECT rtrim(record, chr(13) || chr(10)) AS record, length(rtrim(record, chr(13) || chr(10))) AS n_chars FROM records", "records"
    ),
    "html_text": build(f"SELECT page_id, {markup_text('html')} AS text FROM pages"),
    "split_headers": build(
        f"""SELECT page_id, len(l) AS n_parts, CASE WHEN len(l) = 2 THEN l[1] END AS headers, CASE WHEN len(l) = 2 THEN l[2] END AS body
            FROM (SELECT page_id, string_split(record, {q(CONTENT_TYPE)}) AS l FROM records)""",
        "records",
    ),
    "record_id": build(
        rf"SELECT page_id, nullif(regexp_extract(record, '{RECORD_KEY}: ([^\r\n]*)', 1), '') AS warc_id FROM records", "records"
    ),
    "strip_code_blocks": build(
        """SELECT page_id, coalesce(string_agg(line, ' ' ORDER BY pos) FILTER (
               NOT opens AND NOT closes AND coalesce(opened, -1) <= coalesce(closed, -1)
               AND NOT (line = '' AND pos = n - 1)), '') AS body
           FROM (SELECT *, count(*) OVER (PARTITION BY page_id) AS n FROM block_state) GROUP BY page_id""",
        "block_state",
    ),
    "corpus_counts": build(
        """SELECT CASE WHEN n_parts < 2 THEN 'no content type' WHEN n_parts > 2 THEN 'many content types'
                       WHEN warc_id IS NULL THEN 'no id' ELSE 'ok' END AS reason, count(*) AS n FROM parsed GROUP BY 1""",
        "parsed",
    ),
    "document_mentions": build(
        """SELECT warc_id, count(mention) AS n_mentions, coalesce(string_agg(mention, '|' ORDER BY ord), '') AS mentions
           FROM page_docs LEFT JOIN page_mentions USING (warc_id) GROUP BY warc_id""",
        "page_docs",
        "page_mentions",
    ),
    "tokens": build("SELECT warc_id, pos, token FROM doc_tokens", "doc_tokens"),
    "strip_hex": build("SELECT token, regexp_replace(token, '[0-9][A-F]', '', 'g') AS word, n FROM raw_tokens", "raw_tokens"),
    "strip_nonword": build(
        r"""SELECT token, regexp_replace(token, '[\W_]+', '', 'g') AS word,
            regexp_replace(token, '[^\p{L}\p{N}]+', '', 'g') AS unicode_word, n FROM raw_tokens""",
        "raw_tokens",
    ),
    "strip_digits": build("SELECT token, regexp_replace(token, '[0-9]', '', 'g') AS word, n FROM raw_tokens", "raw_tokens"),
    "lemmas": build("SELECT word, lemma FROM doc_lemma_table", "doc_lemma_table"),
    "clean_tokens": build("SELECT warc_id, pos, word FROM doc_words", "doc_words"),
    "stopword_filter": build(
        f"SELECT word, count(*) AS n FROM doc_words WHERE word NOT IN ({STOP_LIST}) GROUP BY word", "doc_words"
    ),
    "length_or_acronym": build(
        "SELECT word, count(*) AS n FROM doc_words WHERE length(word) > 2 OR regexp_matches(word, '^[A-Z]+$') GROUP BY word", "doc_words"
    ),
    "proper_nouns": build("SELECT warc_id, word, count(*) AS n FROM doc_tagged WHERE tag = 'NNP' GROUP BY warc_id, word", "doc_tagged"),
    "tag_lexicon": build("SELECT word, n, n_capital, tag FROM lexicon", "lexicon"),
    "tag_tokens": build("SELECT word, tag, count(*) AS n FROM lex_doc_tagged GROUP BY word, tag", "lex_doc_tagged"),
    "tag_moves": build("SELECT before, tag, n FROM moves", "moves"),
    "tag_in_context": build(
        "SELECT d.warc_id, d.pos, d.word, b.tag FROM doc_tagged d JOIN backward b ON b.warc_id = d.warc_id AND b.pos = d.pos", "doc_tagged", "backward"
    ),
    "noun_runs": build(
        """SELECT warc_id, row_number() OVER (PARTITION BY warc_id ORDER BY start) - 1 AS pos, chunk AS run
           FROM doc_chunks WHERE size >= 2""",
        "doc_chunks",
    ),
    "mentions": build("SELECT warc_id, ord, kind, mention FROM doc_mentions", "doc_mentions"),
    "context_mentions": build(
        """SELECT warc_id, coalesce(string_agg(mention, '|' ORDER BY ord), '') AS mentions
           FROM docs LEFT JOIN ctx_doc_mentions USING (warc_id) GROUP BY warc_id""",
        "docs",
        "ctx_doc_mentions",
    ),
    "unicode_mentions": build(
        """SELECT warc_id, coalesce(string_agg(mention, '|' ORDER BY ord), '') AS mentions FROM docs LEFT JOIN uni_mentions USING (warc_id) GROUP BY warc_id""",
        "docs",
        "uni_mentions",
    ),
    "typed_entities": build(
        "SELECT warc_id, pos, off AS word_at, entity, type FROM doc_entities JOIN gazetteer ON name = entity", "doc_entities", "gazetteer"
    ),
    "entity_types": build(
        """SELECT warc_id, entity, last(type ORDER BY pos, off, type) AS type FROM doc_entities JOIN gazetteer ON name = entity
           GROUP BY warc_id, entity""",
        "doc_entities",
        "gazetteer",
    ),
    "entity_mentions": build(
        """SELECT warc_id, coalesce(string_agg(DISTINCT entity, '|' ORDER BY entity), '') AS mentions
           FROM docs LEFT JOIN doc_entities USING (warc_id) GROUP BY warc_id""",
        "docs",
        "doc_entities",
    ),
    "typed_places": build(
        """SELECT warc_id, coalesce(string_agg(DISTINCT entity, '|' ORDER BY entity) FILTER (
               entity IN (SELECT name FROM gazetteer WHERE type IN ('GPE', 'ORGANIZATION'))), '') AS mentions
           FROM docs LEFT JOIN doc_entities USING (warc_id) GROUP BY warc_id""",
        "docs",
        "doc_entities",
        "gazetteer",
    ),
    "candidate_search": build("SELECT mention, kb_id, label, n_words, search_score, rank FROM hits WHERE rank <= 100", "hits"),
    "top_hits": build("SELECT mention, rank, kb_id, label, search_score FROM hits WHERE rank <= 10", "hits"),
    "label_sets": build(
        """SELECT mention, kb_id, string_agg(DISTINCT label, '|' ORDER BY label) AS labels, max(search_score) AS search_score
           FROM hits WHERE rank <= 20 GROUP BY mention, kb_id""",
        "hits",
    ),
    "best_candidates": build("SELECT mention, kb_id, labels, search_score FROM candidates", "candidates"),
    "flatten_hits": build("SELECT mention, rank - 1 AS pos, kb_id, label, search_score FROM hits WHERE rank <= 20", "hits"),
    "dictionary_labels": build("SELECT warc_id, label, kb_id FROM docs JOIN labels_kb ON contains(body, label)", "docs", "labels_kb"),
    "kb_key": build(f"SELECT kb_id, 'm.' || substr(kb_id, 4) AS key, {IRI} AS iri FROM items", "items"),
    "kb_abstracts": build("SELECT kb_id, abstract FROM abstracts", "abstracts"),
    "kb_properties": build(
        f"""SELECT kb_id, p, o FROM items JOIN triples ON s = {IRI}
            QUALIFY row_number() OVER (PARTITION BY kb_id ORDER BY p, o) <= 10""",
        "items",
        "triples",
    ),
    "english_abstracts": build("SELECT kb_id, abstract FROM english", "english"),
    "candidates_with_abstract": build(
        "SELECT mention, kb_id, search_score FROM candidates WHERE kb_id IN (SELECT kb_id FROM english)", "candidates", "english"
    ),
    "concat_abstracts": build("SELECT warc_id AS kb_id, body FROM described", "described"),
    "flatten_bindings": build("SELECT kb_id, abstract FROM abstracts", "abstracts"),
    "hamming_similarity": build(
        f"""SELECT a, b, round({similarity("a", "b")}, 6) AS similarity FROM (
            SELECT DISTINCT a, b FROM (
                SELECT word AS a, lead(word) OVER (PARTITION BY warc_id ORDER BY pos) AS b FROM doc_words) WHERE b IS NOT NULL)""",
        "doc_words",
    ),
    "similar_words": build("SELECT word_a, word_b FROM alike", "alike"),
    "similarity_score": build("SELECT DISTINCT warc_id, kb_id, round(score, 6) AS score FROM scored", "scored"),
    "similarity_score_by_abstract": build(
        """SELECT DISTINCT p.warc_id, p.kb_id, round(coalesce(CAST(matches AS DOUBLE) / total, 0.0), 6) AS score FROM proposed p
           LEFT JOIN matches m ON m.warc_id = p.warc_id AND m.kb_id = p.kb_id
           LEFT JOIN (SELECT warc_id AS kb_id, max(n_mentions) AS total FROM kb_counts GROUP BY warc_id) k ON k.kb_id = p.kb_id""",
        "proposed",
        "matches",
        "kb_counts",
    ),
    "best_candidate": build(
        "SELECT warc_id, mention, n, kb_id, search_score, round(score, 6) AS score FROM best", "best"
    ),
    "link_threshold": build("SELECT warc_id, mention, kb_id, round(score, 6) AS score FROM best WHERE score >= 0.2", "best"),
    "link_entities": build("SELECT warc_id, mention, kb_id FROM links", "links"),
    "link_entities_shared_ids": build(
        "SELECT source AS warc_id, mention, kb_id FROM links JOIN documents ON CAST(doc_id AS VARCHAR) = warc_id", "links"
    ),
    "link_entities_from_responses": build("SELECT warc_id, mention, kb_id FROM links", "links"),
    "link_entities_with_lexicon": build("SELECT warc_id, mention, kb_id FROM lex_links", "lex_links"),
    "link_entities_by_type": build("SELECT warc_id, mention, kb_id FROM typed_links", "typed_links"),
    "linked_entities": build(
        """SELECT b.warc_id, b.mention AS name, b.kb_id, d.body AS abstract, round(score, 6) AS score, labels, nouns FROM best b
           JOIN described d ON d.warc_id = b.kb_id
           JOIN (SELECT warc_id AS kb_id, string_agg(mention, '|' ORDER BY ord) AS nouns FROM kb_mentions GROUP BY warc_id) k
             ON k.kb_id = b.kb_id
           WHERE score >= 0.2""",
        "best",
        "described",
        "kb_mentions",
    ),
    "link_entities_streamed": build("SELECT warc_id, mention, kb_id FROM page_links", "page_links"),
    "links_tsv": build("SELECT warc_id, mention, kb_id FROM links", "links"),
    "link_eval": build(
        """SELECT gold, linked, correct, round(p, 6) AS precision, round(r, 6) AS recall,
               CASE WHEN p + r > 0 THEN round(2 * p * r / (p + r), 6) ELSE 0.0 END AS f1
           FROM (SELECT *, CASE WHEN linked > 0 THEN correct / linked ELSE 0.0 END AS p,
                           CASE WHEN gold > 0 THEN correct / gold ELSE 0.0 END AS r
                 FROM (SELECT (SELECT count(*) FROM gold) AS gold, count(*) AS linked,
                              count(*) FILTER ((warc_id, kb_id) IN (SELECT (warc_id, kb_id) FROM gold)) AS correct
                       FROM (SELECT DISTINCT warc_id, kb_id FROM links)))""",
        "links",
        "gold",
    ),
}
