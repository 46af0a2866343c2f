"""SQL that recomputes every registered query on DuckDB, from the raw tables.

Written independently of the Spark plans: rows and joins instead of arrays, and
a stemmer that measures stems by counting vowel runs instead of by pattern.
"""

from __future__ import annotations

from pathlib import Path

# The list of stopwords, and the suffixes of Porter's steps 2 to 4.
_LIST = Path(__file__).resolve().parent / "trawl/data/stopwords.txt"
STOPWORDS = {
    word for line in _LIST.read_text().splitlines() if not line.startswith("#")
    for word in line.split()
}
STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
]
STEP_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()

NL = "chr(10)"
TOKEN = "[A-Za-z0-9][A-Za-z0-9_-]*"
STOP = ", ".join(f"('{word}')" for word in sorted(STOPWORDS))


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


# -- stemming ---------------------------------------------------------------

# y after a vowel or at the start is written Y; "1" stands for a vowel run.
_SHAPE = "regexp_replace({w}, '[aeiouy]+', '1', 'g')"


def _measure(stem: str) -> str:
    """Number of vowel runs that a consonant follows."""
    return f"len(regexp_extract_all({_SHAPE.format(w=stem)}, '1[^1]'))"


def _left(n: int) -> str:
    return f"left(w, len(w) - {n})"


def _rules(rules) -> str:
    """CASE over suffixes, longest first: rules are (suffix, condition, replacement)."""
    ordered = sorted(rules, key=lambda r: -len(r[0]))
    branches = []
    for suffix, condition, replacement in ordered:
        stem = _left(len(suffix))
        branches.append(
            f"WHEN suffix(w, '{suffix}') THEN CASE WHEN {condition.format(stem=stem)} "
            f"THEN {stem} || '{replacement}' ELSE w END"
        )
    return "CASE " + " ".join(branches) + " ELSE w END"


def _stem_ctes(vocabulary: str) -> list[str]:
    """CTEs ending in ``stems(token, stem)`` for the tokens of ``vocabulary``."""
    m = _measure("{stem}")
    vowel = "regexp_matches({stem}, '[aeiouy]')"
    cvc = "regexp_matches({x}, '[^aeiouy][aeiouy][^aeiouywxY]$')"
    step_4 = [
        (s, f"{m} > 1" + (" AND regexp_matches({stem}, '[st]$')" if s == "ion" else ""), "")
        for s in STEP_4
    ]
    body = "left(w, len(w) - 1)"
    steps = [
        _rules([("sses", "true", "ss"), ("ies", "true", "i"), ("ss", "true", "ss"), ("s", "true", "")]),
        _rules([("eed", f"{m} > 0", "ee"), ("ed", vowel, "#"), ("ing", vowel, "#")]),
        f"CASE WHEN NOT suffix(w, '#') THEN w "
        f"WHEN suffix({body}, 'at') OR suffix({body}, 'bl') OR suffix({body}, 'iz') THEN {body} || 'e' "
        f"WHEN len(w) > 2 AND w[-2] = w[-3] AND regexp_matches(w[-2], '[^aeiouylsz]') "
        f"THEN left(w, len(w) - 2) "
        f"WHEN {_measure(body)} = 1 AND {cvc.format(x=body)} THEN {body} || 'e' "
        f"ELSE {body} END",
        f"CASE WHEN lower(w[-1]) = 'y' AND regexp_matches({body}, '[aeiouy]') "
        f"THEN {body} || 'i' ELSE w END",
        _rules([(s, f"{m} > 0", r) for s, r in STEP_2]),
        _rules([(s, f"{m} > 0", r) for s, r in STEP_3]),
        _rules(step_4),
        f"CASE WHEN suffix(w, 'e') AND ({_measure(body)} > 1 OR "
        f"({_measure(body)} = 1 AND NOT {cvc.format(x=body)})) THEN {body} ELSE w END",
        f"CASE WHEN suffix(w, 'll') AND {_measure('w')} > 1 THEN {body} ELSE w END",
    ]
    ctes = [
        f"stem_0 AS (SELECT token, regexp_replace(token, '(^|[aeiouy])y', '\\1Y', 'g') AS w "
        f"FROM ({vocabulary}) WHERE len(token) > 2)"
    ]
    for i, step in enumerate(steps, 1):
        ctes.append(f"stem_{i} AS (SELECT token, {step} AS w FROM stem_{i - 1})")
    ctes.append(
        f"stems AS MATERIALIZED (SELECT token, lower(w) AS stem FROM stem_{len(steps)} "
        f"UNION ALL SELECT token, token FROM ({vocabulary}) WHERE len(token) <= 2)"
    )
    return ctes


# -- corpora ----------------------------------------------------------------

_SOURCE = "src AS (SELECT url, html FROM pages)"

_MARKUP = f"""clean AS (SELECT url, html, regexp_replace(html,
    '(?is)<!--.*?-->|<script[^>]*>.*?</script\\s*>', {NL}, 'g') AS h FROM src)"""

_TEXTS = f"""parts AS (SELECT url, html, h,
    regexp_extract(h, '(?is)^(.*?)<body', 1) AS head,
    regexp_extract(h, '(?is)<body[^>]*>(.*)$', 1) AS body
  FROM clean),
texts AS MATERIALIZED (SELECT url, html, h,
    regexp_replace(regexp_replace(regexp_extract(head, '(?is)<title[^>]*>(.*?)</title>', 1),
      '<[^>]*>', {NL}, 'g'), '&[a-zA-Z][a-zA-Z0-9]*;', ' ', 'g') AS title_text,
    regexp_replace(regexp_replace(body, '<[^>]*>', {NL}, 'g'),
      '&[a-zA-Z][a-zA-Z0-9]*;', ' ', 'g') AS body_text
  FROM parts)"""

_PLAIN = """texts AS MATERIALIZED (SELECT 'doc:' || doc_id AS url, '' AS title_text,
    text AS body_text, text AS html FROM documents WHERE text IS NOT NULL)"""

_TOKENS = f"""stop(token) AS (VALUES {STOP}),
token_lists AS MATERIALIZED (SELECT url,
    list_transform(regexp_extract_all(title_text, '{TOKEN}'), lambda t: lower(t)) AS tt,
    list_transform(regexp_extract_all(body_text, '{TOKEN}'), lambda t: lower(t)) AS bt
  FROM texts),
tokens AS MATERIALIZED (SELECT url, unnest(list_concat(tt, bt)) AS token,
    unnest(range(len(tt) + len(bt)))::INT AS pos FROM token_lists),
title_tokens AS (SELECT DISTINCT url, unnest(tt) AS token FROM token_lists),
kept AS MATERIALIZED (SELECT url, token,
    (row_number() OVER (PARTITION BY url ORDER BY pos) - 1)::INT AS position
  FROM tokens WHERE token NOT IN (SELECT token FROM stop))"""

_TABLES = f"""positions AS MATERIALIZED (
  SELECT stem AS word, url, position FROM kept JOIN stems USING (token)),
postings AS MATERIALIZED (SELECT p.word, p.url, p.tf, t.token IS NOT NULL AS in_title
  FROM (SELECT word, url, count(*)::INT AS tf FROM positions GROUP BY ALL) p
  LEFT JOIN title_tokens t ON t.url = p.url AND t.token = p.word),
keywords AS MATERIALIZED (SELECT word, count(*) AS df FROM postings GROUP BY word),
docs AS MATERIALIZED (SELECT x.url,
    array_to_string(regexp_extract_all(title_text, '[\\[A-Za-z0-9][A-Za-z0-9_-]*'), ' ') AS title,
    (len(tt) + len(bt))::INT AS document_size,
    greatest(1, coalesce(m.mx, 1))::INT AS max_tf,
    octet_length(encode(html))::BIGINT AS document_chars
  FROM texts x JOIN token_lists l USING (url)
  LEFT JOIN (SELECT url, max(tf) AS mx FROM postings GROUP BY url) m ON m.url = x.url)"""

_KEPT_VOCABULARY = "SELECT DISTINCT token FROM kept"


def _corpus(plain: bool, vocabulary: str = _KEPT_VOCABULARY, source: str = _SOURCE) -> list[str]:
    texts = [_PLAIN] if plain else [source, _MARKUP, _TEXTS]
    return [*texts, _TOKENS, *_stem_ctes(vocabulary), _TABLES]


_HREFS = """hrefs AS (SELECT url,
    unnest(range(len(found)))::INT AS pos,
    replace(trim(unnest(found), '"'''), '&amp;', '&') AS href
  FROM (SELECT url, regexp_extract_all(h,
    '(?i)<a\\s[^>]*?href\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s>]+)', 1) AS found FROM clean)),
resolved AS (SELECT url, pos, href, CASE
    WHEN href = '' THEN url
    WHEN regexp_matches(href, '^[a-z]+:') THEN href
    WHEN href[1] = '/' THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || href
    ELSE regexp_extract(url, '^[a-z]+://[^?#]*/') || href END AS child_url FROM hrefs),
edges AS MATERIALIZED (SELECT DISTINCT url AS parent_url, child_url FROM resolved)"""


# -- queries ----------------------------------------------------------------

_PASSAGES = "queries AS (SELECT item_id AS query_id, text AS query FROM benchmark)"
_SENTENCES = f"""queries AS (SELECT item_id || '-' || pos AS query_id, '"' || s || '"' AS query
  FROM (SELECT item_id, unnest(parts) AS s, unnest(range(len(parts))) AS pos
    FROM (SELECT item_id, string_split_regex(replace(text, '"', ' '), '[.\\n]') AS parts
      FROM benchmark)))"""
_PAGE_TITLE = """array_to_string(regexp_extract_all(regexp_replace(
    regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1),
    '&[a-zA-Z][a-zA-Z0-9]*;', ' ', 'g'), '[\\[A-Za-z0-9][A-Za-z0-9_-]*'), ' ')"""
_TITLES = f"queries AS (SELECT page_id AS query_id, {_PAGE_TITLE} AS query FROM pages)"
_TITLE_PAIRS = f"""queries AS (SELECT page_id AS query_id,
    regexp_replace({_PAGE_TITLE}, '(\\S+ \\S+)', '"\\1"', 'g') AS query FROM pages)"""

_QUERY_TOKENS = """query_words AS (SELECT DISTINCT query_id, lower(unnest(
    string_split_regex(query, '[^A-Za-z0-9_-]+'))) AS token FROM queries),
query_tokens AS MATERIALIZED (SELECT * FROM query_words
  WHERE token <> '' AND token NOT IN (SELECT token FROM stop)),
quoted AS (SELECT query_id, unnest(found) AS phrase, unnest(range(len(found))) AS phrase_no
  FROM (SELECT query_id, regexp_extract_all(query, '"([^"]+)"', 1) AS found FROM queries)),
phrase_words AS (SELECT query_id, phrase_no, unnest(ws) AS token, unnest(range(len(ws))) AS raw
  FROM (SELECT query_id, phrase_no, list_transform(
    string_split_regex(phrase, '[^A-Za-z0-9_-]+'), lambda t: lower(t)) AS ws FROM quoted)),
phrase_tokens AS MATERIALIZED (SELECT * FROM phrase_words
  WHERE token <> '' AND token NOT IN (SELECT token FROM stop))"""

_QUERY_VOCABULARY = "SELECT token FROM kept UNION SELECT token FROM query_tokens"

_PARSED = """query_terms AS MATERIALIZED (
  SELECT DISTINCT query_id, stem AS word FROM query_tokens JOIN stems USING (token)),
phrases AS MATERIALIZED (SELECT query_id,
    dense_rank() OVER (PARTITION BY query_id ORDER BY phrase_no) - 1 AS phrase_id,
    row_number() OVER (PARTITION BY query_id, phrase_no ORDER BY raw) - 1 AS off, stem AS word
  FROM phrase_tokens JOIN stems USING (token))"""

_SCORING = """known AS MATERIALIZED (SELECT query_id, word, df,
    count(*) OVER (PARTITION BY query_id) AS n_known
  FROM query_terms JOIN keywords USING (word)),
weights AS (SELECT query_id, url, word, tf, n_known, document_size,
    tf * log2((SELECT count(*) FROM docs)::DOUBLE / df) / max_tf
      * CASE WHEN in_title THEN 1000 ELSE 1 END AS weight
  FROM known JOIN postings USING (word) JOIN docs USING (url)),
known_phrases AS (SELECT query_id, phrase_id, word,
    row_number() OVER (PARTITION BY query_id, phrase_id ORDER BY off) - 1 AS off,
    count(*) OVER (PARTITION BY query_id, phrase_id) AS n_words
  FROM phrases JOIN keywords USING (word)),
phrase_hits AS (SELECT DISTINCT query_id, phrase_id, url FROM (
    SELECT query_id, phrase_id, url, position - off AS start
    FROM known_phrases JOIN positions USING (word)
    GROUP BY query_id, phrase_id, url, start, n_words
    HAVING count(DISTINCT off) = n_words)),
needed AS (SELECT query_id, count(DISTINCT phrase_id) AS n FROM phrases GROUP BY query_id),
holding AS (SELECT query_id, url FROM phrase_hits JOIN needed USING (query_id)
  GROUP BY query_id, url, n HAVING count(*) = n),
scores AS MATERIALIZED (SELECT query_id, url, sum(weight) / (document_size * n_known) AS score
  FROM weights
  WHERE query_id NOT IN (SELECT query_id FROM needed)
     OR (query_id, url) IN (SELECT (query_id, url) FROM holding)
  GROUP BY query_id, url, document_size, n_known),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY printf('%.8e', score)::DOUBLE DESC,
    title DESC, document_size DESC, url) AS position
  FROM scores JOIN docs USING (url)),
top AS MATERIALIZED (SELECT * FROM ranked WHERE position <= 50),
totals AS (SELECT query_id, count(*) AS total FROM scores GROUP BY query_id),
stats AS (SELECT query_id, coalesce(total, 0) AS total, CASE WHEN total > 50
    THEN total || ' (50 shown)' ELSE coalesce(total, 0)::VARCHAR END AS total_results
  FROM queries LEFT JOIN totals USING (query_id)),
matched AS (SELECT query_id, url, string_agg(word || ':' || tf, ' ' ORDER BY word) AS keywords
  FROM weights JOIN top USING (query_id, url) GROUP BY query_id, url)"""

_FLAT = """flat AS (SELECT t.query_id, t.position::INT AS position, 0 AS part, t.url, printf('%.6e', t.score) AS rank,
    t.title, NULL::VARCHAR AS modified, t.document_size AS size, m.keywords,
    coalesce((SELECT string_agg(parent_url, ' ' ORDER BY parent_url) FROM edges
      WHERE child_url = t.url), '') AS parents,
    coalesce((SELECT string_agg(child_url, ' ' ORDER BY child_url) FROM edges
      WHERE parent_url = t.url AND child_url <> t.url), '') AS children
  FROM top t JOIN matched m USING (query_id, url))"""


def _search(plain: bool, queries: str, final: str, *more: str) -> str:
    texts = [_PLAIN] if plain else [_SOURCE, _MARKUP, _TEXTS]
    return _with(
        *texts, _TOKENS, queries, _QUERY_TOKENS, *_stem_ctes(_QUERY_VOCABULARY), _TABLES,
        _PARSED, _SCORING, *more,
    ) + final


_RECRAWLED = """src AS (SELECT url, CASE WHEN contains(html, '<html lang="fr">')
    THEN regexp_replace(html, '(?s)<nav>.*?</nav>', '', 'g') ELSE html END AS html FROM pages)"""

_CRAWL = """raw AS (
  SELECT '/order/' || l_orderkey AS parent, '/part/' || l_partkey AS child, l_linenumber AS lp
  FROM lineitem
  UNION ALL
  SELECT '/part/' || l_partkey, '/order/' || l_orderkey, l_orderkey FROM lineitem),
edge AS MATERIALIZED (SELECT parent, child, min(lp)::BIGINT AS lp FROM raw GROUP BY ALL)"""


def _crawl(levels: int = 24) -> str:
    """Breadth-first search unrolled level by level; empty levels add nothing."""
    ctes = [
        _CRAWL,
        "v0 AS (SELECT '/order/1' AS url, 0 AS depth, NULL::VARCHAR AS parent_url, "
        "0::BIGINT AS link_position, 1::BIGINT AS ord "
        "WHERE EXISTS (FROM edge WHERE parent = '/order/1'))",
    ]
    for n in range(1, levels + 1):
        ctes.append(
            f"""c{n} AS (SELECT child AS url, l.ord AS po, lp, parent FROM v{n - 1} l
  JOIN edge ON parent = l.url WHERE l.depth = {n - 1}
  AND child NOT IN (SELECT url FROM v{n - 1})),
v{n} AS MATERIALIZED (SELECT * FROM v{n - 1} UNION ALL
  SELECT url, {n}, parent, lp, row_number() OVER (ORDER BY po, lp, url) FROM (
    SELECT url, po, lp, parent,
      row_number() OVER (PARTITION BY url ORDER BY po, lp) AS rn FROM c{n}) WHERE rn = 1)"""
        )
    return _with(*ctes) + (
        f"SELECT url, depth, parent_url, link_position FROM v{levels} WHERE CASE WHEN "
        f"depth < {levels} THEN true ELSE error('the graph is deeper than this check') END"
    )


def oracle_sql() -> dict[str, str]:
    pages = _with(*_corpus(plain=False))
    links = _with(_SOURCE, _MARKUP, _HREFS)
    texts_only = _with(_SOURCE, _MARKUP, _TEXTS, _TOKENS)
    recrawled = _with(*_corpus(plain=False, source=_RECRAWLED))
    rows = (
        "SELECT word, url, tf AS term_frequency, in_title, df AS document_frequency "
        "FROM postings JOIN keywords USING (word)"
    )
    details = (_HREFS, _FLAT)
    flat_columns = (
        "query_id, position, part, url, rank, title, modified, size, keywords, parents, children"
    )
    return {
        "page_text": texts_only + "SELECT url, trim(regexp_replace(title_text || ' ' || body_text, "
        "'\\s+', ' ', 'g')) AS text FROM texts",
        "page_title": texts_only + "SELECT url, array_to_string(regexp_extract_all(title_text, "
        "'[\\[A-Za-z0-9][A-Za-z0-9_-]*'), ' ') AS title FROM texts",
        "page_tokens": texts_only + "SELECT url, pos, token FROM tokens",
        "title_tokens": texts_only + "SELECT url, unnest(range(len(tt)))::INT AS pos, "
        "unnest(tt) AS token FROM token_lists",
        "stopword_filter": _with(_PLAIN, _TOKENS) + "SELECT url, "
        "(count(*) - count(s.token))::INT AS n_kept, count(s.token)::INT AS n_dropped "
        "FROM tokens t LEFT JOIN stop s ON s.token = t.token GROUP BY url",
        "stem_vocabulary": _with(_PLAIN, _TOKENS, *_stem_ctes("SELECT DISTINCT token FROM tokens"))
        + "SELECT token, stem FROM stems",
        "documents_table": pages + "SELECT url, title, document_size, NULL::TIMESTAMP AS modified, "
        "max_tf, document_chars FROM docs",
        "keywords_table": pages + "SELECT word, df AS document_frequency FROM keywords",
        "text_keywords_table": _with(*_corpus(plain=True))
        + "SELECT word, df AS document_frequency FROM keywords",
        "postings_table": pages + "SELECT word, url, tf AS term_frequency, in_title FROM postings",
        "positions_table": pages + "SELECT word, url, position FROM positions",
        "position_lists": pages + "SELECT word, url, string_agg(position::VARCHAR, ',' "
        "ORDER BY position) AS positions FROM positions GROUP BY word, url",
        "max_tf": pages + "SELECT url, max_tf FROM docs",
        "doc_term_counts": pages + "SELECT d.url, count(p.word)::INT AS n_terms FROM docs d "
        "LEFT JOIN postings p ON p.url = d.url GROUP BY d.url",
        "in_title_flags": pages + "SELECT word, url FROM postings WHERE in_title",
        "page_links": links + "SELECT url, pos, href FROM hrefs",
        "resolved_links": links + "SELECT url, pos, href, child_url FROM resolved",
        "links_table": links + "SELECT parent_url, child_url FROM edges",
        "parents_children": links + "SELECT child_url AS url, 'parent' AS role, "
        "parent_url AS linked_url FROM edges WHERE child_url IN (SELECT url FROM pages) "
        "UNION ALL SELECT parent_url, 'child', child_url FROM edges WHERE parent_url <> child_url",
        "http_date_parse": "SELECT o_orderkey, date_trunc('second', o_orderdate) AS modified, "
        "strftime(o_orderdate, '%A %d, %B %Y') AS shown FROM orders",
        "modified_date": "SELECT o_orderkey, CASE o_orderstatus "
        "WHEN 'F' THEN date_trunc('day', o_orderdate) "
        "WHEN 'P' THEN date_trunc('second', o_orderdate) "
        "ELSE date_trunc('second', o_orderdate) + INTERVAL 400 DAY END::TIMESTAMP AS modified "
        "FROM orders",
        "parsed_queries": _with(
            f"stop(token) AS (VALUES {STOP})", _SENTENCES, _QUERY_TOKENS,
            *_stem_ctes("SELECT DISTINCT token FROM query_tokens"), _PARSED,
        )
        + "SELECT query_id, 'term' AS kind, 0 AS phrase_id, 0 AS offset, word FROM query_terms "
        "UNION ALL SELECT query_id, 'phrase', phrase_id::INT, off::INT, word FROM phrases",
        "known_terms": _search(
            True, _PASSAGES, "SELECT query_id, word, df AS document_frequency, n_known FROM known"
        ),
        "term_weights": _search(
            False, _TITLES, "SELECT query_id, word, count(*) AS pages, "
            "printf('%.6e', sum(weight)) AS weight_sum, "
            "printf('%.6e', max(weight)) AS weight_max FROM weights GROUP BY ALL"
        ),
        "search_any_term": _search(
            True, _PASSAGES, "SELECT query_id, count(*) AS hits, "
            "printf('%.6e', sum(score)) AS score_sum, printf('%.6e', max(score)) AS score_max "
            "FROM scores GROUP BY query_id"
        ),
        "search_phrase": _search(
            True, _SENTENCES, "SELECT query_id, url, printf('%.6e', score) AS score FROM scores"
        ),
        "search_multi_phrase": _search(
            False, _TITLE_PAIRS, "SELECT query_id, url, printf('%.6e', score) AS score FROM scores"
        ),
        "search_topk": _search(
            True, _PASSAGES,
            "SELECT query_id, position::INT AS position, url, printf('%.6e', score) AS score FROM top",
        ),
        "search_stats": _search(
            True, _PASSAGES, "SELECT query_id, total, total_results FROM stats"
        ),
        "search_no_hits": "SELECT item_id AS query_id, 'No results found for: \"zq' || md5(text) "
        "|| '\" ' || text AS error FROM benchmark",
        "matched_keywords": _search(
            True, _PASSAGES, "SELECT query_id, url, keywords FROM matched"
        ),
        "search_results": _search(False, _TITLES, f"SELECT {flat_columns} FROM flat", *details),
        "search_json": _search(
            False, _TITLES,
            f"SELECT {flat_columns}, NULL::VARCHAR AS error, total_results "
            "FROM flat JOIN stats USING (query_id) UNION ALL SELECT query_id, 0, 0, "
            "NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN total = 0 THEN "
            "'No results found for: ' || coalesce(query, '') END, "
            "CASE WHEN total > 0 THEN total_results END FROM stats JOIN queries USING (query_id)",
            *details,
        ),
        "index_report": _with(*_corpus(plain=False), _HREFS)
        + f"""SELECT url, title || {NL} || url || {NL} || 'None , ' || document_size || {NL} ||
    coalesce((SELECT string_agg(word || ' ' || tf || ' ;', ' ' ORDER BY tf DESC, word)
      FROM postings p WHERE p.url = d.url), '') || {NL} ||
    coalesce((SELECT string_agg('Child ' || child_url || {NL}, '' ORDER BY pos) FROM (
      SELECT url, child_url, min(pos) AS pos FROM resolved GROUP BY ALL) r
      WHERE r.url = d.url), '') || repeat('-', 91) AS report FROM docs d""",
        "crawl_frontier": links + "SELECT child_url AS url, count(*) AS n_parents, "
        "min(parent_url) AS first_parent FROM edges WHERE parent_url <> child_url "
        "AND child_url NOT IN (SELECT url FROM pages) GROUP BY child_url",
        "crawl_order": _crawl(),
        "latest_pages": "WITH " + _RECRAWLED + " SELECT s.url, CASE WHEN contains(p.html, "
        "'<html lang=\"fr\">') THEN 2 ELSE 1 END AS version, md5(s.html) AS html_md5 "
        "FROM src s JOIN pages p USING (url)",
        "incremental_index": recrawled + rows,
        "compacted_index": recrawled + rows,
        "incremental_links": _with(_RECRAWLED, _MARKUP, _HREFS)
        + "SELECT parent_url, child_url FROM edges",
        "streaming_index": recrawled + rows,
        "graph_parents": _with(_CRAWL) + "SELECT child AS url, count(*)::BIGINT AS n_parents, "
        "min(parent) AS first_parent, max(parent) AS last_parent FROM edge GROUP BY child",
    }
