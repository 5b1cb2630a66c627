"""SQL with the same rows as the queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

from rankloom.llm.columns import UPPER
from rankloom.llm.quality_rules import (
    MAX_REPEATED_PCT,
    MIN_WORDS,
    RULES,
    STOP_FORMS,
    WINDOW,
    Rule,
)

_BLANK = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _quoted(texts: tuple[str, ...]) -> str:
    return ", ".join(f"'{t}'" for t in texts)


def _passes(rule: Rule) -> str:
    sides = []
    if rule.low is not None:
        sides.append(f"100 * {rule.measure} >= {rule.low} * {rule.base}")
    if rule.high is not None:
        sides.append(f"100 * {rule.measure} <= {rule.high} * {rule.base}")
    return " AND ".join(sides)


_QUALITY = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
parts AS (
  SELECT doc_id, text,
         list_filter(regexp_split_to_array(text, '{_BLANK}'), lambda w: w <> '') AS words,
         list_filter(string_split(text, chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
),
grams AS (
  SELECT doc_id, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM parts)
),
twice AS (
  SELECT doc_id, unnest(range(i, i + {WINDOW})) AS place
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams) WHERE n > 1
),
repeated AS (SELECT doc_id, count(DISTINCT place) AS n FROM twice GROUP BY doc_id),
measured AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '{_BLANK}', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         length(regexp_replace(text, '[^!]+', '', 'g')) AS n_marks,
         length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS n_capitals,
         len(list_filter(words, lambda w: w IN ({_quoted(STOP_FORMS)}))) AS n_stop_words,
         len(lines) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         len(list_filter(lines, lambda l: regexp_matches(l, '^[ \t]*[-*•]'))) AS n_bullet_lines,
         len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…)[ \t\r]*$')))
           AS n_ellipsis_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM parts LEFT JOIN repeated r USING (doc_id)
),
based AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PCT} * n_words
            AS base_failed
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(f"({_passes(rule)})" for rule in RULES)} AS kept
FROM based
"""

_URLS = f"""
WITH rests AS (
  SELECT page_id, CASE WHEN contains(url, '://')
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
parsed AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
                   '{UPPER}', '{UPPER.lower()}') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
),
rules(h, p, v) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
         ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
),
best AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM parsed JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parsed LEFT JOIN best USING (page_id)
"""

_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{_WORD}')"
)

_CONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT item_id, w, least(13, len(w)) AS n,
               unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
        FROM items WHERE len(w) > 0)
),
placed AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM docs, (SELECT DISTINCT n FROM windows))
),
met AS (SELECT doc_id, i, n, item_id FROM placed JOIN windows USING (n, gram)),
hit AS (
  SELECT doc_id, count(DISTINCT place) AS n
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM met) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM met) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit,
       coalesce(named.n, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_BASE32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"

_ARCHIVES = f"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
),
firsts AS (SELECT html, min(page_id) AS first FROM payloads GROUP BY html)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr({_BASE32}, CAST(
         (CAST('0x' || substr(hex, 10 * (k // 8) + 1, 10) AS BIGINT) >> (35 - 5 * (k % 8))) & 31
       AS BIGINT) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM payloads JOIN firsts USING (html)
"""

_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)

_RANKED = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
item_terms AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
corpus AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS total FROM docs WHERE len(w) > 0),
postings AS (
  SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM docs) GROUP BY ALL
),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, corpus WHERE term IN (SELECT term FROM item_terms) GROUP BY term, n_docs
),
scores AS (
  SELECT item_id, r, doc_id, CAST(sum(
    w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // total)))
  ) AS BIGINT) AS score
  FROM postings JOIN weights USING (term) JOIN item_terms USING (term), corpus
  GROUP BY item_id, r, doc_id
),
ranked AS (
  SELECT item_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE = {
    "op3_quality_rules": _QUALITY,
    "op4_url_filters": _URLS,
    "op8_decontamination": _CONTAMINATION,
    "op10_warc_archives": _ARCHIVES,
    "op12_lexical_search": _RANKED,
}
