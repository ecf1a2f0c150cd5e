"""The numbered queries as SQL, where SQL says the same."""

from __future__ import annotations

from tallyhouse.llm.urls import RULES, THRESHOLD, VOCABULARY

WORD = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS x FROM d, unnest(generate_series(1, len(w) - 12)) AS s(i)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY x) AS first FROM g) WHERE first < doc_id),
c AS (SELECT DISTINCT doc_id, i + k AS p FROM r, unnest(generate_series(0, 12)) AS s(k)),
o AS (SELECT doc_id, list(p ORDER BY p) AS p, count(*) AS n FROM c GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN n IS NULL THEN w
    ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(p, x[2])), lambda x: x[1]) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN o USING (doc_id)
"""

_NORMAL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3 = rf"""
WITH d AS (SELECT doc_id, {_NORMAL} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item_id, {_NORMAL} AS w FROM benchmark),
i AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[a:a + least(len(w), 10) - 1], ' ') AS x
  FROM b, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS s(a) WHERE len(w) > 0),
k AS (SELECT DISTINCT k FROM i),
g AS (SELECT doc_id, a, k, array_to_string(w[a:a + k - 1], ' ') AS x FROM d, k, unnest(generate_series(1, len(w) - k + 1)) AS s(a)),
m AS (SELECT doc_id, a, k, item_id FROM g JOIN i USING (k, x)),
h AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(a, a + k - 1)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

OP8 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM documents),
g AS (SELECT r, i, array_to_string(w[i:i + 2], ' ') AS x FROM d, unnest(generate_series(1, len(w) - 2)) AS s(i)),
h AS (SELECT r, count(DISTINCT i + k) AS n FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM g), unnest([0, 1, 2]) AS s(k) WHERE n > 1 GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
  coalesce(h.n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines, (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_capitals
  FROM d LEFT JOIN h USING (r)),
f AS (SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT + 4 * (100 * n_symbols > 40 * n_words)::BIGINT
  + 8 * (100 * n_dup_lines > 50 * n_lines)::BIGINT + 16 * (100 * n_capitals > 40 * word_chars)::BIGINT + 32 * (word_chars > 40 * n_words)::BIGINT
  + 64 * (word_chars < 2 * n_words)::BIGINT + 128 * (100 * n_repeat_words > 20 * n_words)::BIGINT AS failed FROM m)
SELECT *, failed & 3 <> 0 AS base_failed, failed & 127 = 0 AS kept FROM f
"""

_TERMS = ", ".join(f"{{'t': '{t}', 'w': {w}}}" for t, w in VOCABULARY.items())
_RULES = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)

OP12 = rf"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM p),
u AS (SELECT * FROM (VALUES {_RULES}) AS u(verdict, host, path)),
f AS (SELECT r, u.host || u.path AS rule, u.verdict, row_number() OVER (PARTITION BY r ORDER BY length(u.host || u.path) DESC, length(u.host) DESC) AS k
  FROM s JOIN u ON (s.host = u.host OR ends_with(s.host, '.' || u.host)) AND starts_with(s.path, u.path)),
m AS (SELECT s.*, list_filter([{_TERMS}], lambda x: regexp_matches(translate(host || path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(^|[^a-z])' || x.t || '([^a-z]|$)')) AS terms FROM s),
w AS (SELECT *, coalesce(list_sum(list_transform(terms, lambda x: x.w)), 0)::BIGINT AS weight FROM m)
SELECT page_id, w.host, w.path, f.rule, coalesce(f.verdict, CASE WHEN weight >= {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict, weight,
  len(list_filter(terms, lambda x: x.w >= {THRESHOLD}))::BIGINT AS n_strict, len(list_filter(terms, lambda x: x.w < {THRESHOLD}))::BIGINT AS n_soft
FROM w LEFT JOIN f ON w.r = f.r AND f.k = 1
"""

ORACLE_SQL = {"op1_substring_dedup": OP1, "op3_decontamination": OP3, "op8_quality_rules": OP8, "op12_url_filter": OP12}
