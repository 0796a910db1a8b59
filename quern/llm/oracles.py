"""DuckDB SQL of the queries whose whole result it can express.

Windows and sets are compared here as strings, and every pair that shares a shingle is
looked at, so the SQL holds for tables of some thousand documents; the operators are not
built like this.
"""

from __future__ import annotations

import string

LOWER = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
NEWLINE, BACKSLASH = "chr(10)", "chr(92)"


def _words(pattern: str) -> str:
    return f"coalesce(regexp_extract_all({LOWER}, '{pattern}'), [])"


def _window(k: str) -> str:
    return f"array_to_string(w[p : p + {k} - 1], ' ')"


#: Equal sets are one class, named by its least id; reach holds the classes that links connect.
MINHASH = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words("[^\\x20\\x09-\\x0D]+")} AS w FROM documents),
placed AS (SELECT doc_id, w, least(3, len(w)) AS k, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS p FROM d WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, {_window("k")} AS s FROM placed),
sets AS (SELECT doc_id, count(*) AS n, sha256(string_agg(s, {NEWLINE} ORDER BY s)) AS digest FROM shingles GROUP BY doc_id),
classes AS (SELECT digest, min(doc_id) AS rep, min(n) AS n FROM sets GROUP BY digest),
known AS (SELECT rep, n, s FROM classes JOIN shingles ON doc_id = rep),
both_in AS (SELECT a.rep AS a, b.rep AS b, min(a.n) AS na, min(b.n) AS nb, count(*) AS shared
    FROM known a JOIN known b ON a.s = b.s AND a.rep < b.rep GROUP BY a.rep, b.rep),
links AS (SELECT a, b FROM both_in WHERE 100 * shared >= 85 * (na + nb - shared)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rep AS a, rep AS b FROM classes UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
least_of AS (SELECT a AS rep, min(b) AS component FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(sets.n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id, d.doc_id = coalesce(component, d.doc_id) AS kept
FROM d LEFT JOIN sets ON sets.doc_id = d.doc_id LEFT JOIN classes USING (digest) LEFT JOIN least_of USING (rep)
"""

_ESCAPED = f"replace(replace({{0}}, {BACKSLASH}, {BACKSLASH} || {BACKSLASH}), '<|', '<' || {BACKSLASH} || '|')"
_SAID = "<|im_end|><|im_start|>assistant ok"

#: A turn is <|im_start|>role, newline, text, <|im_end|>, newline: 24 signs besides role and text.
CHAT = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '{_SAID}'), (-1, 1, 'assistant', '{_SAID}'))
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || {NEWLINE} || text || {NEWLINE}, '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(24 + length(replace({_ESCAPED.format("role")}, {NEWLINE}, {BACKSLASH} || 'n')) + length({_ESCAPED.format("text")})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_words("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")} AS w FROM benchmark WHERE item_id IS NOT NULL),
item_places AS (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, {_window("k")} AS s FROM item_places),
doc_places AS (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d CROSS JOIN (SELECT DISTINCT k FROM windows) WHERE len(w) >= k),
found AS (SELECT r, p, doc.k AS k, item_id FROM (SELECT r, p, k, {_window("k")} AS s FROM doc_places) doc JOIN windows USING (s)),
hits AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(p, p + k)) AS at FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""
