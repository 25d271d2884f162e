"""DuckDB counterparts of the queries that SQL can express, written without the library's code."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD_JOIN = rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
),
shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
    ELSE list_transform(range(1, len(w) - 3), lambda k: w[k:k + 4]) END) AS s
  FROM split
),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
),
link AS (
  SELECT x, y FROM shared JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y
  WHERE 100 * shared.n >= 80 * (a.n + b.n - shared.n)
),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x
)
SELECT documents.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(y) AS component_id
FROM documents JOIN reach ON x = documents.doc_id LEFT JOIN size ON size.doc_id = documents.doc_id
GROUP BY documents.doc_id
"""

_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

WINNOWING = f"""
WITH item AS (
  SELECT item_id, {_WORDS} AS w, least(13, len({_WORDS})) AS n FROM benchmark
),
wanted AS (
  SELECT DISTINCT item_id, n,
         unnest(list_transform(range(1, len(w) - n + 2), lambda k: w[k:k + n - 1])) AS win
  FROM item WHERE n > 0
),
split AS (SELECT doc_id, {_WORDS} AS w FROM documents),
placed AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS k,
         unnest(list_transform(range(1, len(w) - n + 2), lambda k: w[k:k + n - 1])) AS win
  FROM split, (SELECT DISTINCT n FROM wanted)
),
hit AS (SELECT doc_id, k, n, item_id FROM placed JOIN wanted USING (n, win)),
word AS (SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + n)) AS place FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items,
         string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM split LEFT JOIN word USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_HIDDEN = (
    r"'[<\[]\\*(?:(?:s|/s|role|/role|image|audio|document)>|(?:INST|/INST|TURN|/TURN)\])'"
)

CHAT_PARTS = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       sum(length(text) + len(regexp_extract_all(text, {_HIDDEN}))
         + CASE role WHEN 'assistant' THEN 7 WHEN 'user' THEN 15
           ELSE 28 + length(role) + len(regexp_extract_all(role, {_HIDDEN})) END)::BIGINT
         AS formatted_chars
FROM turns GROUP BY conv_id
"""
