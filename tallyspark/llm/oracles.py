"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

STOP = """'the','of','and','to','in','a','is','that','for','it','was','on','be','with','as','by','at','from','this','are','or','an','not','which',
'der','die','das','und','den','von','zu','mit','ist','des','im','für','auf','ein','eine','nicht','als','auch','es','dem',
'le','la','les','de','et','un','une','du','que','qui','dans','est','en','pour','pas','sur','au','il','elle',
'el','los','las','y','por','con','no','se','del','lo','para','su','al'"""

OP3 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, list_slice(w, i, i + 7) AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n FROM (
    SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM again) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(body, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines,
    len(list_filter(w, lambda x: rtrim(lower(x), '.,;:!?') IN ({STOP}))) AS n_stop_words,
    len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN covered c ON c.doc_id = d.doc_id),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed
  AND word_chars >= CAST(2.5 AS DOUBLE) * n_words AND word_chars <= CAST(10 AS DOUBLE) * n_words
  AND n_symbols <= CAST(0.1 AS DOUBLE) * n_words AND n_stop_words >= CAST(0.04 AS DOUBLE) * n_words
  AND n_letter_words >= CAST(0.7 AS DOUBLE) * n_words AND n_dup_lines <= CAST(0.4 AS DOUBLE) * n_lines
  AND n_ellipsis_lines <= CAST(0.5 AS DOUBLE) * n_lines AND n_repeat_words <= CAST(0.3 AS DOUBLE) * n_words AS kept
FROM f
"""

OP1 = """
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
w AS (
  SELECT doc_id, i, ls[i] || chr(10) || ls[i + 1] || chr(10) || ls[i + 2] AS win
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS i FROM l)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS n FROM w) WHERE n > 1),
covered AS (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) AS k FROM later),
gone AS (SELECT doc_id, list(k) AS ks FROM covered GROUP BY doc_id)
SELECT l.doc_id,
  CASE WHEN ks IS NULL THEN text ELSE array_to_string(
    list_transform(list_filter(range(1, len(ls) + 1), lambda k: NOT list_contains(ks, k)), lambda k: ls[k]), chr(10)) END AS text,
  CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed
FROM l LEFT JOIN gone USING (doc_id)
"""

OP2 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP4 = """
SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS text_bytes, sha256(text) AS text_sha256, CAST(0 AS BIGINT) AS full_tiers FROM documents
"""

OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS anchor_id, c.vec_id AS other_id, q.label = c.label AS alike, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS r FROM s WHERE alike) WHERE r <= 5),
n AS (
  SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.alike AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

SQL = {
    "op1_line_dedup": OP1,
    "op2_exact_top_k": OP2,
    "op3_quality_rules": OP3,
    "op4_sharding": OP4,
    "op13_hard_negatives": OP13,
}
