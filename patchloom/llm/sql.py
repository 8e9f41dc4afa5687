"""DuckDB equivalents of the training-data queries that SQL can express."""

from __future__ import annotations

QUALITY = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
win AS (
  SELECT doc_id, unnest(range(1, len(words) - 6)) AS p, words FROM w WHERE len(words) >= 8),
keyed AS (SELECT doc_id, p, array_to_string(words[p:p + 7], ' ') AS k FROM win),
twice AS (SELECT doc_id, p FROM keyed QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
hit AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 8)) AS q FROM twice) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(hit.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(length(regexp_replace(t, '[^A-Z]', '', 'g')) AS BIGINT) AS n_capitals
  FROM w LEFT JOIN hit ON w.doc_id = hit.doc_id),
b AS (
  SELECT *, n_words < 20 AS r0, 100 * n_repeat_words > 30 * n_words AS r1, 100 * n_symbols > 30 * n_words AS r2,
         100 * n_dup_lines > 60 * n_lines AS r3, word_chars > 25.0 * n_words AS r4, 100 * n_capitals > 60 * word_chars AS r5
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r0 OR r1 AS base_failed,
       NOT (r0 OR r1 OR r2 OR r3 OR r4 OR r5) AS kept,
       CAST(r0::INT + 2 * r1::INT + 4 * r2::INT + 8 * r3::INT + 16 * r4::INT + 32 * r5::INT AS BIGINT) AS fail_bits
FROM b
"""

DECONTAMINATE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS size, array_to_string(words[p:p + least(len(words), 10) - 1], ' ') AS k
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS p FROM b WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
grams AS (
  SELECT doc_id, size, p, array_to_string(words[p:p + size - 1], ' ') AS k
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS p FROM d, sizes WHERE len(words) >= size)),
found AS (SELECT doc_id, p, g.size, item_id FROM grams g JOIN win USING (size, k)),
hits AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM found GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(hits.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256,
       coalesce(hits.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hits ON d.doc_id = hits.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""

NEAR_DEDUP = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(words[p:p + 3], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS p FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM both_ JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
e AS (SELECT x AS a, y AS b FROM link UNION ALL SELECT y, x FROM link),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
least_ AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce(least_.b, w.doc_id)) AS component_id,
       w.doc_id <= coalesce(least_.b, w.doc_id) AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN least_ ON w.doc_id = least_.a
"""

ORACLES = {
    "op1_near_dedup": NEAR_DEDUP,
    "op5_decontaminate": DECONTAMINATE,
    "op7_quality_rules": QUALITY,
}
