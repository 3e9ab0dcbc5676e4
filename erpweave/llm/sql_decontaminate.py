"""DuckDB SQL of the decontamination query."""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
p AS (SELECT item_id, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS k0, w FROM b WHERE len(w) > 0),
pat AS (SELECT DISTINCT item_id, size, array_to_string(w[k0:k0 + size - 1], ' ') AS words FROM p),
sizes AS (SELECT DISTINCT size FROM pat),
o AS (SELECT doc_id, size, k0, array_to_string(w[k0:k0 + size - 1], ' ') AS words
      FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k0 FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT doc_id, item_id, k0, o.size FROM o JOIN pat USING (size, words)),
pos AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(k0, k0 + size)) AS k FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
       FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""
