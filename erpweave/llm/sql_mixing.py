"""DuckDB SQL of the mixing query."""

SQL = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           md5('0:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(text, '')) AS h,
           row_number() OVER () AS line
    FROM documents),
s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
    FROM d GROUP BY source),
f AS (
    SELECT *, 2 * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total, sum(w) OVER () AS all_w,
           coalesce(sum(2 * source_size) OVER b, 0) AS full_cap, coalesce(sum(w) OVER b, 0) AS full_w
    FROM s WINDOW b AS (ORDER BY (2 * source_size)::DOUBLE / w, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (total - full_cap::DOUBLE) / (all_w - full_w)::DOUBLE AS own FROM f),
lv AS (SELECT own AS level, cap::DOUBLE / w AS ratio, source FROM l WHERE own * w <= cap
       ORDER BY cap::DOUBLE / w, source NULLS LAST LIMIT 1),
t AS (
    SELECT l.source, l.source_size,
           CASE WHEN lv.level IS NULL OR l.cap::DOUBLE / l.w < lv.ratio THEN l.cap::DOUBLE
                ELSE least(l.w * lv.level, l.cap::DOUBLE) END AS target
    FROM l LEFT JOIN lv ON true),
g AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
c AS (
    SELECT d.doc_id, d.size, d.h, g.source_size, g.target, g.whole, g.target - g.whole * g.source_size AS goal,
           sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.line) AS upto, d.size AS n
    FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       whole + CASE WHEN goal > 0 AND 2 * upto - n <= 2 * goal THEN 1 ELSE 0 END AS copies,
       (size * (whole + CASE WHEN goal > 0 AND 2 * upto - n <= 2 * goal THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""
