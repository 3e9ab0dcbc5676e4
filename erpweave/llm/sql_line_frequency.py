"""DuckDB SQL of the quality rules: windows and lines as rows, counts by grouping."""

SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
g AS (
    SELECT r, p.i AS i, w[p.i:p.i + 7] AS gram FROM d, LATERAL (SELECT unnest(range(1, len(w) - 6)) AS i) p WHERE len(w) >= 8),
a AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT r, count(DISTINCT i + o.o) AS n FROM a, (SELECT unnest(range(0, 8)) AS o) o GROUP BY r),
l AS (
    SELECT r, source, text, line, lower_line, n FROM (
        SELECT r, source, text, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
               translate(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ' '),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_line
        FROM (SELECT r, source, text, unnest(string_split(text, chr(10))) AS line FROM d))
    WHERE n > 0),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM l GROUP BY r),
hosts AS (SELECT source, count(DISTINCT text) AS n FROM d GROUP BY source),
often AS (
    SELECT l.source, l.lower_line FROM l JOIN hosts ON l.source IS NOT DISTINCT FROM hosts.source
    GROUP BY l.source, l.lower_line, hosts.n HAVING count(DISTINCT l.text) > greatest(10.0, 0.05::DOUBLE * hosts.n)),
gone AS (
    SELECT r, sum(n) AS n FROM l SEMI JOIN often ON l.source IS NOT DISTINCT FROM often.source AND l.lower_line = often.lower_line
    GROUP BY r),
f AS (
    SELECT d.doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
           coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
           coalesce(gone.n, 0)::BIGINT AS n_removed_words
    FROM d LEFT JOIN c ON d.r = c.r LEFT JOIN dup ON d.r = dup.r LEFT JOIN gone ON d.r = gone.r),
v AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND NOT (n_words - n_removed_words < 0.3::DOUBLE * n_words) AS kept FROM v
"""
