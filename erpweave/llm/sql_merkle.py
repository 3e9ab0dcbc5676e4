"""DuckDB SQL of the Merkle manifest: recursive levels, windows for siblings, a fold per document."""

_FIELD = "coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(x=x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: Unsigned CRC-32 of a decimal number: its bytes are xored in, and 8 shifts (-1) follow each.
CRC32 = """xor(4294967295, list_reduce(
    flatten(list_transform(string_split({x}::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END,
    4294967295))"""

SQL = f"""
WITH RECURSIVE
l AS (
    SELECT row_number() OVER () AS r, doc_id, source, {_leaf("text")} AS leaf,
           CASE WHEN {CRC32.format(x="doc_id")} % 5 = 0
                THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
    FROM documents),
p AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
           count(*) OVER (PARTITION BY source) AS n
    FROM l),
a AS (
    SELECT source, 0 AS level, i, n, leaf AS digest FROM p
    UNION ALL
    SELECT source, level + 1, i // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY i))
    FROM a WHERE n > 1 GROUP BY source, level, i // 16, n),
s AS (
    SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n
    FROM a WHERE n = 1),
b AS (
    SELECT 100 AS level, i, n, subroot AS digest FROM s
    UNION ALL
    SELECT level + 1, i // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY i))
    FROM b WHERE n > 1 GROUP BY level, i // 16, n),
steps AS (
    SELECT p.r, k.level, k.lefts, k.rights
    FROM p JOIN (
        SELECT source, level, i,
               coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lefts,
               coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rights
        FROM a WHERE n > 1 WINDOW w AS (PARTITION BY source, level, i // 16 ORDER BY i)) k
      ON p.source IS NOT DISTINCT FROM k.source AND k.i = p.i // (16 ** k.level)::BIGINT
    UNION ALL
    SELECT p.r, k.level, k.lefts, k.rights
    FROM p JOIN s ON p.source IS NOT DISTINCT FROM s.source JOIN (
        SELECT level, i,
               coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lefts,
               coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rights
        FROM b WHERE n > 1 WINDOW w AS (PARTITION BY level, i // 16 ORDER BY i)) k
      ON k.i = s.i // (16 ** (k.level - 100))::BIGINT),
paths AS (
    SELECT r, string_agg(lefts || rights, '' ORDER BY level) AS siblings, list(lefts || '|' || rights ORDER BY level) AS path
    FROM steps GROUP BY r),
f AS (
    SELECT p.doc_id, p.leaf, s.subroot, (SELECT digest FROM b WHERE n = 1) AS root,
           sha256(coalesce(paths.siblings, '')) AS proof_sha256,
           list_reduce(coalesce(paths.path, []), lambda d, x: sha256(split_part(x, '|', 1) || d || split_part(x, '|', 2)),
                       coalesce(p.changed, p.leaf)) AS folded_root
    FROM p JOIN s ON p.source IS NOT DISTINCT FROM s.source LEFT JOIN paths ON p.r = paths.r)
SELECT *, folded_root = root AS verified FROM f
"""
