"""DuckDB SQL of the conversation trie: nodes as list prefixes, subtrees by their prefixes."""

from erpweave.llm.sql_merkle import CRC32

SQL = f"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
           md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS m
    FROM conversations WHERE conv_id IS NOT NULL),
o AS (
    SELECT conv_id,
           list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, m) AS own,
           {CRC32.format(x="conv_id")} % 4 AS h
    FROM t GROUP BY conv_id),
r AS (
    SELECT o.conv_id, list_concat(coalesce(b.own[1:o.h], []), o.own[o.h + 1:]) AS seq
    FROM o LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 20),
m AS (
    SELECT conv_id, seq[1:d.d] AS node, d.d AS depth, len(seq) AS n FROM r, LATERAL (SELECT unnest(range(0, len(seq) + 1)) AS d) d),
k AS (
    SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           CASE WHEN depth = 0 THEN 0
                ELSE len(regexp_extract_all(node[-1].text, '[^\\x20\\x09-\\x0D]+')) END AS words,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
    FROM m GROUP BY node, depth),
c AS (SELECT k.node, count(*) AS n_children FROM k JOIN k x ON x.depth = k.depth + 1 AND x.node[1:x.depth - 1] = k.node GROUP BY k.node),
f AS (SELECT k.*, coalesce(c.n_children, 0) AS n_children FROM k LEFT JOIN c ON c.node = k.node),
u AS (
    SELECT node[1:d.d] AS top, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
           sum((n_convs - 1) * words) AS saved_tokens
    FROM f, LATERAL (SELECT unnest(range(0, depth + 1)) AS d) d GROUP BY 1)
SELECT f.conv_id::BIGINT AS conv_id, f.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id,
       f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children, u.n_leaves::BIGINT AS n_leaves,
       u.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN u ON u.top = f.node LEFT JOIN k p ON p.depth = f.depth - 1 AND p.node = f.node[1:f.depth - 1]
"""
