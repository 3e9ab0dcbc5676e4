"""DuckDB SQL of the top-k query: every query row against every other row."""

SQL = """
WITH v AS (SELECT row_number() OVER () AS row, vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
           WHERE embedding IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])),
s AS (SELECT q.row, q.vec_id AS query_id, v.vec_id, list_inner_product(q.v, v.v)::BIGINT AS score
      FROM v q JOIN v ON q.row <> v.row WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
