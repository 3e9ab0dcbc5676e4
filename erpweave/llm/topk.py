"""Exact top-k inner products by Fagin's threshold algorithm over sorted per-dimension lists.

Components x become the integers floor(256 * x). Vectors are stored once as integers with a
row number and dealt out over blocks by a hash of it; a block keeps, per dimension, the order of its vectors by that component. A query
reads all its lists in parallel (from the top where its own component is positive, from the
bottom where negative) to growing depths, scores every vector met, and stops as soon as the
best that an unseen vector can reach (the components at the current depth, times the query's)
is below its kth score. Each block gives its k best per query; the best k of these are the
answer, ties to the smaller vec_id.

Queries come in blocks too: a (vector block, query block) pair is one task's group, of at
most about ``BLOCK`` vectors and ``QUERIES`` queries whatever the size of the table.

Defined cases: vectors that are null or hold null, NaN or infinite components take no part;
rows that repeat a vec_id are rows of their own, as queries and as candidates (each such
query row has its own ranks, and the others of its vec_id are its candidates); a row is never
its own neighbour; a null vec_id takes no part; a shorter vector has zeros where others go on; integers are held within 64 bits;
no valid vectors give an empty result.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from erpweave.llm.stored import stored

BLOCK = 8192
QUERIES = 1024
FIRST_DEPTH = 16
_LIMIT = (1 << 63) - 1


def valid_vectors(table: DataFrame) -> DataFrame:
    """vec_id and the integer vector v of the rows that take part."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long"))
    some = table.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & good)
    return some.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = column.combine_chunks()
    size = flat.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(flat), dims), np.int64)
    row = np.repeat(np.arange(len(flat)), size)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = flat.flatten().to_numpy(zero_copy_only=False)
    return out


class SortedLists:
    """The vectors of a block with one sorted list of them per dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray | None = None):
        self.ids, self.vectors = ids, vectors
        self.rows = ids if rows is None else rows
        self.order = np.argsort(vectors, axis=0, kind="stable")  # ascending, per dimension
        self.largest = int(np.abs(vectors.astype(np.float64)).max(initial=0))
        self.as_kind: dict[type, np.ndarray] = {}

    def _kind(self, query: np.ndarray) -> type:
        """The cheapest type in which every partial sum of the inner products is exact."""
        most = self.largest * float(np.abs(query.astype(np.float64)).sum())
        return np.float32 if most < 2.0**23 else np.float64 if most < 2.0**52 else object

    def best(self, own: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, vec_id) of the k best, best first; the row numbered ``own`` is left out."""
        n = len(self.ids)
        kind = self._kind(query)
        if kind not in self.as_kind:
            self.as_kind[kind] = self.vectors.astype(kind)
        vectors, q = self.as_kind[kind], query.astype(kind)
        used = np.flatnonzero(query != 0)
        up = query[used] > 0
        unseen = self.rows != own
        ids = np.zeros(0, np.int64)
        scores = np.zeros(0, kind)
        depth, upto = 0, min(FIRST_DEPTH, n)
        while True:
            met = np.zeros(n, bool)
            if len(used):
                steps = np.arange(depth, upto)
                met[self.order[steps][:, used[~up]]] = True
                met[self.order[n - 1 - steps][:, used[up]]] = True
                met &= unseen
            else:
                met, upto = unseen.copy(), n
            unseen &= ~met
            new = np.flatnonzero(met)
            value = vectors[new] @ q
            if len(new) > k:  # only those that reach the kth of the new ones can be among the best
                keep = value >= np.partition(value, len(value) - k)[len(value) - k]
                new, value = new[keep], value[keep]
            ids = np.concatenate([ids, self.ids[new]])
            scores = np.concatenate([scores, value])
            top = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[top], scores[top]
            if upto == n or not unseen.any():
                break
            edge = vectors[self.order[np.where(up, n - upto, upto - 1), used], used]
            if len(ids) == k and scores[-1] > edge @ q[used]:
                break
            depth, upto = upto, min(2 * upto, n)
        return [(int(s), int(i)) for s, i in zip(scores, ids, strict=True)]


def top_k(table: DataFrame, is_query: Column, k: int = 5, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` best for each row with ``is_query``."""
    numbered = valid_vectors(table).withColumn("row", F.monotonically_increasing_id())
    vectors = stored(table.sparkSession, numbered, "topk-vectors")
    size = vectors.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q"), F.max(F.size("v")).alias("d")).first()
    n_blocks, q_blocks, dims = max(1, -(-size.n // block)), max(1, -(-size.q // queries)), int(size.d or 0)

    def spread(df: DataFrame, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
        """Every row in its own block, once for each block of the other side."""
        return df.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(own_n))).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other_n - 1).cast("long")))
        )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        if left.num_rows and right.num_rows:
            lists = SortedLists(left.column("vec_id").to_numpy(), _matrix(left.column("v"), dims), left.column("row").to_numpy())
            named = zip(right.column("vec_id").to_numpy().tolist(), right.column("row").to_numpy().tolist(), strict=True)
            for (name, own), query in zip(named, _matrix(right.column("v"), dims), strict=True):
                out += [(name, own, i, max(-_LIMIT, min(_LIMIT, s))) for s, i in lists.best(own, query, k)]
        return pa.table({name: pa.array([row[c] for row in out], pa.int64()) for c, name in enumerate(("query_id", "row", "vec_id", "score"))})

    base = spread(vectors, "vb", n_blocks, "qb", q_blocks)
    asked = spread(vectors.filter(is_query), "qb", q_blocks, "vb", n_blocks).select(*base.columns)
    found = base.groupBy("vb", "qb").cogroup(asked.groupBy("vb", "qb")).applyInArrow(run, "query_id long, row long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("vec_id")))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
