"""Connected components of an edge table by hooking and pointer jumping, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from erpweave.llm.stored import stored


def _flattened(parents: DataFrame) -> DataFrame:
    """node and up with every chain of parents replaced by its end (up < node throughout)."""
    spark = parents.sparkSession
    while True:
        upper = parents.select(F.col("node").alias("_n"), F.col("up").alias("_u"))
        jumped = parents.join(upper, F.col("up") == F.col("_n"), "left").select(
            "node", F.coalesce("_u", "up").alias("up"), F.col("_u").isNotNull().alias("moved")
        )
        parents = stored(spark, jumped, "cc-jump")
        if parents.filter("moved").isEmpty():
            return parents.select("node", "up")
        parents = parents.select("node", "up")


def through(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) with ra and rb, the roots of their ends by ``roots`` (node, root)."""
    ra = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    rb = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    return (
        pairs.join(ra, "a", "left")
        .join(rb, "b", "left")
        .select("a", "b", F.coalesce("ra", "a").alias("ra"), F.coalesce("rb", "b").alias("rb"))
    )


def components(edges: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """node and root (the smallest node of its component) for each node that is not a root itself.

    ``roots`` may hold the components found so far; only edges between them are then worked
    on. Each round hooks every node to its smallest neighbour, follows the hooks to their
    ends (doubling the distance each time), and goes on with the edges that still join two
    roots. All tables are stored, so Spark broadcasts those that are small by their size.
    """
    spark = edges.sparkSession
    while True:
        seen = edges if roots is None else through(edges, roots).select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        open_ = seen.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        edges = stored(spark, open_, "cc-edges")
        if edges.isEmpty():
            return roots if roots is not None else edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        hooks = stored(spark, edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up")), "cc-hooks")
        found = _flattened(hooks).select("node", F.col("up").alias("root"))
        if roots is not None:
            upper = found.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
            moved = roots.join(upper, F.col("root") == F.col("_n"), "left").select("node", F.coalesce("_r", "root").alias("root"))
            found = moved.unionByName(found)
        roots = stored(spark, found, "cc-roots")
