"""Merkle manifest of a data set: digests, proofs and tamper checks as a nested-struct rollup.

Every document is a leaf; per source 16 consecutive nodes become one until one is left (the
subroot), and the subroots, in order of their source, become the root in the same way. A
node's digest is the lower-case hex SHA-256 of its children's digests as text.

A leaf's rank within its source is cut into hexadecimal digits. Blocks of 256 leaves (two
digits) are rolled up by grouping the digits away one after the other, each group nesting
its children as structs, so that a block's row holds its small tree. The blocks' digests are
the leaves of the next tier, and so on: a source of n documents has log256(n) tiers, each a
256th of the one before. Going down again, a block's own path to the root meets its nested
tree by grouping on the block (no join of nodes and leaves), and two explodes emit every
child with its siblings. A row never holds more than 256 nodes, whatever the source's size;
ranks come from sorted ranges (``ranks.ranked``), so a source with a third of all rows
spreads over many tasks.

Defined cases: a null field is ``-`` and differs from an empty text; a null source is a
source of its own, before all others; null ids come first in their source; rows of equal
source and id are ordered by their leaf, so equal rows are leaves of their own that can
stand for each other; a source of one document has its leaf as subroot, one source its
subroot as root; an empty table gives an empty result; only the five named columns count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erpweave.llm.ranks import ranked
from erpweave.llm.stored import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BITS = 4  # of one digit: 16 children a node
BLOCK = 2 * BITS
WIDTH = 1 << BITS
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PATH = "array<struct<left:string,right:string>>"


def _field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(row: dict[str, Column]) -> Column:
    """Digest of one document."""
    return F.sha2(F.concat(*[_field(row[name]) for name in FIELDS]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """key, source, doc_id, leaf and changed (the tampered row's leaf, null where not tampered)."""
    row = {name: F.col(name) for name in FIELDS}
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return docs.select(
        source_key(F.col("source")).alias("key"),
        F.col("source").cast("string").alias("source"),
        F.col("doc_id"),
        leaf(row).alias("leaf"),
        F.when(tampered, leaf({**row, "text": F.translate("text", UPPER, LOWER)})).alias("changed"),
    )


def source_key(source: Column) -> Column:
    """A non-null key that sorts like the source, null first (``n`` is before ``s``)."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def _parts(count: Column, bits: int) -> Column:
    """Nodes that ``count`` nodes become when 2**bits of them make one."""
    return F.shiftright(count + ((1 << bits) - 1), bits)


def _joined(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda x: x["digest"]), "")


def blocks_of(nodes: DataFrame) -> DataFrame:
    """One row per block of ``nodes`` (key, n, pos, digest, item): digest and nested ``runs``.

    With one node left in the group nothing more is hashed: the node itself goes up.
    """
    digits = nodes.select(
        "key",
        "n",
        F.shiftright("pos", BLOCK).alias("block"),
        F.shiftright("pos", BITS).bitwiseAND(WIDTH - 1).cast("int").alias("high"),
        F.col("pos").bitwiseAND(WIDTH - 1).cast("int").alias("low"),
        "digest",
        "item",
    ).repartition("key", "block")
    runs = digits.groupBy("key", "block", "high").agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("low", "digest", "item"))).alias("items")
    )
    runs = runs.withColumn(
        "digest", F.when(F.col("n") > 1, F.sha2(_joined(F.col("items")), 256)).otherwise(F.col("items")[0]["digest"])
    )
    blocks = runs.groupBy("key", "block").agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("high", "digest", "items"))).alias("runs")
    )
    return blocks.withColumn(
        "digest", F.when(F.col("n") > WIDTH, F.sha2(_joined(F.col("runs")), 256)).otherwise(F.col("runs")[0]["digest"])
    )


@dataclass
class Tree:
    """The tiers of blocks, lowest first, and one row (key, digest) per group."""

    tiers: list[DataFrame]
    tops: DataFrame


def rollup(nodes: DataFrame, name: str) -> Tree:
    """Roll ``nodes`` (key, n, pos, digest, item) up until one is left in every group."""
    spark = nodes.sparkSession
    most = nodes.agg(F.max("n")).first()[0] or 0
    tiers: list[DataFrame] = []
    while not tiers or most > 1:
        tiers.append(stored(spark, blocks_of(nodes), f"{name}-tier{len(tiers)}"))
        nodes = tiers[-1].select(
            "key",
            _parts(F.col("n"), BLOCK).alias("n"),
            F.col("block").alias("pos"),
            "digest",
            F.struct(F.col("block").alias("pos")).alias("item"),
        )
        most = -(-most // (1 << BLOCK))
    return Tree(tiers, nodes.select("key", "pos", "digest"))


def _siblings(digests: Column, place: Column) -> Column:
    """The digests before and after ``place`` in its run, as text."""
    return F.struct(
        F.array_join(F.slice(digests, 1, place), "").alias("left"),
        F.array_join(F.slice(digests, place + 2, F.lit(WIDTH)), "").alias("right"),
    )


def _down(blocks: DataFrame, above: DataFrame, carried: list[str]) -> DataFrame:
    """Children of ``blocks`` with their whole path; ``above`` has key, pos (the block), path and ``carried``."""
    own = blocks.select(
        "key",
        "block",
        F.struct("n", "runs").alias("tree"),
        F.lit(None).cast(above.select(F.struct("path", *carried)).schema[0].dataType).alias("up"),
    )
    up = above.select(
        "key",
        F.col("pos").alias("block"),
        F.lit(None).cast(own.schema["tree"].dataType).alias("tree"),
        F.struct("path", *carried).alias("up"),
    )
    met = own.unionByName(up).groupBy("key", "block").agg(
        F.first("tree", ignorenulls=True).alias("tree"), F.first("up", ignorenulls=True).alias("up")
    )
    runs = met.select(
        "key",
        "block",
        F.col("tree.n").alias("n"),
        "up",
        F.transform("tree.runs", lambda r: r["digest"]).alias("digests"),
        F.posexplode("tree.runs").alias("high", "run"),
    )
    empty = F.array().cast(PATH)
    runs = runs.select(
        "key",
        "block",
        "n",
        "up",
        "high",
        F.when(F.col("n") > WIDTH, F.array(_siblings(F.col("digests"), F.col("high")))).otherwise(empty).alias("over"),
        F.transform("run.items", lambda x: x["digest"]).alias("digests"),
        F.posexplode("run.items").alias("low", "node"),
    )
    first = F.when(F.col("n") > 1, F.array(_siblings(F.col("digests"), F.col("low")))).otherwise(empty)
    return runs.select(
        "key",
        (F.shiftleft("block", BLOCK) + F.shiftleft("high", BITS) + F.col("low")).alias("pos"),
        F.col("node.item").alias("item"),
        F.col("node.digest").alias("digest"),
        F.concat(first.cast(PATH), F.col("over").cast(PATH), F.col("up.path")).alias("path"),
        *[F.col(f"up.{c}").alias(c) for c in carried],
    )


def unroll(tree: Tree, above: DataFrame, carried: list[str], name: str) -> DataFrame:
    """Every lowest node with its path to the top, then ``above``'s path; ``above`` has one row per key."""
    spark = above.sparkSession
    for level, blocks in reversed(list(enumerate(tree.tiers))):
        above = _down(blocks, above, carried)
        if level:
            above = stored(spark, above.drop("item", "digest"), f"{name}-paths{level}")
    return above


def folded(start: Column, path: Column) -> Column:
    """The root recomputed from a leaf and its siblings."""
    return F.aggregate(path, start, lambda digest, p: F.sha2(F.concat(p["left"], digest, p["right"]), 256))


def proofs(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, changed, subroot, root and path (siblings per level) of every document."""
    spark = docs.sparkSession
    nodes = ranked(stored(spark, leaves(docs), "merkle-leaves"), "key", ["doc_id", "leaf"], "merkle")
    nodes = nodes.select(
        "key", "n", "pos", F.col("leaf").alias("digest"), F.struct("doc_id", "source", "changed").alias("item")
    )
    tree = rollup(stored(spark, nodes, "merkle-nodes"), "merkle")
    subroots = stored(
        spark, tree.tops.select(F.lit("root").alias("all"), F.col("key").alias("sub"), "digest"), "merkle-subroots"
    )
    sources = ranked(subroots, "all", ["sub"], "merkle-sources").select(
        F.col("all").alias("key"), "n", "pos", "digest", F.struct("sub").alias("item")
    )
    top = rollup(stored(spark, sources, "merkle-source-nodes"), "merkle-top")
    start = top.tops.select("key", "pos", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))
    over = unroll(top, start, ["root"], "merkle-top").select(
        F.col("item.sub").alias("key"),
        F.lit(0).cast("long").alias("pos"),
        "path",
        F.col("digest").alias("subroot"),
        "root",
    )
    found = unroll(tree, stored(spark, over, "merkle-over"), ["subroot", "root"], "merkle")
    return found.select(
        F.col("item.doc_id").alias("doc_id"),
        F.col("item.source").alias("source"),
        F.col("digest").alias("leaf"),
        F.col("item.changed").alias("changed"),
        "subroot",
        "root",
        "path",
    )


def manifest(docs: DataFrame) -> DataFrame:
    """Per document: leaf, subroot, root, the digest of its proof, and the check after tampering."""
    siblings = F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), "")
    return proofs(docs).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings, 256).alias("proof_sha256"),
        folded(F.coalesce("changed", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
