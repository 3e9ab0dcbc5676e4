"""Prefix trie of conversations from padded turn-id matrices.

``rebuilt`` gives every conversation as the sequence of its turns' digests. Sequences are
ranked over the whole table by (sequence, conv_id), and every 1,024 ranks are a shard. A
shard task numbers its distinct turns, pads the sequences to a matrix of turn ids and sorts
it with ``np.lexsort`` (a sequence before its extensions). Where a column differs from the
row above, a node starts; OR-accumulated along the row, the mask marks the starts of all
deeper nodes too. ``np.add.reduceat`` and ``np.minimum.reduceat`` over the starts of one
depth give that depth's nodes, and every measure is a sum over rows: members, node starts one
column deeper (children), rows that end a run without extension (childless nodes), and words
from this column on less those of node starts (saved tokens).

Each shard also gets the row before and the row after it, so its masks are those of the whole
table. A node that a neighbour row shares is a boundary node: its parts go out by shard and
are added up on the way of a sorted stream, which also hashes the ids of its ending members
piece by piece, so that not even a node with a third of all conversations is gathered. Nodes
below a boundary node get its ``conv_id`` by a join on (shard, node).

Defined cases: rows of a null conv_id belong to no conversation and are left out; a null turn
comes first, equal turns are ordered by role and by the MD5 of their content; null role or
text counts as empty; repeated rows are turns of their own; a conversation left without turns
is a member of the root; an empty table gives an empty result; other columns are not read.
One conversation's digests (16 bytes a turn) must fit in a row; a shard's matrix is cut into
pieces of ``CELLS`` cells, or of one longer row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from erpweave.llm.mixing import word_count
from erpweave.llm.ranks import ranked
from erpweave.llm.stored import stored

SHARD = 1024
CELLS = 1 << 21
FAMILY = 20
HEADS = 4
DIGEST = 16

#: ``node`` and ``parent`` name boundary nodes (null otherwise); ``ends`` holds a boundary node's ids.
PARTS = (
    "shard long, piece long, node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends string, ends_sha256 string"
)
TOTALS = (
    "node binary, parent binary, shard long, conv_id long, depth long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def conversations_of(turns: DataFrame) -> DataFrame:
    """conv_id, digests (hex MD5 of role and text) and words of every conversation, in turn order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").alias("turn"),
            role.alias("role"),
            digest.alias("digest"),
            word_count(text).cast("int").alias("words"),
        ).alias("t"),
    )
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return listed.select("conv_id", F.col("t.digest").alias("digests"), F.col("t.words").alias("words"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, seq (16 bytes a turn) and words: h turns of the family's first conversation, then the own rest.

    h is the unsigned CRC-32 of the decimal conv_id modulo 4; the family of c starts at c - c % 20.
    """
    own = stored(turns.sparkSession, conversations_of(turns), "trie-conversations")
    first = own.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("base"),
        F.slice("digests", 1, HEADS - 1).alias("base_digests"),
        F.slice("words", 1, HEADS - 1).alias("base_words"),
    )
    own = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    )
    none = F.array()

    def sequence(name: str, kind: str):
        head = F.slice(F.coalesce(F.col(f"base_{name}"), none.cast(kind)), 1, F.col("h"))
        return F.concat(head, F.slice(name, F.col("h") + 1, F.size(name)))

    return own.join(first, "base", "left").select(
        "conv_id",
        F.unhex(F.array_join(sequence("digests", "array<string>"), "")).alias("seq"),
        sequence("words", "array<int>").alias("words"),
    )


def sharded(rows: DataFrame, size: int) -> DataFrame:
    """Rows by shard; a shard's neighbours (-1: the row before, 1: the row after) come along."""
    ordered = ranked(rows.withColumn("all", F.lit(0)), "all", ["seq", "conv_id"], "trie")
    shard, place = F.col("pos").cast("long"), F.col("pos") % size
    shard = F.floor(shard / size)
    mine = F.array(
        F.struct(shard.alias("shard"), F.lit(0).alias("side")),
        F.when((place == 0) & (F.col("pos") > 0), F.struct((shard - 1).alias("shard"), F.lit(1).alias("side"))),
        F.when((place == size - 1) & (F.col("pos") < F.col("n") - 1), F.struct((shard + 1).alias("shard"), F.lit(-1).alias("side"))),
    )
    copies = ordered.select(
        "pos", "conv_id", "seq", "words", F.explode(F.filter(mine, lambda x: x.isNotNull())).alias("at")
    )
    return copies.select("at.shard", "at.side", "pos", "conv_id", "seq", "words")


def _shared(a: bytes | None, b: bytes | None) -> int:
    """Turns that two sequences have in common from the start; -1 if there is no second sequence."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b)) // DIGEST
    x, y = (np.frombuffer(s[: n * DIGEST], np.uint8).reshape(n, DIGEST) for s in (a, b))
    differ = (x != y).any(axis=1)
    return int(differ.argmax()) if differ.any() else n


def _node_key(seq: bytes, depth: int) -> bytes:
    return hashlib.md5(seq[: depth * DIGEST]).digest()


def _ids(conv: np.ndarray) -> str:
    return ",".join(map(str, conv.tolist()))


def piece_nodes(
    seqs: list[bytes], words: list[np.ndarray], conv: np.ndarray, before: bytes | None, after: bytes | None
) -> dict[str, list]:
    """Nodes of consecutive rows between the sequences ``before`` and ``after`` (None at the ends)."""
    rows = len(seqs)
    lens = np.array([len(s) // DIGEST for s in seqs], np.int64)
    width = int(lens.max(initial=0))
    halves = np.frombuffer(b"".join(seqs), dtype=">u8").reshape(-1, 2)
    _, number = np.unique(halves, axis=0, return_inverse=True)
    inside = np.arange(width) < lens[:, None]
    ids = np.zeros((rows, width), np.int32)
    ids[inside] = number.ravel() + 1
    weight = np.zeros((rows, width), np.int64)
    weight[inside] = np.concatenate(words) if len(number) else 0

    order = np.lexsort((conv, *ids.T[::-1]))
    ids, inside, weight, lens, conv = ids[order], inside[order], weight[order], lens[order], conv[order]
    seqs = [seqs[i] for i in order]

    change = np.ones((rows, width), bool)
    change[1:] = ids[1:] != ids[:-1]
    held_before = _shared(seqs[0], before)
    change[0] = np.arange(width) >= held_before
    starts = np.logical_or.accumulate(change, axis=1) & inside
    held_after = _shared(seqs[-1], after)

    # Childless: the last of equal rows, not extended by the next row.
    extends = np.empty(rows, bool)
    differ = np.column_stack([change[1:], np.ones(rows - 1, bool)])
    extends[:-1] = differ.argmax(axis=1) >= lens[:-1]
    extends[-1] = held_after >= lens[-1]
    childless = (~extends).astype(np.int64)

    kept = weight * (inside & ~starts)
    tail = np.zeros((rows, width + 1), np.int64)
    tail[:, :width] = kept[:, ::-1].cumsum(axis=1)[:, ::-1]

    out: dict[str, list] = {k: [] for k in PARTS_NAMES}
    above_conv, above_node = None, None  # per row: the parent's conv_id and boundary key
    for depth in range(width + 1):
        # Local starts of this depth's nodes, and which rows they cover.
        if depth == 0:
            first = np.zeros(1, np.int64)
        else:
            local = starts[:, depth - 1].copy()
            local[0] = inside[0, depth - 1]
            first = np.flatnonzero(local)
        if not len(first):
            break
        member = lens >= depth
        # A node's rows stand together; rows of smaller depth lie before or after them.
        counted = np.add.reduceat(member.astype(np.int64), first)
        stop = first + counted
        smallest = np.minimum.reduceat(np.where(member, conv, np.iinfo(np.int64).max), first)
        leaves = np.add.reduceat(childless * member, first)
        saved = np.add.reduceat(tail[:, max(depth - 1, 0)] * member, first)
        children = (
            np.add.reduceat((starts[:, depth] & member).astype(np.int64), first) if depth < width else np.zeros_like(first)
        )
        ending = np.add.reduceat((lens == depth).astype(np.int64), first)
        node_of, conv_of = [None] * rows, np.zeros(rows, np.int64)
        for k, (a, b) in enumerate(zip(first.tolist(), stop.tolist())):
            outside = (a == 0 and held_before >= depth) or (b == rows and held_after >= depth)
            key = _node_key(seqs[a], depth) if outside else None
            parent = above_node[a] if depth else None
            conv_of[a:b] = smallest[k]
            if outside:
                node_of[a:b] = [key] * (b - a)
            ids_text = _ids(conv[a : a + ending[k]])
            out["node"].append(key)
            out["parent"].append(parent)
            out["conv_id"].append(int(smallest[k]))
            out["depth"].append(depth)
            out["parent_conv_id"].append(int(above_conv[a]) if depth and parent is None else None)
            out["n_convs"].append(int(counted[k]))
            out["n_children"].append(int(children[k]))
            out["n_leaves"].append(int(leaves[k]))
            out["saved_tokens"].append(int(saved[k]))
            out["ends"].append(ids_text if outside else None)
            out["ends_sha256"].append(None if outside else hashlib.sha256(ids_text.encode()).hexdigest())
        above_conv, above_node = conv_of, node_of
    return out


PARTS_NAMES = (
    "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends", "ends_sha256",
)
PARTS_TYPES = {
    "shard": pa.int64(), "piece": pa.int64(), "node": pa.binary(), "parent": pa.binary(), "conv_id": pa.int64(),
    "depth": pa.int64(), "parent_conv_id": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(),
    "n_leaves": pa.int64(), "saved_tokens": pa.int64(), "ends": pa.string(), "ends_sha256": pa.string(),
}


def _pieces(lens: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``CELLS`` padded cells, or of one row."""
    first = 0
    while first < len(lens):
        widest = np.maximum.accumulate(np.maximum(lens[first:], 1))
        fits = int(np.searchsorted(widest * np.arange(1, len(widest) + 1), CELLS, side="right"))
        last = first + max(fits, 1)
        yield first, last
        first = last


def shard_nodes(table: pa.Table) -> pa.Table:
    """All nodes of one shard, cut into pieces of bounded matrices."""
    table = table.sort_by("pos")
    side = table.column("side").to_numpy()
    every = table.column("seq").to_pylist()
    before = next((s for s, k in zip(every, side) if k == -1), None)
    after = next((s for s, k in zip(every, side) if k == 1), None)
    mine = table.filter(pa.array(side == 0))
    seqs = mine.column("seq").to_pylist()
    words = mine.column("words").combine_chunks()
    flat, at = words.values.to_numpy(zero_copy_only=False), words.offsets.to_numpy()
    conv = mine.column("conv_id").to_numpy()
    lens = np.array([len(s) // DIGEST for s in seqs], np.int64)
    shard = int(mine.column("shard")[0].as_py())
    out: dict[str, list] = {k: [] for k in PARTS_TYPES}
    for piece, (a, b) in enumerate(_pieces(lens)):
        found = piece_nodes(
            seqs[a:b],
            [flat[at[i] : at[i + 1]] for i in range(a, b)],
            conv[a:b],
            seqs[a - 1] if a else before,
            seqs[b] if b < len(seqs) else after,
        )
        count = len(found["depth"])
        out["shard"] += [shard] * count
        out["piece"] += [piece] * count
        for name in PARTS_NAMES:
            out[name] += found[name]
    return pa.table({k: pa.array(out[k], t) for k, t in PARTS_TYPES.items()})


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Boundary nodes from their parts, which come sorted by (node, shard, piece)."""
    names = [c.split()[0] for c in TOTALS.split(", ")]
    types = [PARTS_TYPES[n] for n in names]
    now: dict | None = None
    digest, any_end = hashlib.sha256(), False

    def closed(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names=names)

    for batch in batches:
        done: list[dict] = []
        for row in batch.to_pylist():
            if now is None or row["node"] != now["node"]:
                if now is not None:
                    done.append({**now, "ends_sha256": digest.hexdigest()})
                now, digest, any_end = {n: row[n] for n in names}, hashlib.sha256(), False
            else:
                now["conv_id"] = min(now["conv_id"], row["conv_id"])
                for n in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                    now[n] += row[n]
            if row["ends"]:
                digest.update((("," if any_end else "") + row["ends"]).encode())
                any_end = True
        if done:
            yield closed(done)
    if now is not None:
        yield closed([{**now, "ends_sha256": digest.hexdigest()}])


def prefix_trie(turns: DataFrame, shard_size: int = SHARD) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations."""
    spark = turns.sparkSession
    rows = sharded(stored(spark, rebuilt(turns), "trie-rebuilt"), shard_size)
    parts = stored(spark, rows.groupBy("shard").applyInArrow(shard_nodes, PARTS), "trie-parts")

    boundary = parts.filter("node is not null")
    totals = stored(
        spark,
        boundary.repartition("node").sortWithinPartitions("node", "shard", "piece").mapInArrow(_totals, TOTALS),
        "trie-boundary",
    )
    # Where a boundary node has parts, nodes below it may ask for its conv_id.
    known = (
        boundary.select("shard", "node")
        .distinct()
        .join(totals.select("node", F.col("conv_id").alias("above")), "node")
        .select("shard", F.col("node").alias("parent"), "above")
    )
    inner = parts.filter("node is null")
    waiting = inner.filter("parent is not null").select("shard", "parent", *[c for c in RESULT if c != "parent_conv_id"])
    waiting = waiting.unionByName(totals.filter("parent is not null").select(*waiting.columns))
    placed = waiting.join(known, ["shard", "parent"]).withColumn("parent_conv_id", F.col("above"))
    settled = inner.filter("parent is null").select(*RESULT)
    root = totals.filter("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return settled.unionByName(placed.select(*RESULT)).unionByName(root.select(*RESULT))
