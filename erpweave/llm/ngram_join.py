"""Near-duplicate join: Jaccard of word 5-gram sets, by universe partition and pigeonhole.

A document's set holds the 64-bit hashes of its distinct 5-word shingles (of the whole word
sequence when it has fewer words). Two sets x, y with |x| <= |y| and Jaccard >= 0.8 differ in
at most k(|x|) = (|x| + 5|x|/4) / 9 elements. Sizes fall into bands. In a band the hash
universe is cut into m ranges (segments); if they differ in at most k places, they agree on
one of any k + 1 segments, or differ in at most one element on one of any (k + 1) / 2.

* ``band_plan`` chooses per band, by cost, between exact segments and one-deletion
  neighbourhoods (short sets: fewer and larger segments, plus every segment with one element
  left out); both have spare segments.
* Every set indexes all segments of its band, and of the band below when a set there can be
  its smaller partner. As the smaller partner it is allocated only as many segments as the
  pigeonhole asks for, the fullest first, so that empty and nearly empty segments, which
  agree by chance, are skipped.
* Signatures meet in hash partitions, packed as binary. Sets of equal content have equal
  keys and count once. A signature shared by up to ``SMALL`` sets gives all its pairs, a
  larger one a star around its smallest key; the rest of its pairs is only tried where
  components still differ, in blocks, after a bound on the symmetric difference (512-bit
  parity sketches never exceed it). So linked groups cost their size, not its square.
* Candidates are verified exactly on the sets of the texts; components come from
  alternating stars. No pair is lost: each is verified, implied by its component, or
  excluded by an exact bound.

Sets are compared by 64-bit hashes of their shingles, classes of equal sets by a 64-bit
hash of the set, and a class's text is found by the id and the 64-bit hash of one of its
rows, so rows that share an id fetch one text a class. Defined cases: null, empty and blank texts have no shingles and link with
nothing; a null doc_id counts as the smallest id and is returned as null; rows that repeat a
doc_id each give a row, by their own texts; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from erpweave.llm.components import components, through
from erpweave.llm.stored import stored
from erpweave.llm.text import LOWER, NON_SPACE, mix64, slices, utf8, windows, word_hashes, words

WIDTH = 5
NUM, DEN = 80, 100  # Jaccard of at least NUM / DEN; the bounds below are written for 0.8
SMALL = 16  # sets under one signature up to which all pairs are tried at once
BLOCK = 4096  # members of a large signature that one task holds at once
LISTED = 16  # smallest open signatures of a set that its members know of
SKETCH_BITS = 512
EMPTY_COST = 40.0  # cost of a chance agreement on an empty segment, in signatures
HUB = 1024  # pairs of one set that are verified beside one copy of its text
FLUSH = 1 << 21  # signatures that a task packs at once
PER_PART = 1 << 20  # shingles per hash partition aimed at
NO_ID = -(1 << 63)


def most_apart(size: np.ndarray | int) -> np.ndarray | int:
    """Largest symmetric difference of a set of this size and a larger partner."""
    return (size + (5 * size) // 4) // 9


def _bounds() -> np.ndarray:
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, -(-out[-1] * 3 // 2)))
    return np.array(out, np.int64)


BOUNDS = _bounds()


@lru_cache(maxsize=None)
def band_plan(band: int) -> tuple[int, bool]:
    """(segments, with one-deletion neighbourhoods) for the sets of a band, by cost."""
    top = int(BOUNDS[band + 1]) - 1
    need = int(most_apart(top)) + 1
    exact = -(-need * 23 // 20) + 1
    fewer = -(-need // 2) + 1
    cost = exact * (1 + EMPTY_COST * np.exp(-top / exact))
    cost_deletion = (fewer + top) * (1 + EMPTY_COST * np.exp(-top / fewer))
    return (fewer, True) if cost_deletion < cost else (exact, False)


def shingle_sets(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of the documents one after the other, and n + 1 borders."""
    data = LOWER[data]
    starts, ends, first = words(data, borders, NON_SPACE)
    h = word_hashes(data, starts, ends)
    five = windows(h, WIDTH)
    out: list[np.ndarray] = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= WIDTH:
            out.append(np.unique(five[a : b - WIDTH + 1]))
        elif b > a:
            out.append(mix64(windows(h[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    sizes = np.array([len(x) for x in out], np.int64)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def _sums(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return upto[borders[1:]] - upto[borders[:-1]]


def set_keys(tokens: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """A 64-bit key per set; equal sets have equal keys."""
    return mix64(_sums(mix64(tokens ^ np.uint64(0x5851F42D4C957F2D)), borders) + np.diff(borders).astype(np.uint64))


def sketches(tokens: np.ndarray, borders: np.ndarray) -> list[bytes]:
    """Parity of the elements per bit: two sketches differ in at most as many bits as the sets in elements."""
    n = len(borders) - 1
    doc = np.repeat(np.arange(n), np.diff(borders))
    bit = (mix64(tokens) % np.uint64(SKETCH_BITS)).astype(np.int64)
    out: list[bytes] = []
    for lo in range(0, n, 2048):
        hi = min(lo + 2048, n)
        a, b = borders[lo], borders[hi]
        count = np.bincount((doc[a:b] - lo) * SKETCH_BITS + bit[a:b], minlength=(hi - lo) * SKETCH_BITS)
        packed = np.packbits((count & 1).astype(np.uint8).reshape(hi - lo, SKETCH_BITS), axis=1)
        out += [row.tobytes() for row in packed]
    return out


def _band_signatures(
    tokens: np.ndarray, borders: np.ndarray, band: np.ndarray, smaller: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, document, is allocated) for the sets in the segments of the given bands.

    ``smaller``: the sets are of these bands themselves and may be the smaller partner.
    """
    n = np.diff(borders)
    plans = {int(b): band_plan(int(b)) for b in np.unique(band)}
    m = np.array([plans[int(b)][0] for b in band], np.int64)
    deletes = np.array([plans[int(b)][1] for b in band], bool)
    doc = np.repeat(np.arange(len(n)), n)
    base = np.cumsum(m) - m
    seg = ((tokens >> np.uint64(32)) * m[doc].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    flat = base[doc] + seg
    count = np.bincount(flat, minlength=int(m.sum()))
    mixed = mix64(tokens + np.uint64(0x2545F4914F6CDD1D))
    total = _sums(mixed, np.concatenate([[0], np.cumsum(count)]))
    owner = np.repeat(np.arange(len(n)), m)
    place = mix64(band[owner].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (np.arange(len(owner)) - base[owner]).astype(np.uint64))
    signature = mix64(total ^ place)
    allocated = np.zeros(len(owner), bool)
    if smaller:
        need = most_apart(n) + 1
        need = np.where(deletes, (need + 1) // 2, need)
        fullest = np.lexsort((-count, owner))
        rank = np.arange(len(owner)) - base[owner]
        allocated[fullest] = rank < need[owner]
    out = [(signature, owner, allocated)]
    cut = deletes[doc]
    if cut.any():
        f = flat[cut]
        out.append((mix64((total[f] - mixed[cut]) ^ place[f]), doc[cut], allocated[f]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def signatures(tokens: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, document, is allocated) of all sets, in their own band and as larger partners."""
    n = np.diff(borders)
    some = np.flatnonzero(n > 0)
    if not len(some):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
    band = np.zeros(len(n), np.int64)
    band[some] = np.searchsorted(BOUNDS, n[some], side="right") - 1
    out = []
    below = (band > 0) & (n > 0) & (n <= (5 * (BOUNDS[band] - 1)) // 4)
    for pick, shift in ((n > 0, 0), (below, 1)):
        if not pick.any():
            continue
        at = np.flatnonzero(pick)
        keep = np.repeat(pick, n)
        own = np.concatenate([[0], np.cumsum(n[at])])
        s, d, a = _band_signatures(tokens[keep], own, band[at] - shift, shift == 0)
        out.append((s, at[d], a))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _set_batches(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        data, borders = utf8(batch.column("text"))
        for i, j in slices(borders):
            tokens, own = shingle_sets(data[borders[i] : borders[j]], borders[i : j + 1] - borders[i])
            yield batch, i, j, tokens, own


def document_sets(docs: DataFrame) -> DataFrame:
    """id (null as NO_ID), h (hash of the text), n, key and sketch per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, j, tokens, own in _set_batches(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id")[i:j],
                    batch.column("h")[i:j],
                    pa.array(np.diff(own)),
                    pa.array(set_keys(tokens, own).view(np.int64)),
                    pa.array(sketches(tokens, own), pa.binary()),
                ],
                names=["id", "h", "n", "key", "sketch"],
            )

    return docs.mapInArrow(run, "id long, h long, n long, key long, sketch binary")


def _packed_signatures(docs: DataFrame, bits: int) -> DataFrame:
    """part, kind, sig and keys, packed per task and part.

    Kind 0: signatures (5 bytes: 38 bits of the signature, then the flags large and allocated)
    and set keys (8 bytes). A signature that more than ``SMALL`` sets of one task share is
    combined there: its smallest key goes on alone, marked large, and its members as kind 1
    (8 bytes for signature and key each), which only pass through the parts.
    """

    def packed(sig: list, key: list, turn: int) -> Iterator[pa.RecordBatch]:
        s, k = np.concatenate(sig), np.concatenate(key)
        order = np.lexsort((k, s >> np.uint64(64 - bits - 38)))
        s, k = s[order], k[order]
        allocated = (s & np.uint64(1)).astype(bool)
        s = s >> np.uint64(64 - bits - 38)  # the part and 38 bits
        at = np.flatnonzero(_fresh(s, k))
        allocated, s, k = np.logical_or.reduceat(allocated, at), s[at], k[at]
        start = np.flatnonzero(_fresh(s))
        size = np.diff(np.append(start, len(s)))
        keep, large = np.ones(len(s), bool), np.zeros(len(s), bool)
        members = []
        for lo, n in zip(start[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
            own = k[lo : lo + n]
            allocated[lo], large[lo], keep[lo + 1 : lo + n] = allocated[lo : lo + n].any(), True, False
            members.append((np.full(n, s[lo]), own))
        part = (s >> np.uint64(38)).astype(np.int64)
        low = (s & np.uint64((1 << 38) - 1)) << np.uint64(2) | large.astype(np.uint64) << np.uint64(1) | allocated.astype(np.uint64)
        part, low, k = part[keep], low[keep], k[keep]
        cuts = np.flatnonzero(np.diff(part, prepend=-1))
        upto = np.append(cuts[1:], len(part))
        five = np.ascontiguousarray(low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])
        yield _packed_batch(
            part[cuts], 0, [five[a:b].tobytes() for a, b in zip(cuts, upto, strict=True)],
            [k[a:b].astype("<u8").tobytes() for a, b in zip(cuts, upto, strict=True)],
        )
        if members:
            left, right = (np.concatenate(x).astype("<u8") for x in zip(*members, strict=True))
            cells = range(0, len(left), 1 << 16)
            places = np.array([(turn + i) % (1 << bits) for i in range(len(cells))], np.int64)
            yield _packed_batch(places, 1, [left[c : c + (1 << 16)].tobytes() for c in cells], [right[c : c + (1 << 16)].tobytes() for c in cells])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        turn = TaskContext.get().partitionId() * 7919
        sig: list[np.ndarray] = []
        key: list[np.ndarray] = []
        have = 0
        for _, _, _, tokens, own in _set_batches(batches):
            s, d, allocated = signatures(tokens, own)
            sig.append((s & ~np.uint64(1)) | allocated.astype(np.uint64))
            key.append(set_keys(tokens, own)[d])
            have += len(s)
            if have >= FLUSH:
                yield from packed(sig, key, turn)
                sig, key, have, turn = [], [], 0, turn + 101
        if have:
            yield from packed(sig, key, turn)

    return docs.mapInArrow(run, "part long, kind int, sig binary, keys binary")


def _packed_batch(part: np.ndarray, kind: int, sig: list[bytes], keys: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(part), pa.array(np.full(len(part), kind, np.int32)), pa.array(sig, pa.binary()), pa.array(keys, pa.binary())],
        names=["part", "kind", "sig", "keys"],
    )


def _fresh(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = False
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _unique_pairs(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
    a, b = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[fresh], b[fresh]


def _met(part: int, sig: np.ndarray, key: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a, b) of the sets that share a signature, and of the large signatures that join
    sets (signature, key) of the members that came here and (signature, smallest key)."""
    order = np.lexsort((key, sig >> np.uint64(2)))
    sig, key = sig[order], key[order]
    flags, sig = (sig & np.uint64(3)).astype(np.int64), sig >> np.uint64(2)
    at = np.flatnonzero(_fresh(sig, key))
    flags = np.bitwise_or.reduceat(flags, at) if len(at) else flags
    sig, key = sig[at], key[at].view(np.int64)
    start = np.flatnonzero(_fresh(sig)) if len(sig) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(sig)))
    of_sig = np.bitwise_or.reduceat(flags, start) if len(start) else flags
    large = ((size > SMALL) | (of_sig & 2 > 0)) & (of_sig & 1 > 0)
    few = (size > 1) & ~large & (of_sig & 1 > 0)
    pairs: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for c in range(2, SMALL + 1):
        rows = start[few & (size == c)]
        if len(rows):
            i, j = np.triu_indices(c, 1)
            a, b = (rows[:, None] + i).ravel(), (rows[:, None] + j).ravel()
            ok = (flags[a] | flags[b]) & 1 > 0
            pairs.append((key[a[ok]], key[b[ok]]))
    name = (part << 38) | sig.astype(np.int64)
    within = np.repeat(large, size)
    return [_unique_pairs(pairs), (name[within], key[within]), (name[start[large]], key[start[large]])]


def _meet(table: pa.Table) -> pa.Table:
    """kind 0: pairs (a, b); kind 1: members (signature, key) of large signatures; kind 2: their hubs."""
    kinds = table.column("kind").to_numpy()
    sigs, keys = table.column("sig").to_pylist(), table.column("keys").to_pylist()

    def joined(cells: list[bytes], kind: int) -> bytes:
        return b"".join([c for c, k in zip(cells, kinds.tolist(), strict=True) if k == kind])

    raw = joined(sigs, 0)
    wide = np.zeros((len(raw) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    key = np.frombuffer(joined(keys, 0), "<u8").astype(np.uint64)
    found = _met(table.column("part")[0].as_py(), wide.view("<u8").ravel().astype(np.uint64), key)
    found[1] = tuple(np.concatenate([x, np.frombuffer(joined(c, 1), "<i8")]) for x, c in zip(found[1], (sigs, keys), strict=True))
    kind = np.repeat(np.arange(3, dtype=np.int32), [len(x) for x, _ in found])
    return pa.table({"kind": kind, "a": np.concatenate([x for x, _ in found]), "b": np.concatenate([x for _, x in found])})


def _possible(pairs: DataFrame, info: DataFrame) -> DataFrame:
    """Pairs whose sizes and sketches allow a Jaccard of 0.8."""
    left = info.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = info.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            sa, sb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SKETCH_BITS // 8) for c in ("sa", "sb"))
            ok = _may_link(na, nb, np.bitwise_count(sa ^ sb).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(ok)), batch.column("b").filter(pa.array(ok))], names=["a", "b"])

    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def _may_link(na: np.ndarray, nb: np.ndarray, apart: np.ndarray) -> np.ndarray:
    return (DEN * np.minimum(na, nb) >= NUM * np.maximum(na, nb)) & (9 * apart.astype(np.int64) <= na + nb)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold, computed on their texts.

    The texts of ``b`` come first; then the pairs of one ``a`` are dealt out in parts of about
    ``HUB``, and its text travels once for each part and not once for each pair.
    """
    parts = F.ceil(F.count("*") / HUB).cast("int")
    fan = pairs.groupBy("a").agg(parts.alias("parts")).filter("parts > 1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            step = 256
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                (ta, ba), (tb, bb) = (shingle_sets(*_plain(part.column(c))) for c in ("ta", "tb"))
                for i in range(part.num_rows):
                    x, y = ta[ba[i] : ba[i + 1]], tb[bb[i] : bb[i + 1]]
                    both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                    ok[lo + i] = DEN * both >= NUM * (len(x) + len(y) - both)
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    one = F.coalesce(F.col("parts"), F.lit(1))
    dealt = pairs.join(fan, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), one).cast("int").alias("part"))
    left = texts.select(F.col("key").alias("a"), F.col("text").alias("ta")).join(fan, "a", "left")
    left = left.select("a", "ta", F.explode(F.sequence(F.lit(0), one - 1)).alias("part"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("tb"))
    return dealt.join(right, "b").join(left, ["a", "part"]).select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _plain(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, borders = utf8(column)
    return data[borders[0] : borders[-1]], borders - borders[0]


def _cross(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component yet."""
    return through(pairs, roots).filter("ra <> rb").select("a", "b")


def _open_members(members: DataFrame, roots: DataFrame) -> DataFrame:
    """The members of the signatures that join several components, with root and block numbers.

    ``query`` marks those outside the signature's largest component: a pair of two components
    holds at least one of them. ``nc`` and ``nq`` are the blocks of all members and of these.
    """
    named = members.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    per = named.groupBy("sig", "root").agg(F.count("*").alias("c"))
    of_sig = (
        per.groupBy("sig")
        .agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.sum("c").alias("all"), F.max("c").alias("most"))
        .filter(F.col("all") > F.col("most"))
        .select(
            "sig", "main", F.ceil(F.col("all") / BLOCK).alias("nc"), F.ceil((F.col("all") - F.col("most")) / BLOCK).alias("nq")
        )
    )
    return named.join(of_sig, "sig").select("sig", "key", "root", (F.col("root") != F.col("main")).alias("query"), "nc", "nq")


def _open_pairs(left: DataFrame, info: DataFrame) -> DataFrame:
    """Possible pairs (a, b) of different components under the open signatures.

    Members meet in blocks of at most about ``BLOCK``, so that no task holds a whole large
    signature. The sets of a family share many signatures: a pair is left to the smallest one
    that it shares. Each member brings the ``LISTED`` smallest open signatures of its set, and
    where two lists share a smaller one than the signature at hand, the pair is made there, or
    under a smaller one still; under the smallest that it shares it is always made. Two members
    that both ask meet twice, and make their pair once. What is made again all the same
    (lists that end too soon) is combined to one before and after the shuffle.
    """
    listed = left.groupBy("key").agg(F.slice(F.sort_array(F.collect_set("sig")), 1, LISTED).alias("listed"))
    rows = left.join(listed, "key").join(info.select("key", "n", "sketch"), "key")
    columns = ["sig", "cb", "qb", "key", "root", "n", "sketch", "listed", "query"]
    block = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    place = lambda n: F.pmod(F.xxhash64("key"), F.col(n))
    every = rows.withColumn("cb", place("nc")).withColumn("qb", block("nq")).select(*columns)
    asked = rows.filter("query").withColumn("qb", place("nq")).withColumn("cb", block("nc"))
    asked = asked.select(*[F.col(c).alias(f"q_{c}") for c in columns])  # a self-cogroup needs own names

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        if left.num_rows and right.num_rows:
            right = right.rename_columns(columns)
            sig = left.column("sig")[0].as_py()
            (key, root, n, sketch), (q_key, q_root, q_n, q_sketch) = (_member_arrays(t) for t in (left, right))
            first, q_first = (_listed_arrays(t) for t in (left, right))
            asks = left.column("query").to_numpy()
            for i in range(len(q_key)):
                apart = np.bitwise_count(sketch ^ q_sketch[i]).sum(axis=1)
                ok = np.flatnonzero((root != q_root[i]) & ~(asks & (key < q_key[i])) & _may_link(n, q_n[i], apart))
                smaller = q_first[i][(q_first[i] >= 0) & (q_first[i] < sig)]
                if len(ok) and len(smaller):
                    ok = ok[~np.isin(first[ok], smaller).any(axis=1)]
                pairs.append((np.full(len(ok), q_key[i]), key[ok]))
        a, b = _unique_pairs(pairs)
        return pa.table({"a": a, "b": b})

    groups = ["sig", "cb", "qb"]
    return every.groupBy(*groups).cogroup(asked.groupBy(*[f"q_{g}" for g in groups])).applyInArrow(run, "a long, b long").distinct()


def _member_arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    key, root, n = (table.column(c).to_numpy() for c in ("key", "root", "n"))
    return key, root, n, np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH_BITS // 8)


def _listed_arrays(table: pa.Table) -> np.ndarray:
    """The listed signatures, a row of ``LISTED`` for each member; -1 where a list has ended."""
    lists = pa.concat_arrays(table.column("listed").chunks)
    size = np.diff(lists.offsets.to_numpy())
    out = np.full((len(size), LISTED), -1, np.int64)
    out[np.arange(LISTED) < size[:, None]] = lists.flatten().to_numpy()
    return out


def class_rows(docs: DataFrame, info: DataFrame, pairs: DataFrame) -> DataFrame:
    """key and text of the rows that stand for the classes in ``pairs``, found by id and text hash."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct().join(info.select("key", "row.*"), "key")
    return docs.join(wanted, ["id", "h"]).select("key", "text")


def _links(spark: SparkSession, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """node and root for the classes (keys) that link with another class."""
    info = stored(
        spark,
        sets.filter("n > 0").groupBy("key").agg(F.min(F.struct("id", "h")).alias("row"), F.first("n").alias("n"), F.first("sketch").alias("sketch")),
        "ngram-classes",
    )
    shingles = sets.agg(F.sum("n")).first()[0] or 0
    bits = min(25, max(10, int(shingles // PER_PART).bit_length()))  # with 38 more a 64-bit signature is used up
    met = stored(
        spark, _packed_signatures(docs, bits).groupBy("part").applyInArrow(_meet, "kind int, a long, b long"), "ngram-met"
    )
    members = met.filter("kind = 1").select(F.col("a").alias("sig"), F.col("b").alias("key")).distinct()
    hubs = met.filter("kind = 2").select(F.col("a").alias("sig"), F.col("b").alias("hub"))
    # A member listed by a task belongs to a signature that joins sets only if it has a hub.
    members = stored(spark, members.join(hubs, "sig"), "ngram-members")
    stars = members.filter("key <> hub").select(F.least("key", "hub").alias("a"), F.greatest("key", "hub").alias("b"))
    tried = met.filter("kind = 0").select("a", "b").unionByName(stars).distinct()
    pairs = stored(spark, _possible(tried, info), "ngram-pairs")
    members = members.select("sig", "key")

    def texts(of: DataFrame) -> DataFrame:
        """key and text of the sets of these pairs: one named row of each, by id and text hash."""
        one = class_rows(docs, info, of).groupBy("key").agg(F.min("text").alias("text"))
        return stored(spark, one, "ngram-texts", compression="zstd")

    # First one pair per class, then those that are still between components.
    of_pairs = texts(pairs)
    first = stored(spark, pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "ngram-first")
    links = stored(spark, _verified(first, of_pairs), "ngram-links")
    roots = components(links)
    rest = stored(spark, _cross(pairs, roots).join(first, ["a", "b"], "left_anti"), "ngram-rest")
    if not rest.isEmpty():
        roots = components(stored(spark, _verified(rest, of_pairs), "ngram-links"), roots)
    # Large signatures that still join several components: all their pairs across these.
    left = stored(spark, _open_members(members, roots), "ngram-open")
    if not left.isEmpty():
        rest = stored(spark, _open_pairs(left, info), "ngram-rest")
        if not rest.isEmpty():
            roots = components(stored(spark, _verified(rest, texts(rest)), "ngram-links"), roots)
    return roots


def _named(docs: DataFrame) -> DataFrame:
    """id (doc_id, null as NO_ID), h (hash of the text), text."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("h"), F.col("text"))


def _rooted(spark: SparkSession, named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sets of the documents, and key, id (the smallest) and root of the classes."""
    sets = stored(spark, document_sets(named), "ngram-sets")
    roots = _links(spark, named, sets)
    classes = sets.filter("n > 0").groupBy("key").agg(F.min("id").alias("id"))
    rooted = classes.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    return sets, rooted


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) per document."""
    spark = docs.sparkSession
    sets, rooted = _rooted(spark, _named(docs))
    least = rooted.groupBy("root").agg(F.min("id").alias("least"))
    component = stored(spark, rooted.join(least, "root").select("key", "least"), "ngram-components")
    out = sets.filter("n > 0").select("id", "n", "key").join(component, "key").select("id", "n", "least")
    alone = sets.filter("n = 0").select("id", "n", F.col("id").alias("least"))
    shown = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.unionByName(alone).select(
        shown("id").alias("doc_id"), F.col("n").alias("n_shingles"), shown("least").alias("component_id")
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of each component, the one with the smallest doc_id, with all its columns.

    Rows are told apart by their texts, not by their doc_id: rows of unlike texts that repeat
    a doc_id or have none are all kept. Of the rows of a component with its smallest doc_id
    the one with the smallest text stays. A row of no shingles is a component of its own.
    """
    spark = docs.sparkSession
    sets, rooted = _rooted(spark, _named(docs))
    least = rooted.groupBy("root").agg(F.min("id").alias("least"))
    component = stored(spark, rooted.join(least, "root").select("key", "root", F.col("least").alias("id")), "ngram-components")
    first = sets.filter("n > 0").select("id", "h", "key").join(component, ["key", "id"])
    keep = stored(spark, first.select(F.col("id").alias("_id"), F.col("h").alias("_h"), F.col("root").alias("_root")).distinct(), "ngram-keep")
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    some = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    found = docs.filter(some).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64("text").alias("_h"), row)
    kept = found.join(keep, ["_id", "_h"]).groupBy("_root").agg(F.min_by("row", "row.text").alias("row"))
    return kept.select("row.*").unionByName(docs.filter(~some))
