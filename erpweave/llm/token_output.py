"""Token ids in binary shards with a minimal perfect hash index over document keys.

Format: a Parquet folder of one row per shard, shards in ascending doc_id order.

* ``part``, ``seq``: place of the shard; shards sort by (part, seq).
* ``lo``, ``hi``: its smallest and largest doc_id (null if it has none), the shard directory.
* ``payload``: the raw ids of its documents one after the other, little-endian unsigned
  integers of ``width`` bytes (2 when the vocabulary fits, else 4).
* ``keys``: the doc_ids in stored order (for scans of all documents).
* ``pilots``: displacement per bucket of the minimal perfect hash (int32).
* ``offsets``, ``sizes``: first id (int64) and number of ids (int64) per hash slot.
* ``prints``: 32-bit fingerprint of the key per hash slot; another key is refused.
* ``n_tokens``: all ids of the shard.

A key is a doc_id and its occurrence number among equal doc_ids of the shard, so repeated
rows keep their own entries. A lookup computes one hash, reads one pilot, one fingerprint
and one offset, and slices the payload.

Documents are range-partitioned by doc_id (then a hash of the text and the row's place, so
that one id's rows need not stay in one task; the texts are shuffled once),
then encoded and written where they are; every shard holds about ``shard_tokens`` ids or one
longer document. A lookup finds its shards in the directory and reads the files of these.

The tokenizer sees every distinct piece of a text once per worker when its file has the rules
for which the cuts between pieces are known to be free of matches (``CUT_RULES``); with any
other file it is given the whole texts.

Defined cases: a null or empty text has only the end id; a null doc_id sorts first and has a
key of its own; equal doc_ids follow each other in order of a hash of their texts, and a
lookup gives the first; an empty table gives no shard and an empty
result.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from erpweave.llm.stored import stored
from erpweave.llm.text import LOWER, mix64, slices, utf8, word_hashes
from erpweave.session import scratch_path

SHARD_TOKENS = 1 << 21
END_ID = 1
PRUNED_PARTS = 1000  # parts that a lookup names in the filter of its scan
_NULL_KEY = np.uint64(0x6E756C6C)
_EMPTY = np.iinfo(np.int32).min

SHARD_SCHEMA = (
    "part int, seq int, n_tokens long, lo long, hi long, width int, payload binary, keys array<long>, "
    "pilots binary, offsets binary, sizes binary, prints binary"
)


#: Byte classes: 0 white space, 1 ASCII letter, 2 digit, 3 ASCII punctuation, 4 all else. The
#: apostrophe (contractions) and the bar (special tokens) are 4: no cut beside them.
_CLASS = np.full(256, 4, np.uint8)
_CLASS[0x21:0x7F] = 3
_CLASS[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[ord("'"), ord("|")]] = 4
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
_MARK = "7"  # a digit is always a piece and an id of its own

# The rules of a tokenizer file under which the pieces are encoded alone.
CUT_RULES = {
    "truncation": None,
    "padding": None,
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


def pieces_stand_alone(path: str) -> bool:
    """Whether a tokenizer file has the rules of ``CUT_RULES`` and special tokens that no cut parts.

    A special token must be lower case between ``<|`` and ``|>``: no cut is made beside a bar, and
    its case is kept by ``encode``. Dropout would make ids depend on chance.
    """
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    plain = all(
        a["content"][:2] == "<|" and a["content"][-2:] == "|>" and a["content"][2:-2].isalpha() and a["content"].isascii()
        and not (a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"])
        for a in rules.get("added_tokens", [])
    )
    return plain and not rules["model"].get("dropout") and all(rules.get(name) == want for name, want in CUT_RULES.items())


def pieces(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pieces that the tokenizer treats apart, and per document its first one.

    Cuts are at white space, between ASCII letters, digits and punctuation, and between
    digits: no match of the pre-tokenizer, composition of the normalizer or special token
    goes across these.
    """
    kind = _CLASS[data]
    inside = kind > 0
    cut = np.zeros(len(data) + 1, bool)  # a piece starts here
    if len(data):
        cut[0] = inside[0]
        left, right = kind[:-1], kind[1:]
        apart = (left < 4) & (right < 4) & ((left != right) | (left == 2))
        cut[1:-1] = inside[1:] & (apart | ~inside[:-1])
        first = borders[:-1]
        first = first[first < len(data)]
        cut[first] |= inside[first]
    starts = np.flatnonzero(cut)
    # A piece ends where the next one starts or where white space or the document ends.
    stop = cut
    stop[1:] |= ~np.append(inside[1:], False)
    stop[borders] = True
    stops = np.flatnonzero(stop)
    ends = stops[np.searchsorted(stops, starts, side="right")] if len(starts) else starts
    return starts, ends, np.searchsorted(starts, borders)


class WordEncoder:
    """Encodes texts through the ids of their pieces; each distinct piece is encoded once."""

    def __init__(self, path: str, limit: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_piece = pieces_stand_alone(path)
        self.limit = limit
        self.mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        self._clear()

    def _clear(self) -> None:
        self.known: dict[int, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.borders = np.zeros(1, np.int64)

    def _ids(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after the other, and how many each has."""
        flat: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        for lo in range(0, len(found), 1000):
            part = found[lo : lo + 1000]
            joined = f" {_MARK} ".join(part)
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
            at = np.flatnonzero(ids == self.mark[0])
            if len(self.mark) == 1 and len(at) == len(part) - 1:
                sizes.append(np.diff(np.concatenate([[-1], at, [len(ids)]])) - 1)
                flat.append(np.delete(ids, at))
            else:  # a piece holds the mark itself
                each = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
                sizes.append(np.array([len(x) for x in each]))
                flat += each
        return np.concatenate(flat), np.concatenate(sizes)

    def _learn(self, hashes: list[int], found: list[str]) -> None:
        for h in hashes:
            self.known[h] = len(self.known)
        # Pieces with the mark go last, so that only theirs are encoded one by one.
        order = np.argsort([_MARK in p for p in found], kind="stable")
        ids, size = self._ids([found[i] for i in order.tolist()])
        begin = np.cumsum(size) - size
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        size, begin = size[back], begin[back]
        upto = np.cumsum(size)
        ids = ids[np.arange(len(ids)) + np.repeat(begin - (upto - size), size)]
        self.borders = np.concatenate([self.borders, self.borders[-1] + upto])
        self.flat = np.concatenate([self.flat, ids])

    def encode(self, data: np.ndarray, borders: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the documents, each followed by ``end_id``, and the ids per document."""
        if not self.by_piece:
            return self._encode_whole(data, borders, end_id)
        if b"<|" not in data.tobytes():  # special tokens are the only place where case counts
            data = LOWER[data]
        starts, ends, first = pieces(data, borders)
        place, unique = pd.factorize(word_hashes(data, starts, ends))
        at = np.empty(len(unique), np.int64)
        at[place[::-1]] = np.arange(len(place))[::-1]
        if len(self.known) + len(unique) > self.limit:
            self._clear()
        slot = np.array([self.known.get(h, -1) for h in unique.tolist()], dtype=np.int64)
        new = np.flatnonzero(slot < 0)
        if len(new):
            raw = data.tobytes()
            found = [raw[a:b].decode("utf-8") for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist(), strict=True)]
            slot[new] = len(self.known) + np.arange(len(new))
            self._learn(unique[new].tolist(), found)
        word = slot[place] if len(unique) else np.zeros(0, np.int64)
        # One more entry per document for the end id, after its last piece.
        source = np.append(self.flat, np.uint32(end_id))
        lo = np.insert(self.borders[word], first[1:], len(self.flat))
        size = np.insert(self.borders[word + 1] - self.borders[word], first[1:], 1)
        upto = np.cumsum(size)
        ids = source[np.arange(int(upto[-1])) + np.repeat(lo - (upto - size), size)]
        per_doc = np.diff(np.concatenate([[0], upto[first[1:] + np.arange(len(borders) - 1)]]))
        return ids, per_doc


    def _encode_whole(self, data: np.ndarray, borders: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        texts = [raw[a:b].decode("utf-8") for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)]
        ids = [[*e.ids, end_id] for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for own in ids for i in own], np.uint32), np.array([len(own) for own in ids], np.int64)


_ENCODERS: dict[str, WordEncoder] = {}  # a worker process keeps its pieces from task to task


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _key_hashes(keys: list[int | None]) -> np.ndarray:
    """64-bit hashes of (key, occurrence), in order."""
    seen: dict[int | None, int] = {}
    nth = np.empty(len(keys), np.uint64)
    for i, k in enumerate(keys):
        nth[i] = seen.get(k, 0)
        seen[k] = int(nth[i]) + 1
    base = np.array([0 if k is None else k & 0xFFFFFFFFFFFFFFFF for k in keys], np.uint64)
    null = np.array([k is None for k in keys], bool)
    h = mix64(base + np.uint64(0x9E3779B97F4A7C15))
    h[null] = _NULL_KEY
    return mix64(h + nth * np.uint64(0xD1B54A32D192ED03))


def build_index(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pilots of a minimal perfect hash of the distinct hashes ``h``, and the slot of each.

    Buckets of about four keys, largest first, look for a pilot that sends all their keys to
    free slots; a bucket of one key names a free slot itself (as a negative pilot).
    """
    n = len(h)
    r = max(1, (n + 3) // 4)
    pilots = np.full(r, _EMPTY, np.int32)
    slot = np.zeros(n, np.int64)
    bucket = (h % np.uint64(r)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    count = np.bincount(bucket, minlength=r)
    begin = np.cumsum(count) - count
    free = np.ones(n, bool)
    tries = 64
    by_size = np.argsort(-count, kind="stable")
    for b in by_size.tolist():
        c = int(count[b])
        if c < 2:
            break
        own = order[begin[b] : begin[b] + c]
        pilot = 0
        while True:
            many = np.arange(pilot, pilot + tries, dtype=np.uint64)
            to = (mix64(h[own][None, :] + (many[:, None] + np.uint64(1)) * np.uint64(0xA0761D6478BD642F)) % np.uint64(n)).astype(np.int64)
            ok = free[to].all(axis=1)
            for t in np.flatnonzero(ok).tolist():
                if len(set(to[t].tolist())) == c:
                    break
            else:
                pilot += tries
                continue
            pilots[b] = pilot + t
            slot[own] = to[t]
            free[to[t]] = False
            break
    left = np.flatnonzero(free)
    single = [b for b in by_size.tolist() if count[b] == 1]
    for b, s in zip(single, left.tolist(), strict=True):
        pilots[b] = -1 - s
        slot[order[begin[b]]] = s
    return pilots, slot


def lookup(pilots: np.ndarray, prints: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Slot of each key hash, or -1 where the stored fingerprint is another key's."""
    n = len(prints)
    pilot = pilots[(h % np.uint64(len(pilots))).astype(np.int64)].astype(np.int64)
    move = (pilot.clip(0).astype(np.uint64) + np.uint64(1)) * np.uint64(0xA0761D6478BD642F)
    slot = (mix64(h + move) % np.uint64(n)).astype(np.int64)
    slot = np.where(pilot < 0, -1 - pilot, slot)
    inside = (pilot != _EMPTY) & (slot >= 0) & (slot < n)
    slot = np.where(inside, slot, 0)
    return np.where(inside & (prints[slot] == (h >> np.uint64(32)).astype(np.uint32)), slot, -1)


def _shard(part: int, seq: int, width: int, keys: list, ids: list[np.ndarray], sizes: list[np.ndarray]) -> dict:
    size = np.concatenate(sizes).astype(np.int64)
    h = _key_hashes(keys)
    pilots, slot = build_index(h)
    offset = np.zeros(len(keys), np.int64)
    offset[slot] = np.cumsum(size) - size
    by_slot = np.zeros(len(keys), np.int64)
    by_slot[slot] = size
    prints = np.zeros(len(keys), np.uint32)
    prints[slot] = (h >> np.uint64(32)).astype(np.uint32)
    return {
        "part": part, "seq": seq, "n_tokens": int(size.sum()), "width": width,
        "lo": min((k for k in keys if k is not None), default=None), "hi": max((k for k in keys if k is not None), default=None),
        "payload": np.concatenate(ids).astype(f"<u{width}").tobytes(), "keys": keys,
        "pilots": pilots.astype("<i4").tobytes(), "offsets": offset.astype("<i8").tobytes(),
        "sizes": by_slot.astype("<i8").tobytes(), "prints": prints.astype("<u4").tobytes(),
    }


_SHARD_ARROW = pa.schema([
    ("part", pa.int32()), ("seq", pa.int32()), ("n_tokens", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()),
    ("width", pa.int32()), ("payload", pa.binary()),
    ("keys", pa.list_(pa.int64())), ("pilots", pa.binary()), ("offsets", pa.binary()), ("sizes", pa.binary()), ("prints", pa.binary()),
])


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``docs`` (doc_id, text) and write the shards under ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        width = 2 if max(coder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        keys: list = []
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        have = 0
        for batch in batches:
            data, borders = utf8(batch.column("text"))
            names = batch.column("doc_id").to_pylist()
            for i, j in slices(borders):
                own, size = coder.encode(data[borders[i] : borders[j]], borders[i : j + 1] - borders[i], end_id)
                keys += names[i:j]
                ids.append(own.astype(f"<u{width}"))
                sizes.append(size)
                have += len(own)
                if have >= shard_tokens:
                    yield pa.RecordBatch.from_pylist([_shard(part, seq, width, keys, ids, sizes)], schema=_SHARD_ARROW)
                    keys, ids, sizes, have, seq = [], [], [], 0, seq + 1
        if keys:
            yield pa.RecordBatch.from_pylist([_shard(part, seq, width, keys, ids, sizes)], schema=_SHARD_ARROW)

    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "_hash")]
    (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), "text",
            F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_place"),
        )
        .repartitionByRange(*order, F.col("_place").asc())
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(run, SHARD_SCHEMA)
        .write.option("compression", "zstd")
        .option("parquet.block.size", str(16 << 20))
        .parquet(path)
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 per document, each found through the shard's index."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    sizes = stored(spark, shards.select("part", "seq", "n_tokens"), "shard-sizes")
    # The window over all is one row per partition of the writing job; shards add up in their part.
    first = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.sum("n").over(first).alias("base"))
    start = F.coalesce("base", F.lit(0)) + F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
    starts = stored(spark, sizes.join(parts, "part").select("part", "seq", start.cast("long").alias("start")), "shard-starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                cell = {name: batch.column(name)[row] for name in batch.schema.names}
                keys = cell["keys"].as_py()
                offsets, sizes = np.frombuffer(cell["offsets"].as_buffer(), "<i8"), np.frombuffer(cell["sizes"].as_buffer(), "<i8")
                slot = lookup(np.frombuffer(cell["pilots"].as_buffer(), "<i4"), np.frombuffer(cell["prints"].as_buffer(), "<u4"), _key_hashes(keys))
                if (slot < 0).any():
                    msg = "a key of the shard is not in its index"
                    raise ValueError(msg)
                payload = np.frombuffer(cell["payload"].as_buffer(), f"<u{cell['width'].as_py()}")
                first, size = offsets[slot], sizes[slot]
                crc = [zlib.crc32(payload[a : a + n].astype("<u4").tobytes()) for a, n in zip(first.tolist(), size.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(first + cell["start"].as_py()), pa.array(size), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return shards.join(starts, ["part", "seq"]).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_ids(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """doc_id and ids of the wanted ``keys`` (doc_id), by lookup in the shard that may hold each.

    The directory (two numbers a shard) names the shard; when these lie in at most
    ``PRUNED_PARTS`` parts, the payloads of other parts are not read. The first occurrence of a
    repeated doc_id is returned, also where its rows straddle shards: shards are in order of
    doc_id, so the first whose range covers it holds it. Keys that are not stored and null keys
    give no row.
    """
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    wanted = keys.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    covers = wanted.join(shards.select("part", "seq", "lo", "hi"), F.col("doc_id").between(F.col("lo"), F.col("hi")))
    first = covers.groupBy("doc_id").agg(F.min(F.struct("part", "seq")).alias("at")).select("doc_id", "at.*")
    place = stored(spark, first.groupBy("part", "seq").agg(F.collect_list("doc_id").alias("want")), "shard-lookups")
    parts = [row.part for row in place.select("part").distinct().limit(PRUNED_PARTS + 1).collect()]
    if len(parts) <= PRUNED_PARTS:
        shards = shards.filter(F.col("part").isin(parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.to_pylist():
                prints, pilots = np.frombuffer(cell["prints"], "<u4"), np.frombuffer(cell["pilots"], "<i4")
                slot = lookup(pilots, prints, _key_hashes(cell["want"]))
                payload = np.frombuffer(cell["payload"], f"<u{cell['width']}")
                offsets, sizes = np.frombuffer(cell["offsets"], "<i8"), np.frombuffer(cell["sizes"], "<i8")
                found = [(k, payload[offsets[s] : offsets[s] + sizes[s]].astype(np.int64)) for k, s in zip(cell["want"], slot.tolist(), strict=True) if s >= 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in found], pa.int64()), pa.array([x for _, x in found], pa.list_(pa.int64()))], names=["doc_id", "ids"]
                )

    return shards.drop("keys").join(place, ["part", "seq"]).mapInArrow(run, "doc_id long, ids array<long>")


def token_output(docs: DataFrame, tokenizer: str, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """Write ``docs`` as shards (under the work folder if no ``path`` is given) and read them back."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-shards")
    write_shards(docs, path, tokenizer, end_id)
    return read_documents(spark, path)
