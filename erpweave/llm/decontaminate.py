"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The alphabet is words (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z), the
patterns are the 10-word windows of the benchmark items (an item of fewer words is one
shorter pattern). Per pattern length: a shift table over blocks of two words tells how far
the next possible end of a pattern is, so that only every ninth block of a document is
looked up until one occurs in a pattern; where the shift is 0, the hash of the last block
selects the bucket of patterns to test; a direct comparison of the words confirms.

Documents stay where they are: the patterns go to them. Patterns are sent in blocks of at
most ``block_bytes`` of item text, one pass over the documents per block, so that the size
of a broadcast does not follow the size of the benchmark.

Defined cases: null has no words (neither as item nor as document); repeated items count by
their distinct ids, all items of a null id as one more that is not listed; an item of no
words is never found; an empty table gives an empty result;
further columns of the input are passed through by ``decontaminate``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from erpweave.llm.text import ALNUM, LOWER, mix64, slices, utf8, word_hashes, words

WINDOW = 10
BLOCK_BYTES = 4 << 20
_MULT = np.uint64(0x9FB21C651E98DF25)


class _Group:
    """Patterns of one length: shift table, suffix buckets, and the words to compare."""

    def __init__(self, hashes: np.ndarray, texts: list[tuple[bytes, ...]], items: list[list[str]]):
        self.hashes, self.texts, self.items = hashes, texts, items
        self.length = hashes.shape[1]
        self.block = min(2, self.length)
        self.default = self.length - self.block + 1
        shift: dict[int, int] = {}
        for end in range(self.block - 1, self.length):
            for key in self._blocks(hashes, end).tolist():
                shift[key] = self.length - 1 - end  # later ends come last: the smallest shift stays
        self.keys = np.array(sorted(shift), dtype=np.uint64)
        self.shifts = np.array([shift[k] for k in self.keys.tolist()], dtype=np.int64)
        suffix = self._blocks(hashes, self.length - 1)
        self.order = np.argsort(suffix, kind="stable")
        self.suffix = suffix[self.order]

    def _blocks(self, h: np.ndarray, end: int) -> np.ndarray:
        return h[:, end] if self.block == 1 else mix64(h[:, end - 1] * _MULT + h[:, end])

    def _shift(self, h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = h[at] if self.block == 1 else mix64(h[at - 1] * _MULT + h[at])
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[i] == key, self.shifts[i], self.default), key

    def search(self, h: np.ndarray, doc: np.ndarray, text) -> Iterator[tuple[int, int, int]]:
        """(first word, document, pattern) of each occurrence. ``text(i)`` gives word i."""
        if len(h) < self.length:
            return
        # Every run of ``length`` words holds exactly one of these block ends.
        probe = np.arange(self.block - 1, len(h), self.default)
        limit = probe + self.default
        found: list[np.ndarray] = []
        keys: list[np.ndarray] = []
        while len(probe):
            shift, key = self._shift(h, probe)
            end = shift == 0
            if end.any():
                found.append(probe[end])
                keys.append(key[end])
            probe = probe + np.maximum(shift, 1)
            keep = probe < np.minimum(limit, len(h))
            probe, limit = probe[keep], limit[keep]
        if not found:
            return
        at, key = np.concatenate(found) - self.length + 1, np.concatenate(keys)
        ok = at >= 0
        at, key = at[ok], key[ok]
        ok = doc[at] == doc[at + self.length - 1]
        at, key = at[ok], key[ok]
        lo, hi = np.searchsorted(self.suffix, key, "left"), np.searchsorted(self.suffix, key, "right")
        count = hi - lo
        each = np.repeat(np.arange(len(at)), count)
        bucket = self.order[np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)]
        for k in range(self.length):
            same = h[at[each] + k] == self.hashes[bucket, k]
            each, bucket = each[same], bucket[same]
        for a, p in zip(at[each].tolist(), bucket.tolist(), strict=True):
            if all(text(a + k) == w for k, w in enumerate(self.texts[p])):
                yield a, int(doc[a]), p


class Patterns:
    """The windows of a list of (item id, text), ready for search."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        data, borders = utf8(pa.array([t for _, t in items], pa.large_string()))
        data = LOWER[data]
        starts, ends, first = words(data, borders, ALNUM)
        h = word_hashes(data, starts, ends)
        by_length: dict[int, dict[tuple[bytes, ...], tuple[int, list[str]]]] = defaultdict(dict)
        for i, (item, _) in enumerate(items):
            own = [data[s:e].tobytes() for s, e in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]], strict=True)]
            size = min(window, len(own))
            for k in range(len(own) - size + 1 if own else 0):
                ids = by_length[size].setdefault(tuple(own[k : k + size]), (int(first[i]) + k, []))[1]
                if item not in ids:
                    ids.append(item)
        self.groups = [
            _Group(
                np.stack([h[at : at + size] for at, _ in found.values()]),
                list(found),
                [ids for _, ids in found.values()],
            )
            for size, found in sorted(by_length.items())
        ]

    def search(self, data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[str]]]:
        """Words, hit word ranges (of the document's own word numbers) and items per document."""
        starts, ends, first = words(data, borders, ALNUM)
        h = word_hashes(data, starts, ends)
        n = len(borders) - 1
        doc = np.repeat(np.arange(n), np.diff(first))
        ranges: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        items: list[set[str]] = [set() for _ in range(n)]
        for group in self.groups:
            for a, d, p in group.search(h, doc, lambda i: data[starts[i] : ends[i]].tobytes()):
                ranges[d].append((a - int(first[d]), a - int(first[d]) + group.length))
                items[d].update(group.items[p])
        return np.diff(first), ranges, items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of half-open ranges as sorted disjoint ranges."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str | None]]]:
    """The items in lists of about ``block_bytes`` of text; one list at a time on the driver."""
    cells = items.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")).filter("t is not null")
    block, size = [], 0
    for row in cells.toLocalIterator():
        block.append((row.i, row.t))
        size += len(row.t)
        if size >= block_bytes:
            yield block
            block, size = [], 0
    yield block


def _pass(df: DataFrame, block: list[tuple[str, str | None]], window: int) -> DataFrame:
    """Adds the words, hit ranges and items of one block to _n, _hits and _items of each row."""
    shared = df.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = Patterns(shared.value, window)
        for batch in batches:
            data, borders = utf8(batch.column("_text"))
            had, had_items = batch.column("_hits").to_pylist(), batch.column("_items").to_pylist()
            n, hits, names = [], [], []
            for i, j in slices(borders):
                part = LOWER[data[borders[i] : borders[j]]]
                count, ranges, items = patterns.search(part, borders[i : j + 1] - borders[i])
                n.append(count)
                for k in range(i, j):
                    old = [(x["a"], x["b"]) for x in had[k]]
                    hits.append([{"a": a, "b": b} for a, b in merged(old + ranges[k - i])])
                    names.append(sorted(items[k - i].union(had_items[k]), key=lambda x: (x is not None, x or "")))
            at = {f.name: k for k, f in enumerate(batch.schema)}
            columns = list(batch.columns)
            columns[at["_n"]] = pa.array(np.concatenate(n) if n else [], pa.int64())
            columns[at["_hits"]] = pa.array(hits, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))
            columns[at["_items"]] = pa.array(names, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(run, df.schema)


def find_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """row (all columns of ``docs``), n_words, hits (disjoint word ranges) and items (ids) per document."""
    df = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.col("text").alias("_text"),
        F.lit(0).cast("long").alias("_n"),
        F.expr("cast(array() as array<struct<a: bigint, b: bigint>>)").alias("_hits"),
        F.expr("cast(array() as array<string>)").alias("_items"),
    )
    for block in item_blocks(items, block_bytes):
        df = _pass(df, block, window)
    return df.select("row", F.col("_n").alias("n_words"), F.col("_hits").alias("hits"), F.col("_items").alias("items"))


def contamination_report(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated per document."""
    found = find_contamination(docs.select("doc_id", "text").select("doc_id", F.col("text")), items, window)
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        F.aggregate("hits", F.lit(0).cast("long"), lambda acc, x: acc + x["b"] - x["a"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any benchmark window, with all their columns."""
    return find_contamination(docs, items, window).filter(F.size("hits") == 0).select("row.*")
