"""Vectorised word splitting and hashing over Arrow string columns.

Texts stay in the Arrow UTF-8 buffer; words are byte ranges of it. A word never crosses a
document border. Work is done in slices of whole documents of about ``max_bytes``, so that
memory does not follow the Arrow batch size (one longer document is a slice of its own).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: ASCII lower-casing of A-Z only, as a byte table.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Bytes of ``[^\x20\x09-\x0D]+``.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing: digits, a-z, non-ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[ord("0") : ord("9") + 1] = True
ALNUM[ord("a") : ord("z") + 1] = True
ALNUM[0x80:] = True

_LONG_WORD = 64
_SEED = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 document borders; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def slices(offsets: np.ndarray, max_bytes: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``max_bytes`` together, or of one longer document."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + max_bytes, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def words(data: np.ndarray, borders: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data`` and, per document, the index of its first word.

    ``borders`` are the n + 1 document borders within ``data`` (first 0, last len(data)).
    """
    inside = table[data]
    flag = np.zeros(len(data) + 1, dtype=bool)
    flag[:-1] = inside
    starts = flag.copy()
    starts[1:-1] &= ~inside[:-1]
    inner = borders[:-1]
    inner = inner[inner < len(data)]
    starts[inner] |= flag[inner]
    ends = np.zeros(len(data) + 1, dtype=bool)
    ends[1:] = inside
    ends[1:-1] &= ~inside[1:]
    cut = borders[1:]
    cut = cut[cut > 0]
    ends[cut] |= inside[cut - 1]
    s = np.flatnonzero(starts)
    return s, np.flatnonzero(ends), np.searchsorted(s, borders)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word. Words over 64 bytes are hashed one by one."""
    size = ends - starts
    h = np.full(len(starts), _SEED, dtype=np.uint64)
    if not len(starts):
        return h
    active, at, left = np.arange(len(starts)), starts.copy(), np.minimum(size, _LONG_WORD)
    cur = h.copy()
    for _ in range(int(left.max())):
        cur = (cur ^ data[at].astype(np.uint64)) * _BASE
        cur ^= cur >> np.uint64(29)
        left = left - 1
        done = left == 0
        if done.any():
            h[active[done]] = cur[done]
            keep = ~done
            active, at, left, cur = active[keep], at[keep], left[keep], cur[keep]
        at = at + 1
    for i in np.flatnonzero(size > _LONG_WORD):
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return mix64(h)


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive word hashes (order matters)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, _SEED, dtype=np.uint64)
    for k in range(width):
        out = mix64(out * np.uint64(0x9FB21C651E98DF25) + h[k : k + n])
    return out
