"""Vectorised text primitives over Arrow string columns: words, word hashes and shingle hashes as numpy arrays.

A column is handled as its UTF-8 bytes and offsets; nothing is done per row or per word in Python. Work is cut into
slices of whole rows of about ``SLICE`` bytes, which bounds the memory; one longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
_MUL = 0x9E3779B97F4A7C15 | 1
_STEP = 0xD6E8FEB86659FD93 | 1
_MASK = (1 << 64) - 1
#: The first 0 to 8 bytes of a little-endian number.
_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

#: Bytes between words: space and 0x09-0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, all else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Splitmix-style finaliser on uint64."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets (from 0) of a string column; null is the empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    if len(off) == 0 or col.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8)[off[0] : off[-1]]
    return data, off - off[0]


def slices(col: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets) of consecutive row ranges of about ``size`` bytes."""
    data, off = buffers(col)
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, side="right")) - 1)
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def words(data: np.ndarray, off: np.ndarray, sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the row it is in; words never span rows."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    s = sep[data]
    w = ~s
    first, last = w.copy(), w.copy()
    first[1:] &= s[:-1]
    last[:-1] &= s[1:]
    full = off[:-1] < off[1:]
    b, e = off[:-1][full], off[1:][full] - 1
    first[b] = w[b]
    last[e] = w[e]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(off, starts, side="right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans: a span's pieces of eight bytes are mixed with their place and the key, and summed up.

    Spans of one length up to eight bytes never collide. No pattern in long spans makes their hashes equal, as the pieces
    enter through a function that isn't linear; who doesn't know ``key`` can't make texts for it either, so what decides
    by hash alone takes a random one.
    """
    size = ends - starts
    salt, step = mix(np.array([key & _MASK, key + _STEP & _MASK], np.uint64))
    eight = np.ndarray((len(data) + 1,), "<u8", buffer=np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    v = eight[starts]
    v &= _BYTES[np.minimum(size, 8)]
    v += salt
    v = mix(v)
    long = np.flatnonzero(size > 8)
    if len(long):
        pieces = (size[long] - 1) >> 3  # after the first one
        first = np.cumsum(pieces) - pieces
        k = np.arange(1, int(pieces.sum()) + 1) - np.repeat(first, pieces)
        w = eight[np.repeat(starts[long], pieces) + 8 * k]
        w &= _BYTES[np.minimum(np.repeat(size[long], pieces) - 8 * k, 8)]
        w += k.astype(np.uint64) * step + salt
        v[long] += np.add.reduceat(mix(w), first)
    v += size.astype(np.uint64) * np.uint64(_MUL)
    return mix(v)


def shingles(h: np.ndarray, row: np.ndarray, n_rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every k consecutive words and their rows; a row of 1 to k-1 words has one shingle of all of them."""
    out, at = [], []
    if len(h) >= k:
        ok = np.flatnonzero(row[: len(h) - k + 1] == row[k - 1 :])
        v, p = np.zeros(len(ok), np.uint64), 1
        for j in range(k):
            v += h[ok + j] * np.uint64(p)
            p = p * _STEP & _MASK
        out.append(v)
        at.append(row[ok])
    n = np.bincount(row, minlength=n_rows)
    first = np.cumsum(n) - n
    for m in range(1, k):
        short = np.flatnonzero(n == m)
        v, p = np.full(len(short), m, np.uint64), 1
        for j in range(m):
            v += h[first[short] + j] * np.uint64(p)
            p = p * _STEP & _MASK
        out.append(v)
        at.append(short)
    return mix(np.concatenate(out)) if out else np.zeros(0, np.uint64), np.concatenate(at) if at else np.zeros(0, np.int64)


def per_row_unique(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value) pairs, sorted by row and then by value."""
    order = np.lexsort((values, rows))
    v, r = values[order], rows[order]
    keep = np.ones(len(v), bool)
    keep[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    return v[keep], r[keep]
