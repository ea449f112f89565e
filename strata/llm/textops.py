"""Numpy helpers on UTF-8 byte buffers: words, rolling hashes, reply bitmaps.

Every helper works on one bounded block of documents inside a Spark task.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
NULL_ID = np.iinfo(np.int64).min          # a null doc_id sorts before all others


def table(separators: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(is-separator flag, replacement byte) per byte value."""
    sep = np.zeros(256, bool)
    sep[list(separators)] = True
    low = np.arange(256, dtype=np.uint8)
    if lower:
        low[65:91] += 32
        sep[65:91] = sep[97:123]               # separators are judged on the lower-case text
    return sep, low


#: White space of the text contracts: space and tab to carriage return.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
#: ASCII without digits and lower-case letters.
NON_WORD = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, int64 offsets) of a string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_binary()), b"")
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + len(col) + 1]
    if not len(col) or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8)[offs[0]: offs[-1]]
    return data, offs - offs[0]


def column_ids(col: pa.Array) -> np.ndarray:
    """int64 ids; null becomes NULL_ID."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return pc.fill_null(col.cast(pa.int64()), NULL_ID).to_numpy(zero_copy_only=False)


def ids_out(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NULL_ID)


class Words:
    """Words of a block: ``norm`` has each word followed by one space byte,
    word i starts at ``start[i]``; document d owns words first[d]..first[d+1]."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, sep: np.ndarray, low: np.ndarray):
        n = len(data)
        keep = ~sep[data]
        begin = keep.copy()
        if n:
            begin[1:] &= ~keep[:-1]
            inner = offs[1:-1]
            inner = inner[inner < n]
            begin[inner] = keep[inner]         # a word never crosses a document
        word = np.cumsum(begin)
        self.n = int(word[-1]) if n else 0
        self.first = np.concatenate([[0], word])[offs] if n else np.zeros(len(offs), np.int64)
        at = (np.cumsum(keep) + word - 2)[keep] if n else np.zeros(0, np.int64)
        size = (int(at[-1]) + 2) if len(at) else 0
        self.norm = np.full(size, 0x20, np.uint8)
        self.norm[at] = low[data[keep]]
        self.start = np.append(at[begin[keep]], size).astype(np.int64)

    def values(self) -> pa.Array:
        """The words as one Arrow string array."""
        offs = (self.start - np.arange(self.n + 1)).astype(np.int32)
        keep = np.ones(len(self.norm), bool)
        keep[self.start[1:] - 1] = False
        body = np.ascontiguousarray(self.norm[keep])
        return pa.Array.from_buffers(pa.binary(), self.n, [None, pa.py_buffer(offs), pa.py_buffer(body)])

    def docs(self) -> np.ndarray:
        """Document index of every word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U64(29))) * U64(0x9E3779B97F4A7C15)
    return h ^ (h >> U64(32))


@lru_cache(maxsize=4)
def _base(seed: int) -> tuple[int, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(seed))
    base = (int(rng.integers(1 << 62)) << 1) | 5
    return base, rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)


@lru_cache(maxsize=4)
def _powers(seed: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    base = _base(seed)[0]
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


class Rolling:
    """Polynomial hashes (mod 2^64, random byte weights) of any byte range."""

    def __init__(self, data: np.ndarray, seed: int = 1):
        n = len(data)
        size = 1 << max(16, (n + 1).bit_length())
        self.pow, inv = _powers(seed, size)
        self.sum = np.zeros(n + 1, np.uint64)
        np.cumsum(_base(seed)[1][data] * inv[:n], out=self.sum[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hash of [start, end); the length is part of it."""
        raw = (self.sum[end] - self.sum[start]) * self.pow[start]
        return mix(raw ^ (end - start).astype(np.uint64) * U64(0xA24BAED4963EE407))

    def grams(self, k: int, begin: int, end: int) -> np.ndarray:
        """Hash of the k bytes at every position from ``begin`` to before ``end``."""
        return mix((self.sum[begin + k:end + k] - self.sum[begin:end]) * self.pow[begin:end])


def ramp(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[i], starts[i]+1, ... sizes[i] values each, concatenated."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    base = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return base + np.arange(total)


def group_starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Index of the first row of every run of equal keys."""
    n = len(sorted_keys[0])
    if not n:
        return np.zeros(0, np.int64)
    new = np.ones(n, bool)
    new[1:] = False
    for k in sorted_keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def covered(size: int, starts: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Flags of the positions inside any [start, start + length)."""
    d = np.zeros(size + 1, np.int32)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + length, -1)
    return np.cumsum(d[:-1]) > 0
