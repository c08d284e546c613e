"""Words and word shingles of Arrow text columns, as numpy arrays.

Works on the UTF-8 bytes of about a megabyte of documents at a time, so memory
stays flat however long a batch is (one document is always whole).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SLICE_ROWS = 8192  # also fits the 16-bit row numbers of distinct()

#: `[^\x20\x09-\x0D]+`
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing: digits, a-z and all beyond ASCII
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_M1, _M2, _GOLD = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))
_STEP = np.uint64(0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first n of eight bytes


class Slice(NamedTuple):
    lo: int  # first row of the batch
    hi: int
    data: np.ndarray  # bytes
    offsets: np.ndarray  # of the rows in data


class Tokens(NamedTuple):
    starts: np.ndarray  # byte positions
    ends: np.ndarray
    first: np.ndarray  # number of the first word of each row, and of all words
    row: np.ndarray  # row of each word


def slices(texts: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """The rows of a string array, nulls as empty, in runs of about max_bytes."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    n = len(texts)
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), lo + SLICE_ROWS, n)
        yield Slice(lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def tokenize(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> Tokens:
    rows = len(offsets) - 1
    inside = word[data]
    full = offsets[:-1] < offsets[1:]
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][full]] = False
    after = np.zeros(len(inside), bool)
    after[:-1] = inside[1:]
    after[offsets[1:][full] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, offsets)
    return Tokens(starts, ends, first, np.repeat(np.arange(rows), np.diff(first)))


def hash_words(data: np.ndarray, t: Tokens, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of each word: its blocks of eight bytes are
    mixed with their place, each on its own, and only then summed.  Hashes of
    different seeds are independent."""
    if not len(t.starts):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    size = t.ends - t.starts
    blocks = (size + 7) // 8
    first = np.cumsum(blocks) - blocks
    place = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    at = np.repeat(t.starts, blocks) + 8 * place
    # eight bytes from any place on, as a number
    number = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))[at]
    number &= _LOW[np.minimum(np.repeat(size, blocks) - 8 * place, 8)]
    part = mix(number ^ mix(place.astype(np.uint64) + np.uint64(seed << 32)))
    return mix(np.add.reduceat(part, first) + size.astype(np.uint64))


def fold(hashes: np.ndarray, first: np.ndarray, k: int, step: np.uint64 = _STEP) -> np.ndarray:
    """The hash of the k words from each position in ``first``."""
    h = np.full(len(first), k, np.uint64)
    for j in range(k):
        h = h * step + hashes[first + j]
    return mix(h)


def windows(t: Tokens, k: int) -> np.ndarray:
    """Positions (in the slice) of words that begin k words of one row."""
    n = len(t.row) - k + 1
    return np.flatnonzero(t.row[:n] == t.row[k - 1 :]) if n > 0 else np.zeros(0, np.int64)


def shingles(hashes: np.ndarray, t: Tokens, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the k-word shingles; rows of fewer words give their whole sequence."""
    at = windows(t, k)
    rows, out = [t.row[at]], [fold(hashes, at, k)]
    counts = np.diff(t.first)
    for c in range(1, k):
        short = np.flatnonzero(counts == c)
        rows.append(short)
        out.append(fold(hashes, t.first[short], c))
    return np.concatenate(rows), np.concatenate(out)


def distinct(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hash), sorted by row, then hash."""
    o = np.argsort(hashes)
    o = o[np.argsort(rows[o].astype(np.uint16), kind="stable")]
    r, h = rows[o], hashes[o]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    return r[new], h[new]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return LOWER[data]


def binary_cuts(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The array cut at ``cuts``, as an Arrow binary column."""
    raw = np.ascontiguousarray(values)
    offs = (np.asarray(cuts, np.int64) * raw.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offs) - 1, [None, pa.py_buffer(offs.tobytes()), pa.py_buffer(raw.tobytes())])


def longs(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def from_binary(column: pa.Array, dtype=np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Values and cuts (counted in values) of a binary column without nulls."""
    column = column.cast(pa.large_binary())
    n = len(column)
    _, offs, data = column.buffers()
    cuts = np.frombuffer(offs, np.int64)[column.offset : column.offset + n + 1]
    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(data, np.uint8)[cuts[0] : cuts[-1]] if n else np.zeros(0, np.uint8)
    return raw.view(dtype) if len(raw) else np.zeros(0, dtype), (cuts - cuts[0]) // size if n else np.zeros(1, np.int64)
