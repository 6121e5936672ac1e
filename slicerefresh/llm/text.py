"""Array kernels over the UTF-8 buffers of an Arrow text column.

The operators read whole texts as one byte buffer per Arrow batch and work on
it with numpy, in blocks of about a megabyte, so that the memory of a task does
not grow with the number of rows.  A text longer than a block is one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

_U = np.uint64
_MUL = _U(0x9E3779B97F4A7C15)
_ROLL = _U(0xD1342543DE82EF95)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (xor-shift-multiply)."""
    h = h ^ (h >> _U(30))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


_BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * _MUL)

#: Words are runs of other bytes than these: space and 0x09 to 0x0D.
_IS_SEP = np.zeros(256, bool)
_IS_SEP[[9, 10, 11, 12, 13, 32]] = True

LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield ``(first row, end row, bytes, offsets)``; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if not n:
        return
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, width)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j, raw[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


class _Powers:
    """Powers of the rolling base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def __reduce__(self):
        return type(self), ()

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK_BYTES + 1)
            inverse = _U(pow(int(_ROLL), -1, 1 << 64))
            for name, base in (("up", _ROLL), ("down", inverse)):
                powers = np.full(size, base, np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))
        return self.up, self.down


_POWERS = _Powers()


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the rolling hash: ``out[i]`` covers ``data[:i]``."""
    up, _ = _POWERS.upto(len(data) + 1)
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(_BYTE_HASH[data] * up[: len(data)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free 64-bit hashes of the byte ranges ``[start, end)``."""
    _, down = _POWERS.upto(len(prefix))
    h = (prefix[end] - prefix[start]) * down[start]
    return mix(h + (end - start).astype(np.uint64) * _MUL)


def words(data: np.ndarray, off: np.ndarray, is_sep: np.ndarray = _IS_SEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word of a block; words end with their row."""
    n = len(data)
    if not n:
        none = np.empty(0, np.int64)
        return none, none, none
    sep = is_sep[data]
    edge = np.empty(n + 1, bool)
    edge[1:] = sep
    edge[0] = True
    begins = edge[:-1]
    begins[off[:-1][off[:-1] < n]] = True
    start = np.flatnonzero(begins & ~sep)
    ends = np.empty(n, bool)
    ends[:-1] = sep[1:]
    ends[-1] = True
    ends[off[1:][off[1:] > 0] - 1] = True
    end = np.flatnonzero(ends & ~sep) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def lane_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the byte ranges ``[start, end)``, eight bytes at a time.

    Each step mixes the next eight bytes into a mixed state, so that no pair of
    strings is equal under every seed.  A range of ``n`` bytes takes ``n / 8``
    steps over the ranges that are as long.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    left = (end - start).astype(np.int64)
    h = mix(left.astype(np.uint64) * _MUL + _U(seed))
    at, live = start.astype(np.int64), np.flatnonzero(left > 0)
    at, left = at[live], left[live]
    while len(live):
        x = lanes[at]
        short = np.flatnonzero(left < 8)
        x[short] &= (_U(1) << (_U(8) * left[short].astype(np.uint64))) - _U(1)
        h[live] = mix((h[live] ^ mix(x + _MUL)) + _ROLL)
        at, left = at + 8, left - 8
        more = left > 0
        live, at, left = live[more], at[more], left[more]
    return h


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of words, their ASCII letters lower-cased."""
    return lane_hashes(LOWER_ASCII[data], start, end)


def shingle_hashes(word: np.ndarray, row: np.ndarray, width: int, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of runs of ``width`` words, with their row and first word.

    A row with some words but fewer than ``width`` gives one shingle of all
    its words.  Shingles keep the order of the text, repeats included.
    """
    if not len(word):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    n = len(word)
    acc = word.copy()
    count = np.bincount(row, minlength=n_rows)
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    h, at = [], []
    for k in range(1, width + 1):
        if k > 1:
            acc = acc[: n - k + 1] * _MUL + word[k - 1 :] if n >= k else acc[:0]
            acc ^= acc >> _U(29)
        if k < width:
            rows = np.flatnonzero(count == k)
            if len(rows):
                at.append(first[rows])
                h.append(mix(acc[first[rows]] + _U(k)))
        elif n >= width:
            whole = np.flatnonzero(row[: n - width + 1] == row[width - 1 :])
            at.append(whole)
            h.append(mix(acc[whole] + _U(width)))
    if not h:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    h, at = np.concatenate(h), np.concatenate(at)
    order = np.argsort(at, kind="stable")
    h, at = h[order], at[order]
    return h, row[at], at


def row_bounds(row: np.ndarray, n_rows: int) -> np.ndarray:
    """Offsets of each row in an array sorted by row."""
    return np.searchsorted(row, np.arange(n_rows + 1))


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def list_array(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return h.view(np.int64)
