"""Numpy kernels shared by the operators of this subpackage.

A *text block* is one UTF-8 byte array holding several texts end to end plus the offset
of each (what an Arrow string column is).  Words are runs of bytes outside
``[\\x20\\x09-\\x0D]``; they never cross texts.  All hashing is arithmetic modulo 2**64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: one block holds about this many bytes (or one longer text)
BLOCK_BYTES = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values with good avalanche (xor-shift-multiply finaliser)."""
    x = np.atleast_1d(np.asarray(x, dtype=U))
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def byte_values(lower: bool, seed: int = 1) -> np.ndarray:
    """A random 64-bit value per byte; ``lower`` gives A-Z the values of a-z."""
    v = mix(np.arange(256, dtype=U) + U(seed * 1000003 + 7))
    if lower:
        v[65:91] = v[97:123]
    return v


SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        have = np.full(size, base, dtype=U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * BLOCK_BYTES:
            _POWERS[base] = have
    return have


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """64-bit hash of ``data[s:e]`` for each span (of a few hundred bytes at most), from one prefix sum over the block."""
    prefix = np.zeros(len(data) + 1, dtype=U)
    np.cumsum(values[data] * _powers(_BASE, len(data))[: len(data)], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * _powers(_INV, len(data) + 1)[starts]
               + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


#: the first k bytes of a little-endian 64-bit word
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=U)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool, *seeds: int) -> list[np.ndarray]:
    """One 64-bit hash of ``data[s:e]`` per seed for each span, A-Z as a-z when ``lower``.

    A span is read as 8-byte words; each is mixed with its place before the words are summed, so
    no two texts share a hash by their structure (``span_hashes`` is linear in its bytes: some
    pairs of long runs over two letters collide whatever the base; it serves short windows only).
    Hashes of different seeds are independent.
    """
    size = ends - starts
    if not len(size):
        return [np.zeros(0, U) for _ in seeds]
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = _LOWER[data] if lower else data
    word_at = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    parts = np.maximum((size + 7) >> 3, 1)
    long_ = parts > 1
    out = []
    if not long_.any():
        word = word_at[starts] & _FIRST_BYTES[size]
        sums = [mix(word ^ mix(U(seed))) for seed in seeds]
    else:
        first = np.cumsum(parts) - parts
        place = np.arange(int(first[-1] + parts[-1])) - np.repeat(first, parts)
        left = np.minimum(np.repeat(size, parts) - 8 * place, 8)
        word = word_at[np.repeat(starts, parts) + 8 * place] & _FIRST_BYTES[left]
        place = place.astype(U) * U(0xD1342543DE82EF95)
        sums = [np.add.reduceat(mix(word ^ mix(place + U(seed))), first) for seed in seeds]
    for x, seed in zip(sums, seeds):
        out.append(mix(x + size.astype(U) * U(0xD6E8FEB86659FD93) + U(seed)))
    return out


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string or binary column; nulls become empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``size`` bytes together, at least one row each."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


def release() -> None:
    """Give freed memory back to the system: workers live on between tasks and share a machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not a C library with malloc_trim
        pass


def text_blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets) of the blocks of one column."""
    data, offsets = text_arrays(column)
    for a, b in blocks(offsets, size):
        yield a, b, data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]
    release()


def small_batches(batches, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few rows, for kernels that make Python objects of their texts."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
        release()


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text index of every word of a block; ``between`` marks the bytes of no word."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~between[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    first[cut] |= inside[cut]
    last[cut - 1] |= inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text index of every ``\\n``-separated line (an empty text has one empty line)."""
    breaks = np.flatnonzero(data == 10)
    row = np.searchsorted(offsets, breaks, side="right") - 1
    starts = np.concatenate([offsets[:-1], breaks + 1])
    ends_row = np.concatenate([np.arange(len(offsets) - 1), row])
    # a text's lines are ordered by start; its own offset comes first among equals
    order = np.lexsort((starts, ends_row))
    starts, rows = starts[order], ends_row[order]
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    tail = np.append(rows[1:] != rows[:-1], True)
    ends[tail] = offsets[rows[tail] + 1]
    return starts, ends, rows


def run_hashes(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each ``n`` successive entries of ``h`` inside one row, and the index of the first."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    acc = np.zeros(m, dtype=U)
    for j in range(n):
        acc = acc * U(0x100000001B3) + h[j: j + m]
    at = np.flatnonzero(row[:m] == row[n - 1:])
    return mix(acc[at]), at


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, n: int,
                   lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``n``-word shingles of each text and their text index, in order.

    A text of 1 to ``n - 1`` words has one shingle: all its words.  Words are compared
    with A-Z lower-cased when ``lower``.
    """
    s, e, row = word_spans(data, offsets)
    h, = digests(data, s, e, lower, 1)
    sh, at = run_hashes(h, row, n)
    rows = row[at]
    count = np.bincount(row, minlength=len(offsets) - 1)
    for length in range(1, n):
        short = np.flatnonzero(count == length)
        if len(short):
            first = np.searchsorted(row, short)
            acc = np.full(len(short), length, dtype=U)
            for j in range(length):
                acc = acc * U(0x100000001B3) + h[first + j]
            sh, rows = np.concatenate([sh, mix(acc)]), np.concatenate([rows, short])
    if len(rows) and np.any(rows[1:] < rows[:-1]):
        order = np.argsort(rows, kind="stable")
        sh, rows = sh[order], rows[order]
    return sh, rows


def as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64) if h.dtype == U else h.astype(np.int64)
