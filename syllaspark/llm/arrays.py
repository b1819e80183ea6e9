"""Numpy views of Arrow text columns, word boundaries and hashes.

Everything here works on slices of a batch, so that temporaries stay within a few
tens of megabytes whatever the batch holds.  A single longer text is one slice.
"""

from __future__ import annotations

import ctypes
import hashlib

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Spans of up to eight times so many bytes are hashed in rounds.
_ROUNDS = 4
#: The first k bytes of eight.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], U)
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x + U((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INV)):
            p = np.full(max(n, SLICE_BYTES + 1), base, U)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    return _powers[0][:n], _powers[1][:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1) and bytes of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offs, raw


def slices(column: pa.Array, limit: int = SLICE_BYTES):
    """(first row, last row + 1, bytes, offsets from 0) of runs of rows of about ``limit`` bytes."""
    offs, raw = utf8(column)
    n, at = len(offs) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield at, to, raw[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
        at = to


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than white space, and how many each text has.

    A text's end also ends a word.
    """
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs) - 1, np.int64)
    inside = ~IS_SPACE[buf]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    counts = np.diff(np.searchsorted(starts, offs))
    return starts, ends, counts


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each byte span: eight bytes a round, and a digest of spans beyond four rounds."""
    if lower:
        buf = _LOWER[buf]
    size = ends - starts
    padded = np.append(buf, np.zeros(8, np.uint8))
    eight = np.ndarray((len(buf) + 1,), "<u8", padded, strides=(1,))
    out = mix(size.astype(U))
    for k in range(_ROUNDS):
        on = np.flatnonzero(size > 8 * k) if k else slice(None)
        left = np.minimum(size[on] - 8 * k, 8)
        out[on] = mix(out[on] ^ (eight[starts[on] + 8 * k] & _FIRST[left]), k + 1)
        if k + 1 < _ROUNDS and not (size[on] > 8 * (k + 1)).any():
            return out
    long = np.flatnonzero(size > 8 * _ROUNDS)
    view = memoryview(buf)
    digests = [hashlib.blake2b(view[a:b], digest_size=8).digest() for a, b in zip(starts[long].tolist(), ends[long].tolist())]
    out[long] = np.frombuffer(b"".join(digests), "<u8")
    return out


def chained(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive entries (also of runs across texts; callers leave those out)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, U)
    out = hashes[:n] * U(3)
    for j in range(1, width):
        out = mix(out + hashes[j : j + n], j)
    return out


def has_letter_table() -> np.ndarray:
    """For each code point, whether Unicode counts it a letter."""
    import sys
    import unicodedata

    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def tidy(f):
    """``f`` as a task that gives freed memory back, as workers outlive tasks and share an executor's limit."""

    def run(batches):
        try:
            yield from f(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return run
