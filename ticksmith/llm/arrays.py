"""Array helpers for work inside Spark tasks: words and hashes of Arrow text.

A text column arrives as one UTF-8 byte buffer with offsets.  Word boundaries,
64-bit word hashes and hashes of word n-grams are computed for a whole block
of rows at once, so no Python loop touches single words.  Blocks are bounded
by bytes (``blocks``), never by dropping rows: a row longer than the bound is
a block of its own.
"""

from __future__ import annotations

import ctypes
import ctypes.util

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def release() -> None:
    """Give freed memory back to the system, for workers that Spark keeps between tasks."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(ctypes.util.find_library("c") or None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES):
    """Row ranges (a, b) of about ``limit`` bytes each; at least one row."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b
    release()


def space_table() -> np.ndarray:
    """True for bytes of words ``[^\\x20\\x09-\\x0D]+``."""
    t = np.ones(256, bool)
    t[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    return t


def alnum_table() -> np.ndarray:
    """True for bytes of words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, after lower-casing."""
    t = np.zeros(256, bool)
    t[0x30:0x3A] = True
    t[0x61:0x7B] = True
    t[0x80:] = True
    return t


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, every other byte as it is."""
    return raw + ((raw >= 0x41) & (raw <= 0x5A)).astype(np.uint8) * np.uint8(0x20)


def words(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """(start, end, first) of all words of a block.

    ``first[i]:first[i + 1]`` are the words of row i; a word never crosses a
    row boundary.
    """
    n = len(raw)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = table[raw]
    head = inside.copy()
    head[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    head[cuts] = inside[cuts]
    tail = inside.copy()
    tail[:-1] &= ~inside[1:]
    tail[cuts - 1] = inside[cuts - 1]
    start = np.flatnonzero(head)
    end = np.flatnonzero(tail) + 1
    return start, end, np.searchsorted(start, offsets)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: bijective, spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every word: a polynomial over its bytes, then mixed.

    The prefix sums of ``byte * base^i`` give any word's polynomial as a
    difference, brought back to position 0 with the inverse power of its start.
    """
    if len(start) == 0:
        return np.zeros(0, np.uint64)
    n = len(raw)
    inverse = pow(_BASE, -1, 1 << 64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(n, _BASE), out=sums[1:])
    h = (sums[end] - sums[start]) * _powers(n, inverse)[start]
    return mix64(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on (len(h) - k + 1 of them).

    Positions whose k words cross a row are the caller's to leave out.
    """
    m = len(h) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    if k > 12:  # a prefix sum instead of k passes
        n = len(h)
        inverse = pow(_BASE, -1, 1 << 64)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(h * _powers(n, _BASE), out=sums[1:])
        return mix64((sums[k:] - sums[:-k])[:m] * _powers(n, inverse)[:m])
    acc = h[:m].copy()
    for j in range(1, k):
        acc = acc * np.uint64(_BASE) + h[j:j + m]
    return mix64(acc)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values (len(x) - w + 1), by doubling."""
    if len(x) < w:
        return x[:0]
    out, span = x, 1
    while span * 2 <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = w - span
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out

