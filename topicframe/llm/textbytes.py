"""Numpy helpers over the UTF-8 bytes of an Arrow text column: words, hashes, sliding minima."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in blocks of about this many bytes, so that a worker's memory is
#: bounded by the block and by the longest single text.
BLOCK = 1 << 17
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_U = np.uint64


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def blocks(off: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of at most limit bytes together, or one longer text alone."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def byte_table(spans: list[tuple[int, int]]) -> np.ndarray:
    table = np.zeros(256, bool)
    for first, last in spans:
        table[first : last + 1] = True
    return table


#: bytes of words that end at ASCII white space
SPACED = ~byte_table([(0x20, 0x20), (0x09, 0x0D)])
#: bytes of words of ASCII letters, ASCII digits and anything beyond ASCII
ALNUM = byte_table([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])


def lowered(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z, nothing else."""
    return np.where((raw >= 0x41) & (raw <= 0x5A), raw + 32, raw).astype(np.uint8)


def words(raw: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every word, and the index of the first word of each text (one more at the end)."""
    inside = table[raw]
    heads = off[:-1][off[:-1] < off[1:]]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = heads[1:] - 1
    last[tails] = inside[tails]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, off)


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def table(base: int) -> np.ndarray:
        out = np.ones(size + 1, _U)
        out[1:] = _U(base)
        return np.cumprod(out, dtype=_U)

    return table(_BASE), table(pow(_BASE, -1, 1 << 64))


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, at least size + 1 of each."""
    most = 1 << 16
    while most < size:
        most *= 2
    if most > 1 << 22:  # one very long text: not kept
        return _powers.__wrapped__(most)
    return _powers(most)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(33)
    return h


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every byte span, from one running sum."""
    up, down = powers(len(raw))
    total = np.zeros(len(raw) + 1, _U)
    np.cumsum((raw.astype(_U) + _U(1)) * up[: len(raw)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(_U))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive hashes, by doubling; shorter than the input by k - 1."""
    have, out, rest = 0, None, k
    part, width, factor = h, 1, 0xD6E8FEB86659FD93
    while rest:
        if rest & 1:
            if out is None:
                out, have = part, width
            else:
                n = len(h) - have - width + 1
                if n <= 0:
                    return np.zeros(0, _U)
                out = out[:n] * _U(factor) + part[have : have + n]
                have += width
        rest >>= 1
        if rest:
            n = len(part) - width
            if n <= 0:
                return np.zeros(0, _U)
            part, width, factor = part[:n] * _U(factor) + part[width : width + n], width * 2, factor * factor & _MASK
    out = out * _U(0xFF51AFD7ED558CCD)
    out ^= out >> _U(32)
    return out


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    width, out = 1, h
    while width * 2 <= w and len(out) > width:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    if width < w:
        rest = w - width
        if len(out) <= rest:
            return out[:0]
        out = np.minimum(out[:-rest], out[rest:])
    return out


def covered(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Mask of the positions inside any of the spans."""
    edge = np.bincount(starts, minlength=size + 1) - np.bincount(ends, minlength=size + 1)
    return np.cumsum(edge[:size]) > 0
