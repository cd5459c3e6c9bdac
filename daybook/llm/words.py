"""Vectorised work on the words of an Arrow text column.

All functions take the column's own buffers (UTF-8 bytes and row offsets), so
a batch of texts is cut into words, hashed and shingled without a Python loop
over rows. ``slices`` bounds the bytes that are worked on at a time: one slice
holds whole texts of ``limit`` bytes together, or one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at a time.
SLICE_BYTES = 4 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0x80, 0x100)]] = True
_ALNUM = _LETTER.copy()
_ALNUM[[*range(ord("0"), ord("9") + 1)]] = True
KINDS = {"space": ~_SPACE, "letter": _LETTER, "alnum": _ALNUM}

#: Odd base of the polynomial hash and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(data: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each, never less than a row."""
    n, low = len(offsets) - 1, 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other bytes stay."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def spans(data: np.ndarray, offsets: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run of the kind's bytes; runs end at row borders."""
    inside = KINDS[kind][data]
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    borders = offsets[:-1][offsets[:-1] < len(data)]
    before[borders] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(inside & ~after) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


def span_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each span, equal for equal bytes (exact), and the text of each number."""
    if not len(starts):
        return np.zeros(0, np.int64), pa.array([], pa.large_string())
    # spans and the gaps between them, so that the bytes need no copy
    borders = np.empty(2 * len(starts), np.int64)
    borders[::2], borders[1::2] = starts, ends
    parts = pa.Array.from_buffers(pa.large_binary(), len(borders) - 1, [None, pa.py_buffer(borders), pa.py_buffer(data)])
    named = parts.take(pa.array(np.arange(0, len(parts), 2))).dictionary_encode()
    return named.indices.to_numpy().astype(np.int64), named.dictionary.cast(pa.large_string())


def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have:have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(len(data), _BASE), out=total[1:])
    back = _powers(len(data) + 1, _INVERSE)
    h = (total[ends] - total[starts]) * back[starts]
    return mixed(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingles(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every run of ``size`` words of one row.

    A row of fewer words, but at least one, gives one shingle of all its words.
    """
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    row_starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    row_ends = np.r_[row_starts[1:], n]
    short = row_ends - row_starts < size
    whole = np.zeros(n, bool)
    if n >= size:
        whole[:n - size + 1] = rows[:n - size + 1] == rows[size - 1:]
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h[:n - k] = h[:n - k] + mixed(hashes[k:] + np.uint64(k + 1)) * np.uint64(2 * k + 3)
    for s, e in zip(row_starts[short], row_ends[short], strict=True):
        whole[s] = True
        with np.errstate(over="ignore"):
            h[s] = np.uint64(e - s) + sum((mixed(hashes[s + k:s + k + 1] + np.uint64(k + 1))[0] * np.uint64(2 * k + 3)
                                           for k in range(e - s)), np.uint64(0))
    first = np.flatnonzero(whole)
    return mixed(h[first]), first
