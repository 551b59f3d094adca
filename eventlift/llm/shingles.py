"""Word and shingle hashes of whole text columns, vectorised over Arrow buffers.

Words are runs of bytes other than space and tab to carriage return, with A-Z lower-cased.
A word hash is a polynomial over per-byte random values modulo 2^64; shingle hashes
combine word hashes.  Seeds are fixed, so equal texts have equal hashes in every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1_000_000

_rng = np.random.default_rng(20240131)
_BYTE = _rng.integers(1, 2**64, 256, dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE[_SPACE] = 0
_BYTE[65:91] = _BYTE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = _rng.integers(1, 2**64, 64, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the n + 1 offsets of its rows; null counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if at else np.zeros(1, np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges that hold about ``most`` bytes, one row at least."""
    _, offsets = buffers(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the n + 1 offsets of the rows in them."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    solid = ~_SPACE[data]
    start = solid.copy()
    start[1:] &= ~solid[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[heads] = solid[heads]
    starts = np.flatnonzero(start)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    lengths = np.diff(np.append(starts, len(data)))
    data = data[starts[0] :]
    place = np.arange(len(data), dtype=np.int32) - np.repeat((starts - starts[0]).astype(np.int32), lengths)
    values = _BYTE[data]
    # trailing space of a word counts as zero, so its places need no power of their own
    place[values == 0] = 0
    values *= _powers(int(place.max()) + 1)[place]
    return mix(np.add.reduceat(values, starts - starts[0])), np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word shingles in order and the row offsets in them.

    A row of fewer words, but one at least, has its whole sequence as its only shingle.
    """
    counts = np.diff(rows)
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out_rows = np.concatenate([[0], np.cumsum(n)])
    if not out_rows[-1]:
        return np.zeros(0, np.uint64), out_rows
    firsts = np.repeat(rows[:-1] - out_rows[:-1], n) + np.arange(out_rows[-1])
    have = np.minimum(np.repeat(counts, n), size)
    padded = np.append(words, np.zeros(size, np.uint64))
    total = have.astype(np.uint64) * _STEP[63]
    short = bool((have < size).any())
    for j in range(size):
        part = padded[firsts + j] * _STEP[j]
        if short:
            part[have <= j] = 0
        total += part
    return mix(total), out_rows


def shingle_sets(column: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    for first, last in pieces(column):
        data, offsets = buffers(column.slice(first, last - first))
        hashes, rows = shingle_hashes(*word_hashes(data, offsets), size)
        for i in range(last - first):
            own = np.sort(hashes[rows[i] : rows[i + 1]])
            yield own[np.append(True, own[1:] != own[:-1])] if len(own) else own


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned hashes as the longs that Spark stores."""
    return x.view(np.int64)
