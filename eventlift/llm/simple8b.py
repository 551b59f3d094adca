"""Simple-8b: several small unsigned integers in one 64-bit word.

The top four bits of a word are its selector.  Selectors 1 to 14 hold ``COUNTS`` values of
``WIDTHS`` bits, the first in the lowest bits; selector 15 is a run of 240 zeros.  Selector 0
is an escape: the next word is one raw value that needs more than 60 bits.  (Such a value has a
bit among the top four, so a raw word is never taken for an escape.)

Sequences are cut into blocks that start at a word of their own.  Both directions work on all
blocks of a batch at once.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
#: Fixed values of the format, by selector.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 240])
WIDTHS = np.array([64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0])
_SHIFT = np.uint64(60)


def block_starts(lengths: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the blocks of sequences that lie one after the other."""
    number = -(-lengths // block)
    inner = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number)
    starts = np.repeat(np.cumsum(lengths) - lengths, number) + inner * block
    return starts, np.minimum(np.repeat(lengths, number) - inner * block, block)


def _bits(values: np.ndarray) -> np.ndarray:
    if len(values) and int(values.max()) < 1 << 52:
        return np.frexp(values.astype(np.float64))[1].astype(np.uint8)
    return np.searchsorted(np.uint64(1) << np.arange(64, dtype=np.uint64), values, side="right").astype(np.uint8)


def _selectors(bits: np.ndarray) -> np.ndarray:
    """For each place, the selector that packs most values from there on."""
    n = len(bits)
    best = np.where(bits > 60, 0, 14).astype(np.uint8)
    maxima = {1: bits}
    size = 1
    while size < 128:
        last = maxima[size]
        wide = last.copy()
        if n > size:
            wide[:-size] = np.maximum(last[:-size], last[size:])
        maxima[2 * size] = wide
        size *= 2
    for s in [*range(13, 0, -1), 15]:
        count, width = int(COUNTS[s]), int(WIDTHS[s])
        base = 1 << (count.bit_length() - 1)
        most = maxima[base].copy()
        if n > count - base:
            most[: n - (count - base)] = np.maximum(most[: n - (count - base)], maxima[base][count - base :])
        best[most <= width] = s
    return best


def encode(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all blocks, which lie one after the other, in order, and the offset of each block's first word (and the end)."""
    values = values.astype(np.uint64)
    best = _selectors(_bits(values))
    ends = starts + lengths
    order = np.argsort(-lengths, kind="stable")
    at, active, steps = starts[order].copy(), order, []
    while len(active):
        going = at < ends[active]
        at, active = at[going], active[going]
        if not len(active):
            break
        steps.append((active, at))
        at = at + COUNTS[best[at]]
    if not steps:
        return np.zeros(0, np.uint64), np.zeros(len(starts) + 1, np.int64)
    block = np.concatenate([a for a, _ in steps])
    place = np.concatenate([p for _, p in steps])
    # blocks lie one after the other, so the order of places is that of blocks
    taken = np.zeros(len(values), bool)
    taken[place] = True
    place = np.flatnonzero(taken)
    block = np.repeat(np.arange(len(starts)), np.bincount(block, minlength=len(starts)))
    chosen = best[place]
    size = np.where(chosen == 0, 2, 1)
    slot = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    words[slot] = chosen.astype(np.uint64) << _SHIFT
    for s in np.unique(chosen):
        rows = np.flatnonzero(chosen == s)
        if s == 0:
            words[slot[rows] + 1] = values[place[rows]]
        elif s < 15:
            take = place[rows][:, None] + np.arange(COUNTS[s])
            inside = take < ends[block[rows]][:, None]
            held = np.where(inside, values[np.where(inside, take, 0)], np.uint64(0))
            held <<= np.arange(COUNTS[s], dtype=np.uint64) * np.uint64(WIDTHS[s])
            words[slot[rows]] |= np.bitwise_or.reduce(held, axis=1)
    per_block = np.bincount(block, weights=size, minlength=len(starts)).astype(np.int64)
    return words, np.concatenate([[0], np.cumsum(per_block)])


def decode(words: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The values of all blocks in order."""
    out = np.zeros(int(lengths.sum()), np.uint64)
    if not len(words):
        return out
    selector = (words >> _SHIFT).astype(np.int64)
    raw = np.append(False, selector[:-1] == 0)
    count = np.where(raw, 0, COUNTS[selector])
    before = np.cumsum(count) - count
    block = np.repeat(np.arange(len(lengths)), np.diff(offsets))
    first = np.cumsum(lengths) - lengths
    place = before - before[offsets[block]] + first[block]
    end = (first + lengths)[block]
    selector[raw] = -1
    for s in np.unique(selector[~raw]):
        rows = np.flatnonzero(selector == s)
        if s == 0:
            out[place[rows]] = words[rows + 1]
        elif s < 15:
            shifts = np.arange(COUNTS[s], dtype=np.uint64) * np.uint64(WIDTHS[s])
            held = (words[rows][:, None] >> shifts) & np.uint64((1 << int(WIDTHS[s])) - 1)
            target = place[rows][:, None] + np.arange(COUNTS[s])
            inside = target < end[rows][:, None]
            out[target[inside]] = held[inside]
    return out
