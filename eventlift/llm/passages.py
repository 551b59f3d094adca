"""Repeated passages by collinear chains of shared seeds.

Seeds are hashes of ``SEED`` words; one is kept where the least of its ``PART``-word hashes is its first or
last.  That depends on its own words only, so a seed that two texts share is kept in both, and of any
``SEED - PART`` seeds in a row one is kept.  Besides, runs of ``LONG`` words are keys too:
a passage made of parts that were each first seen in another text meets there the text that has it whole.
Every occurrence of a key is joined to the first one, that of the smallest doc_id; a key in n texts
gives n - 1 anchors, not n squared.  The anchors of a text and a first text are chained: in order of place in one text, a Fenwick
tree over the places in the other finds the best chain to go on from, less a cost for the words
between.  Chains, of one anchor also, are then aligned word by word: the words between anchors by edit distance, and
beyond the ends past changed, left out and added words.

Most pairs of texts share a stray anchor or two, so texts are not sent along with all of them: first the
words next to the anchors go to the other text.  Where these show that the alignment ends too soon for a passage, the
pair is done; where it goes on beyond them, or a chain has several runs, the pair is aligned on the whole texts.
Occurrences of keys are shuffled packed, by leading bits of the key, in two kinds: the first of a key in a task's
share, from which the first of all is found, and the others, which meet it one pack at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlift.llm.shingles import _STEP, buffers, mix, pieces, word_hashes
from eventlift.llm.tables import batch_rows, removed, width, written
from eventlift.llm.worker import lean

SEED, PART = 5, 2
#: Longer keys as (words, places): of so many places in a row one starts a key.  Of any 50 words that two texts share one key of 36 is shared, of any 57 one of 50.
LONG = ((36, 15), (50, 8))
#: Cost of a word between anchors, in either text.
GAP = 0.1
#: Places from one anchor to the next, alike in both texts, up to which it is always worth to go on: they cost less than an anchor gives.
_CLOSE = int((SEED - GAP) / (2 * GAP))
#: A passage has so many words at least, and such a share of them agrees.
LEAST_WORDS, LEAST_SHARE = 50, 0.75
#: Beyond the ends, a word that does not agree undoes so many that do: first the wider rule, then that of LEAST_SHARE.
_COSTS = (2, 3)
#: Extension stops so far below its best score; it steps over so many words of one text at once.
_DROP, _STEPS = 12, 4
#: It looks for a step where some of so many words agree.
_AHEAD = 12
#: Words beside a run that are looked at, of many runs at once.
_SIGHT = 64
#: Words beside a run that are looked at first.
_NEAR = 24
#: Occurrences that a task packs at once, packs of an incoming batch, rows of an outgoing one, rows with a text, and runs looked at together.
PACKED, BATCH_PACKS, BATCH_ANCHORS, BATCH_TEXTS, BATCH_RUNS = 2_000_000, 200, 100_000, 2000, 20_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _rolling(words: np.ndarray, size: int) -> np.ndarray:
    """``shingle_hashes`` at every place of one row of words, before they are mixed."""
    n = max(0, len(words) - size + 1)
    total = np.full(n, np.uint64(size) * _STEP[63])
    for j in range(size):
        total += words[j : j + n] * _STEP[j]
    return total


def keys(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, place) of the kept seeds of rows of words, and of the longer keys, which start at the least seed of a window of places."""
    counts = np.diff(rows)
    row = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    ahead = np.repeat(rows[1:], counts) - np.arange(len(words))  # words from a place to the end of its row
    if len(words) < SEED:
        return np.zeros(0, np.uint64), row[:0], ahead[:0]
    every, parts, last = mix(mix(_rolling(words, SEED))), mix(_rolling(words, PART)), SEED - PART
    least = parts[: len(every)].copy()
    for i in range(1, last + 1):
        np.minimum(least, parts[i : i + len(every)], out=least)
    inside = ahead[: len(every)] >= SEED
    place = np.flatnonzero(((parts[: len(every)] == least) | (parts[last:] == least)) & inside)
    hashes, places = [every[place]], [place]
    if counts.max() >= min(LONG)[0]:
        sums = np.append(np.uint64(0), np.cumsum(words * _powers(_BASE, len(words))))
        back = _powers(_BACK, len(words))
        for size, window in LONG:
            first = _least_places(every, window)
            chosen = np.zeros(len(words), bool)
            chosen[first[ahead[: len(first)] >= window + SEED - 1]] = True
            at = np.flatnonzero(chosen & (ahead >= size))
            hashes.append(mix((sums[at + size] - sums[at]) * back[at] + np.uint64(size)))
            places.append(at)
    place = np.concatenate(places)
    return np.concatenate(hashes), row[place], place - rows[row[place]]


def _least_places(values: np.ndarray, window: int) -> np.ndarray:
    """The place of the first least value of each window of places."""
    at, size = np.arange(len(values)), 1
    while size < window:
        step = min(size, window - size)
        n = max(0, len(values) - step)
        at = np.where(values[step:] < values[:n], at[step:], at[:n])
        values = np.minimum(values[:n], values[step:])
        size += step
    return at


def _packs(found: list[tuple[int | np.ndarray, np.ndarray, np.ndarray]], bits: int) -> pa.RecordBatch:
    """Occurrences (doc or docs, hashes, places) by the first ``bits`` of the hash, at least 8, and kind: 0 the first of a hash, 1 others."""
    seed, place = (np.concatenate([f[i] for f in found]) for i in (1, 2))
    doc = np.concatenate([np.broadcast_to(np.asarray(f[0], np.int64), len(f[1])) for f in found])
    order = np.argsort(doc, kind="stable")
    seed, doc, place = seed[order], doc[order], place[order].astype(np.int32)
    # numbers of leading bits and place are sorted faster than places by hash; a hash among others of its leading bits may have several firsts
    low = np.uint64(len(seed).bit_length())
    order = (np.sort(seed >> low << low | np.arange(len(seed), dtype=np.uint64)) & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    inside = seed[order]
    kind = np.zeros(len(seed), np.int64)
    kind[order[1:]] = inside[1:] == inside[:-1]
    group = (seed >> np.uint64(64 - bits)).astype(np.int64) * 2 + kind
    # of 16 bits, numbers are sorted without comparing them
    order = np.argsort(group.astype(np.uint16) if bits < 16 else group, kind="stable")
    group, seed, doc, place = group[order], seed[order], doc[order], place[order]
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    packer = zstandard.ZstdCompressor(level=1)
    low = np.ascontiguousarray(seed.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7])
    hashes, rest = [], []
    for a, b in zip(starts, np.append(starts[1:], len(group))):
        hashes.append(low[a:b].tobytes())
        step = np.diff(doc[a:b], prepend=0).astype("<i8")
        planes = (np.ascontiguousarray(x.view(np.uint8).reshape(b - a, -1).T).tobytes() for x in (step, place[a:b].astype("<i4")))
        rest.append(packer.compress(b"".join(planes)))
    return pa.RecordBatch.from_arrays([pa.array((group[starts] >> 1).astype(np.int32)), pa.array((group[starts] & 1).astype(np.int8)), pa.array(hashes, pa.binary()), pa.array(rest, pa.binary())], names=["bucket", "kind", "hashes", "rest"])


def _unpacked(bucket: int, hashes: bytes, rest: bytes, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, doc, place) of a pack."""
    n = len(hashes) // 7
    seed = np.empty((n, 8), np.uint8)
    seed[:, :7] = np.frombuffer(hashes, np.uint8).reshape(n, 7)
    seed[:, 7] = bucket >> (bits - 8)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(rest), np.uint8)
    step = np.ascontiguousarray(planes[: 8 * n].reshape(8, n).T).view("<i8").ravel()
    place = np.ascontiguousarray(planes[8 * n :].reshape(4, n).T).view("<i4").ravel()
    return seed.view("<u8").ravel(), np.cumsum(step), place


def _seeder(bits: int):
    """Packs of the keys of rows (doc, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, waiting = [], 0
        for batch in batches:
            docs = batch.column(0).to_numpy()
            for first, last in pieces(batch.column(1)):
                data, offsets = buffers(batch.column(1).slice(first, last - first))
                hashes, row, place = keys(*word_hashes(data, offsets))
                found.append((docs[first:last][row], hashes, place))
                waiting += len(hashes)
                if waiting > PACKED:
                    yield _packs(found, bits)
                    found, waiting = [], 0
        if waiting:
            yield _packs(found, bits)

    return run


def _anchors(bits: int):
    """From packs in order of (bucket, kind): each occurrence with the first of its key, where that is in another text."""

    def leads(firsts: list[tuple]) -> tuple[tuple, tuple]:
        """The first occurrence of each key, and the anchors of those that are not."""
        seed, doc, place = (np.concatenate(c) for c in zip(*firsts))
        order = np.argsort(seed)
        equal = seed[order[1:]] == seed[order[:-1]]
        several = np.flatnonzero(np.append(equal, False) | np.append(False, equal))
        some = order[several]
        order[several] = some[np.lexsort((place[some], doc[some], seed[some]))]
        seed, doc, place = seed[order], doc[order], place[order]
        starts = np.flatnonzero(np.append(True, ~equal))
        lead = seed[starts], doc[starts], place[starts]
        return lead, anchored((seed, doc, place), lead)

    def anchored(some: tuple, lead: tuple) -> tuple:
        seed, doc, place = some
        at = np.searchsorted(lead[0], seed)
        other = lead[1][at] != doc
        return doc[other], lead[1][at][other], place[other], lead[2][at][other]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, firsts, lead, out, waiting = None, [], None, [], 0

        def batch_of() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*out)]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc", "lead", "x", "y"])

        for batch in batches:
            for now, kind, hashes, rest in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if firsts and (now != bucket or kind):
                    lead, found = leads(firsts)
                    firsts = []
                    out.append(found)
                    waiting += len(found[0])
                bucket = now
                some = _unpacked(now, hashes, rest, bits)
                if kind:
                    out.append(anchored(some, lead))
                    waiting += len(out[-1][0])
                else:
                    firsts.append(some)
                if waiting > BATCH_ANCHORS:
                    yield batch_of()
                    waiting = 0
        if firsts:
            out.append(leads(firsts)[1])
        if out:
            yield batch_of()

    return run


def chains(x: list[int], y: list[int], seed: int = SEED, gap: float = GAP) -> list[list[int]]:
    """Chains of anchors (in order of x, then y) with ascending places in both texts, best first; each a list of anchors."""
    rank = {v: i + 1 for i, v in enumerate(sorted(set(y)))}
    n = len(rank)
    tree: list[tuple[float, int]] = [(0.0, -1)] * (n + 1)
    score, before = [0.0] * len(x), [-1] * len(x)
    i = 0
    while i < len(x):
        j = i
        while j < len(x) and x[j] == x[i]:  # anchors of one place cannot follow each other
            best, source = 0.0, -1
            k = rank[y[j]] - 1
            while k > 0:
                if tree[k][1] >= 0 and (source < 0 or tree[k][0] > best):
                    best, source = tree[k]
                k &= k - 1
            cost = gap * (x[j] + y[j])
            score[j] = float(seed)
            if source >= 0 and best - cost > 0:
                # words covered twice do not count twice
                across, along = min(seed, x[j] - x[source]), min(seed, y[j] - y[source])
                joined = best - cost + min(across, along) + gap * (across + along)
                if joined > seed:
                    score[j], before[j] = joined, source
            j += 1
        for k in range(i, j):
            value, at = (score[k] + gap * (x[k] + y[k]), k), rank[y[k]]
            while at <= n:
                if tree[at][1] < 0 or tree[at][0] < value[0]:
                    tree[at] = value
                at += at & -at
        i = j
    used, out = [False] * len(x), []
    for end in sorted(range(len(x)), key=lambda k: (-score[k], k)):
        chain = []
        while end >= 0 and not used[end]:
            used[end] = True
            chain.append(end)
            end = before[end]
        if chain:
            out.append(chain[::-1])
    return out


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of batches in their order, cut only where one of the first two changes."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        columns = [c.to_numpy() for c in batch.columns]
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        change[0] = bool(held) and any(c[0] != h[-1] for c, h in zip(columns[:2], held[-1]))
        change[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
        if change.any():
            cut = int(np.flatnonzero(change)[-1])
            yield [np.concatenate(c) for c in zip(*held, [c[:cut] for c in columns])]
            held, columns = [], [c[cut:] for c in columns]
        held.append(columns)
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chains of two texts as one row: (place, place, words) of their runs one after the other, and how many runs each has.

    A run is of anchors that overlap or touch at one distance, so all its words agree.
    """
    names, ints = ["doc", "lead", "xs", "ys", "ns", "sizes"], pa.list_(pa.int32())
    for doc, lead, x, y in _pairs(batches):
        first = np.append(True, (doc[1:] != doc[:-1]) | (lead[1:] != lead[:-1]))
        starts, step = np.flatnonzero(first), np.diff(x, prepend=0)
        # At one distance and close together, all anchors are one chain: each goes on best from the one before.
        apart = ~first & ((np.diff(x - y, prepend=0) != 0) | (step > _CLOSE))
        plain = ~np.logical_or.reduceat(apart, starts)
        counts = np.diff(np.append(starts, len(x)))
        inside = np.repeat(plain, counts)
        head = np.flatnonzero(inside & (first | (step > SEED)))
        last = np.flatnonzero(inside & np.append(first[1:] | (step[1:] > SEED), True))
        runs = np.add.reduceat(first | (step > SEED), starts, dtype=np.int32)[plain]
        at = np.append(0, np.cumsum(runs)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(at, pa.array(v.astype(np.int32))) for v in (x[head], y[head], x[last] + SEED - x[head])]
        sizes = pa.ListArray.from_arrays(np.arange(len(runs) + 1, dtype=np.int32), pa.array(runs))
        yield pa.RecordBatch.from_arrays([pa.array(doc[starts[plain]], pa.int64()), pa.array(lead[starts[plain]], pa.int64()), *lists, sizes], names=names)
        out = []
        for a, n in zip(starts[~plain].tolist(), counts[~plain].tolist()):
            # a place may be found by several keys
            out.append((doc[a], lead[a], *_runs(*zip(*dict.fromkeys(zip(x[a : a + n].tolist(), y[a : a + n].tolist()))))))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), 2 * [pa.int64()] + 4 * [ints])], names=names)


def _runs(x: tuple[int, ...], y: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[int, ...], tuple[int, ...], list[int]]:
    """(places, places, words) of the runs of the chains of anchors, and how many runs each chain has."""
    runs, sizes = [], []
    for chain in chains(x, y):
        before = len(runs)
        for i in chain:
            if len(runs) > before and x[i] - y[i] == runs[-1][0] - runs[-1][1] and x[i] <= runs[-1][0] + runs[-1][2]:
                runs[-1][2] = x[i] + SEED - runs[-1][0]
            else:
                runs.append([x[i], y[i], SEED])
        sizes.append(len(runs) - before)
    return *zip(*runs), sizes


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """Words of the longest common subsequence of two short sequences, whose table is kept by its steps, as bits."""
    at: dict[int, int] = {}
    for i, word in enumerate(a.tolist()):
        at[word] = at.get(word, 0) | 1 << i
    every = level = (1 << len(a)) - 1
    for word in b.tolist():
        met = level & at.get(word, 0)
        level = ((level + met) | (level - met)) & every
    return len(a) - level.bit_count()


def _straight(a: np.ndarray, b: np.ndarray, cost: int) -> tuple[int, int, int]:
    """(words, agreeing ones, score) of the best common start of two sequences without steps."""
    most, size = min(len(a), len(b)), 32
    while most:
        n = min(most, size)
        same = a[:n] == b[:n]
        score = np.cumsum(np.where(same, 1, -cost))
        low = np.flatnonzero(np.maximum(np.maximum.accumulate(score), 0) - score > _DROP)
        if len(low) or n == most:
            score = score[: low[0]] if len(low) else score
            best = len(score) - 1 - int(score[::-1].argmax()) if len(score) else 0
            if not len(score) or score[best] < 0 or not same[best]:
                return 0, 0, 0
            return best + 1, int(same[: best + 1].sum()), int(score[best])
        size *= 8
    return 0, 0, 0


def _extended(a: np.ndarray, b: np.ndarray, cost: int) -> tuple[int, int, int]:
    """(words of a, of b, agreeing ones) by which a passage goes on into two sequences."""
    x, y, same = 0, 0, 0
    n, agree, _ = _straight(a, b, cost)
    while True:
        x, y, same = x + n, y + n, same + agree
        best = (0,)
        # a step is worth a look where some of the next words agree
        left, right = a[x : x + _AHEAD], b[y : y + _AHEAD]
        for step in range(1, _STEPS + 1):
            for over, along in ((step, 0), (0, step)):
                m = min(len(left) - over, len(right) - along)
                if m > 0 and (left[over : over + m] == right[along : along + m]).any():
                    n, agree, score = _straight(a[x + over :], b[y + along :], cost)
                    best = max(best, (score - cost * step, -step, n, agree, over, along))
        if best[0] <= 0:
            return x, y, same
        _, _, n, agree, over, along = best
        x, y = x + over, y + along


class _Side(NamedTuple):
    """Words beside many runs: where the nearest is, in which direction they go, how many are in sight, and whether there are more."""

    words: np.ndarray
    at: np.ndarray
    way: int
    sight: np.ndarray
    more: np.ndarray

    def of(self, rows: np.ndarray) -> _Side:
        return self._replace(at=self.at[rows], sight=self.sight[rows], more=self.more[rows])

    def past(self, n: np.ndarray) -> _Side:
        return self._replace(at=self.at + self.way * n, sight=self.sight - n)


def _straights(a: _Side, b: _Side, cost: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What ``_straight`` gives for each pair of sides, and whether that may depend on words out of sight."""
    most = np.minimum(a.sight, b.sight)
    (best, words), beyond = np.zeros((2, len(most)), np.int64), np.zeros(len(most), bool)
    whole = ~a.more & (a.sight == most) | ~b.more & (b.sight == most)
    row, score, top, k = np.arange(len(most)), np.zeros(len(most), np.int64), np.zeros(len(most), np.int64), 0
    i, j, end = a.at, b.at, most
    while len(row):
        going = k < end
        if not going.all():
            beyond[row[~going]] = ~whole[row[~going]]
            row, score, top, i, j, end = (v[going] for v in (row, score, top, i, j, end))
        score = score + np.where(a.words[i + a.way * k] == b.words[j + b.way * k], 1, -cost)
        k += 1
        better = score >= top
        best[row[better]], words[row[better]] = score[better], k
        top = np.maximum(top, score)
        high = top - score <= _DROP
        if not high.all():
            row, score, top, i, j, end = (v[high] for v in (row, score, top, i, j, end))
    return words, (best + cost * words) // (1 + cost), best, beyond


def _extensions(a: _Side, b: _Side, cost: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What ``_extended`` gives for each pair of sides, and whether that may depend on words out of sight."""
    steps = [s for n in range(1, _STEPS + 1) for s in ((n, 0), (0, n))]
    over, along = (np.array(c) for c in zip(*steps))
    x, y, same = np.zeros((3, len(a.at)), np.int64)
    x[:], same[:], _, beyond = _straights(a, b, cost)
    y[:] = x
    row = np.flatnonzero(~beyond)
    while len(row):
        left, right = a.of(row).past(x[row]), b.of(row).past(y[row])
        short = left.more & (left.sight < _AHEAD) | right.more & (right.sight < _AHEAD)
        each = np.repeat(np.arange(len(row)), len(steps))
        ways = np.tile(np.arange(len(steps)), len(row))
        fit = np.flatnonzero(~short[each] & (left.sight[each] > over[ways]) & (right.sight[each] > along[ways]))
        n, agree, score, far = np.zeros((4, len(each)), np.int64)
        n[fit], agree[fit], score[fit], far[fit] = _straights(left.of(each[fit]).past(over[ways[fit]]), right.of(each[fit]).past(along[ways[fit]]), cost)
        gain = score - cost * (over + along)[ways]
        # most gained, then fewest words stepped over, most words, most agreeing ones; at last a step in the first text
        rank = (((gain * 8 - (over + along)[ways]) * 256 + n) * 256 + agree).reshape(-1, len(steps))
        pick = np.arange(len(row)) * len(steps) + rank.argmax(axis=1)
        lost = short | far.reshape(-1, len(steps)).any(axis=1)
        beyond[row[lost]] = True
        on = ~lost & (gain[pick] > 0)
        row, pick = row[on], pick[on]
        x[row] += over[ways[pick]] + n[pick]
        y[row] += along[ways[pick]] + n[pick]
        same[row] += agree[pick]
    return x, y, same, beyond


def align(a: np.ndarray, b: np.ndarray, xs: list[int], ys: list[int], ns: list[int]) -> tuple[tuple[int, int, int, int, int], int, int]:
    """(start, end) in both texts and the number of agreeing words of the passage at a chain's best part; that part's first and last run.

    The part is the one with most agreeing words less what others undo; it is extended at both ends.
    """
    # from the end of one run to the end of the next, which may overlap in one text
    agree, sizes = [ns[0]], [ns[0]]
    for i in range(1, len(xs)):
        x, y = xs[i - 1] + ns[i - 1], ys[i - 1] + ns[i - 1]
        over = max(0, x - xs[i], y - ys[i])
        left, right = a[x : xs[i] + over], b[y : ys[i] + over]
        agree.append(_agreeing(left, right) + ns[i] - over)
        sizes.append(max(len(left), len(right)) + ns[i] - over)
    top, first, last, score, start = 0, 0, 0, 0, 0
    for i in range(len(xs)):
        gain = agree[i] - _COSTS[-1] * (sizes[i] - agree[i])
        if not i or score + gain < ns[i]:
            score, start = ns[i], i
        else:
            score += gain
        if score > top:
            top, first, last = score, start, i
    core = ns[first] + sum(agree[first + 1 : last + 1])
    x0, y0, x1, y1 = xs[first], ys[first], xs[last] + ns[last], ys[last] + ns[last]
    for cost in _COSTS:
        back_x, back_y, before = _extended(a[:x0][::-1], b[:y0][::-1], cost)
        on_x, on_y, after = _extended(a[x1:], b[y1:], cost)
        found = x0 - back_x, x1 + on_x, y0 - back_y, y1 + on_y, core + before + after
        if found[4] >= LEAST_SHARE * max(found[1] - found[0], found[3] - found[2]):
            break
    return found, first, last


def passages_of(a: np.ndarray, b: np.ndarray, found: list[tuple[list[int], list[int], list[int]]]) -> list[tuple[int, int, int, int, int]]:
    """Passages of two texts from their chains (best first), none inside another."""
    out: list[tuple[int, int, int, int, int]] = []
    for chain in found:
        parts = [chain]
        while parts:
            chain = parts.pop()
            # runs that no passage holds yet
            free = [(x, y, n) for x, y, n in zip(*chain) if not any(p[0] <= x and x + n <= p[1] and p[2] <= y and y + n <= p[3] for p in out)]
            if not free:
                continue
            passage, first, last = align(a, b, *zip(*free))
            parts += [tuple(zip(*part)) for part in (free[:first], free[last + 1 :]) if part]
            x0, x1, y0, y1, same = passage
            size = max(x1 - x0, y1 - y0)
            inside = any(p[0] <= x0 and x1 <= p[1] and p[2] <= y0 and y1 <= p[3] for p in out)
            if not inside and size >= LEAST_WORDS and same >= LEAST_SHARE * size:
                out.append(passage)
    return out


def _beside(words: np.ndarray, start: np.ndarray, n: np.ndarray, before: np.ndarray, after: np.ndarray, cut: tuple = (False, False)) -> tuple[_Side, _Side]:
    """The words on both sides of runs of n words from ``start``, with so many before and after; ``cut`` where there are more."""
    return (
        _Side(words, start - 1, -1, np.minimum(before, _SIGHT), (before > _SIGHT) | cut[0]),
        _Side(words, start + n, 1, np.minimum(after, _SIGHT), (after > _SIGHT) | cut[1]),
    )


def _hopeless(n: np.ndarray, a: tuple[_Side, _Side], b: tuple[_Side, _Side]) -> np.ndarray:
    """Which runs of n words that stand alone give no passage, as far as the words in sight tell."""
    out = np.zeros(len(n), bool)
    for first in range(0, len(n), BATCH_RUNS):
        row = np.arange(first, min(first + BATCH_RUNS, len(n)))
        for cost in _COSTS:
            back_x, back_y, back, far = _extensions(a[0].of(row), b[0].of(row), cost)
            on_x, on_y, on, further = _extensions(a[1].of(row), b[1].of(row), cost)
            size, same = n[row] + np.maximum(back_x + on_x, back_y + on_y), n[row] + back + on
            share = same >= LEAST_SHARE * size
            known = ~(far | further)
            out[row] = known & ((size < LEAST_WORDS) | ~share)
            row = row[known & ~share]
    return out


def _no_passage(near: np.ndarray, x: int, before: bool, after: bool, b: np.ndarray, y: int, n: int) -> bool:
    """Whether a run of n words gives no passage, from the words ``near`` it, in which it is at x; before and after whether words are cut off there."""
    x, y, n = (np.array([v]) for v in (x, y, n))
    beside = _beside(near, x, n, x, len(near) - x - n, (np.array([before]), np.array([after])))
    return bool(_hopeless(n, beside, _beside(b, y, n, y, len(b) - y - n))[0])


def _lengths(column: pa.Array) -> np.ndarray:
    """Words or numbers in each row of a column; null counts as empty."""
    size = pc.list_value_length(column) if pa.types.is_list(column.type) else pc.divide(pc.binary_length(column), 4)
    return size.fill_null(0).to_numpy()


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words or numbers of all rows of a column one after the other, and the n + 1 offsets of the rows in them."""
    if pa.types.is_list(column.type):
        values = column.flatten().to_numpy()
    else:
        column = column.fill_null(b"").cast(pa.large_binary())
        _, at, data = column.buffers()
        at = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else [0, 0]
        values = np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(np.uint32) if at[0] < at[-1] else np.zeros(0, np.uint32)
    return values, np.append(0, np.cumsum(_lengths(column), dtype=np.int64))


def _nearby(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains with the words near their runs, where each chain is one run and these words are fewer than the text's (a)."""
    for batch in batches:
        (x, at), (n, _), (size, _), (a, start) = (_flat(batch.column(i)) for i in (2, 4, 5, 6))
        row, total = np.repeat(np.arange(batch.num_rows), np.diff(at)), np.diff(start)
        words = np.append(0, np.cumsum(n + 2 * _NEAR, dtype=np.int64))
        alone = np.bincount(np.repeat(np.arange(batch.num_rows), _lengths(batch.column(5)))[size > 1], minlength=batch.num_rows) == 0
        alone &= words[at[1:]] - words[at[:-1]] < total
        first, last = np.maximum(0, x - _NEAR), np.where(alone[row], np.minimum(total[row], x + n + _NEAR), 0)
        wide = np.maximum(0, last - first)
        ends = np.append(0, np.cumsum(wide))
        near = a[np.repeat(start[row] + first - ends[:-1], wide) + np.arange(ends[-1])].tobytes()
        ends = 4 * ends[at]
        found = [near[i:j] if some else None for some, i, j in zip(alone.tolist(), ends.tolist(), ends[1:].tolist())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(total, pa.int32()), pa.array(found, pa.binary())], names=[*batch.schema.names[:6], "total", "near"])


def _screened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains of which some may give a passage, from the words near them and the whole other text (b)."""
    for batch in batches:
        (x, at), (y, _), (n, _) = (_flat(batch.column(i)) for i in (2, 3, 4))
        row = np.repeat(np.arange(batch.num_rows), np.diff(at))
        keep = batch.column(7).is_null().to_numpy(zero_copy_only=False).copy()
        alone = ~keep[row]
        row, x, y, n = row[alone], *(v[alone].astype(np.int64) for v in (x, y, n))
        (near, _), (b, start) = (_flat(batch.column(i)) for i in (7, 8))
        total = batch.column(6).to_numpy()[row]
        first, last = np.maximum(0, x - _NEAR), np.minimum(total, x + n + _NEAR)
        before = x - first
        a = _beside(near, np.cumsum(last - first) - (last - first) + before, n, before, last - x - n, (first > 0, last < total))
        hopeless = _hopeless(n, a, _beside(b, start[row] + y, n, y, start[row + 1] - start[row] - y - n))
        keep[row[~hopeless]] = True
        yield batch.select(batch.schema.names[:6]).filter(pa.array(keep, pa.bool_()))


def _open_chains(batch: pa.RecordBatch) -> list[list[tuple[list[int], list[int], list[int]]]]:
    """The chains of each row but those of one run that give no passage, from both texts."""
    (x, at), (y, _), (n, _), (size, chain) = (_flat(batch.column(i)) for i in (2, 3, 4, 5))
    (a, left), (b, right) = (_flat(batch.column(i)) for i in (6, 7))
    x, y, n = (v.astype(np.int64) for v in (x, y, n))
    starts = np.cumsum(size) - size
    row = np.repeat(np.arange(batch.num_rows), np.diff(chain))
    alone = np.flatnonzero(size == 1)
    run, own = starts[alone], row[alone]
    ends = np.diff(left)[own] - x[run] - n[run], np.diff(right)[own] - y[run] - n[run]
    kept = np.ones(len(size), bool)
    kept[alone] = ~_hopeless(n[run], _beside(a, left[own] + x[run], n[run], x[run], ends[0]), _beside(b, right[own] + y[run], n[run], y[run], ends[1]))
    out: list[list] = [[] for _ in range(batch.num_rows)]
    for c in np.flatnonzero(kept).tolist():
        part = slice(starts[c], starts[c] + size[c])
        out[row[c]].append((x[part].tolist(), y[part].tolist(), n[part].tolist()))
    return out


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        docs, leads = (batch.column(i).to_pylist() for i in range(2))
        for i, found in enumerate(_open_chains(batch)):
            if not found:
                continue
            a, b = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint32) for c in (6, 7))
            for x0, x1, y0, y1, same in passages_of(a, b, found):
                out.append((docs[i], x0, x1 - x0, leads[i], y0, y1 - y0, same / max(x1 - x0, y1 - y0)))
        columns = list(zip(*out)) or [()] * 7
        kinds = [pa.int64()] * 6 + [pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "first_word", "n_words", "of_doc_id", "of_first_word", "of_n_words", "similarity"])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for first, last in pieces(batch.column(1)):
            data, offsets = buffers(batch.column(1).slice(first, last - first))
            words, at = word_hashes(data, offsets)
            half = (words >> np.uint64(32)).astype(np.uint32)
            out += [half[a:b].tobytes() for a, b in zip(at, at[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc", "words"])


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, first_word, n_words, of_doc_id, of_first_word, of_n_words, similarity) of passages that repeat.

    Each passage of ``LEAST_WORDS`` words at least of a text is reported with the text of smaller doc_id
    that its seeds, or the longer keys in it, occur in first; similarity is the share of agreeing words.  Words are compared with
    A-Z in lower case.  Rows without doc_id or text are left out, of rows with equal doc_id only
    the smallest text is taken; other columns are ignored.  Repeats inside one text are not reported.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text")).where("doc IS NOT NULL AND text IS NOT NULL")
    # seeds and words must be those of one text: where a doc_id repeats, of its smallest
    repeated = written(rows.groupBy("doc").count().where("count > 1").select("doc"), "passages-repeated")
    if not repeated.isEmpty():
        smallest = rows.join(repeated, "doc", "left_semi").groupBy("doc").agg(F.min("text").alias("text"))
        rows = written(rows.join(repeated, "doc", "left_anti").unionByName(smallest), "passages-texts")
    bits = max(8, (8 * width(spark) - 1).bit_length())
    packs = rows.mapInArrow(lean(_seeder(bits)), "bucket int, kind tinyint, hashes binary, rest binary")
    packs = packs.repartition(width(spark), "bucket").sortWithinPartitions("bucket", "kind")
    with batch_rows(spark, BATCH_PACKS):
        anchors = written(packs.mapInArrow(lean(_anchors(bits)), "doc long, lead long, x int, y int"), "passages-anchors")
    dealt = anchors.repartition(width(spark), "doc", "lead").sortWithinPartitions("doc", "lead", "x", "y")
    pair = "doc long, lead long, xs array<int>, ys array<int>, ns array<int>, sizes array<int>"
    chained = written(dealt.mapInArrow(lean(_chained), pair), "passages-chains")
    removed(anchors)
    words = written(rows.mapInArrow(lean(_words), "doc long, words binary"), "passages-words")

    def side(words: DataFrame, doc: str, name: str) -> DataFrame:
        return words.select(F.col("doc").alias(doc), F.col("words").alias(name))

    columns = ["doc", "lead", "xs", "ys", "ns", "sizes"]
    with batch_rows(spark, BATCH_TEXTS):
        near = written(chained.join(side(words, "doc", "a"), "doc").select(*columns, "a").mapInArrow(lean(_nearby), f"{pair}, total int, near binary"), "passages-near")
        kept = written(near.join(side(words, "lead", "b"), "lead").select(*columns, "total", "near", "b").mapInArrow(lean(_screened), pair), "passages-kept")
    removed(chained, near)
    wanted = kept.select("doc").unionAll(kept.select("lead")).distinct()
    fewer = written(words.join(wanted, "doc", "left_semi"), "passages-wanted")
    removed(words)
    both = kept.join(side(fewer, "doc", "a"), "doc").join(side(fewer, "lead", "b"), "lead").select(*columns, "a", "b")
    return both.mapInArrow(lean(_aligned), "doc_id long, first_word long, n_words long, of_doc_id long, of_first_word long, of_n_words long, similarity double")
