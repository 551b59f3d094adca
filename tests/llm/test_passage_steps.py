"""Steps of repeated passages: packed occurrences, and pairs that are done from the words near their anchors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from eventlift.llm import passages


def test_packed_occurrences_meet_the_first_of_their_key():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 1 << 64, 40, dtype=np.uint64)
    own = {int(d): sorted((int(p), int(keys[rng.integers(40) if rng.random() < 0.7 else 0])) for p in rng.choice(500, 30, replace=False)) for d in rng.permutation(60) - 5}
    found = [(d, np.array([k for _, k in v], np.uint64), np.array([p for p, _ in v])) for d, v in own.items()]
    packs = [passages._packs(found[i : i + 7], 9) for i in range(0, len(found), 7)]
    table = pa.Table.from_batches(packs).sort_by([("bucket", "ascending"), ("kind", "ascending")])
    got = pa.Table.from_batches(passages._anchors(9)(iter(table.to_batches(max_chunksize=3)))).to_pylist()
    first = {}
    for d, v in own.items():
        for p, k in v:
            first[k] = min(first.get(k, (d, p)), (d, p))
    wanted = [(d, first[k][0], p, first[k][1]) for d, v in own.items() for p, k in v if first[k][0] != d]
    assert sorted(tuple(r.values()) for r in got) == sorted(wanted)


def test_pairs_done_from_near_words_have_no_passage():
    rng = np.random.default_rng(6)
    done = 0
    for case in range(400):
        a, b = (rng.integers(0, 6 if case % 3 else 1 << 32, rng.integers(40, 300)).astype(np.uint32) for _ in "ab")
        x, y = (int(rng.integers(0, len(t) - 10)) for t in (a, b))
        size = int(rng.integers(5, 120)) if case % 2 else 5
        size = min(size, len(a) - x, len(b) - y)
        b[y : y + size] = a[x : x + size]
        changed = rng.random(size) < rng.choice([0, 0.1, 0.25, 0.4])
        changed[:5] = False
        b[y : y + size][changed] += 1
        first, last = max(0, x - passages._NEAR), min(len(a), x + 5 + passages._NEAR)
        if passages._no_passage(a[first:last], x - first, first > 0, last < len(a), b, y, 5):
            done += 1
            assert passages.passages_of(a, b, [([x], [y], [5])]) == []
    assert 100 < done < 400
