"""Steps of repeated passages on many texts or pairs at once, against the same steps on one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from eventlift.llm import passages
from eventlift.llm.shingles import mix, shingle_hashes


def one_text(words):
    """(hash, place) of a text's keys, place by place."""
    row = np.array([0, len(words)])
    if len(words) < passages.SEED:
        return set()
    every = mix(shingle_hashes(words, row, passages.SEED)[0])
    parts = shingle_hashes(words, row, passages.PART)[0]
    out = set()
    for i, h in enumerate(every):
        own = parts[i : i + passages.SEED - passages.PART + 1]
        if own.min() in (own[0], own[-1]):
            out.add((int(h), i))
    for size, window in passages.LONG:
        for at in {i + int(every[i : i + window].argmin()) for i in range(len(every) - window + 1)}:
            if len(words) >= max(size, passages.LONG[0][0]) and at + size <= len(words):
                value = sum(int(w) * pow(int(passages._BASE), j, 1 << 64) for j, w in enumerate(words[at : at + size]))
                out.add((int(mix(np.array([(value + size) % (1 << 64)], np.uint64))[0]), at))
    return out


def test_keys_of_many_texts_are_those_of_each():
    rng = np.random.default_rng(11)
    texts = [rng.integers(0, 5 if i % 4 == 0 else 1 << 64, n, dtype=np.uint64) for i, n in enumerate([0, 1, 4, 5, 6, 35, 36, 37, 0, 49, 50, 51, 120, 300, 40, 3])]
    rows = np.append(0, np.cumsum([len(t) for t in texts]))
    hashes, row, place = passages.keys(np.concatenate(texts), rows)
    got = [set() for _ in texts]
    for h, r, p in zip(hashes.tolist(), row.tolist(), place.tolist()):
        got[r].add((h, p))
    assert got == [one_text(t) for t in texts]
    assert len(passages.keys(np.zeros(0, np.uint64), np.zeros(3, np.int64))[0]) == 0


def test_chains_of_plain_pairs_are_those_of_all_anchors():
    rng = np.random.default_rng(12)
    rows = []
    for pair in range(300):
        x = np.cumsum(rng.choice([1, 2, 5, 6, 20, 24, 25, 28, 31] if pair % 3 else [1, 3], rng.integers(1, 30)))
        y = x + 7 + (rng.random(len(x)) < (0.2 if pair % 5 == 0 else 0)) * 3
        rows += sorted((pair // 7, pair, int(a), int(b)) for a, b in list(zip(x, y)) + list(zip(x, y))[:3])
    table = pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64()] * 2 + [pa.int32()] * 2)], names=["doc", "lead", "x", "y"])
    got = {}
    for batch in passages._chained(iter(table.to_batches(max_chunksize=50))):
        got |= {r["lead"]: (r["doc"], r["xs"], r["ys"], r["ns"], r["sizes"]) for r in batch.to_pylist()}
    assert len(got) == 300
    for pair, found in got.items():
        x, y = zip(*dict.fromkeys((a, b) for _, p, a, b in rows if p == pair))
        xs, ys, ns, sizes = passages._runs(x, y)
        assert found == (pair // 7, list(xs), list(ys), list(ns), sizes)


def test_words_in_common_order():
    rng = np.random.default_rng(13)
    for n in (0, 1, 3, 20, 90):
        a, b = (rng.integers(0, 4, n + k).astype(np.uint32) for k in (0, 2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert passages._agreeing(a, b) == table[-1, -1]


def test_only_chains_that_may_give_a_passage_are_aligned(monkeypatch):
    monkeypatch.setattr(passages, "BATCH_RUNS", 50, raising=False)
    rng = np.random.default_rng(14)
    kinds = [pa.int64()] * 2 + [pa.list_(pa.int32())] * 4 + [pa.binary()] * 2
    rows, want, aligned = [], [], []
    for pair in range(60):
        a, b = (rng.integers(0, 8 if pair % 2 else 1 << 32, 900).astype(np.uint32) for _ in "ab")
        runs = [(20 + 100 * i, 800 - 100 * i) for i in range(8)]
        for i, (x, y) in enumerate(runs):
            size = 60 if i == pair % 8 and pair % 3 == 0 else 5
            b[y : y + size] = a[x : x + size]
            if size > 5:
                b[y + 5 : y + size][rng.random(size - 5) < 0.1] += 1
        # one chain of two runs among those of one
        x, y = runs[7][0], runs[7][1]
        a[x + 30 : x + 35] = b[y + 30 : y + 35]
        xs, ys = ([r[k] for r in runs] + [(x, y)[k] + 30] for k in (0, 1))
        rows.append((pair, -1, xs, ys, [5] * 9, [1] * 7 + [2], a.tobytes(), b.tobytes()))
        chains = [([x], [y], [5]) for x, y in runs[:7]] + [(xs[7:], ys[7:], [5, 5])]
        want += [(pair, p[0], p[1] - p[0], p[2], p[3] - p[2]) for p in passages.passages_of(a, b, chains)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc", "lead", "xs", "ys", "ns", "sizes", "a", "b"])
    align = passages.align
    monkeypatch.setattr(passages, "align", lambda *v: aligned.append(1) or align(*v))
    got = pa.Table.from_batches(passages._aligned(iter([batch.slice(0, 25), batch.slice(25)]))).to_pylist()
    assert [(r["doc_id"], r["first_word"], r["n_words"], r["of_first_word"], r["of_n_words"]) for r in got] == want and len(want) >= 15
    assert len(aligned) < 60 * 8 / 2  # without a look at many at once, each chain was aligned by itself


def test_words_of_a_part_of_a_column():
    words = [np.array(w, np.uint32) for w in ([1, 2, 1 << 31], [], [4], [5, 6])]
    for kind in (pa.binary(), pa.large_binary()):
        column = pa.array([words[0].tobytes(), None, words[1].tobytes(), words[2].tobytes(), words[3].tobytes()], kind)
        for first, n, want, ends in ((0, 5, [1, 2, 1 << 31, 4, 5, 6], [0, 3, 3, 3, 4, 6]), (1, 3, [4], [0, 0, 0, 1]), (2, 0, [], [0]), (1, 2, [], [0, 0, 0])):
            values, at = passages._flat(column.slice(first, n))
            assert values.tolist() == want and at.tolist() == ends
    kinds = [pa.int64()] * 2 + [pa.list_(pa.int32())] * 4 + [pa.binary()]
    none = pa.RecordBatch.from_arrays([pa.array([], k) for k in kinds], names=["doc", "lead", "xs", "ys", "ns", "sizes", "a"])
    near = list(passages._nearby(iter([none])))
    both = pa.RecordBatch.from_arrays([*near[0].columns, pa.array([], pa.binary())], names=[*near[0].schema.names, "b"])
    assert [b.num_rows for b in passages._screened(iter([both]))] == [0]
    assert [b.num_rows for b in passages._aligned(iter([pa.RecordBatch.from_arrays([*none.columns, none.column(6)], names=[*none.schema.names, "b"])]))] == [0]
    assert list(passages._chained(iter([pa.RecordBatch.from_arrays([none.column(0)] * 4, names=list("dlxy"))]))) == []
