"""Counting and grouping steps of the suffix tree."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from eventlift.llm import suffix_tree


def test_values_are_counted_and_grouped_in_order():
    rng = np.random.default_rng(3)
    for values in (rng.integers(0, 50, 1000), np.zeros(0, np.int64), np.array([7]), rng.integers(0, 1 << 64, 30, dtype=np.uint64)):
        wanted, number = np.unique(values, return_counts=True)
        found, n = suffix_tree.counted(values)
        assert found.tolist() == wanted.tolist() and n.tolist() == number.tolist()
        order, starts, distinct = suffix_tree.grouped(values)
        assert distinct.tolist() == wanted.tolist() and np.diff(np.append(starts, len(values))).tolist() == number.tolist()
        assert all((np.diff(order[a : a + k]) > 0).all() and (values[order[a : a + k]] == v).all() for a, k, v in zip(starts, number, wanted))


def test_windows_are_looked_up_in_order():
    class Model:
        def log10(self, window):
            assert (np.diff(window) > 0).all()
            return window.astype(float)

    texts = ["the cat sat on the mat", "a zebra, the cat", ""]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([1, 2, 3]), pa.array([0.5, 0.0, 0.0]), pa.array(texts)], names=["doc_id", "text_hash", "score", "text"])
    (out,) = suffix_tree._scored(Model())(iter([batch]))
    wanted = [float(suffix_tree.windows(suffix_tree.normalised(pa.array([t]))[0]).astype(float).sum()) for t in texts]
    assert np.allclose(out.column(2).to_numpy(), np.array(wanted) + [0.5, 0, 0])
