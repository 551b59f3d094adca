"""What tasks leave behind in their workers."""

from __future__ import annotations

import pyarrow as pa

from eventlift.llm import worker


def test_tasks_hand_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(worker, "handed_back", lambda: calls.append(1))
    batch = pa.RecordBatch.from_pydict({"a": [1]})
    rows = worker.lean(lambda batches: (b for b in batches))(iter([batch, batch]))
    assert next(rows) is batch and not calls
    assert list(rows) == [batch] and calls == [1]
