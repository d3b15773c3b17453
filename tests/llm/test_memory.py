"""Memory between tasks."""

import pyarrow as pa

from tarn.llm import common


def test_memory_is_given_back(monkeypatch):
    """Before the first slab of a task and after the last."""
    calls = []
    monkeypatch.setattr(common, "release_memory", lambda: calls.append(1))
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b"])], ["text"])
    assert [len(calls) for _ in common.slabs([batch], 0, rows=1)] == [1, 1] and len(calls) == 2
    monkeypatch.undo()
    common.release_memory()
