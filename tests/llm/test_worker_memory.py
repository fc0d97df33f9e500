"""Python workers live on after a task and must not keep its memory."""

import pyarrow as pa

from basketry.llm import words


def test_unused_arrow_memory_is_returned_after_each_batch(monkeypatch):
    released, pool = [], pa.default_memory_pool()

    class Pool:
        def release_unused(self):
            released.append(pool.release_unused())

    monkeypatch.setattr(words.pa, "default_memory_pool", Pool)
    batch = pa.RecordBatch.from_pydict({"text": ["aa", None, "bbb", "c"]})
    parts = [p.column(0).to_pylist() for p in words.slices(batch, "text", limit=3)]
    assert parts == [["aa", None], ["bbb"], ["c"]]
    assert len(released) == 1
