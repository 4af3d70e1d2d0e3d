"""What the encoder of the packing takes at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

import corpus_pipeline
from voltweave.llm import packing


def test_packing_encodes_no_more_than_a_slice_at_once(monkeypatch):
    seen = []

    class Tool:
        def encode(self, texts):
            sizes = np.array([len(t) for t in texts.to_pylist()])
            seen.append(int(sizes.sum()))
            return np.arange(sizes.sum(), dtype="<u4"), np.concatenate([[0], np.cumsum(sizes)])

    monkeypatch.setattr(packing, "encoder", lambda path, pieces: Tool())
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(100)), "text": ["x" * 50] * 100})
    made = pa.Table.from_batches(list(packing._cutter("", 2, 1024, 10, 200)(iter([batch]))))
    assert max(seen) <= 250 and sum(seen) == 5000
    assert made.column("length").to_pylist() == [51] * 100
    assert corpus_pipeline.SLICE_BYTES <= 1 << 20
