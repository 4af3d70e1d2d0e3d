"""What the language model stores and shuffles, and that seating a part of the cells changes nothing."""

from __future__ import annotations

import numpy as np
import pytest

from voltweave.llm import language_model
from voltweave.llm.text_arrays import BASE, BYTE_CODES, mix, run_hashes


@pytest.mark.parametrize("listed", (0, 1, 1000, 70_000))
def test_frequent_contexts_take_two_bytes(listed):
    rng = np.random.default_rng(listed)
    every = np.unique(rng.integers(0, 2**48, 70_000, dtype=np.uint64))
    coded = language_model.Contexts(every[:listed])
    for values in (every[rng.integers(0, len(every), 5000)], every[:0]):
        assert coded.unpack(coded.pack(values)).tolist() == values.tolist()
    if listed:
        values = np.repeat(every[:listed], 10_000 // listed + 1)
        assert len(coded.pack(values)) < (2.6 if listed < 70_000 else 3) * len(values) + 20


def test_one_large_count_does_not_widen_the_others():
    for large in ([70_000], [255, 256, 2**40]):
        values = np.array([*([1] * 1000), *large, 254, 0], dtype=np.int64)
        blob = language_model._small(values)
        assert len(blob) < 1060
        assert language_model._unsmall(blob).tolist() == values.tolist()


def test_seating_by_parts_is_the_same(monkeypatch):
    rng = np.random.default_rng(1)
    word, cls = np.repeat(np.arange(60), 50), np.tile(np.arange(50), 60)
    count = rng.zipf(1.3, 3000).clip(0, 20_000)
    parts = []
    whole = language_model.Seating.part
    monkeypatch.setattr(language_model.Seating, "part", lambda self, cells: parts.append(len(cells)) or whole(self, cells))

    def run():
        return list(language_model.seatings(word, cls, count, 60, 0.5, 120, 7))

    some = run()
    assert parts
    monkeypatch.setattr(language_model, "PART", 10**9)
    for a, b in zip(some, run(), strict=True):
        assert all((x == y).all() for x, y in zip(a, b))


def test_hashes_of_runs_are_sums_over_places():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 4000).astype(np.uint8)
    cuts = np.unique(rng.integers(0, 4000, 300))
    starts, ends = cuts[:-1], np.minimum(cuts[1:], cuts[:-1] + 60)
    powers = np.cumprod(np.full(64, BASE, dtype=np.uint64))
    wanted = [mix(np.array([(BYTE_CODES[data[a:b]] * powers[:b - a]).sum() + np.uint64(b - a)]))[0] for a, b in zip(starts, ends)]
    assert run_hashes(data, starts, ends).tolist() == [int(x) for x in wanted]
