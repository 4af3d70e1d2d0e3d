"""What a worker holds at once: bounded by chunks, slices and Arrow batches."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from voltweave.llm import language_model
from voltweave.sources.staging import dropped_shuffles, stage


def _peak(run) -> int:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def _texts(rows: int, words: int) -> pa.RecordBatch:
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 5000, words)) for _ in range(rows)]
    return pa.RecordBatch.from_pydict({"doc_id": pa.array(range(rows), pa.int64()), "text": texts, "train": [k % 10 > 0 for k in range(rows)]})


def test_pairs_are_counted_in_few_bytes_a_token():
    batch = _texts(1000, 400)
    tokens = 1000 * 401
    shared = np.empty(0, dtype=np.uint64)

    def run():
        for _ in language_model._counter(shared, 3)(iter([batch])):
            pass

    assert _peak(run) < 100 * tokens


def test_pairs_of_a_chunk_are_whole_and_in_their_bucket():
    batch = _texts(40, 50)
    words, cls, text_of = language_model.text_tokens(batch.column("text"))
    shared = np.unique(words)[:3]
    wanted: dict = {}
    for w, c, t in zip(words.tolist(), cls.tolist(), text_of.tolist()):
        wanted[w, c] = wanted.get((w, c), 0) + (t % 10 > 0)
    for key_rows in (7, 1 << 18):
        before, language_model.KEY_ROWS = language_model.KEY_ROWS, key_rows
        try:
            rows = [r for made in language_model._counter(shared, 4)(iter([batch.slice(0, 13), batch.slice(13)])) for r in language_model._read([made])]
        finally:
            language_model.KEY_ROWS = before
        found: dict = {}
        for bucket, _, _, blobs in rows:
            for w, c, n in language_model._pairs(*blobs).tolist():
                found[w, c] = found.get((w, c), 0) + n
                assert w in shared or w % 4 == bucket
        assert found == wanted


def test_counts_take_the_bytes_they_need():
    for most, width in ((0, 1), (255, 1), (256, 2), (65_536, 3), (1 << 24, 4), (1 << 33, 5), (1 << 57, 8)):
        values = np.array([0, most, most // 2], dtype=np.int64)
        blob = language_model._small(values)
        assert len(blob) == 1 + 3 * width
        assert language_model._unsmall(blob).tolist() == values.tolist()
    assert language_model._unsmall(language_model._small(np.empty(0, dtype=np.int64))).tolist() == []


def test_cells_of_one_customer_are_stored_without_tables():
    rng = np.random.default_rng(3)
    key = np.sort(rng.choice(300 * 70_000, 20_000, replace=False))
    count = np.where(rng.random(20_000) < 0.9, 1, rng.integers(2, 900, 20_000))
    tables = [np.where(count > 1, rng.integers(1, count + 1), 1) for _ in range(3)]
    parents = [(rng.integers(1, 9, 300), rng.integers(1, 5, 300)) for _ in range(3)]
    words, contexts = np.arange(300, dtype=np.uint64), np.arange(70_000, dtype=np.uint64)
    made = language_model.Bucket(words, contexts, key, count, [(t, m, mt) for t, (m, mt) in zip(tables, parents)])
    stored = made.stored()
    assert sum(map(len, stored)) < 6 * 70_000 + 5 * 20_000
    again = language_model.restored(*stored)
    assert (again.key == key).all() and (again.count == count).all()
    for (t, m, mt), (t2, m2, mt2) in zip(made.samples, again.samples):
        assert (t == t2).all() and (m == m2).all() and (mt == mt2).all()


def test_stored_tables_leave_no_shuffle_behind(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with dropped_shuffles(spark):
        assert spark.conf.get(key) == "true"
        made = stage(spark.range(1000).repartition(3, "id"), "few")
    assert spark.conf.get(key) == before
    assert made.count() == 1000


def test_arrow_batches_of_blobs_are_bounded(spark):
    docs = spark.createDataFrame([(k, "a b c") for k in range(20)], "doc_id long, text string")
    assert language_model.score_texts(docs).count() == 20
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20
