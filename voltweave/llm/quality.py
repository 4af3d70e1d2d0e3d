"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

A text is described by counts of character-class trigrams and by a few whole-text measures in bins, all
as terms. Inverse document frequencies and a truncated singular value decomposition are learned from a
bounded sample of labelled rows. The vectors of those rows and their labels are broadcast (the bound is
``MOST_LABELLED``); every document is compared with all of them in exact blocked products, and the
labels of its nearest neighbours vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from voltweave.llm.common import bounded_slices, free_name, held_out, release_memory
from voltweave.llm.text_arrays import LOWERED, flat_bytes, run_hashes, word_bounds

MOST_LABELLED = 8192  # rows with labels that are learned from, by the hash of their id
DIMENSIONS = 48
NEIGHBOURS = 24
FOLDS = 5
SLICE_BYTES = 2 << 20

# Character classes: bytes of one class look alike.
GROUPS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r\t", b".", b",", b"!?", b"|", b"#$%&*",
          b"<>=/\\{}[]", b"'\"-_:;()@+^`~"]
CLASSES = len(GROUPS) + 1
CLASS_OF = np.zeros(256, dtype=np.int32)  # bytes of other letters count as lower case
CLASS_OF[:32] = CLASSES - 1
for _k, _group in enumerate(GROUPS):
    CLASS_OF[list(_group)] = _k
TRIGRAMS = CLASSES**3
BINS = 12
MEASURES = 4
TERMS = TRIGRAMS + BINS * MEASURES
BIN_WEIGHT = 1.0


def term_weights(texts: pa.Array) -> np.ndarray:
    """Row per text: damped counts of its terms; all zero for an empty text."""
    data, offsets = flat_bytes(texts)
    n = len(texts)
    made = np.zeros((n, TERMS), dtype=np.float32)
    if not len(data):
        return made
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(n), sizes)
    cls = CLASS_OF[data]
    if len(cls) > 2:
        code = (cls[:-2] * CLASSES + cls[1:-1]) * CLASSES + cls[2:]
        same = owner[:-2] == owner[2:]
        counts = np.bincount(owner[:-2][same] * TRIGRAMS + code[same], minlength=n * TRIGRAMS).reshape(n, TRIGRAMS)
        share = counts / np.maximum(sizes - 2, 1)[:, None]
        made[:, :TRIGRAMS] = np.sqrt(share)
    starts, ends, text_of = word_bounds(data, offsets)
    words = np.maximum(np.bincount(text_of, minlength=n), 1)
    h = run_hashes(LOWERED[data], starts, ends)
    order = np.lexsort((h, text_of))
    fresh = np.ones(len(h), dtype=bool)
    if len(h) > 1:
        fresh[1:] = (h[order][1:] != h[order][:-1]) | (text_of[order][1:] != text_of[order][:-1])
    distinct = np.bincount(text_of[order][fresh], minlength=n)
    length = np.bincount(text_of, weights=ends - starts, minlength=n) / words
    # Repetition is judged against what texts of that many words have: distinct words grow with a power of words.
    measures = [
        np.log(np.maximum(distinct, 1)) / np.maximum(np.log(words), 0.7) * (BINS - 1),
        np.log2(words),
        length,
        np.bincount(text_of[1:][(h[1:] == h[:-1]) & (text_of[1:] == text_of[:-1])], minlength=n) / words * BINS if len(h) > 1 else np.zeros(n),
    ]
    full = np.flatnonzero(sizes > 0)
    for k, value in enumerate(measures):
        cell = np.clip(value, 0, BINS - 1).astype(np.int64)
        made[full, TRIGRAMS + k * BINS + cell[full]] = BIN_WEIGHT / np.sqrt(MEASURES)
    return made


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


class Voter:
    """Learned state: inverse document frequencies, latent axes, labelled vectors. A few MB, whatever the corpus."""

    def __init__(self, weights: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS, neighbours: int = NEIGHBOURS):
        self.labels = labels.astype(np.float32)
        self.prior = float(self.labels.mean()) if len(labels) else 0.5
        self.neighbours = min(neighbours, len(labels))
        seen = (weights > 0).sum(axis=0)
        self.idf = (np.log((1 + len(labels)) / (1 + seen)) + 0.3).astype(np.float32)
        x = _unit(weights * self.idf)
        k = min(dimensions, *x.shape) if len(labels) else 0
        if k:
            draw = np.random.default_rng(7).standard_normal((x.shape[1], min(k + 16, x.shape[1]))).astype(np.float32)
            basis = draw
            for _ in range(3):  # randomised range finder
                basis, _r = np.linalg.qr(x.T @ (x @ basis))
            _u, _s, vt = np.linalg.svd(x @ basis, full_matrices=False)
            self.axes = (basis @ vt.T)[:, :k].astype(np.float32)
            self.vectors = _unit(x @ self.axes).astype(np.float32)

    def score(self, weights: np.ndarray) -> np.ndarray:
        """Vote for label 1, from 0 to 1; a text without terms gets the share of label 1."""
        out = np.full(len(weights), self.prior)
        full = np.flatnonzero(weights.any(axis=1))
        if not self.neighbours or not len(full):
            return out
        z = _unit(_unit(weights[full] * self.idf) @ self.axes)
        for a in range(0, len(full), 512):
            cosine = z[a:a + 512] @ self.vectors.T
            near = np.argpartition(cosine, -self.neighbours, axis=1)[:, -self.neighbours:]
            c = np.take_along_axis(cosine, near, axis=1)
            vote = np.exp(20.0 * (c - c.max(axis=1, keepdims=True))).astype(np.float64)
            out[full[a:a + 512]] = (vote * self.labels[near]).sum(axis=1) / vote.sum(axis=1)
        return np.clip(out, 0.0, 1.0)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release_memory(drop_caches=True)
    for batch in batches:
        for part in bounded_slices(batch, "text", SLICE_BYTES):
            w = term_weights(part.column("text"))
            rows = [r.nonzero()[0].astype("<i4") for r in w]
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), pa.array([r.tobytes() for r in rows], pa.binary()),
                 pa.array([w[i, r].astype("<f4").tobytes() for i, r in enumerate(rows)], pa.binary())],
                names=["label", "terms", "weights"])
    release_memory(drop_caches=True)


def learn(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, label: str = "quality") -> Voter:
    """Learn from at most ``most`` labelled rows outside the held-out fold; rows without a 0/1 label teach nothing.

    A doc_id with several labels counts as 1 only if all of them are 1.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), FOLDS))
    # A bounded, fixed sample: the rows whose id has the smallest hashes.
    chosen = known.groupBy("doc_id").agg(F.min(label).cast("double").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id")
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label"), F.max("text").alias("text"))  # repeated rows teach once
    got = rows.select("label", "text").mapInArrow(_features, "label double, terms binary, weights binary").collect()
    got.sort(key=lambda r: (r["terms"], r["weights"], r["label"]))
    weights = np.zeros((len(got), TERMS), dtype=np.float32)
    for i, r in enumerate(got):
        weights[i, np.frombuffer(r["terms"], "<i4")] = np.frombuffer(r["weights"], "<f4")
    return Voter(weights, np.array([r["label"] for r in got]))


def score(docs: DataFrame, voter: Voter, name: str = "__score") -> DataFrame:
    """``docs`` with a score column, whose name must be free; every other column is passed through."""
    shared = docs.sparkSession.sparkContext.broadcast(voter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory(drop_caches=True)
        tool = shared.value
        for batch in batches:
            for part in bounded_slices(batch, "text", SLICE_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(tool.score(term_weights(part.column("text"))))], names=[*part.schema.names, name])
        release_memory(drop_caches=True)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def report(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Every row of ``docs``: doc_id, held_out, score, predicted. A null text is empty; an empty table gives no rows."""
    voter = learn(docs, labels)
    scored = score(docs.select("doc_id", "text"), voter)
    return scored.select("doc_id", held_out(F.col("doc_id"), FOLDS).alias("held_out"), F.col("__score").alias("score"),
                         (F.col("__score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``threshold``, columns unchanged."""
    name = free_name(docs, "__score")
    return score(docs, learn(docs, labels), name).where(F.col(name) >= threshold).select(*[F.col(f"`{n}`") for n in docs.columns])
