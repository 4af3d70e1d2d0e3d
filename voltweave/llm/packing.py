"""Best-fit packing of token sequences, as bulk-synchronous rounds.

Waiting pieces and open gaps are range-sorted by size and numbered within their size, whatever ranges a
size is spread over. A round sweeps the sizes upwards: every gap takes the largest piece that fits and is
still free, and of that size as many as fit, as one run. Sizes are whole numbers up to the limit, so the
sweep needs the counts by size alone and gives stretches of numbers: gaps so-and-so of one size take runs
from piece so-and-so on of another. Each task finds the run of its gaps by their numbers, so no two gaps
claim a piece. The gaps shrink, are sorted again, and the next round begins. A run leaves less than half of
its gap, so the rounds grow with the logarithm of the limit, not with the pieces. When no piece fits any gap,
as many sequences open as the waiting tokens fill. Pieces are not moved before the end, when they meet their
runs by size and number.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltweave.llm.common import bounded_slices, expand, partitions, release_memory
from voltweave.llm.encoding import CACHE_PIECES, encoder
from voltweave.sources.staging import stage

SLICE_BYTES = 8 << 20
PIECES = "doc_id long, piece long, start long, length long, ids_crc32 long"
TAKEN = "id long, size long, piece_size long, first long, run long"


def _cutter(path: str, end_id: int, limit: int, cache_pieces: int, slice_bytes: int = SLICE_BYTES):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path, cache_pieces)
        for batch in batches:
            for part in bounded_slices(batch, "text", slice_bytes):
                ids, offsets = tool.encode(part.column("text"))
                rows: list[tuple[int, int, int, int, int]] = []
                end = np.array([end_id], dtype="<u4")
                for row, (a, b) in enumerate(zip(offsets, offsets[1:])):
                    own = np.concatenate([ids[a:b], end])
                    first = (len(own) - 1) % limit + 1
                    bounds = [0, *range(first, len(own) + 1, limit)]
                    for k, (x, y) in enumerate(zip(bounds, bounds[1:])):
                        rows.append((row, k, x, y - x, zlib.crc32(own[x:y].tobytes())))
                made = np.array(rows, dtype=np.int64).reshape(-1, 5)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(made[:, 0])), *(pa.array(made[:, k]) for k in range(1, 5))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )
        release_memory()

    return cut


def token_pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int, limit: int, cache_pieces: int = CACHE_PIECES, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """Pieces of every document: its ids and ``end_id``, cut into ``limit`` ids, only the first piece shorter."""
    if "doc_id" not in docs.columns or "text" not in docs.columns:
        raise ValueError("documents need doc_id and text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _cutter(tokenizer_path, end_id, limit, cache_pieces, slice_bytes), PIECES
    )


def sweep(pieces: dict[int, int], gaps: dict[int, int]) -> list[tuple[int, int, int, int]]:
    """Match counts by size: a list of (gap size, piece size, run, number of gaps), in the order in which numbers are given.

    Like brackets: going up, the pieces of a size open and a gap closes those opened last, the largest that
    fit it; it takes a run of them. The last gap of a size of pieces may find a shorter run.
    """
    waiting: list[list[int]] = []  # size, pieces left
    made = []
    for size in sorted({*pieces, *gaps}):
        if pieces.get(size):
            waiting.append([size, pieces[size]])
        free = gaps.get(size, 0)
        while free and waiting:
            own, left = waiting[-1]
            run = min(size // own, left)
            n = min(free, left // run)
            made.append((size, own, run, n))
            free -= n
            waiting[-1][1] -= n * run
            if not waiting[-1][1]:
                waiting.pop()
    return made


class Numbers:
    """Numbers of rows within their size, from the places that ``numbered`` gives."""

    def __init__(self, counts: list[tuple[int, int, int]]):
        """``counts``: (range, size, rows); a row per range and one per size at most, if the table is range-sorted."""
        self.totals: Counter[int] = Counter()
        rows = []
        for own, size, n in sorted(counts):
            rows.append((own, size, self.totals[size]))
            self.totals[size] += n
        self.table = np.array(rows, dtype=np.int64).reshape(-1, 3)
        self.width = int(self.table[:, 1].max(initial=0)) + 1
        self.keys = self.table[:, 0] * self.width + self.table[:, 1]

    def of(self, own: np.ndarray, size: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self.table[np.searchsorted(self.keys, own * self.width + size), 2] + place


def numbered(rows: DataFrame, size: str, ranges: int, name: str) -> tuple[DataFrame, Numbers]:
    """``rows`` range-sorted by ``size`` and id and stored, with their range and their place in its rows of that size."""
    fields = [*rows.columns, "range", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = -1, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = batch.column(size).to_numpy()
            at = np.arange(len(sizes))
            first = np.maximum.accumulate(np.where(np.diff(sizes, prepend=-1) != 0, at, 0))
            place = at - first + np.where((first == 0) & (sizes == last), count, 0)
            last, count = int(sizes[-1]), int(place[-1]) + 1
            own = np.full(len(sizes), TaskContext.get().partitionId(), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own), pa.array(place)], names=fields)

    schema = ", ".join([*(f"{c} {t}" for c, t in rows.dtypes), "range long", "place long"])
    stored = stage(rows.repartitionByRange(ranges, size, "id").sortWithinPartitions(size, "id").mapInArrow(run, schema), name)
    counts = stored.groupBy("range", size).agg(F.count("*").alias("n")).collect()  # ranges + sizes rows at most
    return stored, Numbers([tuple(r) for r in counts])


def _take(found: list[tuple[int, int, int, int]], used: dict[int, int], numbers: Numbers | None, base: int):
    """Gives every gap its run by its number; gaps without one have run 0. ``used``: pieces taken so far, by size."""
    rows, taken, done = [], dict(used), Counter()
    for size, own, run, n in found:
        rows.append((size, done[size], n, own, taken.get(own, 0), run))
        done[size] += n
        taken[own] = taken.get(own, 0) + n * run
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)  # at most two rows per size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, ids = batch.column("size").to_numpy(), batch.column("id").to_numpy()
            number = numbers.of(batch.column("range").to_numpy(), size, batch.column("place").to_numpy()) if numbers else ids - base
            # The last stretch of the gap's size that does not begin behind it.
            low, high = np.searchsorted(table[:, 0], size, "left"), np.searchsorted(table[:, 0], size, "right")
            at = np.full(len(size), -1, dtype=np.int64)
            for value in np.unique(size[high > low]):
                own = np.flatnonzero(size == value)
                a, b = low[own[0]], high[own[0]]
                at[own] = a + np.searchsorted(table[a:b, 1], number[own], "right") - 1
            row = table[at] if len(table) else np.zeros((len(size), 6), dtype=np.int64)
            inside = number - row[:, 1]
            hit = (at >= 0) & (inside < row[:, 2])
            first = np.where(hit, row[:, 4] + inside * row[:, 5], 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("size"), pa.array(np.where(hit, row[:, 3], 0)), pa.array(first), pa.array(np.where(hit, row[:, 5], 0))],
                names=["id", "size", "piece_size", "first", "run"])

    return run, taken


def _runs(limit: int):
    """A row per piece of every run: its size and number, its sequence, its place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, own, first, runs = (batch.column(c).to_numpy() for c in ("size", "piece_size", "first", "run"))
            at, number = np.repeat(np.arange(len(runs)), runs), expand(first, runs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[at]), pa.array(number), batch.column("id").take(pa.array(at)), pa.array(limit - size[at] + (number - first[at]) * own[at])],
                names=["length", "number", "sequence_id", "offset"])

    return run


def _with_number(numbers: Numbers):
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = numbers.of(*(batch.column(c).to_numpy() for c in ("range", "length", "place")))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(number)], names=[*names, "number"])

    return run


def best_fit(pieces: DataFrame, limit: int, ranges: int | None = None) -> DataFrame:
    """Give every piece (columns of ``PIECES``) a ``sequence_id`` and an ``offset``; no sequence exceeds ``limit``.

    Pieces of more than half the limit open a sequence each. Equal sizes are taken in the order of row numbers.
    Repeated rows are packed one by one, a null doc_id like any other. An empty table gives an empty result.
    The driver holds counts by size, at most ``limit``, and a row per range.
    """
    spark = pieces.sparkSession
    ranges = ranges or partitions(spark)
    stored, places = numbered(stage(pieces.withColumn("id", F.monotonically_increasing_id()), "pieces"), "length", ranges, "sorted-pieces")
    waiting, used = dict(places.totals), {}
    gaps: Counter[int] = Counter()
    state, sequences, taken = None, 0, []
    while waiting:
        least = min(waiting)
        if any(size >= least for size in gaps):
            rows, numbers = numbered(state.where(F.col("size") >= least), "size", ranges, "gaps")
            gaps = numbers.totals
        else:
            large = sum(n for size, n in waiting.items() if 2 * size > limit)
            opened = large or -(-sum(size * n for size, n in waiting.items()) // limit)
            rows, numbers, gaps = spark.range(sequences, sequences + opened).withColumn("size", F.lit(limit).cast("long")), None, Counter({limit: opened})
        found = sweep(waiting, gaps)
        take, used = _take(found, used, numbers, sequences)
        if numbers is None:
            sequences += opened
        taken.append(stage(rows.mapInArrow(take, TAKEN), "taken"))
        for size, own, run, n in found:
            gaps[size] -= n
            gaps[size - own * run] += n
            waiting[own] -= n * run
        waiting = {size: n for size, n in waiting.items() if n}
        gaps = +gaps
        state = taken[-1].select("id", (F.col("size") - F.col("piece_size") * F.col("run")).alias("size"))
    if not taken:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).limit(0)
    runs = reduce(DataFrame.unionByName, taken).where("run > 0")  # one table a round
    runs = runs.mapInArrow(_runs(limit), "length long, number long, sequence_id long, offset long")
    named = stored.mapInArrow(_with_number(places), PIECES + ", number long")
    return named.join(runs, ["length", "number"]).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pack(
    docs: DataFrame, tokenizer_path: str, end_id: int, limit: int = 1024, cache_pieces: int = CACHE_PIECES, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is a document of the end id alone. Other columns of ``docs`` are not read.
    ``cache_pieces`` bounds what a worker keeps of the encoder's work, ``slice_bytes`` the text it encodes at once
    (a longer one whole): less takes less memory and more time.
    """
    return best_fit(token_pieces(docs, tokenizer_path, end_id, limit, cache_pieces, slice_bytes), limit)
