"""Near copies by SimHash, found with the generalised pigeonhole principle.

Two fingerprints within ``radius`` bits of each other are, in one partition of the bits at least, within the
threshold of that partition, if the thresholds add up to radius - partitions + 1 (a threshold of -1 leaves a
partition out). Correlated bits go into one partition, so that values spread over the others. Thresholds are
chosen for every fingerprint anew: histograms of all fingerprints, over groups of a few bits, estimate how many
candidates each partition would give at each threshold, and dynamic programming divides radius + 1 units
among the partitions at the smallest cost. The fingerprint then probes the cells within its thresholds, and
candidates are verified by their differing bits.

A cell of more than ``CROWDED`` fingerprints is not paired off: its members, and whoever probes it, publish all
values within half the radius. Two of them are linked exactly when they share such a midpoint, and no
midpoint has more owners than its ball has members, so the work stays in proportion to the fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltweave.llm.jaccard import components
from voltweave.sources.staging import stage

BITS = 64
SEED = 42
SHINGLES_AT_ONCE = 1 << 15
HISTOGRAM_BITS = 11
PARTITIONS = (3, 2)  # numbers of partitions that are weighed up
PROBE_COST = 16  # a probe costs as much as so many candidates
CROWDED = 128
FINGERPRINTS_AT_ONCE = 1 << 14
ROW_NUMBERS = 64


def fingerprint(text: str, k: int) -> int:
    """Bits set in over half of the hashes of all runs of ``k`` words (fewer words: one run), as a signed number; 0 without words."""
    words = text.encode().lower().split()  # of bytes: A-Z alone, and \x20 and \x09-\x0D alone
    if not words:
        return 0
    line = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    stops = starts[min(k, len(words)):]
    count = np.zeros(BITS, dtype=np.int64)
    for a in range(0, len(stops), SHINGLES_AT_ONCE):
        made = [xxhash.xxh64_digest(line[x:y - 1], SEED) for x, y in zip(starts[a:a + SHINGLES_AT_ONCE], stops[a:a + SHINGLES_AT_ONCE])]
        count += np.unpackbits(np.frombuffer(b"".join(made), dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > len(stops)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, k: int) -> DataFrame:
    """doc_id and fp of every row; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(t.as_py() or "", k) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def _values(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The chosen bits of each fingerprint (uint64), as a number of len(bits) bits."""
    out = np.zeros(len(fps), dtype=np.int64)
    for j, b in enumerate(bits):
        out |= (fps >> np.uint64(b) & np.uint64(1)).astype(np.int64) << j
    return out


def _ball(bits: int, radius: int) -> np.ndarray:
    """All differences of ``radius`` bits or fewer, nearest first."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)], dtype=np.uint64).view(np.int64)


def _summed(classes: DataFrame, count, size: int) -> np.ndarray:
    """The sum of the ``size`` numbers ``count(fps)`` over all fingerprints; a task sends them in rows of ``ROW_NUMBERS``."""
    names = [f"v{i}" for i in range(ROW_NUMBERS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(-(-size // ROW_NUMBERS) * ROW_NUMBERS)
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            for a in range(0, len(fps), FINGERPRINTS_AT_ONCE):
                total[:size] += count(fps[a:a + FINGERPRINTS_AT_ONCE])
        rows = total.reshape(-1, ROW_NUMBERS)
        at = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(np.ascontiguousarray(c)) for c in rows[at].T)], names=["at", *names])

    sent = classes.select("fp").mapInArrow(run, ", ".join(["at long", *(f"{n} double" for n in names)]))
    out = np.zeros((-(-size // ROW_NUMBERS), ROW_NUMBERS))
    for row in sent.groupBy("at").agg(*[F.sum(n) for n in names]).collect():  # size / ROW_NUMBERS rows at most
        out[row["at"]] = row[1:]
    return out.ravel()[:size]


def bit_correlations(classes: DataFrame) -> np.ndarray:
    """Absolute correlation of any two bits over all fingerprints; a constant bit is correlated with none."""

    def together(fps: np.ndarray) -> np.ndarray:
        bits = np.stack([(fps >> np.uint64(b) & np.uint64(1)) for b in range(BITS)], axis=1).astype(np.float64)
        return np.concatenate([(bits.T @ bits).ravel(), [len(fps)]])

    found = _summed(classes, together, BITS * BITS + 1)
    n, both = max(found[-1], 1), found[:-1].reshape(BITS, BITS)
    share = np.diag(both) / n
    spread = np.sqrt(share * (1 - share))
    with np.errstate(divide="ignore", invalid="ignore"):
        r = np.abs((both / n - np.outer(share, share)) / np.outer(spread, spread))
    r = np.nan_to_num(r, nan=0.0, posinf=0.0)
    np.fill_diagonal(r, 0)
    return r


def bit_partitions(r: np.ndarray, m: int) -> list[list[int]]:
    """``m`` partitions of the bits, of about one size, each grown from its most correlated pair by the bit
    most correlated with it."""
    free, made = set(range(len(r))), []
    for left in range(m, 0, -1):
        size = -(-len(free) // left)
        order = sorted(free)
        inside = r[np.ix_(order, order)]
        own = [order[int(inside.max(axis=1).argmax())]]
        free.remove(own[0])
        while len(own) < size:
            order = sorted(free)
            own.append(order[int(r[np.ix_(order, own)].sum(axis=1).argmax())])
            free.remove(own[-1])
        made.append(sorted(own))
    return made


def near_counts(histogram: np.ndarray, radius: int) -> np.ndarray:
    """(values x radius + 1): how many rows of the histogram lie at each distance from a value."""
    near = np.zeros((len(histogram), radius + 1))
    near[:, 0] = histogram
    values = np.arange(len(histogram))
    for j in range(len(histogram).bit_length() - 1):
        near[:, 1:] += near[values ^ 1 << j, :-1]
    return near


class Plan:
    """Partitions of the bits, and estimates of what each threshold costs in each of them."""

    def __init__(self, partitions: list[list[int]], radius: int):
        self.partitions, self.radius = partitions, radius
        self.groups = [[bits[a:a + HISTOGRAM_BITS] for a in range(0, len(bits), HISTOGRAM_BITS)] for bits in partitions]
        self.flat = [g for groups in self.groups for g in groups]
        self.near: list[np.ndarray] = []
        self.n = 1.0

    def count(self, fps: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(_values(fps, g), minlength=1 << HISTOGRAM_BITS) for g in self.flat])

    def learn(self, counts: np.ndarray) -> None:
        tables = counts.reshape(len(self.flat), -1)
        self.n = max(float(tables[0].sum()), 1.0)
        self.near = [near_counts(t[:1 << len(g)], self.radius) for g, t in zip(self.flat, tables)]

    def costs(self, fps: np.ndarray) -> np.ndarray:
        """(fingerprints x partitions x radius + 2): cost of 0, 1, ... units, which stand for thresholds -1, 0, ..."""
        out = np.zeros((len(fps), len(self.partitions), self.radius + 2))
        at = 0
        for i, groups in enumerate(self.groups):
            share = np.zeros((len(fps), self.radius + 1))
            share[:, 0] = 1
            for g in groups:  # distances of independent groups of bits add up
                own = self.near[at][_values(fps, g)] / self.n
                at += 1
                share = np.stack([sum(share[:, a] * own[:, d - a] for a in range(d + 1)) for d in range(self.radius + 1)], axis=1)
            probes = [len(_ball(len(self.partitions[i]), t)) for t in range(self.radius + 1)]
            out[:, i, 1:] = self.n * share.cumsum(axis=1) + PROBE_COST * np.array(probes)
        return out

    def thresholds(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprints x partitions) thresholds of least cost, and that cost."""
        return allocate(self.costs(fps))


def allocate(costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Divide all units among the partitions at least cost, for every row; returns units - 1 and the cost."""
    rows, m, units = costs.shape
    best, chosen = costs[:, 0, :], []
    for i in range(1, m):
        options = np.full((rows, units, units), np.inf)  # by units so far, own units among them
        for total in range(units):
            for own in range(total + 1):
                options[:, total, own] = best[:, total - own] + costs[:, i, own]
        chosen.append(options.argmin(axis=2))
        best = options.min(axis=2)
    left = np.full(rows, units - 1)
    out = np.empty((rows, m), dtype=np.int64)
    for i in range(m - 1, 0, -1):
        out[:, i] = chosen[i - 1][np.arange(rows), left]
        left = left - out[:, i]
    out[:, 0] = left
    return out - 1, best[:, -1]


def make_plan(classes: DataFrame, radius: int) -> Plan:
    """The cheapest plan by estimate, from counts over all fingerprints. Any plan finds the same links."""
    r = bit_correlations(classes)
    plans = [Plan(bit_partitions(r, m), radius) for m in PARTITIONS]
    sizes = [len(p.flat) << HISTOGRAM_BITS for p in plans]
    counts = _summed(classes, lambda fps: np.concatenate([p.count(fps) for p in plans]), sum(sizes))
    for plan, own in zip(plans, np.split(counts, np.cumsum(sizes)[:-1])):
        plan.learn(own)
    spent = _summed(classes, lambda fps: np.array([p.thresholds(fps)[1].sum() for p in plans]), len(plans))
    return plans[int(spent.argmin())]


def _published(plan: Plan, probing: bool):
    """(part, cell, fp): the cell of every fingerprint in all partitions, or the cells that it probes."""
    balls = [[_ball(len(bits), t) for t in range(plan.radius + 1)] for bits in plan.partitions]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, FINGERPRINTS_AT_ONCE):
                own = batch.column("fp").slice(a, FINGERPRINTS_AT_ONCE).to_numpy()
                fps = own.view(np.uint64)
                at = plan.thresholds(fps)[0] if probing else np.zeros((len(fps), len(plan.partitions)), dtype=np.int64)
                for i, bits in enumerate(plan.partitions):
                    cells = _values(fps, bits)
                    for t in range(plan.radius + 1):
                        rows = np.flatnonzero(at[:, i] == t)
                        if len(rows):
                            near = (cells[rows, None] ^ balls[i][t][None, :]).ravel()
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(near), i, dtype=np.int32)), pa.array(near), pa.array(np.repeat(own[rows], len(balls[i][t])))],
                                names=["part", "cell", "fp"])

    return run


def links(classes: DataFrame, radius: int) -> DataFrame:
    """(a, b) of distinct fingerprints of ``classes`` (column fp) that connect all that differ in ``radius`` bits or fewer.

    Not every such pair is listed: a crowded cell gives enough pairs to connect its members.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    plan = make_plan(classes, radius)
    schema = "part int, cell long, fp long"
    indexed = stage(classes.select("fp").mapInArrow(_published(plan, False), schema), "cells")
    probes = stage(classes.select("fp").mapInArrow(_published(plan, True), schema), "probes")
    crowded = stage(indexed.groupBy("part", "cell").agg(F.count("*").alias("n")).where(F.col("n") > CROWDED).select("part", "cell"), "crowded")
    place = ["part", "cell"]
    quiet = indexed.join(crowded, place, "left_anti").withColumnRenamed("fp", "x")
    differ = F.bit_count(F.col("x").bitwiseXOR(F.col("fp")))
    near = probes.withColumnsRenamed({"part": "p", "cell": "c"}).join(
        quiet, (F.col("p") == F.col("part")) & (F.col("c") == F.col("cell")) & (F.col("x") != F.col("fp")) & (differ <= radius))
    direct = near.select(F.least("x", "fp").alias("a"), F.greatest("x", "fp").alias("b"))
    pressed = indexed.join(crowded, place, "left_semi").select("fp").unionByName(probes.join(crowded, place, "left_semi").select("fp")).distinct()
    middles = F.array(*[F.lit(int(d)) for d in _ball(BITS, radius // 2)])
    met = pressed.select("fp", F.explode(middles).alias("d")).groupBy(F.col("fp").bitwiseXOR(F.col("d")).alias("middle")).agg(
        F.sort_array(F.collect_list("fp")).alias("owners"))  # at most as many owners as the ball has members
    shared = met.where(F.size("owners") > 1).select(F.col("owners")[0].alias("a"), F.explode(F.expr("slice(owners, 2, size(owners))")).alias("b"))
    return direct.unionByName(shared).distinct()


def near_copies(docs: DataFrame, k: int = 3, radius: int = 2) -> DataFrame:
    """Every row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Rows link when their fingerprints differ in ``radius`` bits or fewer; component_id is the smallest doc_id
    reachable, null ids counting only as rows (a component of null ids alone has none). Texts that are null or
    have no words have the fingerprint zero and link like any other. Repeated rows give a row each; an empty
    table gives no rows; other columns are not read.
    """
    rows = stage(fingerprints(docs, k), "fingerprints")
    classes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    labels = components(links(classes, radius))
    named = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    named = stage(named, "named")
    smallest = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    found = stage(named.select("fp", "label").join(smallest, "label").select("fp", "component_id"), "components")
    return rows.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
