"""Aggregates made by the user, combined on the map side.

An aggregate is four functions: ``start`` a state, ``add`` an array of values to it, ``merge`` two states,
``finish`` a state to a number. Every task reduces its Arrow batches to one state per group before anything is
shuffled, so a group that holds most of the rows sends a state per task; those meet and are merged.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StructField, StructType

from voltweave.functions.sql import quoted

GROUPS_HELD = 50_000  # states that a task keeps; then they are sent and it starts anew


@dataclass(frozen=True)
class Aggregate:
    """``add`` gets the values that are neither null nor NaN, as floats; ``finish`` may return None."""

    start: Callable[[], Any]
    add: Callable[[Any, np.ndarray], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], float | None]


def user_aggregate(df: DataFrame, by: list[str], cols: list[str], aggregates: dict[str, Aggregate], names: str = "{col}_{fn}") -> DataFrame:
    """One row per group with ``names`` for every column and aggregate. Null keys are a group of their own; a
    group without values finishes its start state; without ``by`` there is one row, also for an empty table."""
    wanted = [(i, col, fn) for i, (col, fn) in enumerate((c, f) for c in cols for f in aggregates)]
    # Keys travel as one struct, so that their names clash with nothing.
    keyed = df.selectExpr(f"struct({', '.join(quoted(k) for k in by) or '0'}) AS k", *[f"double({quoted(c)}) AS x{i}" for i, c in enumerate(cols)])
    key = keyed.schema["k"]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def sent() -> pa.RecordBatch:
            rows = [(k, i, pickle.dumps(s)) for k, states in held.items() for i, s in enumerate(states)]
            keys = pa.array([dict(zip(key.dataType.names, k)) for k, *_ in rows], kind)
            return pa.RecordBatch.from_arrays([keys, pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names=["k", "i", "state"])

        kind = None
        for batch in batches:
            kind = batch.column("k").type
            coded = batch.column("k").to_pandas().map(lambda k: tuple(k.values()))
            values = [batch.column(f"x{i}").to_numpy(zero_copy_only=False).astype(float) for i in range(len(cols))]
            for own, at in coded.groupby(coded, sort=False, dropna=False).indices.items():
                states = held.setdefault(own, [aggregates[fn].start() for _, _, fn in wanted])
                for i, col, fn in wanted:
                    x = values[cols.index(col)][at]
                    x = x[~np.isnan(x)]
                    if len(x):
                        states[i] = aggregates[fn].add(states[i], x)
            if len(held) > GROUPS_HELD:
                yield sent()
                held.clear()
        if held:
            yield sent()

    def merged(rows: pa.Table) -> pa.Table:
        states: dict[int, list] = {}
        for i, state in zip(rows.column("i").to_pylist(), rows.column("state").to_pylist()):
            states.setdefault(i, []).append(pickle.loads(state))
        made = [aggregates[fn].finish(reduce(aggregates[fn].merge, states[i])) for i, _, fn in wanted]
        return pa.table([rows.column("k").slice(0, 1), *(pa.array([None if v is None else float(v)], pa.float64()) for v in made)],
                        names=["k", *(f"v{i}" for i, *_ in wanted)])

    parts = keyed.mapInArrow(partial, StructType([key, StructField("i", IntegerType()), StructField("state", BinaryType())]))
    done = parts.groupBy("k").applyInArrow(merged, StructType([key, *(StructField(f"v{i}", DoubleType()) for i, *_ in wanted)]))
    out = [F.col(f"v{i}").alias(names.format(col=col, fn=fn)) for i, col, fn in wanted]
    if by:
        return done.select(*[F.col(f"k.{quoted(k)}") for k in by], *out)
    empty = [aggregates[fn].finish(aggregates[fn].start()) for _, _, fn in wanted]
    first = df.sparkSession.createDataFrame([tuple(None if v is None else float(v) for v in empty)], ", ".join(f"e{i} double" for i, *_ in wanted))
    return first.join(done, F.lit(True), "left").select(
        *[F.when(F.col("k").isNull(), F.col(f"e{i}")).otherwise(F.col(f"v{i}")).alias(names.format(col=col, fn=fn)) for i, col, fn in wanted])


def _add_moments(state: tuple, x: np.ndarray) -> tuple:
    mean = x.mean()
    d = x - mean
    return _merge_moments(state, (len(x), mean, (d**2).sum(), (d**3).sum()))


def _merge_moments(a: tuple, b: tuple) -> tuple:
    """Counts, means and sums of squared and cubed deviations of two parts, joined."""
    if not a[0] or not b[0]:
        return a if a[0] else b
    n, gap = a[0] + b[0], b[1] - a[1]
    return (n, a[1] + gap * b[0] / n, a[2] + b[2] + gap**2 * a[0] * b[0] / n,
            a[3] + b[3] + gap**3 * a[0] * b[0] * (a[0] - b[0]) / n**2 + 3 * gap * (a[0] * b[2] - b[0] * a[2]) / n)


def skewness() -> Aggregate:
    """Third central moment over the cubed deviation; None for a constant or empty group."""
    return Aggregate(lambda: (0, 0.0, 0.0, 0.0), _add_moments, _merge_moments,
                     lambda s: float(np.sqrt(s[0]) * s[3] / s[2] ** 1.5) if s[2] > 0 else None)


def nth_largest(n: int) -> Aggregate:
    """The ``n``-th largest value, repeated ones counted; None with fewer values. A state holds ``n`` numbers."""

    def top(values: np.ndarray) -> np.ndarray:
        return np.sort(values)[::-1][:n]

    return Aggregate(lambda: np.empty(0), lambda s, x: top(np.concatenate([s, x])), lambda a, b: top(np.concatenate([a, b])),
                     lambda s: float(s[n - 1]) if len(s) >= n else None)
