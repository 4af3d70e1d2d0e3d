"""Mean and standard deviation of many columns in one pass.

A plan with hundreds of ``stddev`` expressions is slow to compile and to run. Here every task
reduces its Arrow batches to one row per column, and those rows are combined in one grouped aggregation.
Deviations are taken from the task's own means, so the result is well conditioned.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from voltweave.functions.sql import quoted

FEW_COLUMNS = 16


def moments(df: DataFrame, cols: list[str]) -> dict[str, tuple[int, float | None, float | None]]:
    """(count, mean, sample sd) per column of the values that are neither null nor NaN, at any number of columns."""
    if not cols:
        return {}
    if len(cols) <= FEW_COLUMNS:
        row = df.selectExpr(*[
            f"struct(count({c}) AS n, double(avg({c})) AS mean, double(stddev_samp({c})) AS sd) AS s{i}"
            for i, c in enumerate(f"nanvl(double({quoted(name)}), NULL)" for name in cols)
        ]).first()
        return {c: (row[i]["n"], row[i]["mean"], row[i]["sd"]) for i, c in enumerate(cols)}

    found = matrix_moments(df, cols, len(cols))
    return {
        c: (int(n), mean, (m2 / (n - 1)) ** 0.5 if n > 1 else None) if n else (0, None, None)
        for c, (n, mean, m2) in zip(cols, found)
    }


def matrix_moments(
    df: DataFrame, cols: list[str], width: int, expand: Callable[[np.ndarray], np.ndarray] | None = None
) -> list[tuple[float, float | None, float | None]]:
    """(count, mean, sum of squared deviations) of ``width`` numbers per row, ignoring NaN.

    ``expand`` turns a batch (rows x columns, nulls as NaN) into its matrix of numbers; by default
    the columns themselves.
    """

    def reduce_rows(batches):
        n, mean, m2 = (np.zeros(width) for _ in range(3))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            x = expand(x) if expand else x
            here = ~np.isnan(x)
            count = here.sum(axis=0)
            centre = np.where(here, x, 0.0).sum(axis=0) / np.maximum(count, 1)
            spread = (np.where(here, x - centre, 0.0) ** 2).sum(axis=0)
            total = np.maximum(n + count, 1)
            shift = centre - mean
            m2 += spread + shift**2 * n * count / total
            mean += shift * count / total
            n += count
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width, dtype="int32")), pa.array(n), pa.array(mean), pa.array(m2)],
            names=["i", "n", "mean", "m2"],
        )

    typed = df.selectExpr(*[f"double({quoted(c)}) AS x{i}" for i, c in enumerate(cols)])
    parts = typed.mapInArrow(reduce_rows, "i int, n double, mean double, m2 double").where("n > 0")
    rows = parts.groupBy("i").applyInArrow(_joined, "i int, n double, mean double, m2 double").collect()
    found = {row["i"]: (row["n"], row["mean"], row["m2"]) for row in rows}
    return [found.get(i, (0, None, None)) for i in range(width)]


def _joined(parts: pa.Table) -> pa.Table:
    """Moments of one number from those of the tasks (a row per task): deviations of task means are added to those inside."""
    n, mean, m2 = (parts.column(c).to_numpy() for c in ("n", "mean", "m2"))
    total = n.sum()
    centre = mean[0] + (n * (mean - mean[0])).sum() / total
    made = [total, centre, m2.sum() + (n * (mean - centre) ** 2).sum()]
    return pa.table([parts.column("i").slice(0, 1), *(pa.array([v]) for v in made)], names=["i", "n", "mean", "m2"])
