"""Spline bases.

The natural spline has a closed form, so it is a SQL expression for any column and any value. The
periodic spline is a lookup table of the days of a month, joined to the data.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltweave.functions.sql import quoted
from voltweave.operators.joins import join_lookup
from voltweave.operators.quantiles import quantile_values
from voltweave.steps.base import FeatureStep


def bspline(x: np.ndarray, knots: np.ndarray, degree: int, derivative: int = 0) -> np.ndarray:
    """B-spline basis (or a derivative) at ``x``, by the two-term recursion; right end included."""
    x = np.asarray(x, dtype=float)
    if derivative:
        lower = bspline(x, knots, degree - 1, derivative - 1)
        out = np.zeros((len(x), len(knots) - degree - 1))
        for j in range(out.shape[1]):
            a, b = knots[j + degree] - knots[j], knots[j + degree + 1] - knots[j + 1]
            out[:, j] = (degree / a * lower[:, j] if a else 0.0) - (degree / b * lower[:, j + 1] if b else 0.0)
        return out
    basis = ((x[:, None] >= knots[:-1]) & (x[:, None] < knots[1:])).astype(float)
    last = np.flatnonzero(knots[:-1] < knots[1:])[-1]
    basis[x == knots[-1], last] = 1.0
    for d in range(1, degree + 1):
        made = np.zeros((len(x), len(knots) - d - 1))
        for j in range(made.shape[1]):
            a, b = knots[j + d] - knots[j], knots[j + d + 1] - knots[j + 1]
            if a:
                made[:, j] += (x - knots[j]) / a * basis[:, j]
            if b:
                made[:, j] += (knots[j + d + 1] - x) / b * basis[:, j + 1]
        basis = made
    return basis


def natural_basis(x: np.ndarray, interior: list[float], low: float, high: float) -> np.ndarray:
    """Cubic basis with zero curvature at both ends, no constant, linear outside ``[low, high]``.

    With knots scaled to [0, 1]: the scaled value itself, and for every knot but the last two the
    truncated cubic that is made linear beyond the last knot, less that of the last but one.
    """
    knots = [0.0, *((k - low) / (high - low) for k in sorted(interior)), 1.0]
    t = (np.asarray(x, dtype=float) - low) / (high - low)

    def bent(k: float) -> np.ndarray:
        return (np.maximum(t - k, 0.0) ** 3 - np.maximum(t - 1.0, 0.0) ** 3) / (1.0 - k)

    return np.column_stack([t] + [bent(k) - bent(knots[-2]) for k in knots[:-2]])


def natural_basis_sql(col: str, interior: list[float], low: float, high: float) -> list[str]:
    """The columns of ``natural_basis`` as SQL text; null for null and NaN."""
    knots = [0.0, *((k - low) / (high - low) for k in sorted(interior)), 1.0]
    t = f"((nanvl(double({quoted(col)}), NULL) - {low!r}D) / {high - low!r}D)"

    def cube(k: float) -> str:
        up = f"(if({t} > {k!r}D, {t} - {k!r}D, {t} * 0D))"
        return f"{up} * {up} * {up}"

    def bent(k: float) -> str:
        return f"(({cube(k)} - {cube(1.0)}) / {1.0 - k!r}D)"

    return [t] + [f"{bent(k)} - {bent(knots[-2])}" for k in knots[:-2]]


def numbered(col: str, n: int) -> list[str]:
    """``col_01`` .. with as many digits as the largest number needs."""
    return [f"{col}_{i:0{len(str(n))}d}" for i in range(1, n + 1)]


class NaturalSpline(FeatureStep):
    """Natural cubic spline with ``df`` columns; knots at quantiles of the training rows.

    Knots that coincide count once, so the basis has fewer columns than ``df`` when the data have
    fewer distinct quantiles.
    """

    def __init__(self, col: str = "DATE_doy", df: int = 10, keep: bool = False):
        super().__init__(col=col, df=df, keep=keep)

    @staticmethod
    def learn(df: DataFrame, config: dict, roles) -> dict:
        col, n = config["col"], config["df"]
        values = df.selectExpr(f"nanvl(double({quoted(col)}), NULL) AS x").where("x IS NOT NULL")
        if values.isEmpty():
            raise ValueError(f"{col} has no values")
        low, *interior, high = quantile_values(values, "x", [0.0, *(i / n for i in range(1, n)), 1.0])
        if low == high:
            raise ValueError(f"{col} is constant")
        inner = sorted({k for k in interior if low < k < high})
        return {"interior": inner, "low": low, "high": high}

    @staticmethod
    def apply(df: DataFrame, config: dict, state: dict) -> DataFrame:
        col = config["col"]
        interior, low, high = state["interior"], state["low"], state["high"]
        texts = natural_basis_sql(col, interior, low, high)
        out = df.selectExpr("*", *[f"{text} AS {quoted(name)}" for name, text in zip(numbered(col, len(texts)), texts)])
        return out if config["keep"] else out.drop(col)


def periodic_basis(x: np.ndarray, period: float, n_splines: int, degree: int = 3) -> np.ndarray:
    """Uniform periodic B-splines; column ``j`` starts ``degree - j`` knots before the origin."""
    step = period / n_splines
    first = -degree * step
    knots = first + step * np.arange(n_splines + 2 * degree + 1)
    folded = np.mod(np.asarray(x, dtype=float), period)
    raw = bspline(folded, knots, degree)
    out = raw[:, :n_splines].copy()
    out[:, : raw.shape[1] - n_splines] += raw[:, n_splines:]
    return out


class PeriodicSpline(FeatureStep):
    """Periodic spline of the day of the month, attached as a lookup table.

    The table has days 1 to 30, so day 31 gets nulls; ``full_month=True`` adds it.
    """

    def __init__(self, col: str = "day", period: int = 30, n_splines: int = 60, degree: int = 3,
                 full_month: bool = False):
        super().__init__(col=col, period=period, n_splines=n_splines, degree=degree, full_month=full_month)

    @staticmethod
    def apply(df: DataFrame, config: dict, state: dict) -> DataFrame:
        col = config["col"]
        days = np.arange(1, 32 if config["full_month"] else 31)
        basis = periodic_basis(days, config["period"], config["n_splines"], config["degree"])
        rows = pd.DataFrame(basis, columns=[f"spline_{i}" for i in range(config["n_splines"])])
        rows.insert(0, col, days)
        lookup = df.sparkSession.createDataFrame(rows).withColumn(col, F.col(col).cast(df.schema[col].dataType))
        return join_lookup(df, F.broadcast(lookup), [col])  # 31 rows at most
