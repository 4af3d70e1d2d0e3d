"""Learned numeric transforms. Each fit is one or a few aggregations that return plain numbers."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltweave.functions.sql import literal, quoted
from voltweave.operators.moments import matrix_moments, moments
from voltweave.operators.quantiles import quantile_values
from voltweave.operators.ranks import tied_ranks
from voltweave.operators.stats import correlation_table
from voltweave.sources.staging import stage
from voltweave.steps.base import FeatureStep, columns_of


def mean_and_sd(df: DataFrame, cols: list[str]) -> dict[str, list[float | None]]:
    """Mean and sample standard deviation of every column, in one pass."""
    return {c: [mean, sd] for c, (_, mean, sd) in moments(df, cols).items()}


def _divided(value: str, sd: float | None) -> str:
    """Null when the column is constant or has no spread to divide by."""
    return f"({value}) / {literal(sd)}" if sd else "cast(NULL AS double)"


class Scale(FeatureStep):
    """Divide by the sample standard deviation."""

    @staticmethod
    def learn(df: DataFrame, config: dict, roles) -> dict:
        return {"stats": mean_and_sd(df, columns_of(config, df, roles))}

    @staticmethod
    def apply(df: DataFrame, config: dict, state: dict) -> DataFrame:
        return df.withColumns({c: F.expr(_divided(quoted(c), sd)) for c, (_, sd) in state["stats"].items()})


class Normalise(Scale):
    """Centre and divide by the sample standard deviation."""

    @staticmethod
    def apply(df: DataFrame, config: dict, state: dict) -> DataFrame:
        return df.withColumns({
            c: F.expr(_divided(f"{quoted(c)} - {literal(mean)}" if mean is not None else quoted(c), sd))
            for c, (mean, sd) in state["stats"].items()
        })


class LogOutcome(FeatureStep):
    """``log(x + offset)`` to a base; ``inverse`` undoes it on a prediction column."""

    @staticmethod
    def learn(df: DataFrame, config: dict, roles) -> dict:
        return {"cols": columns_of(config, df, roles)}

    @staticmethod
    def apply(df: DataFrame, config: dict, state: dict) -> DataFrame:
        base, offset = float(config.get("base", 10)), float(config.get("offset", 1))
        return df.withColumns({
            c: F.expr(f"log({literal(base)}, {quoted(c)} + {literal(offset)})") for c in state["cols"] if c in df.columns
        })

    @staticmethod
    def inverse(df: DataFrame, col: str, base: float = 10.0, offset: float = 1.0) -> DataFrame:
        return df.withColumn(col, F.pow(F.lit(float(base)), F.col(col)) - F.lit(float(offset)))


class ImputeMedian(FeatureStep):
    """Values that fail a validity condition become null, and nulls become the median.

    ``strict=True`` keeps a known slip of the original analysis: with nulls present its median was
    itself null, so nothing was imputed.
    """

    def __init__(self, col: str = "V_5", invalid: str = "V_5 < 0", strict: bool = False):
        super().__init__(col=col, invalid=invalid, strict=strict)

    @staticmethod
    def _masked(config: dict) -> str:
        return f"CASE WHEN {config['invalid']} THEN NULL ELSE {quoted(config['col'])} END"

    @staticmethod
    def learn(df: DataFrame, config: dict, roles) -> dict:
        masked = df.selectExpr(f"{ImputeMedian._masked(config)} AS x")
        if config["strict"] and not masked.where("x IS NULL").isEmpty():
            return {"median": None}
        return {"median": quantile_values(masked, "x", [0.5])[0]}

    @staticmethod
    def apply(df: DataFrame, config: dict, state: dict) -> DataFrame:
        masked, median = ImputeMedian._masked(config), state["median"]
        filled = masked if median is None else f"coalesce({masked}, {literal(median)})"
        return df.withColumn(config["col"], F.expr(filled))


class LogShift(FeatureStep):
    """``log10(x + shift)``; null when the argument is not positive."""

    @staticmethod
    def learn(df: DataFrame, config: dict, roles) -> dict:
        return {"cols": columns_of(config, df, roles)}

    @staticmethod
    def apply(df: DataFrame, config: dict, state: dict) -> DataFrame:
        shift = literal(config.get("shift", 0.1))
        return df.withColumns({c: F.expr(f"log10({quoted(c)} + {shift})") for c in state["cols"]})


def yeo_johnson(x: str, lam: float) -> str:
    """SQL text of the Yeo-Johnson power transform."""
    rest = 2 - lam
    up = f"ln({x} + 1D)" if abs(lam) < 1e-9 else f"(power({x} + 1D, {literal(lam)}) - 1D) / {literal(lam)}"
    down = f"-ln(1D - {x})" if abs(rest) < 1e-9 else f"-(power(1D - {x}, {literal(rest)}) - 1D) / {literal(rest)}"
    return f"CASE WHEN {x} >= 0 THEN {up} ELSE {down} END"


def likelihoods(df: DataFrame, col: str, grid: list[float]) -> list[float]:
    """Profile log-likelihood at each lambda of the grid, from one pass.

    Powers are evaluated on whole Arrow batches: many times cheaper than a row-wise ``power`` for
    every row and lambda. A task sends one row per lambda.
    """
    lambdas = list(grid)

    def expand(x: np.ndarray) -> np.ndarray:
        x = x[:, 0]
        log = np.log1p(np.abs(x))
        positive = x >= 0
        out = np.empty((len(x), len(lambdas) + 1))
        out[:, -1] = np.sign(x) * log
        for i, lam in enumerate(lambdas):
            power = np.where(positive, lam, 2 - lam)
            with np.errstate(divide="ignore", invalid="ignore"):
                size = np.where(np.abs(power) < 1e-9, log, np.expm1(power * log) / power)
            out[:, i] = np.where(positive, size, -size)
        out[np.isnan(x)] = np.nan
        return out

    *spread, (n, jacobian, _) = matrix_moments(df, [col], len(grid) + 1, expand)
    return [
        -n / 2 * math.log(m2 / n) + (lam - 1) * jacobian * n if n and m2 and m2 > 0 else -math.inf
        for lam, (_, _, m2) in zip(grid, spread)
    ]


class YeoJohnson(FeatureStep):
    """Power transform with the lambda of highest likelihood in [-5, 5], then standardised.

    The search is two passes: each evaluates a whole grid at once, the second over the two cells around the
    best point of the first; a parabola through the best three points of that gives lambda.
    """

    @staticmethod
    def learn(df: DataFrame, config: dict, roles) -> dict:
        col, low, high, points = config["col"], -5.0, 5.0, 41
        for _ in range(2):
            step = (high - low) / (points - 1)
            grid = [low + i * step for i in range(points)]
            values = likelihoods(df, col, grid)
            at = max(range(points), key=values.__getitem__)
            best, low, high = grid[at], max(grid[at] - step, -5.0), min(grid[at] + step, 5.0)
        if 0 < at < points - 1 and all(map(math.isfinite, values[at - 1:at + 2])):
            before, top, after = values[at - 1:at + 2]
            bend = before - 2 * top + after
            best += step * (before - after) / (2 * bend) if bend < 0 else 0.0
        made = df.selectExpr(f"{yeo_johnson(f'double({quoted(col)})', best)} AS y")
        mean, sd = mean_and_sd(made, ["y"])["y"]
        return {"lambda": best, "mean": mean, "sd": sd}

    @staticmethod
    def apply(df: DataFrame, config: dict, state: dict) -> DataFrame:
        value = yeo_johnson(f"double({quoted(config['col'])})", state["lambda"])
        if config.get("standardise", True):
            value = _divided(f"{value} - {literal(state['mean'])}", state["sd"])
        return df.withColumn(config["col"], F.expr(value))


def correlation_matrix(df: DataFrame, cols: list[str], method: str = "spearman") -> list[list[float]]:
    """Correlation of every two columns over the rows where both are present; NaN where there is none.

    ``spearman`` correlates ranks that are taken over all values of a column, ties sharing their average.
    """
    if method not in ("spearman", "pearson"):
        raise ValueError(f"unknown method {method!r}")
    values = tied_ranks(df, cols) if method == "spearman" else df.selectExpr(*[f"nanvl(double({quoted(c)}), NULL) AS {quoted(c)}" for c in cols])
    place = {c: i for i, c in enumerate(cols)}
    out = [[1.0 if a == b else math.nan for b in cols] for a in cols]
    for row in correlation_table(values, cols, "none").select("Parameter1", "Parameter2", "r").collect():  # columns squared
        if row["r"] is not None and row["Parameter1"] != row["Parameter2"]:
            out[place[row["Parameter1"]]][place[row["Parameter2"]]] = row["r"]
    return out


def drop_correlated(matrix: list[list[float]], threshold: float) -> list[int]:
    """Indices to drop: strongest pair first, of which the one more correlated with the rest goes (or the first of the pair).

    Strengths and their means are compared at nine digits, an undefined correlation counts as none.
    """
    p = len(matrix)
    strength = [[round(abs(v), 9) if v == v else 0.0 for v in row] for row in matrix]
    pairs = sorted(
        ((strength[i][j], i, j) for i in range(p) for j in range(i + 1, p) if strength[i][j] > threshold),
        key=lambda pair: (-pair[0], pair[1], pair[2]),
    )
    gone: set[int] = set()
    for _, i, j in pairs:
        if i in gone or j in gone:
            continue
        kept = [k for k in range(p) if k not in gone]
        mean_i, mean_j = (round(sum(strength[x][k] for k in kept) / len(kept), 9) for x in (i, j))
        gone.add(j if mean_j > mean_i else i)
    return sorted(gone)


class CorrelationFilter(FeatureStep):
    """Drop columns until no pair is correlated beyond the threshold; a pair is judged on the rows that have both."""

    @staticmethod
    def learn(df: DataFrame, config: dict, roles) -> dict:
        chosen = columns_of(config, df, roles)
        df = stage(df.selectExpr(*[f"double({quoted(c)}) AS {quoted(c)}" for c in chosen]), "judged") if chosen else df
        stats = mean_and_sd(df, chosen)
        cols = [c for c, (_, sd) in stats.items() if sd]  # a constant column has no correlation
        if len(cols) < 2:
            return {"drop": []}
        matrix = correlation_matrix(df, cols, config.get("method", "spearman"))
        return {"drop": [cols[i] for i in drop_correlated(matrix, config.get("threshold", 0.9))]}

    @staticmethod
    def apply(df: DataFrame, config: dict, state: dict) -> DataFrame:
        return df.drop(*state["drop"])
