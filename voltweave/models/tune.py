"""Parameter ranges, grids and search.

The sequential search proposes Latin-hypercube candidates in rounds around the best settings so
far, and stops when a number of rounds brought no gain. Each candidate is scored by resampling.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from voltweave.models.evaluate import collect_metrics, metrics, select_best
from voltweave.models.resample import fit_resamples, last_fit
from voltweave.models.specs import FittedWorkflow, Workflow
from voltweave.operators.sampling import SEED
from voltweave.operators.setops import union_by_name
from voltweave.sources.staging import stage


@dataclass(frozen=True)
class Range:
    """Bounds on the scale ``linear`` or ``log10``; whole numbers when ``whole``."""

    low: float
    high: float
    whole: bool = False
    log10: bool = False

    def at(self, share: float) -> float | int:
        value = self.low + (self.high - self.low) * share
        value = 10**value if self.log10 else value
        return int(round(value)) if self.whole else float(value)

    def levels(self, n: int) -> list[float | int]:
        shares = [i / (n - 1) for i in range(n)] if n > 1 else [0.0]
        return list(dict.fromkeys(self.at(share) for share in shares))


# Search ranges.
RANGES = {
    "trees": Range(1, 2000, whole=True),
    "min_n": Range(2, 40, whole=True),
    "tree_depth": Range(1, 15, whole=True),
    "learn_rate": Range(-3, -0.5, log10=True),
    "loss_reduction": Range(-10, 1.5, log10=True),
    "sample_size": Range(0.1, 1.0),
    "penalty": Range(-10, 0, log10=True),
    "mixture": Range(0.05, 1.0),
    "df": Range(1, 360, whole=True),
}


def param_ranges(workflow: Workflow, df: DataFrame | None = None, **overrides: Range) -> dict[str, Range]:
    """Range of every open setting; ``mtry`` goes up to the number of predictors after the steps."""
    ranges = {}
    for name in workflow.tuned_settings():
        if name in overrides:
            ranges[name] = overrides[name]
        elif name == "mtry":
            if df is None:
                raise ValueError("mtry needs data to count the predictors")
            ranges[name] = Range(1, len(workflow.features.fit(df).predictors), whole=True)
        else:
            ranges[name] = RANGES[name]
    return ranges


def grid_regular(ranges: dict[str, Range], levels: int | dict[str, int]) -> list[dict]:
    """All combinations of evenly spaced levels."""
    count = levels if isinstance(levels, dict) else dict.fromkeys(ranges, levels)
    axes = [[(name, value) for value in ranges[name].levels(count[name])] for name in ranges]
    return [dict(combo) for combo in itertools.product(*axes)]


def latin_hypercube(ranges: dict[str, Range], n: int, seed: int = SEED, near: dict | None = None, width: float = 1.0) -> list[dict]:
    """``n`` points, each axis cut into ``n`` cells used once; optionally shrunk around a point."""
    rng = random.Random(seed)
    columns = {}
    for name in ranges:
        cells = list(range(n))
        rng.shuffle(cells)
        columns[name] = [(cell + rng.random()) / n for cell in cells]
    points = []
    for i in range(n):
        point = {}
        for name, axis in ranges.items():
            share = columns[name][i]
            if near is not None:
                centre = near[f"__{name}"]
                share = min(max(centre + (share - 0.5) * width, 0.0), 1.0)
            point[name], point[f"__{name}"] = axis.at(share), share
        points.append(point)
    return points


def settings_of(point: dict) -> dict:
    return {name: value for name, value in point.items() if not name.startswith("__")}


def describe_point(settings: dict) -> str:
    return ", ".join(f"{name}={value:.6g}" if isinstance(value, float) else f"{name}={value}"
                     for name, value in sorted(settings.items()))


def tune_grid(
    workflow: Workflow, df: DataFrame, grid: list[dict], metric_names: tuple[str, ...] = ("rmse",),
    fold: str = "fold", parallelism: int = 4, stored: bool = False,
) -> DataFrame:
    """Resampled metrics of every grid point: ``point, settings, metric, mean, n, std_err``."""
    data = df if stored else stage(df, "folds")
    candidates = {str(i): workflow.with_settings(**settings_of(point)) for i, point in enumerate(grid)}
    predictions = fit_resamples(candidates, data, fold, parallelism, stored=True)
    scored = collect_metrics(metrics(predictions, metric_names, ["wflow_id", fold]))
    names = df.sparkSession.createDataFrame(
        [(str(i), describe_point(settings_of(point))) for i, point in enumerate(grid)], "wflow_id string, settings string"
    )
    joined = scored.join(names, "wflow_id")
    return joined.selectExpr("int(wflow_id) AS point", "settings", "metric", "mean", "n", "std_err")


def best_settings(results: DataFrame, grid: list[dict], metric: str = "rmse") -> dict:
    """Settings of the grid point with the lowest mean."""
    return settings_of(grid[select_best(results, metric, ["point"]).first()["point"]])


def tune_search(
    workflow: Workflow, df: DataFrame, ranges: dict[str, Range], initial: int = 10, iterations: int = 10,
    no_improve: int = 3, batch: int = 1, fold: str = "fold", parallelism: int = 4, seed: int = SEED,
) -> tuple[DataFrame, dict]:
    """(history, best settings). ``history`` has one row per scored point with its round."""
    data = stage(df, "folds")
    best_point, best_score, stale, width = None, float("inf"), 0, 1.0
    parts: list[DataFrame] = []
    for number in range(iterations + 1):
        n = initial if number == 0 else batch
        points = latin_hypercube(ranges, n, seed + number, best_point, width)
        results = stage(tune_grid(workflow, data, points, ("rmse",), fold, parallelism, stored=True), "round")
        parts.append(results.selectExpr(f"{number} AS round", "*"))
        top = select_best(results, "rmse", ["point"]).first()
        if top["mean"] < best_score:
            best_point, best_score, stale = points[top["point"]], top["mean"], 0
        else:
            stale += number > 0
        width = max(width * 0.7, 0.1)
        if stale >= no_improve:
            break
    return union_by_name(*parts), settings_of(best_point)


def workflow_map(
    workflows: dict[str, Workflow], df: DataFrame, how: str = "resamples", grids: dict[str, list[dict]] | None = None,
    ranges: dict[str, dict[str, Range]] | None = None, fold: str = "fold", parallelism: int = 4, **search,
) -> DataFrame:
    """Resampled metrics of a whole set: ``wflow_id`` and what the single-workflow call gives.

    ``grid`` and ``search`` take each workflow's own points or ranges by its name; a workflow with
    nothing to tune is resampled as it is.
    """
    data = stage(df, "folds")
    fixed = {name: w for name, w in workflows.items() if how == "resamples" or not w.tuned_settings()}
    parts = []
    if fixed:
        found = collect_metrics(metrics(fit_resamples(fixed, data, fold, parallelism, stored=True), ("rmse",), ["wflow_id", fold]))
        parts.append(stage(found.selectExpr("wflow_id", "'' AS settings", "metric", "mean", "n", "std_err"), "mapped"))
    for name, workflow in workflows.items():
        if name in fixed:
            continue
        if how == "grid":
            made = tune_grid(workflow, data, grids[name], ("rmse",), fold, parallelism, stored=True)
        elif how == "search":
            made, _ = tune_search(workflow, data, ranges[name], fold=fold, parallelism=parallelism, **search)
        else:
            raise ValueError(f"unknown way {how!r}")
        parts.append(stage(made.selectExpr(f"'{name}' AS wflow_id", "settings", "metric", "mean", "n", "std_err"), "mapped"))
    return union_by_name(*parts)


def finalise(workflow: Workflow, settings: dict) -> Workflow:
    return workflow.with_settings(**settings)


def fit_all_and_submit(
    workflow: Workflow, split: DataFrame, train: DataFrame, test: DataFrame, submission: DataFrame,
    write: Callable[[DataFrame], None] | None = None,
) -> tuple[DataFrame, DataFrame, FittedWorkflow]:
    """(hold-out metrics, submission, model refitted on all training rows).

    The submission keeps its rows and gets the predictions as ``POWER``, matched by ``ID``.
    """
    from voltweave.operators.joins import attach_by_key

    _, _, scores = last_fit(workflow, split)
    final = workflow.fit(train)
    scored = final.predict(test, (workflow.key,)).withColumnRenamed("pred", workflow.features.outcome)
    result = attach_by_key(submission, scored, workflow.key)
    if write is not None:
        write(result)
    return scores, result, final
