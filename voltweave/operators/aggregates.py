"""Grouped summaries.

Sums, means, counts, extremes and standard deviations combine on the map side, so a date or site
that holds most of the rows sends one partial row per task. Medians and quartiles use
``operators.quantiles`` for the same reason.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltweave.operators.joins import natural_left_join
from voltweave.operators.quantiles import quantiles
from voltweave.sources.staging import stage

FUNCTIONS: dict[str, Callable[[str], Column]] = {
    "mean": F.avg,
    "sd": F.stddev_samp,
    "std": F.stddev_samp,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
}


def whole_or_null(col: str, value: Column) -> Column:
    """Null when any input of the group is null (the ``na="propagate"`` rule)."""
    return F.when(F.count(col) == F.count(F.lit(1)), value)


def summarise(
    df: DataFrame,
    by: list[str],
    cols: list[str],
    fns: list[str],
    names: str = "{col}_{fn}",
    na: str = "skip",
) -> DataFrame:
    """Named functions of several columns per group (``median`` included)."""
    plain = [fn for fn in fns if fn != "median"]

    def value(fn: str, col: str) -> Column:
        return whole_or_null(col, FUNCTIONS[fn](col)) if na == "propagate" else FUNCTIONS[fn](col)

    wanted = {names.format(col=col, fn=fn): (col, fn) for col in cols for fn in fns}
    exprs = [value(fn, col).alias(names.format(col=col, fn=fn)) for col in cols for fn in plain]
    if "median" not in fns:
        return df.groupBy(*by).agg(*exprs).select(*by, *wanted)
    complete = [(F.count(col) == F.count(F.lit(1))).alias(f"__whole_{col}") for col in cols]
    base = df.groupBy(*by).agg(*exprs, *complete)
    medians = quantiles(df, cols, {"median": 0.5}, by, names)
    if by:
        joined = natural_left_join(base, medians, by)
    else:
        learned = medians.first().asDict()  # one row
        joined = base.withColumns({name: F.lit(value).cast("double") for name, value in learned.items()})
    out = []
    for name, (col, fn) in wanted.items():
        keep = fn == "median" and na == "propagate"
        out.append(F.when(F.col(f"__whole_{col}"), F.col(name)).alias(name) if keep else F.col(name))
    return joined.select(*by, *out)


def daily_mean(
    df: DataFrame, cols: list[str], date: str = "DATE", names: str = "{col}_mean", na: str = "skip"
) -> DataFrame:
    return summarise(df, [date], cols, ["mean"], names, na)


def daily_median(
    df: DataFrame, cols: list[str], date: str = "DATE", names: str = "{col}_median", approx: bool = False
) -> DataFrame:
    """Exact by default; ``approx`` reads the data once and has a rank error of 1/10000."""
    if approx:
        return df.groupBy(date).agg(*[
            F.percentile_approx(col, 0.5).alias(names.format(col=col)) for col in cols
        ])
    return quantiles(df, cols, {"median": 0.5}, [date], names)


def site_mean(df: DataFrame, col: str = "POWER", keys: tuple[str, ...] = ("SOT", "LAT", "LON")) -> DataFrame:
    """Mean of the known outcomes per site, with its coordinates."""
    return df.where(F.col(col).isNotNull()).groupBy(*keys).agg(F.avg(col).alias("mean"))


def count_by(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return count_by(df, keys).where(F.col("n") != 1)


def attach_group_stats(
    df: DataFrame, key: str, cols: list[str], fns: list[str], names: str, na: str = "skip"
) -> DataFrame:
    """Statistics of each row's group beside the row.

    Aggregate-then-join rather than a window: the aggregate combines before its shuffle, while a
    window would gather a large group in one task.
    """
    return natural_left_join(df, stage(summarise(df, [key], cols, fns, names, na), "groups"), [key])


def group_stats(
    df: DataFrame,
    key: str = "Geo_Group",
    cols: tuple[str, ...] = ("POWER", "V_1", "V_2", "V_3"),
    fns: tuple[str, ...] = ("mean", "median", "sd", "min", "max"),
) -> DataFrame:
    return attach_group_stats(df, key, list(cols), list(fns), "Geo_by_{col}_{fn}")


def cluster_stats(df: DataFrame, key: str = "cluster", cols: tuple[str, ...] = ()) -> DataFrame:
    cols = cols or tuple(f"V_{i}" for i in range(1, 7))
    return attach_group_stats(df, key, list(cols), ["mean", "std", "max", "min"], "{col}_{fn}")


def season_by_quarter(df: DataFrame) -> DataFrame:
    return df.groupBy("quarter").agg(*[F.sum(name).alias(name) for name in ("spring", "summer", "fall", "winter")])


def minmax_scale(df: DataFrame, col: str, reference: DataFrame | None = None) -> DataFrame:
    """``(x - min) / (max - min)``; null for a constant column.

    The extremes are scalar subqueries, computed once over ``reference`` (default: ``df`` itself).
    """
    ends = (reference or df).agg(F.min(col).alias("low"), F.max(col).alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    return df.withColumn(col, F.try_divide(F.col(col) - low, high - low))


def mean_std_of_folds(scores: DataFrame, col: str = "rmse") -> DataFrame:
    """Mean and population standard deviation of the fold scores."""
    return scores.agg(F.avg(col).alias("mean"), F.stddev_pop(col).alias("std"))
