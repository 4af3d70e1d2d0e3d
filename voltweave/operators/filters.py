"""Row filters. Each is a plain predicate, so Catalyst can push it into a Parquet scan."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted open range (low, high) of each measure.
OUTLIER_BOUNDS: dict[str, tuple[float | None, float | None]] = {
    "V_2": (-6, None),
    "V_4": (250, None),
    "V_7": (0.675, None),
    "V_11": (None, 14),
    "V_12": (None, 9),
}


def outlier_filter(
    df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]] = OUTLIER_BOUNDS
) -> DataFrame:
    """Keep rows strictly inside every range; a null measure fails its range."""
    for name, (low, high) in bounds.items():
        if low is not None:
            df = df.where(F.col(name) > low)
        if high is not None:
            df = df.where(F.col(name) < high)
    return df


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in cols]))


def any_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [F.col(name).isNull() for name in cols or df.columns]))


def date_range_filter(df: DataFrame, start: str, end: str, date: str = "DATE", also: Column | None = None) -> DataFrame:
    """Closed date range, optionally combined with another condition."""
    out = df.where(F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return out if also is None else out.where(also)


def in_set(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    return df.where(F.col(col).isin(list(values)))


def not_in_set(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """Rows whose value is not listed; a null is not listed, so it is kept."""
    return df.where(F.col(col).isNull() | ~F.col(col).isin(list(values)))


def text_filter(df: DataFrame, col: str, pattern: str) -> DataFrame:
    return df.where(F.col(col).rlike(pattern))


def equals(df: DataFrame, col: str, value) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


def nulls_last(col: str) -> list[Column]:
    """Sort key parts that put nulls after every value inside a struct comparison."""
    return [F.col(col).isNull(), F.col(col)]


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key in ``order`` (ascending, nulls last); ``order`` should be unique per key.

    Written as a ``min`` over a struct rather than ``row_number``: each input partition keeps one
    candidate per key before the shuffle, so a key with very many rows costs no more than any other.
    Null keys form one group.
    """
    rank = [part.alias(f"o{i}_{j}") for i, name in enumerate(order) for j, part in enumerate(nulls_last(name))]
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.distinct()
    row = F.struct(*rank, F.struct(*[F.col(name) for name in rest]).alias("row"))
    best = df.groupBy(*keys).agg(F.min(row).alias("best"))
    return best.select(*[
        F.col(name) if name in keys else F.col("best.row").getField(name).alias(name) for name in df.columns
    ])
