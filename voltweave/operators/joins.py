"""Left joins to date, site and lookup tables.

Physical choice is left to Spark: the right side is either a staged table (its file size is known,
so it is broadcast exactly when small enough) or a table with a fixed number of rows. Beyond the
threshold the same join runs shuffled, with adaptive splitting of skewed partitions. Null keys match
null keys, and may be half of a table: they are dealt over ``SPREAD`` salts and meet copies of the few
right rows with null keys, so that they never share one partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltweave.functions import numeric

SPREAD = 64


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"`{key}`").isNull() for key in keys])


def natural_left_join(left: DataFrame, right: DataFrame, on: list[str] | None = None, spread: list[str] | None = None) -> DataFrame:
    """Left join on all shared column names; null keys match null keys.

    ``spread``: columns of ``left`` that deal its rows with null keys, by default the first two that are
    no keys (more would be read from the source for this alone). It changes no result.
    """
    keys = on or [name for name in left.columns if name in right.columns]
    if not keys:
        raise ValueError("the tables share no column")
    if spread is None:
        spread = [name for name, kind in left.dtypes if name not in keys and not any(x in kind for x in ("map<", "variant"))][:2]
    renamed = right.withColumnsRenamed({key: f"__right_{key}" for key in keys})
    same = [left[key].eqNullSafe(renamed[f"__right_{key}"]) for key in keys]
    if spread:
        dealt = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in spread]), F.lit(SPREAD)).cast("int")
        left = left.withColumn("__left_salt", F.when(_any_null(keys), dealt).otherwise(F.lit(0)))
        copies = F.when(_any_null([f"__right_{key}" for key in keys]), F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
        renamed = renamed.withColumn("__right_salt", F.explode(copies))
        same = [left[key].eqNullSafe(renamed[f"__right_{key}"]) for key in keys] + [left["__left_salt"] == renamed["__right_salt"]]
    made = left.join(renamed, reduce(lambda a, b: a & b, same), "left")
    return made.drop(*[f"__right_{key}" for key in keys], "__left_salt", "__right_salt")


def join_daily(df: DataFrame, daily: DataFrame, date: str = "DATE") -> DataFrame:
    """Attach a daily series to every reading of its date."""
    return natural_left_join(df, daily, [date])


def join_site(df: DataFrame, sites: DataFrame, keys: tuple[str, str] = ("LAT", "LON")) -> DataFrame:
    """Attach site columns by position; readings of unknown sites get nulls."""
    return natural_left_join(df, sites, list(keys))


def join_lookup(df: DataFrame, lookup: DataFrame, on: list[str]) -> DataFrame:
    return natural_left_join(df, lookup, on)


def attach_by_key(left: DataFrame, right: DataFrame, key: str = "ID") -> DataFrame:
    """Put the columns of ``right`` beside those of ``left`` for equal keys.

    Replaces pairing by row position, which a distributed table does not define. Where both sides
    have a column, the one of ``right`` wins.
    """
    kept = [name for name in left.columns if name == key or name not in right.columns]
    return natural_left_join(left.select(*kept), right, [key])


def pairwise_distance(
    points: DataFrame, refs: dict[str, tuple[float, ...]], cols: tuple[str, ...] = ("LAT", "LON")
) -> DataFrame:
    """Euclidean distance of each point to each named reference, one row per (point, reference).

    The references are parameters of the call, so they expand inside each row: no join at all.
    """
    here: list[Column] = [F.col(name) for name in cols]
    pairs = F.array(*[
        F.struct(F.lit(name).alias("ref"), numeric.euclidean(here, [F.lit(float(v)) for v in at]).alias("distance"))
        for name, at in refs.items()
    ])
    return points.withColumn("__pair", F.explode(pairs)).select(*points.columns, "__pair.ref", "__pair.distance")
