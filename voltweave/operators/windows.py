"""Rolling means, shifts and autocorrelation of a daily series; strict trailing means of a panel.

The daily operators take one row per date (per ``partition_by`` group), so a window partition is
bounded by the calendar. Shifts are positional: gaps in the dates are not filled. All requested
columns are built in one projection, so many series share a single sort.

``trailing_roll`` works on row-level input and therefore runs in chunks of the global order.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltweave.functions.sql import over, quoted, text_literal
from voltweave.operators.order import CHUNK_ROWS, ordered_chunks
from voltweave.sources.staging import stage

# Name suffix of each rolling mean and the rows it takes on either side.
ROLL_HALF_WIDTHS = {"roll_1": 1, "roll_5": 2, "roll_7": 3}


WHOLE = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"


def daily_only(df: DataFrame, order: str, keys: list[str]) -> DataFrame:
    """The frame as it is, but two rows of one date (per group) are refused when it is run.

    Without groups the window runs in one task, which only a daily series may do. The check shares
    the sort of the window that follows it.
    """
    if keys:
        return df
    message = f"window without groups needs one row per {order}: aggregate first, or give partition_by"
    seen = df.selectExpr("*", f"lag({quoted(order)}) {over(order)} AS __before")
    return seen.where(f"if(__before = {quoted(order)}, raise_error({text_literal(message)}), true)").drop("__before")


def centred_roll(
    df: DataFrame,
    cols: list[str],
    half_widths: dict[str, int] | None = None,
    order: str = "DATE",
    partition_by: Iterable[str] = (),
) -> DataFrame:
    """Mean over the rows up to ``h`` before and after; windows are partial at both ends."""
    keys = list(partition_by)
    widths = half_widths or ROLL_HALF_WIDTHS
    return daily_only(df, order, keys).selectExpr("*", *[
        f"avg({quoted(col)}) {over(order, keys, f'ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING')} "
        f"AS {quoted(f'{col}_{suffix}')}"
        for col in cols
        for suffix, h in widths.items()
    ])


def shift_fill_self(
    df: DataFrame,
    cols: list[str],
    lags: Iterable[int] = (1, 2, 3),
    leads: Iterable[int] = (1, 2, 3),
    order: str = "DATE",
    partition_by: Iterable[str] = (),
) -> DataFrame:
    """Lags and leads; where there is no such row the row's own value is used."""
    w = over(order, list(partition_by))
    shifts = [("lag", k) for k in lags] + [("lead", k) for k in leads]
    return daily_only(df, order, list(partition_by)).selectExpr("*", *[
        f"coalesce({fn}({quoted(col)}, {k}) {w}, {quoted(col)}) AS {quoted(f'{col}_{fn}_{k}')}"
        for col in cols
        for fn, k in shifts
    ])


def lag_fill_self(df: DataFrame, cols: list[str], ks: Iterable[int] = (1, 2, 3), **window) -> DataFrame:
    return shift_fill_self(df, cols, ks, (), **window)


def lead_fill_self(df: DataFrame, cols: list[str], ks: Iterable[int] = (1, 2, 3), **window) -> DataFrame:
    return shift_fill_self(df, cols, (), ks, **window)


def shift_fill_edge(
    df: DataFrame,
    cols: list[str],
    lags: Iterable[int] = (1, 2, 3, 4, 5),
    leads: Iterable[int] = (1, 2, 3, 4, 5),
    order: str = "DATE",
    partition_by: Iterable[str] = (),
) -> DataFrame:
    """Lags and leads whose undefined edge rows all get the mean of the ``k`` rows at that edge.

    In a series shorter than ``k`` every row is an edge row. All series travel as one array column,
    so the number of window expressions depends on the number of shifts, not on the number of
    series.
    """
    keys = list(partition_by)
    w, whole = over(order, keys), over(order, keys, WHOLE)
    values = ", ".join(f"double({quoted(col)})" for col in cols)
    placed = daily_only(df, order, keys).selectExpr(
        "*", f"array({values}) AS __v", f"row_number() {w} AS __first",
        f"count(1) {whole} - row_number() {w} + 1 AS __last",
    )
    sides = [("lag", "__first", sorted(set(lags))), ("lead", "__last", sorted(set(leads)))]
    shifted, filled, wanted = [], [], []
    for fn, place, ks in sides:
        shifted += [f"{fn}(__v, {k}) {w} AS __{fn}_{k}" for k in ks]
        shifted += [
            f"max(CASE WHEN {place} = {j} THEN __v END) {whole} AS __{fn}_edge_{j}"
            for j in range(1, max(ks, default=0) + 1)
        ]
        for k in ks:
            edge = ", ".join(f"__{fn}_edge_{j}[i]" for j in range(1, k + 1))
            mean = (
                f"transform(sequence(0, {len(cols) - 1}), i -> aggregate(filter(array({edge}), x -> x IS NOT NULL), "
                "struct(0D AS s, 0 AS n), (a, x) -> struct(a.s + x AS s, a.n + 1 AS n), a -> try_divide(a.s, a.n)))"
            )
            filled.append(f"CASE WHEN {place} <= {k} THEN {mean} ELSE __{fn}_{k} END AS __{fn}_{k}")
            wanted.append((fn, k))
    arrays = placed.selectExpr("*", *shifted).selectExpr(*[quoted(name) for name in df.columns], *filled)
    return arrays.selectExpr(*[quoted(name) for name in df.columns], *[
        f"__{fn}_{k}[{i}] AS {quoted(f'{col}_{fn}_{k}')}" for i, col in enumerate(cols) for fn, k in wanted
    ])


def lag_fill_edge(df: DataFrame, cols: list[str], ks: Iterable[int] = (1, 2, 3, 4, 5), **window) -> DataFrame:
    return shift_fill_edge(df, cols, ks, (), **window)


def lead_fill_edge(df: DataFrame, cols: list[str], ks: Iterable[int] = (1, 2, 3, 4, 5), **window) -> DataFrame:
    return shift_fill_edge(df, cols, (), ks, **window)


def delta(df: DataFrame, col: str, order: str = "DATE", partition_by: Iterable[str] = ()) -> DataFrame:
    before = f"lag({quoted(col)}, 1) {over(order, list(partition_by))}"
    return daily_only(df, order, list(partition_by)).selectExpr(
        "*", f"{before} AS {quoted(f'{col}_lag_1')}", f"{quoted(col)} - {before} AS {quoted(f'{col}_delta_1')}"
    )


def roll_then_lag(
    df: DataFrame,
    col: str,
    half_widths: dict[str, int] | None = None,
    lags: Iterable[int] = (1, 2, 3),
    order: str = "DATE",
    partition_by: Iterable[str] = (),
) -> DataFrame:
    """Plain lags of each rolling mean."""
    keys = list(partition_by)
    widths = half_widths or ROLL_HALF_WIDTHS
    rolled = centred_roll(df, [col], widths, order, keys)
    return rolled.selectExpr("*", *[
        f"lag({quoted(f'{col}_{suffix}')}, {k}) {over(order, keys)} AS {quoted(f'{col}_{suffix}_lag_{k}')}"
        for suffix in widths
        for k in lags
    ])


def acf(daily: DataFrame, col: str, max_lag: int | None = None, order: str = "DATE") -> DataFrame:
    """Autocorrelation by lag, lag 0 included; default range is ``10 * log10(n)`` rows."""
    if max_lag is None:
        # The series is read twice, for its length and for the sums: store it rather than remake it.
        daily = stage(daily.select(order, col), "daily")
        n = daily.where(F.col(col).isNotNull()).count()
        max_lag = max(min(n - 1, int(10 * math.log10(n))), 0) if n else 0
    centred = daily_only(daily.where(F.col(col).isNotNull()), order, []).selectExpr(
        quoted(order), f"{quoted(col)} - avg({quoted(col)}) {over(order, (), WHOLE)} AS d"
    )
    lags = range(1, max_lag + 1)
    shifted = centred.selectExpr("d AS d0", *[f"lag(d, {k}) {over(order)} AS d{k}" for k in lags])
    sums = shifted.selectExpr(f"array({', '.join(f'sum(d0 * d{k})' for k in range(max_lag + 1))}) AS s")
    return sums.selectExpr("posexplode(transform(s, x -> try_divide(x, s[0]))) AS (lag, acf)")


def trailing_roll(
    df: DataFrame,
    cols: list[str],
    size: int,
    order: list[str],
    partition_by: Iterable[str] = (),
    names: str = "roll_mean_{size}_{col}",
    chunk_rows: int = CHUNK_ROWS,
    row: str | None = None,
) -> DataFrame:
    """Mean of the last ``size`` rows including the current one; null unless all are non-null.

    ``order`` must be a unique row order. With ``partition_by`` the window restarts per group, and
    a group of any size is still spread over many tasks. ``row`` names a column to hold the row
    position in the order.
    """
    groups = list(partition_by)
    chunked = ordered_chunks(df, groups + [name for name in order if name not in groups], size - 1, 0, chunk_rows)
    key = ", ".join(quoted(name) for name in ["chunk", *groups])
    w = f"OVER (PARTITION BY {key} ORDER BY row ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)"
    rolled = chunked.selectExpr("*", *[
        f"CASE WHEN count({quoted(col)}) {w} = {size} THEN avg({quoted(col)}) {w} END "
        f"AS {quoted(names.format(size=size, col=col))}"
        for col in cols
    ])
    home = rolled.where(~F.col("border"))
    return (home.withColumnRenamed("row", row) if row else home.drop("row")).drop("chunk", "border")


def trailing_features(
    train: DataFrame, test: DataFrame, cols: list[str], size: int, order: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Trailing means over train followed by test; the first ``size`` training rows are dropped."""
    tagged = train.withColumn("__side", F.lit(0)).unionByName(
        test.withColumn("__side", F.lit(1)), allowMissingColumns=True
    )
    # Training rows come first, so the row position also tells which ones to drop. The result is
    # stored because both parts are read from it.
    rolled = stage(trailing_roll(tagged, cols, size, ["__side", *order], row="__at"), "trailing")
    lacking = [name for name in train.columns if name not in test.columns]
    head = rolled.where((F.col("__side") == 0) & (F.col("__at") >= size))
    return head.drop("__side", "__at"), rolled.where("__side = 1").drop("__side", "__at", *lacking)
