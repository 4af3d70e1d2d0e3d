"""Column selection, renaming, arithmetic blocks and reshaping. All of them are narrow (no shuffle)."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltweave.functions import numeric

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def matching(names: Iterable[str], pattern: str, ignore_case: bool = True) -> list[str]:
    regex = re.compile(pattern, re.IGNORECASE if ignore_case else 0)
    return [name for name in names if regex.search(name)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind in NUMERIC_TYPES or kind.startswith("decimal")]


def rename(df: DataFrame, mapping: Mapping[str | int, str]) -> DataFrame:
    """Rename by name or by 1-based position."""
    by_name = {df.columns[key - 1] if isinstance(key, int) else key: new for key, new in mapping.items()}
    return df.withColumnsRenamed(by_name)


def drop_cols(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.drop(*cols)


def select_matching(df: DataFrame, pattern: str, ignore_case: bool = True) -> DataFrame:
    return df.select(*matching(df.columns, pattern, ignore_case))


def drop_matching(df: DataFrame, pattern: str, ignore_case: bool = True) -> DataFrame:
    return df.drop(*matching(df.columns, pattern, ignore_case))


def relocate_first(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols, *[name for name in df.columns if name not in cols])


def across_exprs(
    cols: Iterable[str], fns: Mapping[str, Callable[[Column], Column]], names: str = "{col}_{fn}"
) -> list[Column]:
    """One aliased expression per (column, function), columns outermost."""
    return [fn(F.col(col)).alias(names.format(col=col, fn=fn_name)) for col in cols for fn_name, fn in fns.items()]


def across(
    df: DataFrame, cols: Iterable[str], fns: Mapping[str, Callable[[Column], Column]], names: str = "{col}_{fn}"
) -> DataFrame:
    """Add or replace the results of several functions on several columns, in one projection."""
    cols = list(cols)
    return df.withColumns({
        names.format(col=col, fn=fn_name): fn(F.col(col)) for col in cols for fn_name, fn in fns.items()
    })


def arith_features(df: DataFrame) -> DataFrame:
    """Sums of measures, square and reciprocal of ``V_1``."""
    v = {i: F.col(f"V_{i}") for i in range(1, 7)}
    return df.withColumns({
        "V1_2_6": numeric.total(v[1], v[2], v[6]),
        "V3_4_5": numeric.total(v[3], v[4], v[5]),
        "V_1_square_2": numeric.square(v[1]),
        "1_/_V_1": numeric.inverse(v[1]),
    })


# The columns that get a reciprocal.
INVERSE_COLUMNS = ["V_11", "V_13", "V_7", "V_4", "V_5", "V_8", "V_3", "V3_4_5"]


def inverse_features(df: DataFrame, cols: Iterable[str] = INVERSE_COLUMNS, eps: float = numeric.EPSILON) -> DataFrame:
    return df.withColumns({f"inv{name}": numeric.inverse(F.col(name), eps) for name in cols})


def tag_source(df: DataFrame, name: str, col: str = "dataset") -> DataFrame:
    return df.withColumn(col, F.lit(name))


def unpivot_long(
    df: DataFrame, ids: list[str], cols: list[str] | None = None, names_to: str = "param", values_to: str = "val"
) -> DataFrame:
    """Wide to long. Value columns are cast to double so that they share a type."""
    cols = cols or [name for name in df.columns if name not in ids]
    typed = df.select(*ids, *[F.col(name).cast("double") for name in cols])
    return typed.unpivot(ids, cols, names_to, values_to)


def explode_list(df: DataFrame, col: str) -> DataFrame:
    """One row per list element; rows with an empty or null list disappear."""
    return df.withColumn(col, F.explode(col))


def as_text_levels(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Numbers to text, the first half of making a categorical column (``LevelOrder`` is the other)."""
    return df.withColumns({name: F.col(name).cast("string") for name in cols})
