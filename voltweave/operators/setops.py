"""Stacking, distinct values and set difference."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_by_name(*tables: DataFrame) -> DataFrame:
    """Stack tables; columns a table lacks are null."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()


def missing_dates(left: DataFrame, right: DataFrame, date: str = "DATE") -> DataFrame:
    """Distinct dates of ``left`` that ``right`` does not have."""
    # Both sides are reduced to distinct dates first, so the anti join sees calendar-sized input.
    return left.select(date).distinct().subtract(right.select(date).distinct())
