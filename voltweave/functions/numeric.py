"""Arithmetic expressions with the null rules of this package.

Logs of non-positive numbers and divisions by zero give null instead of an infinity or an error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-3


def log10_shift(x: Column, shift: float = 0.0) -> Column:
    """``log10(x + shift)``; null when the argument is not positive."""
    return F.log10(x + F.lit(shift) if shift else x)


def inverse(x: Column, eps: float = EPSILON) -> Column:
    """``1 / (x + eps)``; null when the denominator is zero."""
    return F.try_divide(F.lit(1.0), x + F.lit(eps))


def square(x: Column) -> Column:
    return x * x


def total(*xs: Column) -> Column:
    """Sum that is null when any term is null."""
    return reduce(lambda a, b: a + b, xs)


def if_else(cond: Column, yes: Column, no: Column) -> Column:
    """Conditional that is null when the condition is null."""
    return F.when(cond.isNull(), None).when(cond, yes).otherwise(no)


def haversine(lat: Column, lon: Column, ref_lat: float, ref_lon: float, radius: float = 6371000.0) -> Column:
    """Great-circle distance in metres to a fixed point."""
    d_lat = F.radians(F.lit(ref_lat) - lat) / 2
    d_lon = F.radians(F.lit(ref_lon) - lon) / 2
    chord = F.pow(F.sin(d_lat), F.lit(2.0)) + F.cos(F.radians(lat)) * F.cos(F.radians(F.lit(ref_lat))) * F.pow(
        F.sin(d_lon), F.lit(2.0)
    )
    return F.lit(2 * radius) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


def euclidean(a: list[Column], b: list[Column]) -> Column:
    return F.sqrt(total(*[(x - y) * (x - y) for x, y in zip(a, b)]))
