"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def site_number(sot: Column) -> Column:
    """Leading digits of a site id; empty when there are none."""
    return F.regexp_extract(sot, "^[0-9]*", 0)


def text_match(col: Column, pattern: str) -> Column:
    return col.rlike(pattern)


def relabel(col: Column, patterns: dict[str, str]) -> Column:
    """Apply ``regexp_replace`` for each pattern in turn."""
    for pattern, replacement in patterns.items():
        col = F.regexp_replace(col, pattern, replacement)
    return col
