"""Calendar expressions.

Three week numbers and three weekday codings exist side by side on purpose; see each docstring.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label order of abbreviated English month and weekday names.
MONTH_LABELS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
WEEKDAY_LABELS = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
# Months of each season.
SEASON_MONTHS = {"spring": [3, 4, 5], "summer": [6, 7, 8], "fall": [9, 10, 11], "winter": [12, 1, 2]}


def date_parts(date: Column) -> dict[str, Column]:
    """Integer calendar parts; ``dayofweek`` is Mon=0 and ``weekday`` is Mon=1."""
    return {
        "month": F.month(date),
        "hour": F.hour(date.cast("timestamp")),
        "year": F.year(date),
        "dayofweek": F.weekday(date),
        "quarter": F.quarter(date),
        "dayofmonth": F.dayofmonth(date),
        "weekofyear": F.weekofyear(date),
        "day": F.dayofmonth(date),
        "weekday": F.weekday(date) + 1,
    }


def weekday_flags(date: Column, names: list[str]) -> dict[str, Column]:
    """0/1 flag per weekday, ``names`` starting at Monday (five or seven of them)."""
    return {name: (F.weekday(date) == k).cast("int") for k, name in enumerate(names)}


def is_weekday(date: Column) -> Column:
    """1 from Monday to Friday."""
    return (F.weekday(date) < 5).cast("int")


def season_flags(date: Column) -> dict[str, Column]:
    return {name: F.month(date).isin(months).cast("int") for name, months in SEASON_MONTHS.items()}


def week_fraction(date: Column) -> Column:
    """ISO week over 52; 53-week years exceed one."""
    return F.weekofyear(date) / F.lit(52.0)


def week_of_year_sevens(date: Column) -> Column:
    """Complete seven-day periods since 1 January, plus one (not the ISO week)."""
    return F.floor((F.dayofyear(date) - 1) / F.lit(7)).cast("int") + 1


def seconds_since(date: Column, epoch: str = "2016-01-01") -> Column:
    return (F.datediff(date, F.lit(epoch).cast("date")) * F.lit(86400)).cast("double")


def ymd_number(date: Column) -> Column:
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def cyclic_pair(x: Column, period: float = 365.0, cycles: int = 1) -> tuple[Column, Column]:
    """(sin, cos) of ``2*pi*cycles*x/period``."""
    angle = F.lit(2 * cycles * math.pi) * x / F.lit(period)
    return F.sin(angle), F.cos(angle)


def month_label(date: Column) -> Column:
    return F.date_format(date, "MMM")


def weekday_label(date: Column) -> Column:
    return F.date_format(date, "E")


def spike_flag(date: Column, start: str = "2019-02-21", end: str = "2019-03-05") -> Column:
    """1 inside the closed date range; null for a null date."""
    return F.when(date.isNotNull(), date.between(F.lit(start).cast("date"), F.lit(end).cast("date")).cast("int"))


def time_parts(ts: Column) -> dict[str, Column]:
    return {"hour": F.hour(ts), "minute": F.minute(ts), "second": F.second(ts)}
