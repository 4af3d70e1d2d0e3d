"""Optional feature blocks behind switches: the second, independent way to build features.

Everything is one lazy plan per input; the switches only decide which columns are added. The two
stateful blocks (site groups and trailing means) store their small or windowed tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltweave.functions import calendar, numeric
from voltweave.operators.aggregates import cluster_stats, minmax_scale
from voltweave.operators.columns import inverse_features
from voltweave.operators.filters import outlier_filter
from voltweave.operators.joins import join_site
from voltweave.operators.spatial import distinct_sites, ring_cluster, single_link_cluster
from voltweave.operators.windows import trailing_features
from voltweave.sources.staging import stage
from voltweave.steps import PeriodicSpline

# Names of the two sets of weekday flags, Monday first.
SHORT_DAYS = ["Mon", "Tue", "Wed", "Thur", "Fri", "Sat", "Sun"]
LONG_DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday"]
MEASURES = [f"V_{i}" for i in range(1, 14)]


@dataclass(frozen=True)
class Switches:
    """Which blocks to add. The defaults are the setting the published scores were made with."""

    # The names of the switches and their defaults.
    datetime_features: bool = True
    outlier_detect: bool = True
    extract_features: bool = True
    extract_features2: bool = False
    deal_date: bool = True
    seasonality_spline_features: bool = True
    lag_feats: bool = False
    lat_lon: bool = False
    beijing_latlon: bool = False
    corr_features_transform: bool = False


def datetime_features(df: DataFrame, date: str = "DATE") -> DataFrame:
    """Calendar parts, weekday flags, and a cyclic pair of the number ``yyyymmdd``."""
    d = F.col(date)
    ymd = calendar.ymd_number(d)
    sin, cos = calendar.cyclic_pair(ymd)
    return df.withColumns({
        **calendar.date_parts(d), **calendar.weekday_flags(d, LONG_DAYS), "ymd": ymd, "sin": sin, "cos": cos,
    })


def deal_date(df: DataFrame, date: str = "DATE", reference: DataFrame | None = None) -> DataFrame:
    """Week share, weekday and season flags, and elapsed time scaled to 0..1.

    The scale is that of ``reference`` when given, else of ``df`` itself: train and scoring rows are
    then on different scales, as in the original.
    """
    d = F.col(date)
    elapsed = calendar.seconds_since(d)
    made = df.withColumns({
        "week": calendar.week_fraction(d),
        **calendar.weekday_flags(d, SHORT_DAYS),
        "distance": elapsed,
        "isweekday": calendar.is_weekday(d),
        **calendar.season_flags(d),
    })
    ends = None if reference is None else reference.select(elapsed.alias("distance"))
    return minmax_scale(made, "distance", ends)


def add_sums(df: DataFrame) -> DataFrame:
    v = {i: F.col(f"V_{i}") for i in range(1, 7)}
    return df.withColumns({"V1_2_6": numeric.total(v[1], v[2], v[6]), "V3_4_5": numeric.total(v[3], v[4], v[5])})


def build_features(
    train: DataFrame, test: DataFrame, switches: Switches = Switches(), order: tuple[str, ...] = ("DATE", "ID")
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with the chosen blocks. Outliers are removed from training rows only.

    Site groups are made once on the union of both inputs, so their numbers mean the same on both.
    """
    parts = [train, test]
    if switches.beijing_latlon or switches.lat_lon or switches.corr_features_transform:
        sites = distinct_sites(train.select("LAT", "LON").unionByName(test.select("LAT", "LON")))
        if switches.beijing_latlon:
            rings = stage(ring_cluster(sites), "rings")
            parts = [join_site(df, rings) for df in parts]
        if switches.lat_lon or switches.corr_features_transform:
            groups = stage(single_link_cluster(sites), "groups")
            parts = [join_site(df, groups) for df in parts]
    if switches.corr_features_transform:
        parts = [cluster_stats(df) for df in parts]
    if switches.lag_feats:
        parts = list(trailing_features(parts[0], parts[1], MEASURES, 15, list(order)))
    if switches.deal_date:
        parts = [deal_date(df) for df in parts]
    if switches.datetime_features:
        parts = [datetime_features(df) for df in parts]
    if switches.seasonality_spline_features:
        if not switches.datetime_features:
            parts = [df.withColumn("day", F.dayofmonth("DATE")) for df in parts]
        parts = [PeriodicSpline().fit(df).transform(df) for df in parts]
    if switches.outlier_detect:
        parts = [add_sums(outlier_filter(parts[0])), add_sums(parts[1])]
    if switches.extract_features:
        parts = [
            df.withColumns({"1_/_V_1": numeric.inverse(F.col("V_1")), "V_1_square_2": numeric.square(F.col("V_1"))})
            for df in parts
        ]
    if switches.extract_features2:
        parts = [inverse_features(df if "V3_4_5" in df.columns else add_sums(df)) for df in parts]
    return parts[0], parts[1]


__all__ = ["Switches", "build_features", "datetime_features", "deal_date"]
