"""Grouping of sites by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltweave.functions import numeric
from voltweave.operators import clustering
from voltweave.operators.aggregates import site_mean
from voltweave.operators.filters import first_per_key
from voltweave.operators.order import ordered_chunks


def distinct_sites(
    df: DataFrame, order: list[str] | None = None, keys: tuple[str, str] = ("LAT", "LON")
) -> DataFrame:
    """First row per position in ``order``; just the positions when no order is given."""
    if order is None:
        return df.select(*keys).distinct()
    return first_per_key(df, list(keys), order)


def geo_cluster(
    sites: DataFrame,
    k: int = 10,
    linkage: str = "ward",
    keys: tuple[str, str] = ("LAT", "LON"),
    name: str = "Geo_Group",
    tile: int = clustering.TILE,
) -> DataFrame:
    """Group number 1..k per distinct position, by smallest member in position order (null positions are left out).

    ``ward`` merges the pair with the smallest growth of the within-group sum of squares, ``single`` the pair with
    the smallest distance; equal ones by the order of members that ``clustering`` fixes. The exact hierarchy at any size; fewer positions than
    ``k`` are a group each, and an empty table gives no rows.
    """
    if linkage not in clustering.LINKAGES:
        raise ValueError(f"unknown linkage {linkage!r}")
    points = clustering.numbered_points(sites, keys)
    return clustering.LINKAGES[linkage](points, k, name, tile).select(*keys, name)


def single_link_cluster(sites: DataFrame, k: int = 10, name: str = "cluster", **options) -> DataFrame:
    return geo_cluster(sites, k, "single", name=name, **options)


def ring_cluster(
    sites: DataFrame,
    ref: tuple[float, float] = (39.9, 116.4),
    k: int = 12,
    keys: tuple[str, str] = ("LAT", "LON"),
    name: str = "cluster_capital",
    digits: int = 9,
) -> DataFrame:
    """Single linkage on the distance to one point, exact: cut at the ``k - 1`` widest gaps.

    Distances are compared at ``digits`` decimals; equal gaps are taken from the near side first.
    Groups are numbered 0.. from the reference outwards. The gaps are found per chunk of the
    distance order, so the number of sites does not matter.
    """
    distance = F.round(numeric.euclidean([F.col(key) for key in keys], [F.lit(v) for v in ref]), digits)
    placed = sites.withColumn("__distance", distance)
    w = Window.partitionBy("chunk").orderBy("row")
    steps = ordered_chunks(placed.where("__distance is not null").select("__distance").distinct(), ["__distance"], 1)
    gaps = steps.withColumn("gap", F.round(F.col("__distance") - F.lag("__distance").over(w), digits))
    widest = (
        gaps.where(~F.col("border") & F.col("gap").isNotNull())
        .orderBy(F.col("gap").desc(), F.col("__distance"))
        .limit(k - 1)
        .collect()
    )
    ring = F.lit(0)
    for cut in sorted(row["__distance"] for row in widest):
        ring = ring + (F.col("__distance") >= F.lit(cut)).cast("int")
    return placed.withColumn(name, ring).drop("__distance")


def site_map_table(df: DataFrame) -> DataFrame:
    """Per-site mean outcome with coordinates, ready to plot."""
    return site_mean(df)
