"""Distance features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltweave.functions.geodesic import geodesic
from voltweave.functions.numeric import haversine
from voltweave.operators.joins import join_site
from voltweave.sources.staging import stage
from voltweave.steps.base import FeatureStep


class GeoDistance(FeatureStep):
    """Great-circle distance in metres to a fixed point."""

    @staticmethod
    def apply(df: DataFrame, config: dict, state: dict) -> DataFrame:
        lat, lon = F.col(config.get("lat", "LAT")), F.col(config.get("lon", "LON"))
        return df.withColumn(config["name"], haversine(lat, lon, config["ref_lat"], config["ref_lon"]))


class GeodesicDistance(FeatureStep):
    """Ellipsoidal distance in metres to a fixed point, optionally as log10.

    Computed once per distinct position and joined back, because the iteration runs in Python.
    """

    @staticmethod
    def apply(df: DataFrame, config: dict, state: dict) -> DataFrame:
        lat, lon = config.get("lat", "LAT"), config.get("lon", "LON")
        value = geodesic(F.col(lat), F.col(lon), config["ref_lat"], config["ref_lon"])
        value = F.log10(value) if config.get("log10", False) else value
        places = stage(df.select(lat, lon).distinct().withColumn(config["name"], value), "distances")
        return join_site(df, places, (lat, lon))
