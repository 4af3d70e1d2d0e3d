"""Learned transforms as ``pyspark.ml`` stages, and the role-aware feature specification."""

from voltweave.steps.base import FeatureStep, FittedStep
from voltweave.steps.encode import DateFeatures, DummyEncode, IntegerEncode, LevelOrder, Mutate
from voltweave.steps.numeric import (
    CorrelationFilter,
    ImputeMedian,
    LogOutcome,
    LogShift,
    Normalise,
    Scale,
    YeoJohnson,
)
from voltweave.steps.select import FilterRows, RemoveMatching, SelectStep
from voltweave.steps.spatial import GeodesicDistance, GeoDistance
from voltweave.steps.spec import FeatureSpec, FittedFeatures
from voltweave.steps.spline import NaturalSpline, PeriodicSpline

__all__ = [
    "CorrelationFilter", "DateFeatures", "DummyEncode", "FeatureSpec", "FeatureStep", "FilterRows",
    "FittedFeatures", "FittedStep", "GeoDistance", "GeodesicDistance", "ImputeMedian", "IntegerEncode",
    "LevelOrder", "LogOutcome", "LogShift", "Mutate", "NaturalSpline", "Normalise", "PeriodicSpline",
    "RemoveMatching", "Scale", "SelectStep", "YeoJohnson",
]
