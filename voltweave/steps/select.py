"""Steps that drop columns or rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from voltweave.steps.base import FeatureStep, columns_of, resolve


class RemoveMatching(FeatureStep):
    """Drop the columns the selectors find when the step is reached."""

    @staticmethod
    def learn(df: DataFrame, config: dict, roles) -> dict:
        return {"drop": columns_of(config, df, roles)}

    @staticmethod
    def apply(df: DataFrame, config: dict, state: dict) -> DataFrame:
        return df.drop(*state["drop"])


class SelectStep(FeatureStep):
    """Keep only the chosen columns."""

    @staticmethod
    def learn(df: DataFrame, config: dict, roles) -> dict:
        return {"keep": resolve(config["cols"], df, roles)}

    @staticmethod
    def apply(df: DataFrame, config: dict, state: dict) -> DataFrame:
        return df.select(*[name for name in state["keep"] if name in df.columns])


class FilterRows(FeatureStep):
    """Keep rows for which a SQL condition holds; by default only while fitting."""

    def __init__(self, condition: str = "true", skip: bool = True):
        super().__init__(condition=condition, skip=skip)

    @staticmethod
    def apply(df: DataFrame, config: dict, state: dict) -> DataFrame:
        return df.where(config["condition"])
