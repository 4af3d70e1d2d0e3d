"""Base of the feature steps.

A step is a ``pyspark.ml`` estimator. ``learn`` computes a small state (statistics, level lists,
knots) from the data; ``apply`` is a lazy DataFrame transformation from that state. The fitted stage
keeps configuration and state as plain parameters, so it can be saved and put in a ``PipelineModel``.

Columns are chosen by selectors that are resolved when the step is fitted, against the columns and
roles that exist at that point: a name, or one of the ``sel`` functions below.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from voltweave.operators.columns import matching, numeric_columns

Selector = str | dict
STEPS: dict[str, type["FeatureStep"]] = {}


class sel:
    """Selectors, as plain dictionaries so that a step can be stored."""

    @staticmethod
    def regex(pattern: str) -> dict:
        return {"regex": pattern}

    @staticmethod
    def numeric_predictors() -> dict:
        return {"role": "predictor", "kind": "numeric"}

    @staticmethod
    def nominal_predictors() -> dict:
        return {"role": "predictor", "kind": "nominal"}

    @staticmethod
    def predictors() -> dict:
        return {"role": "predictor"}

    @staticmethod
    def outcomes() -> dict:
        return {"role": "outcome"}


def resolve(selectors: Iterable[Selector], df: DataFrame, roles: dict[str, str] | None = None) -> list[str]:
    """Column names in table order, each once. Unknown names are an error."""
    numbers = set(numeric_columns(df))
    chosen: set[str] = set()
    for selector in selectors:
        if isinstance(selector, str):
            if selector not in df.columns:
                raise ValueError(f"no column {selector!r}")
            chosen.add(selector)
        elif "regex" in selector:
            chosen.update(matching(df.columns, selector["regex"]))
        else:
            names = [c for c in df.columns if (roles or {}).get(c, "predictor") == selector["role"]]
            kind = selector.get("kind")
            if kind:
                texts = {c for c, t in df.dtypes if t == "string"}
                names = [c for c in names if c in (numbers if kind == "numeric" else texts)]
            chosen.update(names)
    return [name for name in df.columns if name in chosen]


class _Configured(Params):
    config = Param(Params._dummy(), "config", "settings of the step")

    def settings(self) -> dict:
        return self.getOrDefault("config")


class FittedStep(Model, _Configured, DefaultParamsReadable, DefaultParamsWritable):
    """A learned step: the name of its kind, its settings and its state."""

    kind = Param(Params._dummy(), "kind", "class name of the step")
    state = Param(Params._dummy(), "state", "what the step learned")

    def __init__(self, kind: str = "", config: dict | None = None, state: dict | None = None):
        super().__init__()
        self._set(kind=kind, config=config or {}, state=state or {})

    def learned(self) -> dict:
        return self.getOrDefault("state")

    @property
    def skip(self) -> bool:
        """True when the step only acts on training rows."""
        return self.settings().get("skip", False)

    def _transform(self, df: DataFrame) -> DataFrame:
        return STEPS[self.getOrDefault("kind")].apply(df, self.settings(), self.learned())


class FeatureStep(Estimator, _Configured, DefaultParamsReadable, DefaultParamsWritable):
    """Subclasses define ``learn(df, config, roles) -> state`` and ``apply(df, config, state)``."""

    def __init__(self, **config):
        super().__init__()
        self._set(config=config)

    def __init_subclass__(cls, **kwargs):
        super().__init_subclass__(**kwargs)
        STEPS[cls.__name__] = cls

    @staticmethod
    def learn(df: DataFrame, config: dict, roles: dict[str, str] | None) -> dict:
        return {}

    @staticmethod
    def apply(df: DataFrame, config: dict, state: dict) -> DataFrame:
        raise NotImplementedError

    def fit_with_roles(self, df: DataFrame, roles: dict[str, str] | None = None) -> FittedStep:
        config = self.settings()
        return FittedStep(type(self).__name__, config, self.learn(df, config, roles))

    def _fit(self, df: DataFrame) -> FittedStep:
        return self.fit_with_roles(df)


def columns_of(config: dict, df: DataFrame, roles: dict[str, str] | None) -> list[str]:
    return resolve(config["cols"], df, roles)
