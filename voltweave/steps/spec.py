"""Feature specifications: column roles, ordered steps, and fitting them.

Roles are assigned against the columns known when ``role`` is called: a pattern does not reach
columns that a step creates later. Steps resolve their selectors when they are fitted. Columns made
by a step are predictors.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from voltweave.operators.columns import matching
from voltweave.steps.base import FeatureStep, FittedStep, Selector


@dataclass(frozen=True)
class FeatureSpec:
    columns: tuple[str, ...]
    outcome: str = "POWER"
    roles: dict[str, str] = field(default_factory=dict)
    steps: tuple[FeatureStep, ...] = ()

    @classmethod
    def on(cls, df: DataFrame, outcome: str = "POWER") -> FeatureSpec:
        roles = {name: "outcome" if name == outcome else "predictor" for name in df.columns}
        return cls(tuple(df.columns), outcome, roles)

    def role(self, role: str, *selectors: Selector) -> FeatureSpec:
        """Give a role to columns by name or pattern, now; the last assignment wins."""
        roles = dict(self.roles)
        for selector in selectors:
            if isinstance(selector, str):
                if selector not in self.columns:
                    raise ValueError(f"no column {selector!r}")
                roles[selector] = role
            else:
                roles.update(dict.fromkeys(matching(self.columns, selector["regex"]), role))
        return replace(self, roles=roles)

    def step(self, *steps: FeatureStep) -> FeatureSpec:
        return replace(self, steps=self.steps + steps)

    def with_step_settings(self, **settings) -> FeatureSpec:
        """Fill in tuned settings: ``df`` of the spline step, for instance."""
        steps = []
        for step in self.steps:
            config = step.settings()
            known = {key: value for key, value in settings.items() if config.get(key, False) is None}
            steps.append(type(step)(**{**config, **known}) if known else step)
        return replace(self, steps=tuple(steps))

    def tuned_settings(self) -> list[str]:
        return [key for step in self.steps for key, value in step.settings().items() if value is None]

    def fit(self, df: DataFrame) -> FittedFeatures:
        roles = dict(self.roles)
        stages: list[FittedStep] = []
        current = df
        for step in self.steps:
            fitted = step.fit_with_roles(current, roles)
            stages.append(fitted)
            current = fitted.transform(current)
            roles = {name: roles.get(name, "predictor") for name in current.columns}
        return FittedFeatures(self, tuple(stages), roles, current)


@dataclass(frozen=True)
class FittedFeatures:
    """Learned stages plus the final roles. ``training_result`` is the transformed training table."""

    spec: FeatureSpec
    stages: tuple[FittedStep, ...]
    roles: dict[str, str]
    training_result: DataFrame

    @property
    def predictors(self) -> list[str]:
        """Numeric and categorical predictor columns, in table order."""
        return [name for name in self.training_result.columns if self.roles[name] == "predictor"]

    def model(self, training: bool = False) -> PipelineModel:
        """The stages as one ``PipelineModel``; row filters only belong to the training one."""
        return PipelineModel([stage for stage in self.stages if training or not stage.skip])

    def transform(self, df: DataFrame, training: bool = False) -> DataFrame:
        for stage in self.stages:
            if training or not stage.skip:
                df = stage.transform(df)
        return df
