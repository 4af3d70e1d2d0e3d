"""Model specifications and workflows (a feature specification with a model)."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltweave.operators.columns import numeric_columns
from voltweave.operators.sampling import SEED, row_hash
from voltweave.sources.staging import stage
from voltweave.steps.spec import FeatureSpec, FittedFeatures

MISSING = "1e300D"  # what trees see for a null
TASK_ROWS = 1 << 18  # training rows of trees in a task, at most about
TUNE = "tune"  # placeholder for a setting that a search fills in


@dataclass(frozen=True)
class ModelSpec:
    """``kind`` is ``linear`` or ``boosted``; a setting may be the ``TUNE`` placeholder."""

    kind: str
    settings: dict = field(default_factory=dict)

    def tuned_settings(self) -> list[str]:
        return [name for name, value in self.settings.items() if value == TUNE]

    def with_settings(self, **settings) -> ModelSpec:
        return replace(self, settings={**self.settings, **settings})

    def estimator(self, n_predictors: int):
        if self.tuned_settings():
            raise ValueError(f"settings still to be tuned: {self.tuned_settings()}")
        common = {"featuresCol": "__features", "labelCol": "__label", "predictionCol": "pred"}
        s = self.settings
        if self.kind == "linear":
            return LinearRegression(
                regParam=float(s.get("penalty", 0.0)), elasticNetParam=float(s.get("mixture", 0.0)),
                maxIter=int(s.get("max_iter", 200)), tol=1e-9, standardization=True, **common,
            )
        mtry = s.get("mtry")
        return GBTRegressor(
            maxIter=int(s.get("trees", 15)),
            maxDepth=int(s.get("tree_depth", 6)),
            stepSize=float(s.get("learn_rate", 0.3)),
            minInstancesPerNode=int(s.get("min_n", 1)),
            minInfoGain=float(s.get("loss_reduction", 0.0)),
            subsamplingRate=float(s.get("sample_size", 1.0)),
            featureSubsetStrategy="all" if mtry is None else str(min(int(mtry), n_predictors)),
            maxBins=int(s.get("max_bins", 64)), maxMemoryInMB=int(s.get("memory_mb", 256)), seed=SEED,
            cacheNodeIds=True, **common,
        )


def stop_round(errors: list[float], patience: int) -> int:
    """Number of rounds to keep: the first best one, once ``patience`` rounds after it brought nothing lower."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def linear() -> ModelSpec:
    """Least squares."""
    return ModelSpec("linear")


def lasso(penalty: float | str = TUNE) -> ModelSpec:
    return ModelSpec("linear", {"penalty": penalty, "mixture": 1.0})


def ridge(penalty: float | str = TUNE) -> ModelSpec:
    return ModelSpec("linear", {"penalty": penalty, "mixture": 0.0})


def elastic(penalty: float | str = TUNE, mixture: float | str = TUNE) -> ModelSpec:
    return ModelSpec("linear", {"penalty": penalty, "mixture": mixture})


def boosted_trees(**settings) -> ModelSpec:
    """Gradient-boosted trees: ``trees, tree_depth, learn_rate, min_n, mtry, loss_reduction,
    sample_size``. With ``stop_after``, a tenth of the rows is held out and the trees end at the best round
    that is followed by that many rounds without a lower error on them."""
    return ModelSpec("boosted", settings)


def boosted_tune() -> ModelSpec:
    return boosted_trees(**dict.fromkeys(
        ["mtry", "trees", "min_n", "tree_depth", "learn_rate", "loss_reduction", "sample_size"], TUNE
    ))


@dataclass(frozen=True)
class Workflow:
    features: FeatureSpec
    model: ModelSpec
    key: str = "ID"

    def with_settings(self, **settings) -> Workflow:
        """Distribute tuned settings between the feature steps and the model."""
        mine = {name: value for name, value in settings.items() if name in self.features.tuned_settings()}
        rest = {name: value for name, value in settings.items() if name not in mine}
        return replace(
            self, features=self.features.with_step_settings(**mine), model=self.model.with_settings(**rest)
        )

    def tuned_settings(self) -> list[str]:
        return self.features.tuned_settings() + self.model.tuned_settings()

    def fit(self, df: DataFrame) -> FittedWorkflow:
        features = self.features.fit(df)
        numbers = set(numeric_columns(features.training_result))
        kinds = dict(features.training_result.dtypes)
        text = [name for name in features.predictors if kinds[name] == "string"]
        if text:
            raise ValueError(f"text predictors, encode or drop them: {text}")
        predictors = [name for name in features.predictors if name in numbers]
        fitted = FittedWorkflow(self, features, None, tuple(predictors))
        rows = fitted.assemble(features.training_result).where(F.col("__label").isNotNull())
        if self.model.kind == "linear":
            rows = rows.where(~F.col("__incomplete"))  # least squares needs complete rows
        estimator = self.model.estimator(len(predictors))
        if self.model.kind == "linear":
            return replace(fitted, model=estimator.fit(rows))
        held = F.pmod(row_hash(F.col(self.key)), F.lit(10)) == 0
        # Every round of the trees reads the rows again: stored once, with nothing but what it needs.
        rows = stage(rows.select("__features", "__label", held.alias("__held")), "training")
        patience = self.model.settings.get("stop_after")
        held_rows = rows.where("__held")
        # Trees keep their rows unpacked in memory, so partitions are cut by rows, not by the size of packed files.
        parts = -(-rows.count() // TASK_ROWS)
        if parts > rows.rdd.getNumPartitions():
            rows = rows.repartition(parts)
        if patience is None or held_rows.isEmpty():
            return replace(fitted, model=estimator.fit(rows))
        whole = estimator.fit(rows.where("not __held"))
        best = stop_round(whole.evaluateEachIteration(held_rows, "squared"), int(patience))
        if best < whole.getNumTrees:
            whole = estimator.setMaxIter(best).fit(rows.where("not __held"))
        return replace(fitted, model=whole)


@dataclass(frozen=True)
class FittedWorkflow:
    workflow: Workflow
    features: FittedFeatures
    model: Model | None
    predictors: tuple[str, ...]

    def assemble(self, df: DataFrame) -> DataFrame:
        """Predictors as one vector.

        Trees see a null as a number above every real value, so a split can set nulls apart.
        Linear models do not use incomplete rows; zero is only a placeholder there.
        """
        names = list(self.predictors)
        stand_in = "0D" if self.workflow.model.kind == "linear" else MISSING
        missing = " OR ".join(f"`{name}` IS NULL" for name in names)
        outcome = self.workflow.features.outcome
        label = f"double(`{outcome}`)" if outcome in df.columns else "cast(NULL AS double)"
        filled = [f"coalesce(double(`{name}`), {stand_in}) AS __x{i}" for i, name in enumerate(names)]
        extended = df.selectExpr("*", f"({missing}) AS __incomplete", f"{label} AS __label", *filled)
        inputs = [f"__x{i}" for i in range(len(names))]
        return VectorAssembler(inputCols=inputs, outputCol="__features").transform(extended).drop(*inputs)

    def predict(self, df: DataFrame, keep: tuple[str, ...] | None = None) -> DataFrame:
        """Score rows: key, outcome when present, and ``pred``."""
        outcome = self.workflow.features.outcome
        keep = keep or tuple(c for c in (self.workflow.key, outcome) if c in df.columns)
        rows = self.assemble(self.features.transform(df))
        scored = self.model.transform(rows)
        pred = F.col("pred")
        if self.workflow.model.kind == "linear":
            pred = F.when(~F.col("__incomplete"), pred)
        return scored.select(*keep, pred.alias("pred"))


def feature_importance(fitted: FittedWorkflow) -> DataFrame:
    """Predictors ranked by importance (one row per predictor, from the model itself)."""
    spark = fitted.features.training_result.sparkSession
    values = fitted.model.featureImportances.toArray()
    rows = sorted(zip(fitted.predictors, values.tolist()), key=lambda row: (-row[1], row[0]))
    return spark.createDataFrame(
        [(i + 1, name, float(value)) for i, (name, value) in enumerate(rows)],
        "rank int, feature string, importance double",
    )
