"""Trees get their rows in partitions of a bounded number of rows."""

import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from voltweave.models import specs
from voltweave.steps import FeatureSpec


@pytest.mark.parametrize("settings", [{}, {"stop_after": 1}])
def test_rows_of_a_tree_task_are_bounded(spark, monkeypatch, settings):
    frame = spark.range(2000).select(F.col("id").alias("ID"), (F.col("id") % 17).cast("double").alias("x"),
                                     (F.col("id") % 17 * 2.0 + 1).alias("POWER")).coalesce(1)
    sizes = []
    fit = GBTRegressor.fit

    def counted(self, rows, *more):
        sizes.append(rows.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first())
        return fit(self, rows, *more)

    monkeypatch.setattr(specs, "TASK_ROWS", 250, raising=False)
    monkeypatch.setattr(GBTRegressor, "fit", counted)
    flow = specs.Workflow(FeatureSpec.on(frame).role("id variable", "ID"), specs.boosted_trees(trees=2, tree_depth=5, learn_rate=1.0, **settings))
    scored = flow.fit(frame).predict(frame)
    assert sizes and all(most <= 300 for most, _ in sizes) and all(1700 < total <= 2000 for _, total in sizes)
    assert scored.count() == 2000 and scored.where("abs(pred - POWER) > 0.01").isEmpty()
