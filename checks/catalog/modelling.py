"""Models, resampling, tuning and final predictions.

Least squares on one predictor has an SQL form, so those queries check the whole way through
folds, splits and submissions exactly. Trees and searches are checked by their properties in tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import rounded, table, test, train
from voltweave.models import evaluate, specs, tune
from voltweave.models.resample import cv_train_eval, cv_train_predict, fit_resamples, last_fit, resample_metrics, workflow_set
from voltweave.models.specs import Workflow
from voltweave.operators.sampling import initial_split, kfold, vfold
from voltweave.plans import recipes
from voltweave.steps import FeatureSpec

SMALL_TREES = {"trees": 5, "tree_depth": 4}


def line_spec(df, outcome: str = "POWER") -> FeatureSpec:
    return FeatureSpec.on(df, outcome).role("id variable", "ID")


def lines(spark, sf_dir):
    """Order lines as rows to regress: extended price on quantity."""
    return table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity")),
        F.col("o_orderkey") == F.col("l_orderkey"),
    ).select(F.col("o_orderkey").alias("ID"), "quantity", (F.col("o_totalprice") / 1000).alias("POWER"))


LINES_SQL = """lines AS (SELECT o_orderkey AS ID, quantity, o_totalprice / 1000 AS POWER FROM orders JOIN (
  SELECT l_orderkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey)"""


@query("n1_linear", f"""WITH {LINES_SQL} SELECT ID, round(POWER + 1e-9, 6) AS POWER,
  round(regr_intercept(POWER, quantity) OVER () + regr_slope(POWER, quantity) OVER () * quantity + 1e-7, 4) AS pred FROM lines""")
def n1(spark, sf_dir):
    rows = lines(spark, sf_dir)
    scored = Workflow(line_spec(rows), specs.linear()).fit(rows).predict(rows)
    return scored.selectExpr("ID", "round(POWER + 1e-9D, 6) AS POWER", "round(pred + 1e-7D, 4) AS pred")


PENALTY = 0.5


def penalised_sql(kind: str) -> str:
    """Closed form for one predictor when both columns are standardised with their population sd,
    as the penalised least squares solver does."""
    shrink = {
        "lasso": f"sign(r) * greatest(abs(r) - {PENALTY} / sy, 0)",
        "ridge": f"r / (1 + {PENALTY} / sy)",
    }[kind]
    return f"""WITH {LINES_SQL}, s AS (SELECT avg(quantity) AS mx, avg(POWER) AS my,
  stddev_pop(quantity) AS sx, stddev_pop(POWER) AS sy, corr(POWER, quantity) AS r FROM lines)
SELECT ID, round(my + ({shrink}) * sy / sx * (quantity - mx) + 1e-7, 3) AS pred FROM lines, s"""


@query("n2_lasso", penalised_sql("lasso"))
def n2_lasso(spark, sf_dir):
    rows = lines(spark, sf_dir)
    scored = Workflow(line_spec(rows), specs.lasso(PENALTY)).fit(rows).predict(rows)
    return scored.selectExpr("ID", "round(pred + 1e-7D, 3) AS pred")


@query("n2_ridge", penalised_sql("ridge"))
def n2_ridge(spark, sf_dir):
    rows = lines(spark, sf_dir)
    scored = Workflow(line_spec(rows), specs.ridge(PENALTY)).fit(rows).predict(rows)
    return scored.selectExpr("ID", "round(pred + 1e-7D, 3) AS pred")


@query("n2_elastic")
def n2_elastic(spark, sf_dir):
    rows = train(spark, sf_dir)
    return Workflow(recipes.recipe("rec_base", rows), specs.elastic(0.1, 0.5)).fit(rows).predict(test(spark, sf_dir))


@query("n3_boosted_trees")
def n3(spark, sf_dir):
    rows = train(spark, sf_dir)
    fitted = Workflow(recipes.recipe("rec_base", rows), specs.boosted_trees(**SMALL_TREES)).fit(rows)
    return fitted.predict(rows)


@query("n3_boosted_trees_early_stop")
def n3_stop(spark, sf_dir):
    rows = train(spark, sf_dir)
    model = specs.boosted_trees(trees=12, tree_depth=4, learn_rate=1.0, stop_after=2)
    return Workflow(recipes.recipe("rec_base", rows), model).fit(rows).predict(test(spark, sf_dir))


@query("n4_predict", f"""WITH {LINES_SQL}, m AS (SELECT regr_intercept(POWER, quantity) AS a, regr_slope(POWER, quantity) AS b
  FROM lines WHERE ID % 4 <> 0) SELECT ID, round(a + b * quantity + 1e-7, 4) AS pred FROM lines, m WHERE ID % 4 = 0""")
def n4(spark, sf_dir):
    rows = lines(spark, sf_dir)
    fitted = Workflow(line_spec(rows), specs.linear()).fit(rows.where("ID % 4 <> 0"))
    return fitted.predict(rows.where("ID % 4 = 0").drop("POWER")).selectExpr("ID", "round(pred + 1e-7D, 4) AS pred")


FOLDED_SQL = f"""{LINES_SQL}, folded AS (SELECT *, ID % 5 AS fold FROM lines),
oof AS (SELECT f.ID, f.fold, f.POWER, a + b * f.quantity AS pred FROM folded f JOIN (
  SELECT k.fold, regr_intercept(POWER, quantity) AS a, regr_slope(POWER, quantity) AS b
  FROM (SELECT DISTINCT fold FROM folded) k JOIN folded r ON r.fold <> k.fold GROUP BY k.fold) m ON f.fold = m.fold)"""


@query("n6_fit_resamples", f"""WITH {FOLDED_SQL}, e AS (
  SELECT fold, sqrt(avg((POWER - pred) ** 2)) AS rmse, avg(abs(POWER - pred)) AS mae FROM oof GROUP BY fold)
SELECT 'line' AS wflow_id, metric, round(avg(value) + 1e-7, 4) AS mean, count(*) AS n, round(stddev_samp(value) / sqrt(count(*)) + 1e-7, 4) AS std_err
FROM e UNPIVOT (value FOR metric IN (rmse, mae)) GROUP BY metric""")
def n6(spark, sf_dir):
    rows = lines(spark, sf_dir).withColumn("fold", F.expr("int(ID % 5)"))
    oof = fit_resamples({"line": Workflow(line_spec(rows.drop("fold")), specs.linear())}, rows)
    return rounded(resample_metrics(oof, ["rmse", "mae"]), 4, nudge=1e-7)


@query("n7_workflow_set")
def n7(spark, sf_dir):
    rows = vfold(train(spark, sf_dir), 3)
    plain = rows.drop("fold")
    flows = workflow_set(
        {name: recipes.recipe(name, plain) for name in ("rec_base", "rec_base_v2_scaling")},
        {"lm": specs.linear(), "trees": specs.boosted_trees(trees=3, tree_depth=3)},
    )
    return resample_metrics(fit_resamples(flows, rows), ["rmse", "mae", "mape"])


@query("n8_tune_grid")
def n8(spark, sf_dir):
    rows = vfold(train(spark, sf_dir), 3)
    flow = Workflow(recipes.recipe("rec_base", rows.drop("fold")), specs.ridge())
    grid = tune.grid_regular(tune.param_ranges(flow), 4)
    return tune.tune_grid(flow, rows, grid, ("rmse", "mae"))


@query("n9_tune_search")
def n9(spark, sf_dir):
    rows = vfold(train(spark, sf_dir), 3)
    flow = Workflow(recipes.recipe("rec_base", rows.drop("fold")), specs.elastic())
    history, _ = tune.tune_search(flow, rows, tune.param_ranges(flow), initial=4, iterations=3, no_improve=2)
    return history


@query("n10_param_ranges")
def n10(spark, sf_dir):
    rows = train(spark, sf_dir)
    ranges = tune.param_ranges(Workflow(recipes.recipe("rec_v1", rows), specs.boosted_tune()), rows)
    return spark.createDataFrame(
        [(name, float(axis.at(0.0)), float(axis.at(1.0)), axis.whole) for name, axis in ranges.items()],
        "setting string, low double, high double, whole boolean")


SPLIT_SQL = """hashed AS (SELECT *, CAST('0x' || substr(md5('54147:' || ID), 1, 13) AS BIGINT) AS h FROM lines),
split AS (SELECT *, h <= (SELECT quantile_cont(h::DOUBLE, 0.75) FROM hashed) AS is_train FROM hashed),
m AS (SELECT regr_intercept(POWER, quantity) AS a, regr_slope(POWER, quantity) AS b FROM split WHERE is_train)"""


@query("n12_last_fit", f"""WITH {LINES_SQL}, {SPLIT_SQL}
SELECT ID, round(POWER + 1e-9, 6) AS POWER, round(a + b * quantity + 1e-7, 4) AS pred FROM split, m WHERE NOT is_train""")
def n12(spark, sf_dir):
    rows = lines(spark, sf_dir)
    _, scored, _ = last_fit(Workflow(line_spec(rows), specs.linear()), initial_split(rows, by=None))
    return scored.selectExpr("ID", "round(POWER + 1e-9D, 6) AS POWER", "round(pred + 1e-7D, 4) AS pred")


@query("n13_fit_all_and_submit", f"""WITH {LINES_SQL}, m AS (
  SELECT regr_intercept(POWER, quantity) AS a, regr_slope(POWER, quantity) AS b FROM lines WHERE ID % 4 <> 0)
SELECT ID, round(a + b * quantity + 1e-7, 4) AS POWER FROM lines, m WHERE ID % 4 = 0""")
def n13(spark, sf_dir):
    rows = lines(spark, sf_dir)
    training, scoring = rows.where("ID % 4 <> 0"), rows.where("ID % 4 = 0").drop("POWER")
    template = scoring.select("ID", F.lit(0.0).alias("POWER"))
    _, result, _ = tune.fit_all_and_submit(
        Workflow(line_spec(rows), specs.linear()), initial_split(training, by=None), training, scoring, template)
    return result.selectExpr("ID", "round(POWER + 1e-7D, 4) AS POWER")


@query("n13_holdout_metrics", f"""WITH {LINES_SQL}, {SPLIT_SQL}, e AS (
  SELECT sqrt(avg((POWER - pred) ** 2)) AS rmse, avg(abs(POWER - pred)) AS mae, corr(POWER, pred) ** 2 AS rsq
  FROM (SELECT POWER, a + b * quantity AS pred FROM split, m WHERE NOT is_train))
SELECT metric, round(value + 1e-7, 4) AS value FROM e UNPIVOT (value FOR metric IN (rmse, mae, rsq))""")
def n13_holdout(spark, sf_dir):
    rows = lines(spark, sf_dir)
    _, scored, _ = last_fit(Workflow(line_spec(rows), specs.linear()), initial_split(rows, by=None))
    return rounded(evaluate.metrics(scored, ["rmse", "mae", "rsq"]), 4, nudge=1e-7)


def _predicted(scores, predictions):
    """Predictions of the test rows beside mean and deviation of the fold scores."""
    found = scores.select("mean", "std").first()
    return predictions.withColumns({"mean": F.lit(found["mean"]), "std": F.lit(found["std"])})


@query("n14_cv_train_eval")
def n14(spark, sf_dir):
    """Five folds at the reference's depth, all rows fitted again, the test rows predicted; few trees."""
    rows = kfold(train(spark, sf_dir), 5)
    flow = Workflow(recipes.recipe("rec_base", rows.drop("fold")), specs.boosted_trees(trees=2, tree_depth=8))
    return _predicted(*cv_train_predict(flow, rows, test(spark, sf_dir)))


@query("n14_cv_train_predict", f"""WITH {FOLDED_SQL}, e AS (SELECT fold, sqrt(avg((POWER - pred) ** 2)) AS rmse FROM oof WHERE ID % 4 <> 0 GROUP BY fold),
 m AS (SELECT regr_intercept(POWER, quantity) AS a, regr_slope(POWER, quantity) AS b FROM lines WHERE ID % 4 <> 0)
SELECT ID, round(a + b * quantity + 1e-7, 4) AS pred, round((SELECT avg(rmse) FROM e) + 1e-7, 4) AS mean,
       round((SELECT stddev_pop(rmse) FROM e) + 1e-7, 4) AS std FROM lines, m WHERE ID % 4 = 0""".replace(
    "folded AS (SELECT *, ID % 5 AS fold FROM lines)", "folded AS (SELECT *, ID % 5 AS fold FROM lines WHERE ID % 4 <> 0)"))
def n14_predict(spark, sf_dir):
    rows = lines(spark, sf_dir)
    learning = rows.where("ID % 4 <> 0").withColumn("fold", F.expr("int(ID % 5)"))
    made = cv_train_predict(Workflow(line_spec(rows), specs.linear()), learning, rows.where("ID % 4 = 0").drop("POWER"))
    return rounded(_predicted(*made), 4, nudge=1e-7)


@query("n14_cv_scores", f"""WITH {FOLDED_SQL}, e AS (SELECT fold, sqrt(avg((POWER - pred) ** 2)) AS rmse FROM oof GROUP BY fold)
SELECT CAST(fold AS INTEGER) AS fold, round(rmse + 1e-7, 4) AS rmse, round(avg(rmse) OVER () + 1e-7, 4) AS mean,
       round(stddev_pop(rmse) OVER () + 1e-7, 4) AS std FROM e""")
def n14_scores(spark, sf_dir):
    rows = lines(spark, sf_dir).withColumn("fold", F.expr("int(ID % 5)"))
    return rounded(cv_train_eval(Workflow(line_spec(rows.drop("fold")), specs.linear()), rows), 4, nudge=1e-7)


@query("n15_feature_importance")
def n15(spark, sf_dir):
    rows = train(spark, sf_dir)
    return specs.feature_importance(
        Workflow(recipes.recipe("rec_base", rows), specs.boosted_trees(**SMALL_TREES)).fit(rows))
