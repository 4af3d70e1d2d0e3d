"""Summaries, chart tables, splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import predictions, readings, rounded, table, train, with_predictions, with_readings
from voltweave.models import evaluate
from voltweave.operators import quantiles, sampling, stats

V = [f"V_{i}" for i in range(1, 14)]
NUMBERS = [*V, "POWER"]


def rows_sql(cols: list[str], template: str) -> str:
    """One SELECT per column, stacked."""
    return " UNION ALL ".join(template.format(c=c) for c in cols)


@query("e9_describe", with_readings(rows_sql(NUMBERS, """
SELECT '{c}' AS variable, count({c}) AS count, round(avg({c}) + 1e-9, 6) AS mean, round(stddev_samp({c}) + 1e-9, 6) AS std,
       round(min({c}) + 1e-9, 6) AS min, round(max({c}) + 1e-9, 6) AS max, round(quantile_cont({c}, 0.25) + 1e-9, 6) AS q25,
       round(quantile_cont({c}, 0.5) + 1e-9, 6) AS q50, round(quantile_cont({c}, 0.75) + 1e-9, 6) AS q75 FROM train""")))
def e9(spark, sf_dir):
    return rounded(stats.describe(train(spark, sf_dir), NUMBERS))


PROFILED = NUMBERS
TEXTS = ["SOT", "dataset"]
HIST = "[" + ", ".join(
    f"count(*) FILTER ({{c}} IS NOT NULL AND least(floor(({{c}} - lo) / (CASE WHEN hi > lo THEN (hi - lo) / 8 ELSE 1 END)), 7) = {b})" for b in range(8)) + "]"


@query("e10_profile", with_readings(rows_sql(PROFILED, """
SELECT '{c}' AS variable, 'numeric' AS kind, count(*) - count({c}) AS n_missing, round(count({c}) / count(*) + 1e-9, 6) AS complete_rate,
       round(avg({c}) + 1e-9, 6) AS mean, round(stddev_samp({c}) + 1e-9, 6) AS sd, round(min({c}) + 1e-9, 6) AS p0, round(max({c}) + 1e-9, 6) AS p100,
       NULL::BIGINT AS min_length, NULL::BIGINT AS max_length, NULL::BIGINT AS empty, NULL::BIGINT AS whitespace,
       round(quantile_cont({c}, 0.25) + 1e-9, 6) AS q25, round(quantile_cont({c}, 0.5) + 1e-9, 6) AS q50,
       round(quantile_cont({c}, 0.75) + 1e-9, 6) AS q75, NULL::BIGINT AS n_unique, array_to_string(""" + HIST + """, ',') AS hist
FROM (SELECT *, min({c}) OVER () AS lo, max({c}) OVER () AS hi FROM readings)""") + " UNION ALL " + rows_sql(TEXTS, """
SELECT '{c}', 'character', count(*) - count({c}), round(count({c}) / count(*) + 1e-9, 6), NULL, NULL, NULL, NULL,
       min(length({c})), max(length({c})), count(*) FILTER ({c} = ''), count(*) FILTER (regexp_matches({c}, '^\\s+$')),
       NULL, NULL, NULL, count(DISTINCT {c}), NULL FROM readings""")))
def e10(spark, sf_dir):
    made = stats.profile(readings(spark, sf_dir).select(*PROFILED, *TEXTS))
    return rounded(made.withColumn("hist", F.expr("array_join(cast(hist AS array<string>), ',')")))


@query("e10_profile_texts", rows_sql(["lang", "source", "text"], """
SELECT '{c}' AS variable, 'character' AS kind, count(*) - count({c}) AS n_missing, round(count({c}) / count(*) + 1e-9, 6) AS complete_rate,
       NULL::DOUBLE AS mean, NULL::DOUBLE AS sd, NULL::DOUBLE AS p0, NULL::DOUBLE AS p100, min(length({c})) AS min_length,
       max(length({c})) AS max_length, count(*) FILTER ({c} = '') AS empty, count(*) FILTER (regexp_full_match({c}, '\\s+')) AS whitespace,
       count(DISTINCT {c}) AS n_unique FROM documents"""))
def e10_texts(spark, sf_dir):
    return rounded(stats.profile(table(spark, sf_dir, "documents").select("lang", "source", "text")))


@query("e2_grouped_quantiles", """
SELECT event_type, round(quantile_cont(value, 0.05) + 1e-9, 6) AS value_p5, round(quantile_cont(value, 0.5) + 1e-9, 6) AS value_p50,
       round(quantile_cont(value, 0.99) + 1e-9, 6) AS value_p99 FROM events GROUP BY event_type""")
def e2_quantiles(spark, sf_dir):
    # accuracy 200 makes groups above 1,000 rows take the bracketed way
    made = quantiles.quantiles(table(spark, sf_dir, "events"), ["value"], {"p5": 0.05, "p50": 0.5, "p99": 0.99},
                               ["event_type"], accuracy=200)
    return rounded(made)


PAIRED = NUMBERS


@query("l1_correlation_table", with_readings(" UNION ALL ".join(
    f"SELECT '{a}' AS Parameter1, '{b}' AS Parameter2, " + ("1.0::DOUBLE" if a == b else f"round(corr({a}, {b}) + 1e-9, 6)")
    + f" AS r, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n_Obs FROM readings" for a in PAIRED for b in PAIRED)))
def l1(spark, sf_dir):
    made = stats.correlation_table(readings(spark, sf_dir), PAIRED)
    return rounded(made.select("Parameter1", "Parameter2", "r", "n_Obs"))


@query("l1_correlation_p_values")
def l1_p(spark, sf_dir):
    return stats.correlation_table(readings(spark, sf_dir), NUMBERS)


def histogram_sql(source: str, col: str, by: str | None, bins: int = 30) -> str:
    key = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"""
SELECT {key}bin, round(lo + bin * w + 1e-9, 6) AS x_min, round(lo + (bin + 1) * w + 1e-9, 6) AS x_max, n,
       round(n / (sum(n) OVER ({part}) * w) + 1e-9, 6) AS density
FROM (SELECT {key}CAST(least(floor(({col} - lo) / w), {bins - 1}) AS INTEGER) AS bin, lo, w, count(*) AS n
      FROM {source}, (SELECT min({col}) AS lo, (max({col}) - min({col})) / {bins} AS w FROM {source})
      WHERE {col} IS NOT NULL GROUP BY ALL)"""


@query("l2_histogram", with_readings(histogram_sql("readings", "V_5", "dataset")))
def l2(spark, sf_dir):
    return rounded(stats.histogram(readings(spark, sf_dir, False), "V_5", 30, "dataset"))


@query("l2_histogram_events", histogram_sql("events", "value", "event_type"))
def l2_events(spark, sf_dir):
    return rounded(stats.histogram(table(spark, sf_dir, "events"), "value", 30, "event_type"))


@query("l3_density")
def l3(spark, sf_dir):
    return stats.density(readings(spark, sf_dir, False), "V_5", "dataset")


@query("l4_log_axis_histogram", with_readings(histogram_sql("shown", "V_5", "dataset"),
       "shown AS (SELECT dataset, log10(V_5) AS V_5 FROM readings WHERE V_5 > 0)"))
def l4(spark, sf_dir):
    return rounded(stats.histogram(stats.log_axis(readings(spark, sf_dir, False), "V_5"), "V_5", 30, "dataset"))


@query("l5_trend", with_readings("""
SELECT DATE, round(avg(POWER) + 1e-9, 6) AS mean, round(median(POWER) + 1e-9, 6) AS median FROM train GROUP BY DATE"""))
def l5(spark, sf_dir):
    return rounded(stats.trend(train(spark, sf_dir, False)))


@query("l6_scatter_all", with_readings("""
SELECT V_5, round(POWER + 1e-9, 6) AS POWER FROM train WHERE V_5 IS NOT NULL AND POWER IS NOT NULL"""))
def l6(spark, sf_dir):
    return rounded(sampling.scatter_sample(train(spark, sf_dir, False), "V_5"), keep=("V_5",))


HASH = "CAST('0x' || substr(md5('{seed}:' || ID), 1, 13) AS BIGINT)"


@query("l6_scatter_sample", with_readings(f"""
SELECT V_5, round(POWER + 1e-9, 6) AS POWER FROM train
WHERE V_5 IS NOT NULL AND POWER IS NOT NULL AND {HASH.format(seed=54147)} < 0.1 * 4503599627370496"""))
def l6_sample(spark, sf_dir):
    return rounded(sampling.scatter_sample(train(spark, sf_dir, False), "V_5", fraction=0.1), keep=("V_5",))


@query("l7_box_stats", """
SELECT event_type, round(q1 + 1e-9, 6) AS q1, round(m + 1e-9, 6) AS median, round(q3 + 1e-9, 6) AS q3,
       min(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
       max(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
       count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outside, count(*) AS n
FROM events JOIN (SELECT event_type, quantile_cont(value, 0.25) AS q1, median(value) AS m, quantile_cont(value, 0.75) AS q3
                  FROM events GROUP BY event_type) USING (event_type) GROUP BY event_type, q1, m, q3""")
def l7(spark, sf_dir):
    return rounded(stats.box_stats(table(spark, sf_dir, "events"), "value", "event_type"),
                   keep=("whisker_low", "whisker_high"))


@query("l8_category_share", """
SELECT event_type, user_group, n, round(n / sum(n) OVER (PARTITION BY event_type) + 1e-9, 6) AS share
FROM (SELECT event_type, user_id % 3 AS user_group, count(*) AS n FROM events GROUP BY ALL)""")
def l8(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("user_group", F.col("user_id") % 3)
    return rounded(stats.category_share(rows, "event_type", "user_group"))


@query("l9_qq_points")
def l9(spark, sf_dir):
    return stats.qq_points(stats.residuals(predictions(spark, sf_dir)), "residual")


@query("l10_residuals", with_predictions("SELECT ID, round(POWER + 1e-9, 6) AS POWER, round(pred - POWER + 1e-9, 6) AS residual FROM predictions"))
def l10(spark, sf_dir):
    return rounded(stats.residuals(predictions(spark, sf_dir)).select("ID", "POWER", "residual"))


@query("l11_pred_vs_truth", with_predictions("SELECT ID, round(POWER + 1e-9, 6) AS POWER, round(pred + 1e-9, 6) AS pred FROM predictions"))
def l11(spark, sf_dir):
    rows = predictions(spark, sf_dir)
    return rounded(stats.pred_vs_truth(rows.select("ID", "pred"), rows.select("ID", "POWER")))


@query("l11_pred_trend", with_predictions("""
SELECT DATE, round(avg(POWER) + 1e-9, 6) AS truth_mean, round(avg(pred) + 1e-9, 6) AS pred_mean FROM predictions GROUP BY DATE"""))
def l11_trend(spark, sf_dir):
    return rounded(stats.pred_trend(predictions(spark, sf_dir)))


METRICS_SQL = """scores AS (
  SELECT wflow_id, fold, metric, value FROM (
    SELECT wflow_id, fold, sqrt(avg((POWER - pred) ** 2)) AS rmse, avg(abs(POWER - pred)) AS mae,
           avg(abs((POWER - pred) / nullif(POWER, 0))) * 100 AS mape, avg((POWER - pred) / nullif(POWER, 0)) * 100 AS mpe,
           corr(POWER, pred) ** 2 AS rsq
    FROM predictions GROUP BY ALL) UNPIVOT (value FOR metric IN (rmse, mae, mape, mpe, rsq)))"""


@query("n5_metrics", with_predictions("SELECT wflow_id, fold, metric, round(value + 1e-9, 6) AS value FROM scores", METRICS_SQL))
def n5(spark, sf_dir):
    return rounded(evaluate.metrics(predictions(spark, sf_dir), by=["wflow_id", "fold"]))


@query("n6_collect_metrics", with_predictions("""
SELECT wflow_id, metric, round(avg(value) + 1e-9, 6) AS mean, count(*) AS n, round(stddev_samp(value) / sqrt(count(*)) + 1e-9, 6) AS std_err
FROM scores GROUP BY ALL""", METRICS_SQL))
def n6_collect(spark, sf_dir):
    return rounded(evaluate.collect_metrics(evaluate.metrics(predictions(spark, sf_dir), by=["wflow_id", "fold"])))


@query("l12_rank_plot_table", with_predictions("""
SELECT CAST(rank() OVER (ORDER BY mean, wflow_id) AS INTEGER) AS rank, wflow_id, round(mean + 1e-9, 6) AS mean, n,
       round(se + 1e-9, 6) AS std_err, round(mean - se + 1e-9, 6) AS low, round(mean + se + 1e-9, 6) AS high
FROM (SELECT wflow_id, avg(value) AS mean, count(*) AS n, stddev_samp(value) / sqrt(count(*)) AS se
      FROM scores WHERE metric = 'rmse' GROUP BY wflow_id)""", METRICS_SQL))
def l12(spark, sf_dir):
    return rounded(stats.rank_plot_table(evaluate.metrics(predictions(spark, sf_dir), by=["wflow_id", "fold"])))


@query("n11_select_best", with_predictions("""
SELECT wflow_id, round(mean + 1e-9, 6) AS mean FROM (SELECT wflow_id, avg(value) AS mean FROM scores WHERE metric = 'rmse' GROUP BY wflow_id)
ORDER BY mean, wflow_id LIMIT 1""", METRICS_SQL))
def n11(spark, sf_dir):
    collected = evaluate.collect_metrics(evaluate.metrics(predictions(spark, sf_dir), by=["wflow_id", "fold"]))
    return rounded(evaluate.select_best(collected, "rmse", ["wflow_id"]).select("wflow_id", "mean"))


@query("n16_compare_models", with_predictions("""
SELECT regexp_replace(model || '_' || wflow_id, '_wf_', ' / ') AS wflow_id, metric, round(avg(value) + 1e-9, 6) AS mean, count(*) AS n,
       round(stddev_samp(value) / sqrt(count(*)) + 1e-9, 6) AS std_err
FROM (SELECT *, 'first' AS model FROM scores UNION ALL SELECT *, 'second' FROM scores WHERE fold < 3)
WHERE metric = 'rmse' GROUP BY model, wflow_id, metric""", METRICS_SQL))
def n16(spark, sf_dir):
    scores = evaluate.metrics(predictions(spark, sf_dir), by=["wflow_id", "fold"])
    tables = {"first": evaluate.collect_metrics(scores), "second": evaluate.collect_metrics(scores.where("fold < 3"))}
    return rounded(evaluate.compare_models(tables, "rmse", {"_wf_": " / "}))


# --- M splits ------------------------------------------------------------------------------------

STRATA = """layered AS (
  SELECT *, CASE WHEN POWER IS NULL THEN 0 ELSE 1 + (POWER > c1)::INTEGER + (POWER > c2)::INTEGER + (POWER > c3)::INTEGER END AS stratum
  FROM train, (SELECT quantile_cont(POWER, 0.25) AS c1, quantile_cont(POWER, 0.5) AS c2, quantile_cont(POWER, 0.75) AS c3 FROM train))"""


@query("m1_strata", with_readings("SELECT ID, stratum FROM layered", STRATA))
def m1(spark, sf_dir):
    return sampling.strata(train(spark, sf_dir, False), "POWER").select("ID", "stratum")


@query("m1_strata_date", with_readings("""
SELECT ID, 1 + (d > c1)::INTEGER + (d > c2)::INTEGER + (d > c3)::INTEGER AS stratum
FROM days, (SELECT quantile_cont(d, 0.25) AS c1, quantile_cont(d, 0.5) AS c2, quantile_cont(d, 0.75) AS c3 FROM days)""",
    "days AS (SELECT ID, (DATE - DATE '1970-01-01')::DOUBLE AS d FROM train)"))
def m1_date(spark, sf_dir):
    return sampling.strata(train(spark, sf_dir, False), "DATE").select("ID", "stratum")


@query("m2_initial_split", with_readings(f"""
SELECT ID, (h <= quantile_cont(h::DOUBLE, 0.75) OVER (PARTITION BY stratum))::INTEGER AS is_train
FROM (SELECT *, {HASH.format(seed=54147)} AS h FROM layered)""", STRATA))
def m2(spark, sf_dir):
    return sampling.initial_split(train(spark, sf_dir, False)).select("ID", "is_train")


@query("m3_vfold", with_readings("SELECT ID, CAST(" + " + ".join(
    f"(h > c[{i}])::INTEGER" for i in range(1, 10)) + f""" AS INTEGER) AS fold
FROM (SELECT *, {HASH.format(seed=54147)} AS h FROM layered) JOIN (
  SELECT stratum, [{', '.join(f'quantile_cont(h::DOUBLE, {i / 10})' for i in range(1, 10))}] AS c
  FROM (SELECT *, {HASH.format(seed=54147)} AS h FROM layered) GROUP BY stratum) USING (stratum)""", STRATA))
def m3(spark, sf_dir):
    return sampling.vfold(train(spark, sf_dir, False)).select("ID", "fold")


@query("m3_vfold_by_hash", with_readings(f"SELECT ID, CAST({HASH.format(seed=54147)} % 10 AS INTEGER) AS fold FROM train"))
def m3_hash(spark, sf_dir):
    return sampling.vfold(train(spark, sf_dir, False), exact=False).select("ID", "fold")


@query("m4_kfold", with_readings("SELECT ID, CAST(" + " + ".join(f"(h > c{i})::INTEGER" for i in range(1, 5)) + f""" AS INTEGER) AS fold
FROM (SELECT ID, {HASH.format(seed=42)} AS h FROM train), (
  SELECT {', '.join(f'quantile_cont(h::DOUBLE, {i / 5}) AS c{i}' for i in range(1, 5))} FROM (SELECT {HASH.format(seed=42)} AS h FROM train))"""))
def m4(spark, sf_dir):
    return sampling.kfold(train(spark, sf_dir, False)).select("ID", "fold")
