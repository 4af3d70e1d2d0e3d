"""Aggregates, daily windows, panel windows and site grouping."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import (
    predictions, readings, rounded, single_link_sql, sites, test, train, ward_sql, with_predictions, with_readings,
)
from voltweave.functions import calendar
from voltweave.operators import aggregates, joins, order, spatial, user_aggregates, windows
from voltweave.sources import stage

V = [f"V_{i}" for i in range(1, 14)]
DAILY_SQL = "daily AS (SELECT DATE, avg(POWER) AS POWER_mean, avg(V_5) AS V_5_mean FROM train GROUP BY DATE)"


def daily(spark, sf_dir):
    return aggregates.daily_mean(train(spark, sf_dir, False), ["POWER", "V_5"])


# --- E aggregates --------------------------------------------------------------------------------

@query("e1_daily_mean", with_readings(
    "SELECT DATE, " + ", ".join(f"round(avg({c}) + 1e-9, 6) AS {c}_mean" for c in [*V, "POWER"]) + " FROM train GROUP BY DATE"))
def e1(spark, sf_dir):
    return rounded(aggregates.daily_mean(train(spark, sf_dir), [*V, "POWER"]))


@query("e1_daily_mean_propagate", with_readings("""
SELECT DATE, CASE WHEN count(V_1) = count(*) THEN round(avg(V_1) + 1e-9, 6) END AS V_1_mean FROM train GROUP BY DATE"""))
def e1_na(spark, sf_dir):
    return rounded(aggregates.daily_mean(train(spark, sf_dir), ["V_1"], na="propagate"))


@query("e2_daily_median", with_readings("SELECT DATE, round(median(POWER) + 1e-9, 6) AS POWER_median FROM train GROUP BY DATE"))
def e2(spark, sf_dir):
    return rounded(aggregates.daily_median(train(spark, sf_dir, False), ["POWER"]))


@query("e3_site_mean", with_readings("""
SELECT SOT, LAT, LON, round(avg(POWER) + 1e-9, 6) AS mean FROM readings WHERE POWER IS NOT NULL GROUP BY ALL"""))
def e3(spark, sf_dir):
    return rounded(aggregates.site_mean(readings(spark, sf_dir, False)))


@query("e4_count_by", with_readings("SELECT LAT, LON, count(*) AS n FROM train GROUP BY ALL"))
def e4(spark, sf_dir):
    return aggregates.count_by(train(spark, sf_dir, False), ["LAT", "LON"])


@query("e5_duplicate_keys", with_readings("SELECT DATE, SOT, count(*) AS n FROM train GROUP BY ALL HAVING count(*) <> 1"))
def e5(spark, sf_dir):
    return aggregates.duplicate_keys(train(spark, sf_dir, False), ["DATE", "SOT"])


GROUPED = "grouped AS (SELECT *, CAST(V_13 AS INTEGER) % 10 AS Geo_Group FROM train)"


@query("e6_group_stats", with_readings("SELECT ID, " + ", ".join(
    f"round({fn}({c}) OVER (PARTITION BY Geo_Group) + 1e-9, 6) AS Geo_by_{c}_{name}"
    for c in ("POWER", "V_1", "V_2", "V_3")
    for name, fn in (("mean", "avg"), ("median", "median"), ("sd", "stddev_samp"), ("min", "min"), ("max", "max")))
    + " FROM grouped", GROUPED))
def e6(spark, sf_dir):
    rows = train(spark, sf_dir).withColumn("Geo_Group", F.expr("cast(V_13 as int) % 10"))
    made = aggregates.group_stats(rows)
    return rounded(made.select("ID", *[c for c in made.columns if c.startswith("Geo_by_")]))


@query("e7_cluster_stats", with_readings("SELECT ID, " + ", ".join(
    f"round({fn}(V_{i}) OVER (PARTITION BY Geo_Group) + 1e-9, 6) AS V_{i}_{name}" for i in range(1, 7)
    for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("max", "max"), ("min", "min")))
    + " FROM grouped", GROUPED))
def e7(spark, sf_dir):
    rows = train(spark, sf_dir).withColumn("cluster", F.expr("cast(V_13 as int) % 10"))
    made = aggregates.cluster_stats(rows)
    return rounded(made.select("ID", *[f"V_{i}_{f}" for i in range(1, 7) for f in ("mean", "std", "max", "min")]))


@query("e8_season_by_quarter", with_readings("""
SELECT quarter(DATE)::INTEGER AS quarter, count(*) FILTER (month(DATE) IN (3,4,5)) AS spring,
       count(*) FILTER (month(DATE) IN (6,7,8)) AS summer, count(*) FILTER (month(DATE) IN (9,10,11)) AS fall,
       count(*) FILTER (month(DATE) IN (12,1,2)) AS winter FROM train GROUP BY ALL"""))
def e8(spark, sf_dir):
    flags = calendar.season_flags(F.col("DATE"))
    return aggregates.season_by_quarter(train(spark, sf_dir, False).withColumns({"quarter": F.quarter("DATE"), **flags}))


@query("e11_minmax_scale", with_readings("""
SELECT ID, round((d - min(d) OVER ()) / (max(d) OVER () - min(d) OVER ()) + 1e-9, 6) AS distance
FROM (SELECT ID, (DATE - DATE '2016-01-01') * 86400::DOUBLE AS d FROM train)"""))
def e11(spark, sf_dir):
    rows = train(spark, sf_dir, False).select("ID", calendar.seconds_since(F.col("DATE")).alias("distance"))
    return rounded(aggregates.minmax_scale(rows, "distance"))


@query("e12_mean_std_of_folds", with_predictions("""
SELECT round(avg(rmse) + 1e-9, 6) AS mean, round(stddev_pop(rmse) + 1e-9, 6) AS std FROM (
  SELECT fold, sqrt(avg((POWER - pred) ** 2)) AS rmse FROM predictions GROUP BY fold)"""))
def e12(spark, sf_dir):
    scores = predictions(spark, sf_dir).groupBy("fold").agg(
        F.sqrt(F.avg(F.pow(F.col("POWER") - F.col("pred"), 2))).alias("rmse"))
    return rounded(aggregates.mean_std_of_folds(scores))


# --- F windows -----------------------------------------------------------------------------------

ROLLS = ", ".join(
    f"round(avg(POWER_mean) OVER (ORDER BY DATE ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) + 1e-9, 6) AS POWER_mean_{s}"
    for s, h in (("roll_1", 1), ("roll_5", 2), ("roll_7", 3)))
SELF_PARTS = [
    f"round(coalesce({fn}(POWER_mean, {k}) OVER (ORDER BY DATE), POWER_mean) + 1e-9, 6) AS POWER_mean_{fn}_{k}"
    for fn in ("lag", "lead") for k in (1, 2, 3)]
SELF = ", ".join(SELF_PARTS)


@query("f1_centred_roll", with_readings(f"SELECT DATE, {ROLLS} FROM daily", DAILY_SQL))
def f1(spark, sf_dir):
    return rounded(windows.centred_roll(daily(spark, sf_dir), ["POWER_mean"]).drop("POWER_mean", "V_5_mean"))


@query("f2_lag_fill_self", with_readings(
    "SELECT DATE, " + ", ".join(SELF_PARTS[:3]) + " FROM daily", DAILY_SQL))
def f2(spark, sf_dir):
    return rounded(windows.lag_fill_self(daily(spark, sf_dir), ["POWER_mean"]).drop("POWER_mean", "V_5_mean"))


@query("f3_lead_fill_self", with_readings(
    "SELECT DATE, " + ", ".join(SELF_PARTS[3:]) + " FROM daily", DAILY_SQL))
def f3(spark, sf_dir):
    return rounded(windows.lead_fill_self(daily(spark, sf_dir), ["POWER_mean"]).drop("POWER_mean", "V_5_mean"))


def edge_sql(cols: list[str], fns=("lag", "lead"), ks=range(1, 6)) -> str:
    """Shift with the mean of the k edge rows where the shift is undefined."""
    parts = []
    for c in cols:
        for fn in fns:
            place = "rn" if fn == "lag" else "back"
            for k in ks:
                parts.append(
                    f"round(CASE WHEN {place} <= {k} THEN avg(CASE WHEN {place} <= {k} THEN {c} END) OVER () "
                    f"ELSE {fn}({c}, {k}) OVER (ORDER BY DATE) END + 1e-9, 6) AS {c}_{fn}_{k}")
    return ", ".join(parts)


PLACED = """placed AS (SELECT *, row_number() OVER (ORDER BY DATE) AS rn, row_number() OVER (ORDER BY DATE DESC) AS back
FROM daily)"""


@query("f4_lag_fill_edge", with_readings(
    f"SELECT DATE, {edge_sql(['POWER_mean', 'V_5_mean'], ('lag',))} FROM placed", DAILY_SQL, PLACED))
def f4(spark, sf_dir):
    made = windows.lag_fill_edge(daily(spark, sf_dir), ["POWER_mean", "V_5_mean"])
    return rounded(made.drop("POWER_mean", "V_5_mean"))


@query("f5_lead_fill_edge", with_readings(
    f"SELECT DATE, {edge_sql(['POWER_mean', 'V_5_mean'], ('lead',))} FROM placed", DAILY_SQL, PLACED))
def f5(spark, sf_dir):
    made = windows.lead_fill_edge(daily(spark, sf_dir), ["POWER_mean", "V_5_mean"])
    return rounded(made.drop("POWER_mean", "V_5_mean"))


@query("d2_join_daily", with_readings(f"""
SELECT r.ID, r.SOT, r.DATE, d.* EXCLUDE (DATE) FROM readings r LEFT JOIN (
  SELECT DATE, round(POWER_mean + 1e-9, 6) AS POWER_mean, {ROLLS}, {SELF} FROM daily) d ON r.DATE = d.DATE""", DAILY_SQL))
def d2(spark, sf_dir):
    series = aggregates.daily_mean(train(spark, sf_dir, False), ["POWER"])
    made = windows.shift_fill_self(windows.centred_roll(series, ["POWER_mean"]), ["POWER_mean"])
    rows = readings(spark, sf_dir, False).select("ID", "SOT", "DATE")
    return rounded(joins.join_daily(rows, stage(made, "daily")))


@query("f6_delta", with_readings("""
SELECT DATE, round(lag(POWER_mean) OVER w + 1e-9, 6) AS POWER_mean_lag_1, round(POWER_mean - lag(POWER_mean) OVER w + 1e-9, 6) AS POWER_mean_delta_1
FROM daily WINDOW w AS (ORDER BY DATE)""", DAILY_SQL))
def f6(spark, sf_dir):
    return rounded(windows.delta(daily(spark, sf_dir), "POWER_mean").drop("POWER_mean", "V_5_mean"))


@query("f6_delta_per_site", with_readings("""
SELECT SOT, DATE, round(POWER_mean - lag(POWER_mean) OVER (PARTITION BY SOT ORDER BY DATE) + 1e-9, 6) AS POWER_mean_delta_1
FROM (SELECT SOT, DATE, avg(POWER) AS POWER_mean FROM train GROUP BY ALL)"""))
def f6_site(spark, sf_dir):
    by_site = aggregates.summarise(train(spark, sf_dir, False), ["SOT", "DATE"], ["POWER"], ["mean"])
    made = windows.delta(by_site, "POWER_mean", partition_by=["SOT"])
    return rounded(made.select("SOT", "DATE", "POWER_mean_delta_1"))


@query("f7_roll_then_lag", with_readings("SELECT DATE, " + ", ".join(
    f"round(lag({s}, {k}) OVER (ORDER BY DATE) + 1e-9, 6) AS POWER_mean_{s}_lag_{k}" for s in ("roll_1", "roll_5", "roll_7") for k in (1, 2, 3))
    + " FROM (SELECT DATE, " + ", ".join(
    f"avg(POWER_mean) OVER (ORDER BY DATE ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) AS {s}"
    for s, h in (("roll_1", 1), ("roll_5", 2), ("roll_7", 3))) + " FROM daily)", DAILY_SQL))
def f7(spark, sf_dir):
    made = windows.roll_then_lag(daily(spark, sf_dir), "POWER_mean")
    return rounded(made.select("DATE", *[c for c in made.columns if "_lag_" in c]))


TRAILING = ", ".join(
    f"CASE WHEN count({c}) OVER w = 15 THEN round(avg({c}) OVER w + 1e-9, 6) END AS roll_mean_15_{c}" for c in V)


@query("f8_trailing_roll", with_readings(f"""
SELECT ID, {TRAILING} FROM train WINDOW w AS (PARTITION BY SOT ORDER BY DATE NULLS LAST, ID ROWS BETWEEN 14 PRECEDING AND CURRENT ROW)"""))
def f8(spark, sf_dir):
    made = windows.trailing_roll(train(spark, sf_dir).select("ID", "SOT", "DATE", *V), V, 15, ["DATE", "ID"], ["SOT"])
    return rounded(made.drop("SOT", "DATE", *V))


@query("f8_trailing_train_part", with_readings("SELECT ID, " + ", ".join(
    f"roll_mean_15_{c}" for c in V) + " FROM (SELECT *, row_number() OVER (ORDER BY part, DATE, ID) AS rn, " + ", ".join(
    f"CASE WHEN count({c}) OVER w = 15 THEN round(avg({c}) OVER w + 1e-9, 6) END AS roll_mean_15_{c}" for c in V) + """
  FROM (SELECT *, CASE WHEN dataset = 'train' THEN 0 ELSE 1 END AS part FROM readings)
  WINDOW w AS (ORDER BY part, DATE, ID ROWS BETWEEN 14 PRECEDING AND CURRENT ROW)) WHERE part = 0 AND rn > 15"""))
def f8_train(spark, sf_dir):
    head, _ = windows.trailing_features(train(spark, sf_dir), test(spark, sf_dir), V, 15, ["DATE", "ID"])
    return rounded(head.select("ID", *[f"roll_mean_15_{c}" for c in V]))


@query("f8_trailing_test_part", with_readings("SELECT ID, " + ", ".join(
    f"roll_mean_15_{c}" for c in V) + " FROM (SELECT *, " + ", ".join(
    f"CASE WHEN count({c}) OVER w = 15 THEN round(avg({c}) OVER w + 1e-9, 6) END AS roll_mean_15_{c}" for c in V) + """
  FROM (SELECT *, CASE WHEN dataset = 'train' THEN 0 ELSE 1 END AS part FROM readings)
  WINDOW w AS (ORDER BY part, DATE, ID ROWS BETWEEN 14 PRECEDING AND CURRENT ROW)) WHERE part = 1"""))
def f8_test(spark, sf_dir):
    _, tail = windows.trailing_features(train(spark, sf_dir), test(spark, sf_dir), V, 15, ["DATE", "ID"])
    return rounded(tail.select("ID", *[f"roll_mean_15_{c}" for c in V]))


POSITIONS = [1, 2, 3, 500, 501, 502, 1428, 1429, 1430]


@query("f9_top_and_slices", with_readings(f"""
SELECT SOT, round(mean + 1e-9, 6) AS mean, CAST(position AS INTEGER) AS position FROM (
  SELECT SOT, mean, row_number() OVER (ORDER BY mean DESC NULLS LAST, SOT) AS position
  FROM (SELECT SOT, avg(POWER) AS mean FROM train GROUP BY SOT)) WHERE position IN ({', '.join(map(str, POSITIONS))})"""))
def f9(spark, sf_dir):
    means = train(spark, sf_dir, False).groupBy("SOT").agg(F.avg("POWER").alias("mean"))
    return rounded(order.slice_positions(means, ["mean", "SOT"], POSITIONS, [True, False]))


@query("f9_row_index", with_readings("""
SELECT ID, row_number() OVER (ORDER BY DATE NULLS LAST, ID) - 1 AS "row" FROM readings"""))
def f9_index(spark, sf_dir):
    return order.row_index(readings(spark, sf_dir, False).select("ID", "DATE"), ["DATE", "ID"]).drop("DATE")


@query("f10_acf", with_readings("""
SELECT CAST(lag AS INTEGER) AS lag, round(sum(a.d * b.d) / (SELECT sum(d * d) FROM c) + 1e-9, 6) AS acf
FROM c a, range(0, (SELECT floor(10 * log10(count(*)))::BIGINT + 1 FROM c)) AS r(lag), c b
WHERE b.rn = a.rn - lag GROUP BY lag""", DAILY_SQL,
    "c AS (SELECT row_number() OVER (ORDER BY DATE) AS rn, POWER_mean - avg(POWER_mean) OVER () AS d FROM daily)"))
def f10(spark, sf_dir):
    return rounded(windows.acf(daily(spark, sf_dir), "POWER_mean"))


# --- P user aggregates ---------------------------------------------------------------------------

@query("p5_user_aggregates", with_readings("""
, c AS (SELECT DATE, V_5 - avg(V_5) OVER (PARTITION BY DATE) AS d, V_5, row_number() OVER (PARTITION BY DATE ORDER BY V_5 DESC) AS place FROM readings)
SELECT DATE, round(CASE WHEN sum(d * d) > 1e-9 THEN sqrt(count(*)) * sum(d * d * d) / power(sum(d * d), 1.5) END + 1e-7, 4) AS V_5_skew,
       round(max(CASE WHEN place = 3 THEN V_5 END) + 1e-7, 4) AS V_5_third FROM c GROUP BY DATE"""))
def p5(spark, sf_dir):
    made = {"skew": user_aggregates.skewness(), "third": user_aggregates.nth_largest(3)}
    return rounded(user_aggregates.user_aggregate(readings(spark, sf_dir, False), ["DATE"], ["V_5"], made), 4, nudge=1e-7)


# --- K site grouping -----------------------------------------------------------------------------

@query("k1_distinct_sites", with_readings("SELECT DISTINCT LAT, LON FROM readings"))
def k1(spark, sf_dir):
    return spatial.distinct_sites(readings(spark, sf_dir, False))


@query("k2_geo_cluster_ward", ward_sql("SELECT * FROM groups", "sites"))
def k2(spark, sf_dir):
    return spatial.geo_cluster(sites(spark, sf_dir))


@query("k3_geo_cluster_single", single_link_sql("sites"))
def k3(spark, sf_dir):
    return spatial.single_link_cluster(sites(spark, sf_dir))


@query("k4_ring_cluster", with_readings("""
, near AS (SELECT *, round(sqrt((LAT - 39.9) ** 2 + (LON - 116.4) ** 2), 9) AS d FROM sites),
gaps AS (SELECT d, round(d - lag(d) OVER (ORDER BY d), 9) AS gap FROM (SELECT DISTINCT d FROM near)),
cuts AS (SELECT d FROM gaps WHERE gap IS NOT NULL ORDER BY gap DESC, d LIMIT 11)
SELECT SOT, CAST((SELECT count(*) FROM cuts WHERE cuts.d <= near.d) AS INTEGER) AS cluster_capital FROM near"""))
def k4(spark, sf_dir):
    return spatial.ring_cluster(sites(spark, sf_dir).select("SOT", "LAT", "LON")).select("SOT", "cluster_capital")


@query("k5_site_map_table", with_readings("""
SELECT SOT, LAT, LON, round(avg(POWER) + 1e-9, 6) AS mean FROM train GROUP BY ALL"""))
def k5(spark, sf_dir):
    return rounded(spatial.site_map_table(readings(spark, sf_dir, False)))


@query("k5_site_counts", with_readings("""
SELECT LAT, LON, count(*) AS n, round(avg(POWER) + 1e-9, 6) AS mean FROM train GROUP BY ALL"""))
def k5_counts(spark, sf_dir):
    rows = train(spark, sf_dir, False)
    means = aggregates.site_mean(rows, keys=("LAT", "LON"))
    return rounded(joins.natural_left_join(aggregates.count_by(rows, ["LAT", "LON"]), means, ["LAT", "LON"]))
