"""Learned feature steps, feature specifications and named recipes."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import READINGS_SQL, readings, rounded, sites, table, test, train, ward_sql, with_readings
from voltweave.functions import calendar
from voltweave.operators import joins
from voltweave.plans import blocks, recipes, tables
from voltweave.steps import (
    CorrelationFilter, DateFeatures, DummyEncode, FeatureSpec, FilterRows, GeoDistance, GeodesicDistance,
    ImputeMedian, IntegerEncode, LevelOrder, LogOutcome, LogShift, NaturalSpline, Normalise, PeriodicSpline,
    RemoveMatching, Scale, SelectStep, YeoJohnson,
)
from voltweave.steps.base import sel
from voltweave.steps.numeric import correlation_matrix, likelihoods

MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
DAYS = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]


def applied(step, df):
    return step.fit(df).transform(df)


# --- B8-B10, C2: roles and selection inside a specification --------------------------------------

@query("b8_set_roles", with_readings("SELECT LAT, LON, V_5, V_8, V_13 FROM train"))
def b8(spark, sf_dir):
    df = train(spark, sf_dir, False)
    spec = FeatureSpec.on(df).role("id variable", "ID", "SOT").role("non-use variable", "DATE", sel.regex("^v_"))
    spec = spec.role("predictor", sel.regex("^V_(5|8|13)$"))
    return df.select(*spec.fit(df).predictors)


@query("b9_remove_matching", with_readings("SELECT ID, SOT, DATE, LAT, LON, round(POWER + 1e-9, 6) AS POWER FROM train"))
def b9(spark, sf_dir):
    return rounded(applied(RemoveMatching(cols=[sel.regex("^V_")]), train(spark, sf_dir, False)))


@query("b10_select_step", with_readings("SELECT ID, LAT, LON FROM train"))
def b10(spark, sf_dir):
    return applied(SelectStep(cols=["ID", sel.regex("^l(at|on)$")]), train(spark, sf_dir, False))


@query("c2_train_only_filter", with_readings("""
SELECT 'fit' AS mode, ID FROM train WHERE V_6 > 4 UNION ALL SELECT 'score', ID FROM test"""))
def c2(spark, sf_dir):
    rows = train(spark, sf_dir)
    fitted = FeatureSpec.on(rows).step(FilterRows("V_6 > 4")).fit(rows)
    return fitted.training_result.select(F.lit("fit").alias("mode"), "ID").unionByName(
        fitted.transform(test(spark, sf_dir)).select(F.lit("score").alias("mode"), "ID"))


# --- J steps -------------------------------------------------------------------------------------

DATE_SQL = """SELECT ID, strftime(DATE, '%b') AS DATE_month, (floor((dayofyear(DATE) - 1) / 7) + 1)::INTEGER AS DATE_week,
  strftime(DATE, '%a') AS DATE_dow, dayofyear(DATE)::INTEGER AS DATE_doy FROM readings"""


@query("j1_date_features", with_readings(DATE_SQL))
def j1(spark, sf_dir):
    return applied(DateFeatures(), readings(spark, sf_dir, False).select("ID", "DATE"))


@query("j2_integer_encode", with_readings("""
SELECT ID, month(DATE)::INTEGER AS DATE_month, (isodow(DATE) % 7 + 1)::INTEGER AS DATE_dow FROM readings"""))
def j2(spark, sf_dir):
    dated = applied(DateFeatures(features=["month", "dow"]), readings(spark, sf_dir, False).select("ID", "DATE"))
    return applied(IntegerEncode(cols=["DATE_month", "DATE_dow"]), dated)


@query("j2_integer_encode_new_level", """
SELECT o_orderkey AS ID, CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS code
FROM orders""")
def j2_new(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ID"), F.col("o_orderpriority").alias("code"))
    return IntegerEncode(cols=["code"]).fit(rows.where("code <> '5-LOW'")).transform(rows)


@query("j2_many_levels", with_readings("""
SELECT ID, coalesce(code, 0)::INTEGER AS SOT FROM readings LEFT JOIN
 (SELECT SOT, dense_rank() OVER (ORDER BY SOT) AS code FROM (SELECT DISTINCT SOT FROM readings WHERE V_13 < 20)) USING (SOT)"""))
def j2_many(spark, sf_dir):
    """As many levels as sites: a stored dictionary. Sites of some nations are new to it."""
    rows = readings(spark, sf_dir, False).select("ID", "SOT", "V_13")
    return IntegerEncode(cols=["SOT"], inline=20).fit(rows.where("V_13 < 20")).transform(rows).drop("V_13")


@query("j3_many_levels", with_readings("""
SELECT SOT AS level, dense_rank() OVER (ORDER BY SOT)::INTEGER AS code, count(*) AS n FROM readings GROUP BY SOT"""))
def j3_many(spark, sf_dir):
    rows = applied(LevelOrder(cols=["SOT"], inline=20), readings(spark, sf_dir, False).select("SOT"))
    both = rows.withColumn("level", F.col("SOT"))
    return applied(IntegerEncode(cols=["SOT"]), both).groupBy("level", F.col("SOT").alias("code")).agg(F.count("*").alias("n"))


@query("j3_level_order", with_readings("""
SELECT ID, CAST(dense_rank() OVER (ORDER BY month(DATE)::VARCHAR) AS INTEGER) AS m FROM readings"""))
def j3(spark, sf_dir):
    rows = readings(spark, sf_dir, False).select("ID", F.month("DATE").alias("m"))
    return applied(IntegerEncode(cols=["m"]), applied(LevelOrder(cols=["m"]), rows))


@query("j4_dummy_encode", with_readings("SELECT ID, " + ", ".join(
    f"(strftime(DATE, '%b') = '{m}')::INTEGER AS DATE_month_{m}" for m in MONTHS[1:]) + ", " + ", ".join(
    f"(strftime(DATE, '%a') = '{d}')::INTEGER AS DATE_dow_{d}" for d in DAYS[1:]) + " FROM readings"))
def j4(spark, sf_dir):
    dated = applied(DateFeatures(features=["month", "dow"]), readings(spark, sf_dir, False).select("ID", "DATE"))
    return applied(DummyEncode(cols=["DATE_month", "DATE_dow"]), dated)


@query("j5_scale", with_readings("""
SELECT ID, round(V_1 / (SELECT stddev_samp(V_1) FROM train) + 1e-9, 6) AS V_1, round(V_5 / (SELECT stddev_samp(V_5) FROM train) + 1e-9, 6) AS V_5
FROM readings"""))
def j5(spark, sf_dir):
    rows = readings(spark, sf_dir)
    fitted = Scale(cols=["V_1", "V_5"]).fit(rows.where("dataset = 'train'"))
    return rounded(fitted.transform(rows.select("ID", "V_1", "V_5")))


@query("j6_normalise", with_readings("SELECT ID, " + ", ".join(
    f"round((V_{i} - (SELECT avg(V_{i}) FROM train)) / (SELECT stddev_samp(V_{i}) FROM train) + 1e-9, 6) AS V_{i}" for i in (1, 5, 8, 13))
    + " FROM readings"))
def j6(spark, sf_dir):
    rows = readings(spark, sf_dir)
    cols = ["V_1", "V_5", "V_8", "V_13"]
    fitted = Normalise(cols=[sel.regex("^V_(1|5|8|13)$")]).fit(rows.where("dataset = 'train'"))
    return rounded(fitted.transform(rows.select("ID", *cols)))


@query("j7_log_outcome", with_readings("""
SELECT ID, round(log10(POWER + 1) + 1e-9, 6) AS POWER, round(POWER + 1e-9, 6) AS back FROM train"""))
def j7(spark, sf_dir):
    made = applied(LogOutcome(cols=["POWER"]), train(spark, sf_dir, False).select("ID", "POWER"))
    return rounded(LogOutcome.inverse(made.withColumn("back", F.col("POWER")), "back"))


@query("j8_impute_median", with_readings("""
SELECT ID, round(coalesce(CASE WHEN V_5 >= 0 THEN V_5 END, (SELECT median(V_5) FROM readings WHERE V_5 >= 0)) + 1e-9, 6) AS V_5 FROM readings"""))
def j8(spark, sf_dir):
    return rounded(applied(ImputeMedian(), readings(spark, sf_dir, False).select("ID", "V_5")))


@query("j8_impute_median_strict", with_readings("SELECT ID, CASE WHEN V_5 >= 0 THEN round(V_5 + 1e-9, 6) END AS V_5 FROM readings"))
def j8_strict(spark, sf_dir):
    return rounded(applied(ImputeMedian(strict=True), readings(spark, sf_dir, False).select("ID", "V_5")))


@query("j9_log_shift", with_readings("SELECT ID, " + ", ".join(
    f"round(log10(V_{i} + 0.1) + 1e-9, 6) AS V_{i}" for i in (1, 6, 9, 11, 12)) + " FROM readings"))
def j9(spark, sf_dir):
    cols = ["V_1", "V_6", "V_9", "V_11", "V_12"]
    return rounded(applied(LogShift(cols=cols, shift=0.1), readings(spark, sf_dir).select("ID", *cols)))


LAMBDAS = [-1.0, 0.0, 0.5, 1.0, 2.0, 3.0]


@query("j10_likelihoods", with_readings(" UNION ALL ".join(
    f"SELECT {lam}::DOUBLE AS lambda, round(-count(*) / 2.0::DOUBLE * ln(var_pop(y)) + {lam - 1} * sum(sign(x) * ln(abs(x) + 1)) + 1e-6, 3) AS likelihood FROM (SELECT x, CASE WHEN x >= 0 THEN "
    + ("ln(x + 1)" if lam == 0 else f"(power(x + 1, {lam}) - 1) / {lam}") + " ELSE "
    + ("-ln(1 - x)" if lam == 2 else f"-(power(1 - x, {2 - lam}) - 1) / {2 - lam}")
    + " END AS y FROM (SELECT V_8 AS x FROM readings WHERE V_8 IS NOT NULL))" for lam in LAMBDAS)))
def j10_grid(spark, sf_dir):
    found = likelihoods(readings(spark, sf_dir, False), "V_8", LAMBDAS)
    return rounded(spark.createDataFrame(list(zip(LAMBDAS, map(float, found))), "lambda double, likelihood double"), 3, keep=("lambda",), nudge=1e-6)


@query("j10_yeo_johnson")
def j10(spark, sf_dir):
    return applied(YeoJohnson(col="V_8"), readings(spark, sf_dir, False).select("ID", "V_8"))


@query("j10_transformed_readings")
def j10_all(spark, sf_dir):
    return tables.eda_transformed(readings(spark, sf_dir))


def spline_sql(value: str, name: str, df: int) -> str:
    """Natural cubic functions on the quantiles of the column; the textbook form with knots scaled to [0, 1]."""
    knots = [f"((q[{i + 1}] - q[1]) / (q[{df + 1}] - q[1]))" for i in range(df + 1)]
    bent = [f"((greatest(t - {k}, 0) ** 3 - greatest(t - 1, 0) ** 3) / (1 - {k}))" for k in knots[:-1]]
    texts = ["t"] + [f"{b} - {bent[-1]}" for b in bent[:-1]]
    digits = len(str(df))
    columns = ", ".join(f"round({text} + 1e-9, 6) AS {name}_{i:0{digits}d}" for i, text in enumerate(texts, 1))
    probs = ", ".join(f"{i}::DOUBLE / {df}" for i in range(df + 1))
    return with_readings(f"""SELECT ID, {name}, {columns} FROM (
  SELECT ID, {value} AS {name}, q, ({value} - q[1]) / (q[{df + 1}] - q[1]) AS t FROM readings,
    (SELECT quantile_cont(({value})::DOUBLE, [{probs}]) AS q FROM readings))""")


@query("j11_natural_spline", spline_sql("dayofyear(DATE)::INTEGER", "DATE_doy", 26))
def j11(spark, sf_dir):
    rows = readings(spark, sf_dir, False).select("ID", F.dayofyear("DATE").alias("DATE_doy"))
    return rounded(applied(NaturalSpline("DATE_doy", 26, keep=True), rows))


@query("j11_natural_spline_values", spline_sql("V_5", "V_5", 8))
def j11_values(spark, sf_dir):
    return rounded(applied(NaturalSpline("V_5", 8, keep=True), readings(spark, sf_dir, False).select("ID", "V_5")), keep=("V_5",))


@query("j12_periodic_spline", with_readings("SELECT ID, day(DATE)::INTEGER AS day, " + ", ".join(
    f"CASE WHEN day(DATE) <= 30 THEN round(CASE (2 * day(DATE) - {j} + 61) % 60 WHEN 0 THEN 4 / 6.0::DOUBLE WHEN 1 THEN 1 / 6.0::DOUBLE "
    f"WHEN 59 THEN 1 / 6.0::DOUBLE ELSE 0 END + 1e-9, 6) END AS spline_{j}" for j in range(60)) + " FROM readings"))
def j12(spark, sf_dir):
    rows = readings(spark, sf_dir, False).select("ID", F.dayofmonth("DATE").alias("day"))
    return rounded(applied(PeriodicSpline(), rows))


@query("j13_geo_distance", with_readings("SELECT SOT, " + ", ".join(
    f"round(2 * 6371000 * asin(sqrt(power(sin(radians({lat} - LAT) / 2), 2) + cos(radians(LAT)) * cos(radians({lat})) * "
    f"power(sin(radians({lon} - LON) / 2), 2))) + 1e-5, 3) AS {name}"
    for name, lat, lon in (("dist_Shanghai", 31, 121), ("dist_Beijing", 39, 116))) + " FROM sites"))
def j13(spark, sf_dir):
    rows = sites(spark, sf_dir).select("SOT", "LAT", "LON")
    for place in (recipes.SHANGHAI, recipes.BEIJING):
        rows = applied(GeoDistance(**place), rows)
    return rounded(rows.drop("LAT", "LON"), 3, nudge=1e-5)


def vincenty_sql(lat2: float, lon2: float, rounds: int = 12) -> tuple[str, str]:
    """(CTEs, expression) of the same series solution, unrolled."""
    f, a = "(1 / 298.257223563::DOUBLE)", "6378137.0::DOUBLE"
    ctes = [f"""v0 AS (SELECT SOT, s1, c1, s2, c2, L, L AS lam FROM (
      SELECT SOT, sin(u1) AS s1, cos(u1) AS c1, sin(u2) AS s2, cos(u2) AS c2, radians({lon2} - LON) AS L FROM (
        SELECT SOT, LON, atan((1 - {f}) * tan(radians(LAT))) AS u1, atan((1 - {f}) * tan(radians({lat2}))) AS u2 FROM sites)))"""]
    for i in range(rounds):
        ctes.append(f"""a{i} AS (SELECT *, sqrt((c2 * sin(lam)) ** 2 + (c1 * s2 - s1 * c2 * cos(lam)) ** 2) AS ss,
          s1 * s2 + c1 * c2 * cos(lam) AS cs FROM v{i}),
        b{i} AS (SELECT *, atan2(ss, cs) AS sigma, c1 * c2 * sin(lam) / ss AS sa FROM a{i}),
        d{i} AS (SELECT *, 1 - sa * sa AS ca, cs - 2 * s1 * s2 / (1 - sa * sa) AS cm FROM b{i}),
        e{i} AS (SELECT *, {f} / 16 * ca * (4 + {f} * (4 - 3 * ca)) AS cc FROM d{i}),
        w{i} AS (SELECT *, L + (1 - cc) * {f} * sa * (sigma + cc * ss * (cm + cc * cs * (2 * cm * cm - 1))) AS nxt FROM e{i}),
        v{i + 1} AS (SELECT SOT, s1, c1, s2, c2, L, nxt AS lam, ss, cs, sigma, ca, cm FROM w{i})"""
                    if i == rounds - 1 else
                    f"""a{i} AS (SELECT *, sqrt((c2 * sin(lam)) ** 2 + (c1 * s2 - s1 * c2 * cos(lam)) ** 2) AS ss,
          s1 * s2 + c1 * c2 * cos(lam) AS cs FROM v{i}),
        b{i} AS (SELECT *, atan2(ss, cs) AS sigma, c1 * c2 * sin(lam) / ss AS sa FROM a{i}),
        d{i} AS (SELECT *, 1 - sa * sa AS ca, cs - 2 * s1 * s2 / (1 - sa * sa) AS cm FROM b{i}),
        e{i} AS (SELECT *, {f} / 16 * ca * (4 + {f} * (4 - 3 * ca)) AS cc FROM d{i}),
        v{i + 1} AS (SELECT SOT, s1, c1, s2, c2, L,
          L + (1 - cc) * {f} * sa * (sigma + cc * ss * (cm + cc * cs * (2 * cm * cm - 1))) AS lam FROM e{i})""")
    ctes.append(f"""series AS (SELECT *, 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u))) AS aa,
        u / 1024 * (256 + u * (-128 + u * (74 - 47 * u))) AS bb FROM (
        SELECT *, ca * (1 / ((1 - {f}) ** 2) - 1) AS u FROM v{rounds}))""")
    value = (f"{a} * (1 - {f}) * aa * (sigma - bb * ss * (cm + bb / 4 * (cs * (2 * cm * cm - 1) "
             f"- bb / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3))))")
    return ", ".join(ctes), value


_CTES, _DISTANCE = vincenty_sql(31.2304, 121.4737)


@query("j14_geodesic_distance", with_readings(
    f"SELECT SOT, round(log10({_DISTANCE}) + 1e-9, 6) AS dist_shanghai FROM series", _CTES))
def j14(spark, sf_dir):
    step = GeodesicDistance(name="dist_shanghai", ref_lat=31.2304, ref_lon=121.4737, log10=True)
    return rounded(applied(step, sites(spark, sf_dir).select("SOT", "LAT", "LON")).drop("LAT", "LON"))


RANKED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("j15_spearman_matrix", "WITH ranked AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS {c}" for c in RANKED)
    + " FROM lineitem) " + " UNION ALL ".join(
    f"SELECT '{a}' AS Parameter1, '{b}' AS Parameter2, round(corr({a}, {b}) + 1e-9, 6) AS rho FROM ranked"
    for a in RANKED for b in RANKED))
def j15_matrix(spark, sf_dir):
    matrix = correlation_matrix(table(spark, sf_dir, "lineitem"), RANKED)
    rows = [(a, b, float(matrix[i][j])) for i, a in enumerate(RANKED) for j, b in enumerate(RANKED)]
    return rounded(spark.createDataFrame(rows, "Parameter1 string, Parameter2 string, rho double"))


JUDGED = [f"V_{i}" for i in range(1, 14)] + ["V_8b"]
_RANKS = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE END AS {c}" for c in JUDGED)
_STRENGTHS = " UNION ALL ".join(
    f"SELECT {i} AS i, [" + ", ".join("1.0" if a == b else f"round(coalesce(abs(corr({a}, {b})), 0), 9)" for b in JUDGED) + "] AS s FROM ranked"
    for i, a in enumerate(JUDGED))


@query("j15_kept_columns", "WITH RECURSIVE " + READINGS_SQL + f""",
wide AS (SELECT *, V_8 * 2 + V_13 / 1000 AS V_8b FROM readings),
ranked AS MATERIALIZED (SELECT {_RANKS} FROM wide),
m AS MATERIALIZED ({_STRENGTHS}),
pairs AS MATERIALIZED (SELECT row_number() OVER (ORDER BY a.s[b.i + 1] DESC, a.i, b.i) AS k, a.i AS i, b.i AS j, a.s AS si, b.s AS sj
  FROM m a JOIN m b ON a.i < b.i AND a.s[b.i + 1] > 0.9),
walk AS (
 SELECT 0 AS k, []::INTEGER[] AS gone
 UNION ALL
 SELECT w.k + 1, CASE WHEN list_contains(gone, i) OR list_contains(gone, j) THEN gone ELSE list_append(gone,
   CASE WHEN round(list_avg([sj[x + 1] for x in range({len(JUDGED)}) if NOT list_contains(gone, x::INTEGER)]), 9)
           > round(list_avg([si[x + 1] for x in range({len(JUDGED)}) if NOT list_contains(gone, x::INTEGER)]), 9) THEN j ELSE i END) END
 FROM walk w JOIN pairs p ON p.k = w.k + 1),
last AS (SELECT arg_max(gone, k) AS gone FROM walk)
SELECT c AS name, NOT list_contains(gone, (i - 1)::INTEGER) AS kept FROM last,
 (SELECT unnest({JUDGED!r}) AS c, unnest(range(1, {len(JUDGED) + 1})) AS i)""")
def j15_kept(spark, sf_dir):
    rows = readings(spark, sf_dir).withColumn("V_8b", F.col("V_8") * 2 + F.col("V_13") / 1000)
    left = CorrelationFilter(cols=JUDGED, threshold=0.9).fit(rows).transform(rows).columns
    return spark.createDataFrame([(c, c in left) for c in JUDGED], "name string, kept boolean")


@query("j15_correlation_filter")
def j15(spark, sf_dir):
    rows = readings(spark, sf_dir).withColumn("V_8b", F.col("V_8") * 2 + F.col("V_13") / 1000)
    return applied(CorrelationFilter(cols=[sel.regex("^V_")], threshold=0.9), rows)


@query("j16_feature_steps", with_readings("""
SELECT ID, SOT, LAT, LON, V_5, V_8, V_13, (floor((dayofyear(DATE) - 1) / 7) + 1)::INTEGER AS DATE_week, dayofyear(DATE)::INTEGER AS DATE_doy,
       month(DATE)::INTEGER AS DATE_month, (isodow(DATE) % 7 + 1)::INTEGER AS DATE_dow FROM test"""))
def j16(spark, sf_dir):
    rows = train(spark, sf_dir, False)
    fitted = recipes.recipe("rec_base", rows).fit(rows)
    return fitted.model().transform(test(spark, sf_dir, False))


@query("j16_scaled_steps", with_readings("""
, s AS (SELECT stddev_samp(LAT) AS a, stddev_samp(LON) AS b, stddev_samp(V_5) AS c, stddev_samp(V_8) AS d, stddev_samp(V_13) AS e,
        stddev_samp(floor((dayofyear(DATE) - 1) / 7) + 1) AS f, stddev_samp(dayofyear(DATE)) AS g FROM train)
SELECT ID, SOT, POWER, round(LAT / a + 1e-9, 6) AS LAT, round(LON / b + 1e-9, 6) AS LON, round(V_5 / c + 1e-9, 6) AS V_5,
       round(V_8 / d + 1e-9, 6) AS V_8, round(V_13 / e + 1e-9, 6) AS V_13,
       round((floor((dayofyear(DATE) - 1) / 7) + 1) / f + 1e-9, 6) AS DATE_week, round(dayofyear(DATE) / g + 1e-9, 6) AS DATE_doy,
       month(DATE)::INTEGER AS DATE_month, (isodow(DATE) % 7 + 1)::INTEGER AS DATE_dow FROM train, s"""))
def j16_scaled(spark, sf_dir):
    rows = train(spark, sf_dir, False)
    return rounded(recipes.recipe("rec_base_v2_scaling", rows).fit(rows).training_result, keep=("POWER",))


FLAGS = ", ".join(f"(isodow(DATE) = {k + 1})::INTEGER AS {name}" for names in (blocks.SHORT_DAYS, blocks.LONG_DAYS)
                  for k, name in enumerate(names))


@query("j17_date_blocks", with_readings(f"""
SELECT ID, {FLAGS}, round(weekofyear(DATE) / 52.0::DOUBLE + 1e-9, 6) AS week, (isodow(DATE) < 6)::INTEGER AS isweekday,
       (month(DATE) IN (3,4,5))::INTEGER AS spring, (month(DATE) IN (6,7,8))::INTEGER AS summer,
       (month(DATE) IN (9,10,11))::INTEGER AS fall, (month(DATE) IN (12,1,2))::INTEGER AS winter,
       round((DATE - min(DATE) OVER ()) / (max(DATE) OVER () - min(DATE) OVER ()) + 1e-9, 6) AS distance,
       month(DATE)::INTEGER AS month, 0 AS hour, year(DATE)::INTEGER AS year, (isodow(DATE) - 1)::INTEGER AS dayofweek,
       quarter(DATE)::INTEGER AS quarter, day(DATE)::INTEGER AS dayofmonth, weekofyear(DATE)::INTEGER AS weekofyear,
       day(DATE)::INTEGER AS day, isodow(DATE)::INTEGER AS weekday, ymd,
       round(sin(2 * pi() * ymd / 365) + 1e-9, 6) AS sin, round(cos(2 * pi() * ymd / 365) + 1e-9, 6) AS cos
FROM (SELECT *, (year(DATE) * 10000 + month(DATE) * 100 + day(DATE))::INTEGER AS ymd FROM train)"""))
def j17(spark, sf_dir):
    rows = train(spark, sf_dir, False).select("ID", "DATE")
    return rounded(blocks.datetime_features(blocks.deal_date(rows)).drop("DATE"))


def both_sides(spark, sf_dir, switches):
    """Training and scoring rows of a setting; the outlier block removes training rows only."""
    made, scored = blocks.build_features(train(spark, sf_dir), test(spark, sf_dir), switches)
    return made.withColumn("dataset", F.lit("train")).unionByName(scored.withColumn("dataset", F.lit("test")), allowMissingColumns=True)


@query("j18_switches_default")
def j18(spark, sf_dir):
    return both_sides(spark, sf_dir, blocks.Switches())


@query("j18_switches_all")
def j18_all(spark, sf_dir):
    return both_sides(spark, sf_dir, blocks.Switches(**dict.fromkeys(blocks.Switches.__dataclass_fields__, True)))


@query("d4_join_lookup", with_readings("""
SELECT ID, CASE WHEN day(DATE) <= 30 THEN round(CASE (2 * day(DATE) + 60) % 60 WHEN 0 THEN 4 / 6.0::DOUBLE WHEN 1 THEN 1 / 6.0::DOUBLE
       WHEN 59 THEN 1 / 6.0::DOUBLE ELSE 0 END + 1e-9, 6) END AS spline_1 FROM readings"""))
def d4(spark, sf_dir):
    days = spark.createDataFrame(
        [(d, {0: 4 / 6, 1: 1 / 6, 59: 1 / 6}.get((2 * d) % 60, 0.0)) for d in range(1, 31)], "day int, spline_1 double")
    rows = readings(spark, sf_dir, False).select("ID", F.dayofmonth("DATE").alias("day"))
    return rounded(joins.join_lookup(rows, days, ["day"]).select("ID", "spline_1"))


# --- feature tables and named recipes ------------------------------------------------------------

SERIES = [f"V_{i}" for i in range(1, 14)]


@query("q_daily_measures", with_readings(
    ", d AS (SELECT DATE, " + ", ".join(
        f"avg({c}) AS {c}_mean, avg(CASE WHEN {c} + 10 > 0 THEN log10(greatest({c} + 10, 1e-300)) END) AS {c}_log10_mean" for c in SERIES)
    + """ FROM readings GROUP BY DATE),
p AS (SELECT *, row_number() OVER (ORDER BY DATE) AS rn, row_number() OVER (ORDER BY DATE DESC) AS back FROM d)
SELECT DATE, """ + ", ".join(
        f"round({c}_{s} + 1e-9, 6) AS {c}_{s}, " + ", ".join(
            f"round(CASE WHEN {place} <= {k} THEN avg(CASE WHEN {place} <= {k} THEN {c}_{s} END) OVER () "
            f"ELSE {fn}({c}_{s}, {k}) OVER (ORDER BY DATE) END + 1e-9, 6) AS {c}_{s}_{fn}_{k}"
            for fn, place in (("lag", "rn"), ("lead", "back")) for k in range(1, 6))
        for c in SERIES for s in ("mean", "log10_mean")) + " FROM p"))
def q_daily(spark, sf_dir):
    return rounded(tables.daily_measures(readings(spark, sf_dir)))


GROUP_STATS = ", ".join(
    f"round({fn} + 1e-9, 6) AS Geo_by_{c}_{name}" for c in ("POWER", "V_1", "V_2", "V_3")
    for name, fn in (("mean", f"avg({c})"), ("median", f"quantile_cont({c}, 0.5)"), ("sd", f"stddev_samp({c})"), ("min", f"min({c})"), ("max", f"max({c})")))


@query("q_site_targets", ward_sql(
    "SELECT * FROM (SELECT DISTINCT LAT, LON, Geo_Group FROM grouped) JOIN stats USING (Geo_Group)", "readings",
    "grouped AS (SELECT * FROM train JOIN groups USING (LAT, LON))", f"stats AS (SELECT Geo_Group, {GROUP_STATS} FROM grouped GROUP BY Geo_Group)"))
def q_sites(spark, sf_dir):
    return rounded(tables.site_targets(readings(spark, sf_dir)), keep=("LAT", "LON"))


@query("q_site_distances", ward_sql(
    f"SELECT LAT, LON, Geo_Group, round(log10({_DISTANCE}) + 1e-9, 6) AS dist_shanghai FROM series JOIN sites USING (SOT) JOIN groups USING (LAT, LON)", "readings", _CTES))
def q_distances(spark, sf_dir):
    return rounded(tables.site_distances(readings(spark, sf_dir, False)), keep=("LAT", "LON"))


def baked(name: str):
    def run(spark, sf_dir):
        rows, scoring = train(spark, sf_dir), test(spark, sf_dir)
        make = {1: tables.feature_tables_v1, 2: tables.feature_tables_v2, 3: tables.feature_tables_v3}.get(
            recipes.table_of(name))
        joined, scored = make(rows, scoring) if make else (rows, scoring)
        fitted = recipes.recipe(name, joined).fit(joined)
        return fitted.transform(scored).select("ID", *fitted.predictors)

    return run


WEEK = "(floor((dayofyear(DATE) - 1) / 7) + 1)::INTEGER"
CODES = {"month": ("month(DATE)", range(1, 13)), "week": (WEEK, range(1, 54)), "dow": ("(isodow(DATE) % 7 + 1)", range(1, 8))}
MEASURES = ["LAT", "LON", *SERIES]
PLAIN = "ID, " + ", ".join(f"round({c} + 1e-9, 6) AS {c}" for c in MEASURES) + ", dayofyear(DATE)::INTEGER AS DATE_doy"
LABELS = ", ".join(f"(strftime(DATE, '%b') = '{m}')::INTEGER AS DATE_month_{m}" for m in MONTHS[1:]) + ", " + ", ".join(
    f"(strftime(DATE, '%a') = '{d}')::INTEGER AS DATE_dow_{d}" for d in DAYS[1:])
SEASONS = ", ".join(f"(month(DATE) IN {tuple(months)})::INTEGER AS {name}" for name, months in calendar.SEASON_MONTHS.items())


def baked_rounded(name: str):
    return lambda spark, sf_dir: rounded(baked(name)(spark, sf_dir))


query("q_rec_v1", with_readings(f"SELECT {PLAIN}, " + ", ".join(
    f"({expr} = {level})::INTEGER AS DATE_{part}_X{level}" for part, (expr, levels) in CODES.items()
    for level in sorted(levels, key=str)[1:]) + " FROM test"))(baked_rounded("rec_v1"))
query("q_rec_v9_base", with_readings(f"""
SELECT {PLAIN}, {WEEK} AS DATE_week, month(DATE)::INTEGER AS DATE_month, (isodow(DATE) % 7 + 1)::INTEGER AS DATE_dow
FROM test"""))(baked_rounded("rec_v9_base"))
query("q_rec_v9_on_hot_week_month", with_readings(
    f"SELECT {PLAIN}, {WEEK} AS DATE_week, {LABELS} FROM test"))(baked_rounded("rec_v9_on_hot_week_month"))
query("q_rec_v12_base", with_readings(f"""
SELECT {PLAIN}, {WEEK} AS DATE_week, (isodow(DATE) < 6)::INTEGER AS iswweekday, {SEASONS}, {LABELS}
FROM test"""))(baked_rounded("rec_v12_base"))

for _name in ("rec_v3_mean_lag_1_2_lead_1_2", "rec_v5_mod_v4", "rec_v6_dist_1_2", "rec_v7_v8", "rec_v9_full",
              "rec_v11_Geo_by_POWER_stats", "rec_v12_V_1_and_other", "rec_v13_sincos", "rec_v14_scale",
              "rec_v15_add_combine", "rec_v15_remove_corrr"):
    query(f"q_{_name}")(baked(_name))
