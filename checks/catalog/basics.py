"""Sources, columns, filters, joins, sets, order and scalar functions."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import (
    predictions, readings, rounded, sites, sql_rounded, table, test, train, with_predictions, with_readings,
)
from voltweave.functions import calendar, numeric, text
from voltweave.operators import columns, filters, joins, order, setops
from voltweave.sources import (
    materialise, parse_date, profile_schema, read_readings, readings_schema, write_predictions,
)
from voltweave.sources.staging import staging_root

V = [f"V_{i}" for i in range(1, 14)]


def scratch(spark, name: str) -> str:
    return os.path.join(staging_root(spark), "voltweave", f"{name}-{uuid.uuid4().hex}")


# --- A sources and sinks -------------------------------------------------------------------------

@query("a1_read_readings", with_readings("""
SELECT ID, SOT, strftime(DATE, '%Y/%-m/%-d') AS DATE, LAT, LON, """ + sql_rounded(V + ["POWER"]) + " FROM train"))
def a1(spark, sf_dir):
    path = scratch(spark, "readings-csv")
    as_text = train(spark, sf_dir).withColumn("DATE", F.date_format("DATE", "y/M/d"))
    write_predictions(as_text.select(readings_schema().fieldNames()), path)
    return rounded(read_readings(spark, path), keep=("LAT", "LON"))


@query("a1_read_parquet", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 100000""")
def a1_parquet(spark, sf_dir):
    return read_readings(spark, f"{sf_dir}/orders.parquet", None, "parquet").where("o_totalprice > 100000").select(
        "o_orderkey", "o_custkey", "o_totalprice")


@query("a2_parse_date", """
SELECT o_orderkey AS ID, CAST(o_orderdate AS DATE) AS DATE FROM orders""")
def a2(spark, sf_dir):
    dated = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ID"),
        F.concat_ws("/", F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate")).alias("DATE"))
    return parse_date(dated, sort=True)


@query("a3_write_predictions", with_predictions("SELECT ID, round(pred + 1e-9, 6) AS POWER FROM predictions"))
def a3(spark, sf_dir):
    path = scratch(spark, "predictions-csv")
    write_predictions(predictions(spark, sf_dir).select("ID", F.col("pred").alias("POWER")), path)
    return rounded(spark.read.schema("ID bigint, POWER double").option("header", True).csv(path))


@query("a4_materialise", with_readings("SELECT ID, SOT, DATE, LAT, LON, V_5, POWER FROM train"))
def a4(spark, sf_dir):
    return materialise(train(spark, sf_dir, False).drop("V_8", "V_13"), scratch(spark, "train"))


@query("a5_profile_schema", """
SELECT * FROM (VALUES (0, 'event_id', 'bigint'), (1, 'ts', 'timestamp'), (2, 'user_id', 'bigint'),
                      (3, 'event_type', 'string'), (4, 'value', 'double')) AS c(position, column_name, data_type),
       (SELECT count(*) AS n_rows FROM events), (SELECT 5 AS n_columns)""")
def a5(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    return profile_schema(events)


# --- B projections -------------------------------------------------------------------------------

@query("b1_rename", with_readings("SELECT ID AS id, DATE AS date, POWER AS power FROM train"))
def b1(spark, sf_dir):
    return columns.rename(train(spark, sf_dir, False).select("ID", "DATE", "POWER"), {1: "id", "DATE": "date", 3: "power"})


@query("b2_drop_cols", with_readings("SELECT * EXCLUDE (SOT, ID, V_1, V_2, V_3, V_4, V_6, V_7, V_9, V_10, V_11, V_12) FROM train"))
def b2(spark, sf_dir):
    return columns.drop_cols(train(spark, sf_dir, False), ["SOT", "ID"])


@query("b3_select_matching", with_readings(
    "SELECT ID, " + sql_rounded(["V_1", "V_10", "V_11", "V_12", "V_13"]) + " FROM readings"))
def b3(spark, sf_dir):
    return rounded(columns.select_matching(readings(spark, sf_dir), "^v_1[0-9]?$|^id$"))


@query("b4_relocate_first", with_readings("SELECT POWER, ID, SOT, DATE, LAT, LON, V_5, V_8, V_13 FROM train"))
def b4(spark, sf_dir):
    return columns.relocate_first(train(spark, sf_dir, False), "POWER")


@query("b5_arith_features", with_readings("""
SELECT ID, round(V_1 + V_2 + V_6 + 1e-9, 6) AS V1_2_6, round(V_3 + V_4 + V_5 + 1e-9, 6) AS V3_4_5,
       round(V_1 * V_1 + 1e-9, 6) AS V_1_square_2, round(1 / (V_1 + 0.001) + 1e-9, 6) AS "1_/_V_1" FROM readings"""))
def b5(spark, sf_dir):
    made = columns.arith_features(readings(spark, sf_dir))
    return rounded(made.select("ID", "V1_2_6", "V3_4_5", "V_1_square_2", "1_/_V_1"))


@query("b6_inverse_features", with_readings("SELECT ID, " + ", ".join(
    f"round(1 / nullif({name} + 0.001, 0) + 1e-9, 6) AS inv{name}" for name in columns.INVERSE_COLUMNS)
    + " FROM (SELECT *, V_3 + V_4 + V_5 AS V3_4_5 FROM readings)"))
def b6(spark, sf_dir):
    made = columns.inverse_features(columns.arith_features(readings(spark, sf_dir)))
    return rounded(made.select("ID", *[f"inv{name}" for name in columns.INVERSE_COLUMNS]))


@query("b7_across", with_readings("SELECT ID, " + ", ".join(
    f"round(log10({c} + 10) + 1e-9, 6) AS {c}_log10, round({c} * {c} + 1e-9, 6) AS {c}_sq" for c in ("V_1", "V_6", "V_9"))
    + " FROM readings"))
def b7(spark, sf_dir):
    cols = ["V_1", "V_6", "V_9"]
    made = columns.across(readings(spark, sf_dir), cols,
                          {"log10": lambda x: numeric.log10_shift(x, 10.0), "sq": numeric.square})
    return rounded(made.select("ID", *[f"{c}_{f}" for c in cols for f in ("log10", "sq")]))


@query("b11_attach_by_key", with_readings("""
SELECT r.ID, r.SOT, round(p.o_totalprice / 2000 + 1e-9, 6) AS POWER
FROM readings r JOIN orders p ON r.ID = p.o_orderkey WHERE dataset = 'test'"""))
def b11(spark, sf_dir):
    template = test(spark, sf_dir, False).select("ID", "SOT").withColumn("POWER", F.lit(0.0))
    scored = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ID"), (F.col("o_totalprice") / 2000).alias("POWER"))
    return rounded(joins.attach_by_key(template, scored))


@query("b12_tag_source", with_readings("SELECT ID, 'train' AS dataset FROM train"))
def b12(spark, sf_dir):
    return columns.tag_source(train(spark, sf_dir, False).select("ID"), "train")


@query("b13_unpivot_long", with_readings("""
SELECT ID, DATE, param, round(val + 1e-9, 6) AS val FROM (
  SELECT ID, DATE, V_5, V_8, V_13, POWER FROM readings) UNPIVOT INCLUDE NULLS (val FOR param IN (V_5, V_8, V_13, POWER))"""))
def b13(spark, sf_dir):
    wide = readings(spark, sf_dir, False).select("ID", "DATE", "V_5", "V_8", "V_13", "POWER")
    return rounded(columns.unpivot_long(wide, ["ID", "DATE"]))


@query("b14_explode_list", """
SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS element FROM embeddings""")
def b14(spark, sf_dir):
    listed = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("element"))
    return columns.explode_list(listed, "element").withColumn("element", F.col("element").cast("double"))


@query("b15_site_number", """
SELECT o_orderpriority AS SOT, regexp_extract(o_orderpriority, '^[0-9]*', 0) AS SOT_ID, count(*) AS n
FROM orders GROUP BY ALL""")
def b15(spark, sf_dir):
    tagged = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("SOT"), text.site_number(F.col("o_orderpriority")).alias("SOT_ID"))
    return tagged.groupBy("SOT", "SOT_ID").agg(F.count(F.lit(1)).alias("n"))


# --- C filters -----------------------------------------------------------------------------------

BOUNDS = {"V_2": (0.02, None), "V_4": (25, None), "V_7": (0.005, None), "V_11": (None, 0.075), "V_12": (None, 50)}


@query("c1_outlier_filter", with_readings("""
SELECT ID FROM train WHERE V_2 > 0.02 AND V_4 > 25 AND V_7 > 0.005 AND V_11 < 0.075 AND V_12 < 50"""))
def c1(spark, sf_dir):
    return filters.outlier_filter(train(spark, sf_dir), BOUNDS).select("ID")


@query("c1_outlier_filter_default", with_readings("""
SELECT ID FROM (SELECT ID, V_2, V_4 * 10 AS V_4, V_7 + 0.7 AS V_7, V_11, V_12 / 6 AS V_12 FROM train)
WHERE V_2 > -6 AND V_4 > 250 AND V_7 > 0.675 AND V_11 < 14 AND V_12 < 9"""))
def c1_default(spark, sf_dir):
    scaled = train(spark, sf_dir).select(
        "ID", "V_2", (F.col("V_4") * 10).alias("V_4"), (F.col("V_7") + 0.7).alias("V_7"), "V_11",
        (F.col("V_12") / 6).alias("V_12"))
    return filters.outlier_filter(scaled).select("ID")


@query("c3_not_null", with_readings("SELECT ID, POWER FROM readings WHERE POWER IS NOT NULL"))
def c3(spark, sf_dir):
    return filters.not_null(readings(spark, sf_dir, False), "POWER").select("ID", "POWER")


@query("c4_any_null", with_readings("SELECT ID FROM readings WHERE V_1 IS NULL OR POWER IS NULL"))
def c4(spark, sf_dir):
    return filters.any_null(readings(spark, sf_dir), ["V_1", "POWER"]).select("ID")


@query("c5_date_range_filter", with_readings("""
SELECT DATE, round(mean + 1e-9, 6) AS mean FROM (SELECT DATE, avg(POWER) AS mean FROM train GROUP BY DATE)
WHERE DATE BETWEEN DATE '1996-02-21' AND DATE '1998-03-05' AND mean > 150"""))
def c5(spark, sf_dir):
    daily = train(spark, sf_dir, False).groupBy("DATE").agg(F.avg("POWER").alias("mean"))
    return rounded(filters.date_range_filter(daily, "1996-02-21", "1998-03-05", also=F.col("mean") > 150))


@query("c6_in_set", with_readings("SELECT ID, month(DATE)::INTEGER AS m FROM readings WHERE month(DATE) IN (3, 4, 5)"))
def c6(spark, sf_dir):
    return filters.in_set(readings(spark, sf_dir, False).select("ID", F.month("DATE").alias("m")), "m", [3, 4, 5])


@query("c6_not_in_set", """
SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderpriority IS NULL OR o_orderpriority NOT IN ('1-URGENT', '5-LOW')""")
def c6_not(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return filters.not_in_set(rows, "o_orderpriority", ["1-URGENT", "5-LOW"])


@query("c7_text_match", """
SELECT o_orderkey AS ID, strftime(o_orderdate, '%Y/%-m/%-d') AS DATE FROM orders
WHERE regexp_matches(strftime(o_orderdate, '%Y/%-m/%-d'), '1997/12/25|1998/6/17')""")
def c7(spark, sf_dir):
    dated = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ID"), F.date_format("o_orderdate", "y/M/d").alias("DATE"))
    return filters.text_filter(dated, "DATE", "1997/12/25|1998/6/17")


@query("c8_equals", with_readings("SELECT ID, SOT, POWER FROM train WHERE SOT = 'Customer#000000010'"))
def c8(spark, sf_dir):
    return filters.equals(train(spark, sf_dir, False), "SOT", "Customer#000000010").select("ID", "SOT", "POWER")


@query("c9_first_per_key", with_readings("""
SELECT ID, SOT, DATE, LAT, LON, V_5, POWER FROM (
  SELECT *, row_number() OVER (PARTITION BY LAT, LON ORDER BY DATE NULLS LAST, ID) AS rn FROM readings) WHERE rn = 1"""))
def c9(spark, sf_dir):
    rows = readings(spark, sf_dir, False).select("ID", "SOT", "DATE", "LAT", "LON", "V_5", "POWER")
    return filters.first_per_key(rows, ["LAT", "LON"], ["DATE", "ID"])


@query("c9_first_per_date", with_readings("""
SELECT DATE, ID FROM (SELECT *, row_number() OVER (PARTITION BY DATE ORDER BY ID) AS rn FROM readings) WHERE rn = 1"""))
def c9_date(spark, sf_dir):
    return filters.first_per_key(readings(spark, sf_dir, False).select("DATE", "ID"), ["DATE"], ["ID"])


# --- D joins -------------------------------------------------------------------------------------

@query("d1_natural_left_join", with_readings("""
SELECT r.ID, r.DATE, r.V_1k, round(m.mean + 1e-9, 6) AS mean
FROM (SELECT ID, DATE, CAST(floor(V_1 / 10) AS BIGINT) AS V_1k FROM readings) r
LEFT JOIN (SELECT CAST(floor(V_1 / 10) AS BIGINT) AS V_1k, avg(POWER) AS mean FROM train GROUP BY 1) m
  ON r.V_1k IS NOT DISTINCT FROM m.V_1k"""))
def d1(spark, sf_dir):
    bin_of = F.floor(F.col("V_1") / 10).alias("V_1k")
    rows = readings(spark, sf_dir).select("ID", "DATE", bin_of)
    means = train(spark, sf_dir).groupBy(bin_of).agg(F.avg("POWER").alias("mean"))
    return rounded(joins.natural_left_join(rows, means))


@query("d3_join_site", with_readings("""
SELECT r.ID, round(s.mean + 1e-9, 6) AS mean FROM readings r
LEFT JOIN (SELECT LAT, LON, avg(POWER) AS mean FROM train GROUP BY LAT, LON) s
  ON r.LAT IS NOT DISTINCT FROM s.LAT AND r.LON IS NOT DISTINCT FROM s.LON"""))
def d3(spark, sf_dir):
    by_site = train(spark, sf_dir, False).groupBy("LAT", "LON").agg(F.avg("POWER").alias("mean"))
    return rounded(joins.join_site(readings(spark, sf_dir, False).select("ID", "LAT", "LON"), by_site).select("ID", "mean"))


@query("d5_pairwise_distance", """
SELECT SOT, ref, round(sqrt((LAT - rlat) ** 2 + (LON - rlon) ** 2) + 1e-9, 6) AS distance FROM (
  SELECT c_name AS SOT, 18 + (c_custkey * 37 % 350) / 10.0::DOUBLE AS LAT,
         73 + (c_custkey * 61 % 620) / 10.0::DOUBLE AS LON FROM customer),
  (VALUES ('north', 39.9::DOUBLE, 116.4::DOUBLE), ('east', 31.2::DOUBLE, 121.5::DOUBLE)) AS refs(ref, rlat, rlon)""")
def d5(spark, sf_dir):
    points = sites(spark, sf_dir).select("SOT", "LAT", "LON")
    made = joins.pairwise_distance(points, {"north": (39.9, 116.4), "east": (31.2, 121.5)})
    return rounded(made.select("SOT", "ref", "distance"))


# --- G set operations, H order -------------------------------------------------------------------

@query("g1_union_by_name", with_readings("""
SELECT ID, DATE, POWER, 'train' AS dataset FROM train UNION ALL SELECT ID, DATE, NULL, 'test' FROM test"""))
def g1(spark, sf_dir):
    return setops.union_by_name(
        columns.tag_source(train(spark, sf_dir, False).select("ID", "DATE", "POWER"), "train"),
        columns.tag_source(test(spark, sf_dir, False).select("ID", "DATE"), "test"))


@query("g2_distinct_values", with_readings("SELECT DISTINCT DATE FROM train"))
def g2(spark, sf_dir):
    return setops.distinct_values(train(spark, sf_dir, False), "DATE")


@query("g3_missing_dates", with_readings("SELECT DISTINCT DATE FROM train EXCEPT SELECT DISTINCT DATE FROM test"))
def g3(spark, sf_dir):
    return setops.missing_dates(train(spark, sf_dir, False), test(spark, sf_dir, False))


@query("h1_sort", with_readings("SELECT ID, SOT, POWER FROM readings ORDER BY POWER DESC NULLS LAST, ID"))
def h1(spark, sf_dir):
    rows = readings(spark, sf_dir, False).select("ID", "SOT", "POWER")
    return order.sort(rows, ["POWER", "ID"], [True, False])


@query("h2_slice_range", with_readings("SELECT ID, DATE FROM train ORDER BY DATE NULLS LAST, ID LIMIT 99 OFFSET 1"))
def h2(spark, sf_dir):
    return order.slice_range(train(spark, sf_dir, False).select("ID", "DATE"), 1, 100, ["DATE", "ID"])


@query("h3_top_k", with_readings("SELECT SOT, round(mean + 1e-9, 6) AS mean FROM (SELECT SOT, avg(POWER) AS mean FROM train GROUP BY SOT) ORDER BY mean DESC, SOT LIMIT 20"))
def h3(spark, sf_dir):
    means = train(spark, sf_dir, False).groupBy("SOT").agg(F.avg("POWER").alias("mean"))
    return rounded(order.top_k(means, ["mean", "SOT"], 20, [True, False]))


# --- I scalar functions --------------------------------------------------------------------------

@query("i1_date_parts", with_readings("""
SELECT ID, month(DATE)::INTEGER AS month, 0 AS hour, year(DATE)::INTEGER AS year, (isodow(DATE) - 1)::INTEGER AS dayofweek,
       quarter(DATE)::INTEGER AS quarter, day(DATE)::INTEGER AS dayofmonth, weekofyear(DATE)::INTEGER AS weekofyear,
       day(DATE)::INTEGER AS day, isodow(DATE)::INTEGER AS weekday FROM readings"""))
def i1(spark, sf_dir):
    return readings(spark, sf_dir, False).select(
        "ID", *[expr.alias(name) for name, expr in calendar.date_parts(F.col("DATE")).items()])


# Names of the two sets of weekday flags.
DAYS = ["Mon", "Tue", "Wed", "Thur", "Fri", "Sat", "Sun"]
LONG_DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday"]


@query("i2_weekday_flags", with_readings("SELECT ID, " + ", ".join(
    f"(isodow(DATE) = {k + 1})::INTEGER AS {name}" for names in (DAYS, LONG_DAYS) for k, name in enumerate(names))
    + " FROM readings"))
def i2(spark, sf_dir):
    flags = calendar.weekday_flags(F.col("DATE"), DAYS) | calendar.weekday_flags(F.col("DATE"), LONG_DAYS)
    return readings(spark, sf_dir, False).select("ID", *[expr.alias(name) for name, expr in flags.items()])


@query("i3_is_weekday", with_readings("SELECT ID, (isodow(DATE) < 6)::INTEGER AS isweekday FROM readings"))
def i3(spark, sf_dir):
    return readings(spark, sf_dir, False).select("ID", calendar.is_weekday(F.col("DATE")).alias("isweekday"))


@query("i4_seasons", with_readings("""
SELECT ID, (month(DATE) IN (3,4,5))::INTEGER AS spring, (month(DATE) IN (6,7,8))::INTEGER AS summer,
       (month(DATE) IN (9,10,11))::INTEGER AS fall, (month(DATE) IN (12,1,2))::INTEGER AS winter FROM readings"""))
def i4(spark, sf_dir):
    return readings(spark, sf_dir, False).select(
        "ID", *[expr.alias(name) for name, expr in calendar.season_flags(F.col("DATE")).items()])


@query("i5_week_fraction", with_readings("""
SELECT ID, round(weekofyear(DATE) / 52.0::DOUBLE + 1e-9, 6) AS week, (floor((dayofyear(DATE) - 1) / 7) + 1)::INTEGER AS week_sevens
FROM readings"""))
def i5(spark, sf_dir):
    date = F.col("DATE")
    return rounded(readings(spark, sf_dir, False).select(
        "ID", calendar.week_fraction(date).alias("week"), calendar.week_of_year_sevens(date).alias("week_sevens")))


@query("i6_seconds_since", with_readings("""
SELECT ID, (DATE - DATE '1995-06-01') * 86400::DOUBLE AS distance FROM readings"""))
def i6(spark, sf_dir):
    return readings(spark, sf_dir, False).select(
        "ID", calendar.seconds_since(F.col("DATE"), "1995-06-01").alias("distance"))


@query("i7_ymd_cycle", with_readings("""
SELECT ID, ymd, round(sin(2 * pi() * ymd / 365) + 1e-9, 6) AS sin, round(cos(2 * pi() * ymd / 365) + 1e-9, 6) AS cos
FROM (SELECT ID, (year(DATE) * 10000 + month(DATE) * 100 + day(DATE))::INTEGER AS ymd FROM readings)"""))
def i7(spark, sf_dir):
    ymd = calendar.ymd_number(F.col("DATE"))
    sin, cos = calendar.cyclic_pair(ymd)
    return rounded(readings(spark, sf_dir, False).select("ID", ymd.alias("ymd"), sin.alias("sin"), cos.alias("cos")))


@query("i8_day_of_year_cycle", with_readings("SELECT ID, " + ", ".join(
    f"round({fn}({2 * n} * pi() * dayofyear(DATE) / 365) + 1e-9, 6) AS {fn}_{n}" for n in (1, 3) for fn in ("sin", "cos"))
    + " FROM readings"))
def i8(spark, sf_dir):
    doy = F.dayofyear("DATE")
    (s1, c1_), (s3, c3_) = calendar.cyclic_pair(doy), calendar.cyclic_pair(doy, cycles=3)
    return rounded(readings(spark, sf_dir, False).select(
        "ID", s1.alias("sin_1"), c1_.alias("cos_1"), s3.alias("sin_3"), c3_.alias("cos_3")))


@query("i9_spike_flag", with_readings("""
SELECT ID, (DATE BETWEEN DATE '1997-02-21' AND DATE '1997-03-05')::INTEGER AS Flag_Spike,
       (DATE BETWEEN DATE '2019-02-21' AND DATE '2019-03-05')::INTEGER AS Flag_Default FROM readings"""))
def i9(spark, sf_dir):
    date = F.col("DATE")
    return readings(spark, sf_dir, False).select(
        "ID", calendar.spike_flag(date, "1997-02-21", "1997-03-05").alias("Flag_Spike"),
        calendar.spike_flag(date).alias("Flag_Default"))


@query("i10_time_parts", """
SELECT event_id, hour(ts)::INTEGER AS hour, minute(ts)::INTEGER AS minute, second(ts)::INTEGER AS second FROM events""")
def i10(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", *[expr.alias(name) for name, expr in calendar.time_parts(F.col("ts")).items()])


@query("i11_math", with_readings("""
SELECT ID, round(log10(V_1 + 0.1) + 1e-9, 6) AS log_a, CASE WHEN V_5 + 10 > 0 THEN round(log10(V_5 + 10) + 1e-9, 6) END AS log_b,
       CASE WHEN V_5 > 0 THEN round(log10(V_5) + 1e-9, 6) END AS log_c, round(V_1 * V_1 + 1e-9, 6) AS sq, round(sqrt(V_6) + 1e-9, 6) AS root
FROM readings"""))
def i11(spark, sf_dir):
    v1, v5 = F.col("V_1"), F.col("V_5")
    return rounded(readings(spark, sf_dir).select(
        "ID", numeric.log10_shift(v1, 0.1).alias("log_a"), numeric.log10_shift(v5, 10.0).alias("log_b"),
        numeric.log10_shift(v5).alias("log_c"), numeric.square(v1).alias("sq"), F.sqrt("V_6").alias("root")))


@query("i12_text", """
SELECT c_custkey, 'Submittion_' || c_name || '_v1.csv' AS file, regexp_replace(regexp_replace(c_name, 'Customer#', 'site '), '0+', '0') AS label,
       regexp_extract(c_name, '[0-9]+', 0) AS digits, regexp_matches(c_name, '7$') AS ends_in_seven FROM customer""")
def i12(spark, sf_dir):
    name = F.col("c_name")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("Submittion_"), name, F.lit("_v1.csv")).alias("file"),
        text.relabel(name, {"Customer#": "site ", "^(site )0+": "$10"}).alias("label"),
        F.regexp_extract(name, "[0-9]+", 0).alias("digits"), text.text_match(name, "7$").alias("ends_in_seven"))


@query("i13_conditional", with_readings("""
SELECT ID, CASE WHEN V_1 IS NULL THEN NULL WHEN V_1 > 25 THEN 1 ELSE 0 END AS high, round(coalesce(V_1, V_13) + 1e-9, 6) AS filled
FROM readings"""))
def i13(spark, sf_dir):
    return rounded(readings(spark, sf_dir).select(
        "ID", numeric.if_else(F.col("V_1") > 25, F.lit(1), F.lit(0)).alias("high"),
        F.coalesce("V_1", "V_13").alias("filled")))


@query("i14_casts", with_readings("SELECT ID, month(DATE)::VARCHAR AS DATE_month, day(DATE)::VARCHAR AS DATE_day FROM readings"))
def i14(spark, sf_dir):
    rows = readings(spark, sf_dir, False).select("ID", F.month("DATE").alias("DATE_month"), F.dayofmonth("DATE").alias("DATE_day"))
    return columns.as_text_levels(rows, ["DATE_month", "DATE_day"])
