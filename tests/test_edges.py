"""Hand-made edge cases."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from voltweave.functions import calendar, numeric
from voltweave.models import evaluate
from voltweave.operators import aggregates, columns, filters, joins, order, quantiles, sampling, setops, spatial, stats, windows
from voltweave.sources import parse_date, read_readings, readings_schema, write_predictions
from voltweave.steps import DummyEncode, FeatureSpec, ImputeMedian, IntegerEncode, Normalise, PeriodicSpline
from voltweave.steps.base import sel


def days(spark, values, start="2019-02-19"):
    first = dt.date.fromisoformat(start)
    rows = [(first + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "DATE date, x double")


def column(df, name, key="DATE"):
    return [row[name] for row in df.orderBy(key).collect()]


def test_null_keys_match_on_both_sides(spark):
    left = spark.createDataFrame([(1, None), (2, "a"), (3, "z")], "ID int, k string")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, v int")
    assert column(joins.natural_left_join(left, right), "v", "ID") == [10, 20, None]



def test_null_keys_do_not_share_a_partition(spark):
    """Half of the keys are null and the join is shuffled: no partition holds much more than its part."""
    left = spark.range(40_000).selectExpr("id AS ID", "IF(id % 2 = 0, NULL, id % 500) AS a", "IF(id % 4 = 0, NULL, 'x') AS b")
    right = spark.sql("SELECT id AS a, 'x' AS b, id AS v FROM range(500) UNION ALL SELECT NULL, 'x', -1 UNION ALL SELECT NULL, NULL, -2 UNION ALL SELECT NULL, NULL, -3")
    kept = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        made = joins.natural_left_join(left, right)
        assert made.columns == ["ID", "a", "b", "v"]
        got = {(r["kind"], r["v"]): r["n"] for r in made.selectExpr("ID % 4 AS kind", "IF(a IS NULL, v, v - a) AS v").groupBy("kind", "v").agg(F.count("*").alias("n")).collect()}
        assert got == {(0, -2): 10_000, (0, -3): 10_000, (1, 0): 10_000, (2, -1): 10_000, (3, 0): 10_000}
        sizes = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / len(sizes), sizes
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)


def test_natural_join_needs_a_shared_column(spark):
    with pytest.raises(ValueError):
        joins.natural_left_join(spark.range(1), spark.range(1).withColumnRenamed("id", "other"))


@pytest.mark.parametrize("n", [1, 2, 3])
def test_edge_shifts_of_short_series(spark, n):
    made = windows.shift_fill_edge(days(spark, range(1, n + 1)), ["x"])
    mean = sum(range(1, n + 1)) / n
    assert column(made, "x_lag_5") == [mean] * n
    assert column(made, "x_lead_5") == [mean] * n


def test_edge_shifts_fill_all_first_rows_with_one_mean(spark):
    made = windows.shift_fill_edge(days(spark, [1, 2, 4, 8, 16, 32]), ["x"])
    assert column(made, "x_lag_1") == [1, 1, 2, 4, 8, 16]
    assert column(made, "x_lag_3") == [pytest.approx(7 / 3)] * 3 + [1, 2, 4]
    assert column(made, "x_lead_2") == [4, 8, 16, 32, 24, 24]


def test_edge_shifts_per_group(spark):
    df = days(spark, [1, 2, 3]).withColumn("g", F.lit("a")).unionByName(days(spark, [10, 20]).withColumn("g", F.lit("b")))
    made = windows.shift_fill_edge(df, ["x"], (1,), (1,), partition_by=["g"]).where("g = 'b'")
    assert column(made, "x_lag_1") == [10, 10]
    assert column(made, "x_lead_1") == [20, 20]


def test_rolling_windows_are_partial_at_both_ends(spark):
    made = windows.centred_roll(days(spark, [1, 2, 3, 4]), ["x"])
    assert column(made, "x_roll_1") == [1.5, 2, 3, 3.5]
    assert column(made, "x_roll_7") == [2.5, 2.5, 2.5, 2.5]


def test_self_filled_shifts(spark):
    made = windows.shift_fill_self(days(spark, [5, 6, 7]), ["x"])
    assert column(made, "x_lag_2") == [5, 6, 5]
    assert column(made, "x_lead_1") == [6, 7, 7]


def test_trailing_mean_needs_all_values(spark):
    df = days(spark, range(20)).withColumn("x", F.when(F.col("x") != 3, F.col("x")))
    made = column(windows.trailing_roll(df, ["x"], 5, ["DATE"], chunk_rows=6), "roll_mean_5_x")
    assert made[:8] == [None] * 8
    assert made[8:] == [float(i - 2) for i in range(8, 20)]


def test_trailing_mean_restarts_per_group_across_chunks(spark):
    rows = [(g, i, float(i)) for g in ("a", "b") for i in range(10)]
    df = spark.createDataFrame(rows, "g string, i int, x double")
    made = windows.trailing_roll(df, ["x"], 3, ["i"], ["g"], chunk_rows=4).orderBy("g", "i").collect()
    assert [row["roll_mean_3_x"] for row in made] == ([None, None] + [float(i - 1) for i in range(2, 10)]) * 2


def test_week_numbers_differ_at_the_year_end(spark):
    df = spark.createDataFrame([(dt.date(2019, 12, 31),)], "d date").select(
        F.weekofyear("d").alias("iso"), calendar.week_of_year_sevens(F.col("d")).alias("sevens"),
        calendar.week_fraction(F.col("d")).alias("share"))
    assert tuple(df.first()) == (1, 53, pytest.approx(1 / 52))


def test_spike_flag_includes_both_ends(spark):
    dates = [dt.date(2019, 2, 20), dt.date(2019, 2, 21), dt.date(2019, 3, 5), dt.date(2019, 3, 6), None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(dates)], "i int, d date")
    assert column(df.withColumn("f", calendar.spike_flag(F.col("d"))), "f", "i") == [0, 1, 1, 0, None]


def test_logs_and_inverses_of_awkward_numbers(spark):
    df = spark.createDataFrame([(0, 0.0), (1, -1.0), (2, 100.0), (3, -1e-3)], "i int, x double")
    made = df.select("i", numeric.log10_shift(F.col("x")).alias("log"), numeric.inverse(F.col("x")).alias("inv"))
    assert column(made, "log", "i") == [None, None, 2.0, None]
    assert column(made, "inv", "i")[3] is None


def test_condition_null_gives_null(spark):
    df = spark.createDataFrame([(0, None), (1, 5)], "i int, x int")
    made = df.withColumn("y", numeric.if_else(F.col("x") > 3, F.lit(1), F.lit(0)))
    assert column(made, "y", "i") == [None, 1]


def test_day_31_has_no_spline_unless_asked(spark):
    df = spark.createDataFrame([(30,), (31,)], "day int")
    assert column(PeriodicSpline().fit(df).transform(df), "spline_0", "day")[1] is None
    full = PeriodicSpline(full_month=True).fit(df).transform(df)
    assert column(full, "spline_1", "day") == [pytest.approx(4 / 6), pytest.approx(0.0)]
    assert sum(full.where("day = 31").drop("day").first()) == pytest.approx(1.0)


def test_unseen_and_null_levels(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    rows = spark.createDataFrame([(0, "a"), (1, "c"), (2, "new"), (3, None)], "i int, k string")
    assert column(IntegerEncode(cols=["k"]).fit(train).transform(rows), "k", "i") == [1, 3, 0, None]
    made = DummyEncode(cols=["k"]).fit(train).transform(rows)
    assert made.columns == ["i", "k_b", "k_c"]
    assert column(made, "k_c", "i") == [0, 1, None, None]


def test_constant_column(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert column(Normalise(cols=["x"]).fit(df).transform(df), "x", "y") == [None, None]
    found = {(r["Parameter1"], r["Parameter2"]): r["r"] for r in stats.correlation_table(df).collect()}
    assert found[("x", "y")] is None and found[("x", "x")] == 1.0
    assert aggregates.minmax_scale(df, "x").first()["x"] is None


def test_zero_truth_is_left_out_of_percent_errors(spark):
    df = spark.createDataFrame([(0.0, 1.0), (10.0, 8.0)], "POWER double, pred double")
    found = {r["metric"]: r["value"] for r in evaluate.metrics(df).collect()}
    assert found["mape"] == pytest.approx(20.0) and found["mpe"] == pytest.approx(20.0)
    assert found["rmse"] == pytest.approx(math.sqrt(2.5))


def test_mean_can_propagate_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0)], "k string, x double")
    made = aggregates.summarise(df, ["k"], ["x"], ["mean", "median"], na="propagate")
    assert column(made, "x_mean", "k") == [None, 2.0] and column(made, "x_median", "k") == [None, 2.0]
    assert column(aggregates.summarise(df, ["k"], ["x"], ["mean"]), "x_mean", "k") == [1.0, 2.0]


def test_strict_imputation_does_nothing_when_nulls_exist(spark):
    df = spark.createDataFrame([(0, -1.0), (1, 2.0), (2, 4.0)], "i int, V_5 double")
    assert column(ImputeMedian().fit(df).transform(df), "V_5", "i") == [3.0, 2.0, 4.0]
    assert column(ImputeMedian(strict=True).fit(df).transform(df), "V_5", "i") == [None, 2.0, 4.0]


def test_roles_are_resolved_when_they_are_given(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, "1")], "ID int, POWER double, POWER_mean double, Geo_Group string")
    spec = FeatureSpec.on(df).role("id variable", "ID").step(DummyEncode(cols=["Geo_Group"]))
    late = spec.role("non-use variable", sel.regex("POWER_mean_|Geo_Group_"))
    both = df.union(spark.createDataFrame([(2, 1.0, 2.0, "2")], df.schema))
    assert late.fit(both).predictors == ["POWER_mean", "Geo_Group_X2"]


def test_first_per_key_keeps_whole_rows(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", None, "z"), (None, 5, "n")], "k string, o int, v string")
    made = {row["k"]: (row["o"], row["v"]) for row in filters.first_per_key(df, ["k"], ["o"]).collect()}
    assert made == {"a": (1, "y"), None: (5, "n")}


def test_sort_puts_nulls_last_both_ways(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    assert [r[0] for r in order.sort(df, ["x"]).collect()] == [1, 3, None]
    assert [r[0] for r in order.sort(df, ["x"], True).collect()] == [3, 1, None]


def test_large_slices_take_the_indexed_way(spark, monkeypatch):
    monkeypatch.setattr(order, "TOP_K_LIMIT", 5)
    df = spark.range(100).withColumnRenamed("id", "x")
    assert sorted(r[0] for r in order.slice_range(df, 90, 95, ["x"]).collect()) == [90, 91, 92, 93, 94]
    rows = order.slice_positions(df, ["x"], [1, 50], True).collect()
    assert {(r["x"], r["position"]) for r in rows} == {(99, 1), (50, 50)}
    assert order.drop_head(df, 40, ["x"]).count() == 60


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, 2.0)], "ID int, POWER double"), spark.createDataFrame([(2,)], "ID int")
    assert column(setops.union_by_name(a, b), "POWER", "ID") == [2.0, None]
    assert column(setops.missing_dates(a, b, "ID"), "ID", "ID") == [1]


def test_one_site_only(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0)], "LAT double, LON double")
    assert [tuple(r) for r in spatial.geo_cluster(df).collect()] == [(1.0, 2.0, 1)]
    assert [r["cluster_capital"] for r in spatial.ring_cluster(df).collect()] == [0, 0]


def test_csv_round_trip_with_unpadded_dates(spark, tmp_path):
    names = readings_schema(False).fieldNames()
    row = [7, "2167A", "2019/6/17", 1.5, 2.5, *[float(i) for i in range(13)]]
    path = str(tmp_path / "out")
    write_predictions(spark.createDataFrame([row], readings_schema(False)), path)
    back = parse_date(read_readings(spark, path, readings_schema(False)))
    assert back.columns == names and back.first()["DATE"] == dt.date(2019, 6, 17)


def test_wrong_header_is_an_error(spark, tmp_path):
    path = str(tmp_path / "out")
    write_predictions(spark.createDataFrame([(1, 2.0)], "POWER int, ID double"), path)
    with pytest.raises(Exception, match="header"):
        read_readings(spark, path, readings_schema().__class__.fromDDL("ID bigint, POWER double")).collect()


def test_grouped_quantiles_in_the_bracketed_way(spark):
    rows = spark.range(30000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id < 10 THEN 'tiny' ELSE 'other' END AS k",
        "CASE WHEN id % 11 <> 0 THEN double((id * 7919) % 10007) / 7 END AS x").cache()
    made = {r["k"]: r for r in quantiles.quantiles(rows, ["x"], {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.999, "e": 1.0}, ["k"], accuracy=200).collect()}
    exact = rows.groupBy("k").agg(F.expr("percentile(x, array(0, 0.1, 0.5, 0.999, 1)) AS p")).collect()
    for row in exact:
        found = [made[row["k"]][f"x_{n}"] for n in "abcde"]
        assert found == pytest.approx(row["p"], abs=1e-9)


def test_strata_with_few_distinct_values(spark):
    df = spark.createDataFrame([(i, float(i % 2)) for i in range(40)], "ID int, POWER double")
    split = sampling.initial_split(df)
    assert split.where("is_train = 1").count() == pytest.approx(30, abs=2)


def test_selection_ignores_case_unless_told(spark):
    assert columns.matching(["V_1", "v_2"], "^v_") == ["V_1", "v_2"]
    assert columns.matching(["V_1", "v_2"], "^v_", ignore_case=False) == ["v_2"]


def test_stored_tables_of_a_block_are_removed(spark):
    import os

    from voltweave.sources.staging import scratch, stage

    with scratch(spark):
        kept = stage(spark.range(5), "block")
        path = kept.inputFiles()[0].removeprefix("file://")
        assert kept.count() == 5 and os.path.exists(path)
    assert not os.path.exists(path)
    assert stage(spark.range(3), "outside").count() == 3


def test_windows_without_groups_refuse_row_level_input(spark):
    from voltweave.operators import windows

    rows = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 3.0), (None, 4.0)], "DATE int, x double")
    for call in (windows.centred_roll, windows.lag_fill_self, windows.lag_fill_edge):
        with pytest.raises(Exception, match="one row per DATE"):
            call(rows, ["x"]).collect()
        assert len(call(rows.where("x > 1"), ["x"]).collect()) == 3
    with pytest.raises(Exception, match="one row per DATE"):
        windows.delta(rows, "x").collect()
    assert windows.centred_roll(rows, ["x"], partition_by=["x"]).count() == 4


def test_correlation_filter_without_a_complete_row(spark):
    from voltweave.steps import CorrelationFilter

    halves = spark.createDataFrame([(float(i), None) if i % 2 else (None, float(i)) for i in range(10)], "a double, b double")
    assert CorrelationFilter(cols=["a", "b"]).fit(halves).transform(halves).columns == ["a", "b"]


def test_dictionary_of_many_levels(spark, tmp_path):
    """Nulls, new levels, clashing names and order as with a short list; saved steps find their dictionary."""
    from pyspark.ml import PipelineModel

    from voltweave.steps import DummyEncode, IntegerEncode, LevelOrder

    known = [(i, None if i % 5 == 0 else f"s{i * 7 % 60:03d}", "é" if i % 2 else "z", i) for i in range(300)]
    df = spark.createDataFrame(known, "id int, a string, b string, code int")
    new = spark.createDataFrame([(1, "s001", "é", 2), (2, "new", None, 3), (3, None, "a", 4)], "id int, a string, b string, code int")
    for frame in (df, new):
        made = [sorted(map(tuple, IntegerEncode(cols=["a", "b"], inline=n).fit(df).transform(frame).collect()), key=repr) for n in (1, 500)]
        assert made[0] == made[1] and len(made[0]) == frame.count()
    fitted = IntegerEncode(cols=["a"], inline=1).fit(df)
    PipelineModel([fitted]).save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(new)
    assert again.columns == new.columns and [r["a"] for r in again.orderBy("id").collect()] == [2 if "s000" in {r[1] for r in known} else 1, 0, None]
    ordered = LevelOrder(cols=["b"], inline=1).fit(df).transform(df)
    assert len(DummyEncode(cols=["b"]).fit(ordered).transform(ordered).columns) == 4
    with pytest.raises(ValueError):
        DummyEncode(cols=["a"], max_levels=10).fit(df)
