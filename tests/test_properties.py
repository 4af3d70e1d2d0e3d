"""Properties of the results that SQL cannot state, and independence from partitioning."""

import math
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from checks.tables import readings, sites, test as scoring, train
from voltweave.functions.geodesic import vincenty
from voltweave.functions.normal import normal_quantile
from voltweave.models import specs, tune
from voltweave.models.resample import fit_resamples, last_fit
from voltweave.models.specs import Workflow
from voltweave.operators import clustering, order, quantiles, sampling, spatial, stats, user_aggregates, windows
from voltweave.operators import ranks as ranks_of
from voltweave.plans import recipes, tables
from voltweave.sources import stage
from voltweave.steps import CorrelationFilter, NaturalSpline, YeoJohnson
from voltweave.steps.base import sel
from voltweave.steps.numeric import correlation_matrix, likelihoods
from voltweave.steps.spline import natural_basis, periodic_basis


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return stage(train(spark, sf_dir), "train")


# --- site grouping -------------------------------------------------------------------------------

def one_at_a_time(points, k, linkage):
    """Groups (sets of positions) left after merging the cheapest pair again and again; equal costs by member order."""
    points = sorted(set(points))
    place = {p: (i + 1) * clustering.MIXER % clustering.MODULUS if linkage == "ward" else i for i, p in enumerate(points)}
    groups = {place[p]: [p] for p in points}

    def cost(a, b):
        a, b = (np.round(np.array(groups[g]) * clustering.SCALE) for g in (a, b))
        if linkage == "single":
            gaps = [(float(clustering.comparable(((p - q) ** 2).sum())), *sorted((place[tuple(p / clustering.SCALE)], place[tuple(q / clustering.SCALE)])))
                    for p in a for q in b]
            return min(gaps)
        gap = ((a.sum(axis=0) / len(a) - b.sum(axis=0) / len(b)) ** 2).sum()
        return (float(clustering.comparable(gap * (len(a) * len(b) / (len(a) + len(b))))),)

    costs = {(a, b): (*cost(a, b), a, b) for a in groups for b in groups if a < b}
    while len(groups) > k:
        a, b = min(costs, key=costs.get)
        groups[a] += groups.pop(b)
        costs = {pair: c for pair, c in costs.items() if b not in pair and a not in pair}
        costs |= {(min(a, g), max(a, g)): (*cost(min(a, g), max(a, g)), min(a, g), max(a, g)) for g in groups if g != a}
    return {frozenset(g) for g in groups.values()}


def made_groups(rows, name):
    found = {}
    for r in rows:
        found.setdefault(r[name], set()).add((r["LAT"], r["LON"]))
    assert sorted(found) == list(range(1, len(found) + 1))
    assert [min(found[g]) for g in sorted(found)] == sorted(map(min, found.values()))
    return {frozenset(g) for g in found.values()}


def point_sets():
    rng = np.random.default_rng(5)
    lattice = [(float(x), float(y)) for x in range(11) for y in range(9)]
    blobs = [tuple(np.round(rng.normal(size=2) * s + c, 3)) for c, s in (((0, 0), 1), ((9, 9), 0.01), ((-40, 3), 4)) for _ in range(40)]
    return {"lattice": lattice, "blobs": [(float(x), float(y)) for x, y in blobs], "line": [(1.0, i * i / 8) for i in range(60)]}


@pytest.mark.parametrize("linkage", ["ward", "single"])
@pytest.mark.parametrize("kind", ["lattice", "blobs", "line"])
def test_clustering_equals_one_at_a_time(spark, linkage, kind):
    """Ties, dense spots and outliers, points on a line: on many tiles as on one, whatever the partitioning."""
    points = point_sets()[kind]
    expected = one_at_a_time(points, 6, linkage)
    df = spark.createDataFrame([*points, *points[:9], (None, 1.0)], "LAT double, LON double")
    for tile, partitions in ((25, 7), (1000, 1)):
        rows = spatial.geo_cluster(df.repartition(partitions), 6, linkage, name="g", tile=tile).collect()
        assert len(rows) == len(set(points)) and made_groups(rows, "g") == expected


def test_clusters_do_not_depend_on_partitions(spark, sf_dir):
    places = sites(spark, sf_dir).select("LAT", "LON")
    for linkage in ("ward", "single"):
        found = [sorted(map(tuple, spatial.geo_cluster(places.repartition(n), linkage=linkage, tile=t).collect()))
                 for n, t in ((1, 512), (4, 40), (64, 60))]
        assert found[0] == found[1] == found[2] and len(found[0]) == 150


def test_clustering_of_few_or_no_points(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0), (1.0, 2.0)], "LAT double, LON double")
    for linkage in ("ward", "single"):
        assert sorted(map(tuple, spatial.geo_cluster(df, 10, linkage).collect())) == [(1.0, 2.0, 1), (3.0, 2.0, 2)]
        assert spatial.geo_cluster(df, 1, linkage).select("Geo_Group").distinct().count() == 1
        assert spatial.geo_cluster(df.limit(0), 10, linkage).count() == 0


# --- statistics ----------------------------------------------------------------------------------

def test_student_probabilities():
    # published two-sided values of the t table
    assert stats.student_p(np.array([2.228, 1.96, 12.706]), np.array([10.0, 1e7, 1.0])) == pytest.approx(
        [0.05, 0.05, 0.05], abs=2e-4)
    assert stats.student_p(np.array([0.0]), np.array([5.0]))[0] == pytest.approx(1.0)


def test_normal_quantiles(spark):
    probs = [1e-12, 0.001, 0.02, 0.3, 0.5, 0.9, 0.99999]
    df = spark.createDataFrame([(p,) for p in probs], "p double").select("p", normal_quantile(F.col("p")).alias("z"))
    for row in df.collect():
        assert row["z"] == pytest.approx(statistics.NormalDist().inv_cdf(row["p"]), abs=1e-9)


def test_density_integrates_to_one(spark, sf_dir):
    made = stats.density(readings(spark, sf_dir, False), "V_5", "dataset").orderBy("dataset", "x").toPandas()
    for _, part in made.groupby("dataset"):
        assert len(part) == 512
        assert np.trapezoid(part["density"], part["x"]) == pytest.approx(1.0, abs=2e-3)


def test_qq_points_are_ordered(spark, rows):
    made = stats.qq_points(rows, "POWER").orderBy("sample").toPandas()
    assert made["theoretical"].is_monotonic_increasing
    assert made["theoretical"].iloc[0] == pytest.approx(-made["theoretical"].iloc[-1])


def test_ellipsoidal_distance_is_near_the_sphere():
    lat, lon = np.array([0.0, 31.2304, -33.9]), np.array([0.0, 121.4737, 18.4])
    metres = vincenty(lat, lon, 31.2304, 121.4737)
    assert metres[1] == pytest.approx(0.0, abs=1e-6)
    cosine = np.sin(np.radians(lat)) * math.sin(math.radians(31.2304)) + np.cos(np.radians(lat)) * math.cos(
        math.radians(31.2304)) * np.cos(np.radians(lon - 121.4737))
    assert metres[[0, 2]] == pytest.approx(6371000 * np.arccos(cosine[[0, 2]]), rel=6e-3)
    # a degree of longitude on the equator
    assert vincenty(np.array([0.0]), np.array([0.0]), 0.0, 1.0)[0] == pytest.approx(111319.491, abs=1e-2)


# --- learned steps -------------------------------------------------------------------------------

def test_power_transform_maximises_the_likelihood(spark, rows):
    fitted = YeoJohnson(col="V_8").fit(rows)
    best = fitted.learned()["lambda"]
    here, *near = likelihoods(rows, "V_8", [best, best - 0.05, best + 0.05, 1.0])
    assert all(here >= value for value in near)
    summary = fitted.transform(rows).agg(F.avg("V_8"), F.stddev_samp("V_8")).first()
    assert tuple(summary) == (pytest.approx(0.0, abs=1e-9), pytest.approx(1.0))


def test_natural_spline_spans_lines_and_has_linear_tails():
    x = np.arange(1, 367, dtype=float)
    basis = natural_basis(x, [50.0, 120.0, 200.0, 300.0], 20.0, 340.0)
    assert basis.shape == (366, 5)
    design = np.column_stack([np.ones(366), basis])
    for target in (x, np.ones(366)):
        fit = design @ np.linalg.lstsq(design, target, rcond=None)[0]
        assert fit == pytest.approx(target, abs=1e-6)
    second = np.diff(basis, 2, axis=0)
    assert np.abs(second[:17]).max() < 1e-9 and np.abs(second[-25:]).max() < 1e-9


def test_natural_spline_is_a_cubic_between_knots():
    x = np.linspace(20, 340, 1000)
    knots = [100.0, 180.0, 260.0]
    design = np.column_stack([np.ones(1000), natural_basis(x, knots, 20.0, 340.0)])

    def truncated(k):  # textbook natural cubic functions
        def d(j):
            return (np.maximum(x - j, 0) ** 3 - np.maximum(x - 340, 0) ** 3) / (340 - j)
        return d(k) - d(260.0)

    for k in (20.0, 100.0, 180.0):
        target = truncated(k)
        fit = design @ np.linalg.lstsq(design, target, rcond=None)[0]
        assert np.abs(fit - target).max() < 1e-6 * np.abs(target).max()


def test_natural_spline_expression_is_the_basis_for_any_value(spark, rows):
    dated = rows.select("ID", F.dayofyear("DATE").alias("DATE_doy"))
    fitted = NaturalSpline("DATE_doy", 12).fit(dated)
    state = fitted.learned()
    values = [-50, 1, 77, 366, 380, 5000]
    for kind in ("int", "double"):
        given = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "ID long, v int").select("ID", F.col("v").cast(kind).alias("DATE_doy"))
        got = fitted.transform(given).orderBy("ID").toPandas().drop(columns="ID").to_numpy()
        assert got.shape == (6, 12)
        assert np.allclose(got, natural_basis(np.array(values, dtype=float), state["interior"], state["low"], state["high"]))
    empty = fitted.transform(spark.createDataFrame([(1, None), (2, float("nan"))], "ID long, DATE_doy double")).collect()
    assert all(v is None for row in empty for v in row[1:])


@pytest.mark.parametrize("width", [16, 17])
def test_nan_is_missing_at_every_width(spark, width):
    from voltweave.operators.moments import moments

    frame = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double").selectExpr(*[f"x AS c{i}" for i in range(width)])
    found = moments(frame, frame.columns)
    assert len(found) == width and all((n, m) == (2, 2.0) and sd == pytest.approx(2**0.5) for n, m, sd in found.values())


def test_many_levels_make_a_plan_of_linear_size(spark):
    from voltweave.steps import DummyEncode

    frame = spark.createDataFrame([(f"l{i:03d}",) for i in range(300)] + [(None,)], "lab string")
    fitted = DummyEncode(cols=["lab"]).fit(frame)
    out = fitted.transform(frame)
    sums = out.agg(*[F.sum(c).alias(c) for c in out.columns]).first()
    assert len(out.columns) == 299 and set(sums) == {1}
    assert out.where("lab_l001 IS NULL").count() == 1
    with pytest.raises(ValueError):
        DummyEncode(cols=["lab"], max_levels=200).fit(frame)


def test_stop_round_follows_patience():
    from voltweave.models.specs import stop_round

    errors = [5.0, 4.0, 4.5, 4.4, 3.0, 3.1, 3.2, 3.3, 2.0]
    assert [stop_round(errors, k) for k in (1, 2, 3, 4, 100)] == [2, 2, 5, 9, 9]


def test_periodic_spline_repeats_and_sums_to_one():
    days = np.arange(1, 31, dtype=float)
    basis = periodic_basis(days, 30, 60)
    assert basis.sum(axis=1) == pytest.approx(np.ones(30))
    assert periodic_basis(days + 30, 30, 60) == pytest.approx(basis)


def test_correlation_filter_leaves_no_strong_pair(spark, rows):
    wide = rows.withColumns({"a": F.col("V_5") * 2 + 1, "b": F.exp(F.col("V_8") / 5)})
    kept = CorrelationFilter(cols=[sel.regex("^V_|^a$|^b$")], threshold=0.9).fit(wide).transform(wide)
    names = [c for c in kept.columns if c.startswith(("V_", "a", "b"))]
    data = kept.select(*names).dropna().toPandas()
    ranks = data.rank().corr().abs().to_numpy()
    np.fill_diagonal(ranks, 0)
    assert np.nanmax(ranks) <= 0.9 + 1e-9
    assert len({"V_5", "V_8", "a", "b"} & set(names)) == 1


def test_fitted_steps_can_be_saved(spark, sf_dir, rows, tmp_path):
    fitted = recipes.recipe("rec_v1", rows).fit(rows)
    path = str(tmp_path / "steps")
    fitted.model().save(path)
    again = PipelineModel.load(path).transform(scoring(spark, sf_dir))
    first = fitted.transform(scoring(spark, sf_dir))
    assert again.columns == first.columns
    assert again.exceptAll(first).count() == 0


# --- recipes -------------------------------------------------------------------------------------

def test_all_recipes_can_be_specified(spark, sf_dir, rows):
    scored = stage(scoring(spark, sf_dir), "test")
    joined = {0: rows, 1: tables.feature_tables_v1(rows, scored)[0], 2: tables.feature_tables_v2(rows, scored)[0],
              3: tables.feature_tables_v3(rows, scored)[0]}
    assert len(recipes.RECIPES) == 75
    for name in recipes.RECIPES:
        spec = recipes.recipe(name, joined[recipes.table_of(name)])
        assert spec.roles["ID"] == "id variable" and spec.roles["POWER"] == "outcome"


def predictors(name, df):
    return recipes.recipe(name, df).fit(df).predictors


def test_role_quirks_of_the_recipes(spark, sf_dir, rows):
    joined = stage(tables.feature_tables_v1(rows, scoring(spark, sf_dir))[0], "v1")
    base, mean = predictors("rec_v3_base", joined), predictors("rec_v3_mean", joined)
    assert base == mean and "POWER_mean" in base and "Geo_Group_X2" in base
    assert not [name for name in base if name.startswith("POWER_mean_")]
    assert not [name for name in predictors("rec_v5", joined) if name.startswith("Geo_Group")]
    assert "POWER_mean_lag_1" in predictors("rec_v3_lag_1", joined)


def test_friday_counts_as_no_weekday_in_the_seventh_version(spark, sf_dir, rows):
    joined = stage(tables.feature_tables_v1(rows, scoring(spark, sf_dir))[0], "v1")
    made = recipes.recipe("rec_v7", joined).fit(joined).training_result
    found = {r["DATE_dow"]: r["iswweekday"] for r in made.select("DATE_dow", "iswweekday").distinct().collect()}
    assert found == {1: 0, 2: 1, 3: 1, 4: 1, 5: 1, 6: 0, 7: 0}


# --- splits, order and partitioning --------------------------------------------------------------

def test_split_and_folds_are_balanced_and_disjoint(spark, rows):
    split = sampling.initial_split(rows).join(sampling.strata(rows, "POWER").select("ID", "stratum"), "ID")
    for row in split.groupBy("stratum").agg(F.avg("is_train").alias("share")).collect():
        assert row["share"] == pytest.approx(0.75, abs=0.01)
    assert sampling.training(sampling.initial_split(rows)).join(
        sampling.testing(sampling.initial_split(rows)), "ID", "left_semi").count() == 0
    folds = sampling.vfold(rows).join(sampling.strata(rows, "POWER").select("ID", "stratum"), "ID")
    sizes = [r["count"] for r in folds.groupBy("stratum", "fold").count().collect()]
    assert len(sizes) == 40 and max(sizes) - min(sizes) <= 2


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_results_do_not_depend_on_partitioning(spark, rows, parts):
    moved = rows.repartition(parts)
    assert sampling.initial_split(moved).select("ID", "is_train").exceptAll(
        sampling.initial_split(rows).select("ID", "is_train")).count() == 0
    assert sampling.kfold(moved).select("ID", "fold").exceptAll(sampling.kfold(rows).select("ID", "fold")).count() == 0
    assert order.row_index(moved.select("ID", "DATE"), ["DATE", "ID"]).exceptAll(
        order.row_index(rows.select("ID", "DATE"), ["DATE", "ID"])).count() == 0
    cut = windows.trailing_roll(moved.select("ID", "SOT", "DATE", "V_5"), ["V_5"], 3, ["DATE", "ID"], ["SOT"], chunk_rows=100)
    whole = windows.trailing_roll(rows.select("ID", "SOT", "DATE", "V_5"), ["V_5"], 3, ["DATE", "ID"], ["SOT"])
    digits = F.round("roll_mean_3_V_5", 6)
    assert cut.select("ID", digits).exceptAll(whole.select("ID", digits)).count() == 0


# --- models --------------------------------------------------------------------------------------

def test_penalties_shrink_and_select(spark, rows):
    spec = recipes.recipe("rec_base", rows)
    free = np.abs(Workflow(spec, specs.linear()).fit(rows).model.coefficients.toArray()).sum()
    held = np.abs(Workflow(spec, specs.ridge(50.0)).fit(rows).model.coefficients.toArray()).sum()
    sparse = Workflow(spec, specs.lasso(8.0)).fit(rows).model.coefficients.toArray()
    assert held < free and (sparse == 0).any()


def test_trees_learn_and_report_importance(spark, rows):
    signal = rows.withColumn("POWER", F.col("V_5") / 100 + F.when(F.col("V_1").isNull(), 500.0).otherwise(0.0))
    flow = Workflow(recipes.recipe("rec_base", signal), specs.boosted_trees(trees=5, tree_depth=4))
    fitted = flow.fit(signal)
    scored = fitted.predict(signal)
    assert scored.agg(F.corr("POWER", "pred")).first()[0] > 0.98
    top = {r["feature"] for r in specs.feature_importance(fitted).where("rank <= 3").collect()}
    assert top & {"V_5", "V_8"}


def test_out_of_fold_predictions_cover_every_row_once(spark, rows):
    folded = sampling.kfold(rows, 3)
    flow = Workflow(recipes.recipe("rec_base", rows), specs.linear())
    oof = fit_resamples({"lm": flow}, folded)
    assert oof.count() == rows.count() == oof.select("ID").distinct().count()


def test_daily_means_can_be_refitted_within_a_fold(spark, sf_dir, rows):
    joined, _ = tables.feature_tables_v1(rows, scoring(spark, sf_dir))
    folded = sampling.kfold(joined, 3)
    flow = Workflow(recipes.recipe("rec_v3_mean", joined), specs.linear())
    oof = fit_resamples({"lm": flow}, folded, within_fold=tables.daily_within_fold)
    assert oof.count() == rows.count()


def test_search_stops_and_finds_settings_in_range(spark, rows):
    folded = sampling.kfold(rows, 2)
    flow = Workflow(recipes.recipe("rec_base", rows), specs.ridge())
    ranges = tune.param_ranges(flow)
    history, best = tune.tune_search(flow, folded, ranges, initial=3, iterations=4, no_improve=1)
    assert 1e-10 <= best["penalty"] <= 1.0
    assert history.where("round = 0").count() == 3 and history.count() <= 7


def test_spline_degrees_can_be_tuned(spark, sf_dir, rows):
    joined, _ = tables.feature_tables_v3(rows, stage(scoring(spark, sf_dir), "test"))
    folded = sampling.kfold(joined, 2)
    flow = Workflow(recipes.recipe("rec_v12_final_tune_spline", joined), specs.linear())
    assert flow.tuned_settings() == ["df"]
    grid = tune.grid_regular({"df": tune.Range(3, 9, whole=True)}, 2)
    results = tune.tune_grid(flow, folded, grid)
    assert results.count() == 2 and tune.best_settings(results, grid)["df"] in (3, 9)


def test_grid_levels_and_predictor_bound(spark, rows):
    assert tune.Range(1, 360, whole=True).levels(120)[0] == 1
    assert len(tune.Range(1, 360, whole=True).levels(120)) == 120
    flow = Workflow(recipes.recipe("rec_base", rows), specs.boosted_tune())
    assert tune.param_ranges(flow, rows)["mtry"].high == len(flow.features.fit(rows).predictors)


def test_submission_keeps_rows_and_replaces_the_outcome(spark, sf_dir, rows):
    scored = stage(scoring(spark, sf_dir), "test")
    template = scored.select("ID", F.lit(0.0).alias("POWER"))
    flow = Workflow(recipes.recipe("rec_base", rows), specs.boosted_trees(trees=2, tree_depth=3))
    scores, result, _ = tune.fit_all_and_submit(flow, sampling.initial_split(rows), rows, scored, template)
    assert result.columns == ["ID", "POWER"] and result.count() == template.count()
    assert result.where("POWER IS NULL OR POWER = 0").count() == 0
    assert {r["metric"] for r in scores.collect()} == {"rmse", "mae", "mape", "mpe", "rsq"}
    _, holdout, _ = last_fit(flow, sampling.initial_split(rows))
    assert 0 < holdout.count() < rows.count()


def test_a_set_of_workflows_is_mapped_with_own_points(spark, rows):
    from voltweave.models import specs, tune
    from voltweave.operators.sampling import vfold
    from voltweave.steps.spec import FeatureSpec

    train_rows = rows.where("POWER IS NOT NULL").select("ID", "V_5", "V_13", "POWER")
    spec = FeatureSpec.on(train_rows).role("id variable", "ID").role("outcome", "POWER").role("predictor", "V_5", "V_13")
    flows = {"plain": specs.Workflow(spec, specs.linear()), "lasso": specs.Workflow(spec, specs.lasso()), "ridge": specs.Workflow(spec, specs.ridge())}
    folds = vfold(train_rows, 3)
    grids = {"lasso": [{"penalty": 0.1}, {"penalty": 10.0}], "ridge": [{"penalty": 1.0}]}
    got = tune.workflow_map(flows, folds, "grid", grids).collect()
    assert sorted((r["wflow_id"], r["settings"]) for r in got) == [
        ("lasso", "penalty=0.1"), ("lasso", "penalty=10"), ("plain", ""), ("ridge", "penalty=1")]
    assert all(r["n"] == 3 and r["mean"] > 0 for r in got)


# --- quantiles and ranks -------------------------------------------------------------------------

@pytest.mark.parametrize("by", [None, ["g"]])
def test_brackets_are_narrowed_to_a_fixed_bound(spark, by):
    """Heavy tails, long ties, nulls, extreme sizes: as numpy, with hardly any values left to rank."""
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.pareto(0.3, 3000), -rng.pareto(0.3, 500), np.full(2000, 3.25), [1e300, -1e300, 0.0]])
    groups = rng.integers(0, 3, len(values))
    rows = [(int(g), float(x), float(i) if i % 3 else None) for i, (g, x) in enumerate(zip(groups, values))]
    df = spark.createDataFrame(rows, "g int, a double, b double")
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = quantiles.quantiles_long(df, ["a", "b"], probs, by, accuracy=100, most=20).collect()
    assert len(got) == 10 * (3 if by else 1)
    for r in got:
        own = [(x if r["variable"] == "a" else y) for g, x, y in rows if not by or g == r["g"]]
        own = [x for x in own if x is not None]
        assert r["n"] == len(own)
        assert r["value"] == pytest.approx(float(np.quantile(own, r["prob"])), rel=1e-9)


def test_tied_ranks_and_pairs_of_half_filled_columns(spark):
    rng = np.random.default_rng(8)
    a = rng.integers(0, 9, 400).astype(float)
    data = {"a": a, "b": a**3 - 5, "c": rng.normal(size=400), "d": -a, "e": np.full(400, 2.0)}
    rows = [tuple(None if (k == 1 and i % 2) or (k == 3 and i % 5 == 0) else float("nan") if k == 2 and i == 7 else float(col[i])
                  for k, col in enumerate(data.values())) for i in range(400)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data))
    frame = pd.DataFrame(rows, columns=list(data)).astype(float)
    ranks = frame.rank()
    got = ranks_of.tied_ranks(df.repartition(7), ["a", "b", "c"]).toPandas()
    for c in got:
        assert sorted(got[c].dropna()) == sorted(ranks[c].dropna())
    matrix = np.array(correlation_matrix(df, list(data)))
    expected = ranks.corr().to_numpy()
    for i in range(5):
        for j in range(5):
            assert i == j or (np.isnan(matrix[i, j]) if "e" in (list(data)[i], list(data)[j]) else matrix[i, j] == pytest.approx(expected[i, j], abs=1e-9))
    kept = CorrelationFilter(cols=list(data), threshold=0.9).fit(df).transform(df).columns
    assert len({"a", "b", "d"} & set(kept)) == 1 and {"c", "e"} <= set(kept)


def test_filter_drops_equal_columns_without_a_complete_row(spark):
    rows = [(float(i % 17), float(i % 17), float(i) if i % 2 else None, None if i % 2 else float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    kept = CorrelationFilter(cols=["a", "b", "c", "d"], threshold=0.9).fit(df).transform(df).columns
    assert len({"a", "b"} & set(kept)) == 1 and {"c", "d"} <= set(kept)


def test_hash_cuts_by_radix_passes(spark):
    """Any number of passes finds the same cuts as sorting: crowded leading bits, repeated hashes, small strata."""
    rng = np.random.default_rng(3)
    hashes = np.concatenate([rng.integers(0, 1 << 52, 3000), rng.integers(0, 1 << 20, 500), np.full(40, 77), [(1 << 52) - 1]])
    rows = [(int(h), int(i % 7 == 0) + 5 * int(i == 3)) for i, h in enumerate(hashes)]
    df = spark.createDataFrame(rows, "hash long, stratum int")
    probs = [0.0, 0.1, 1 / 3, 0.5, 0.9, 1.0]
    expected = {s: [float(sorted(h for h, t in rows if t == s)[int(p * (sum(t == s for _, t in rows) - 1))]) for p in probs] for s in {t for _, t in rows}}
    for few in (1, 4, 10_000):
        assert sampling.hash_cuts(df, probs, few) == expected
    assert sampling.hash_cuts(df.limit(0), probs) == {}


# --- user aggregates, early stop -----------------------------------------------------------------

def test_user_aggregates_are_mergeable(spark, monkeypatch):
    """Null keys and values, groups spread over tasks and sent more than once, no group, no row."""
    monkeypatch.setattr(user_aggregates, "GROUPS_HELD", 2)
    rng = np.random.default_rng(4)
    rows = [(None if i % 7 == 0 else f"k{i % 5}", int(i % 2), None if i % 11 == 0 else float("nan") if i % 13 == 0 else float(rng.gamma(1.0))) for i in range(500)]
    rows += [("only nulls", 1, None), ("constant", 0, 2.0), ("constant", 0, 2.0)]
    df = spark.createDataFrame(rows, "k string, i int, x double")
    made = {"skew": user_aggregates.skewness(), "second": user_aggregates.nth_largest(2)}

    def expected(values):
        x = np.array([v for v in values if v is not None and not math.isnan(v)])
        d = x - x.mean() if len(x) else x
        skew = math.sqrt(len(x)) * (d**3).sum() / (d**2).sum() ** 1.5 if len(x) and (d**2).sum() > 0 else None
        return skew, sorted(x)[-2] if len(x) > 1 else None

    for frame in (df.repartition(7), df.coalesce(1)):
        got = {(r["k"], r["i"]): (r["x_skew"], r["x_second"]) for r in user_aggregates.user_aggregate(frame, ["k", "i"], ["x"], made).collect()}
        assert set(got) == {(k, i) for k, i, _ in rows}
        for (k, i), (skew, second) in got.items():
            wanted = expected([x for a, b, x in rows if (a, b) == (k, i)])
            assert second == wanted[1] and (skew == wanted[0] or skew == pytest.approx(wanted[0], abs=1e-9))
    whole = user_aggregates.user_aggregate(df, [], ["x"], made).collect()
    assert len(whole) == 1 and whole[0]["x_skew"] == pytest.approx(expected([x for *_, x in rows])[0])
    assert user_aggregates.user_aggregate(df.limit(0), ["k"], ["x"], made).count() == 0
    assert [tuple(r) for r in user_aggregates.user_aggregate(df.limit(0), [], ["x"], made).collect()] == [(None, None)]


def test_boosting_stops_by_patience(spark, sf_dir, rows):
    flow = Workflow(recipes.recipe("rec_base", rows), specs.boosted_trees(trees=12, tree_depth=4, learn_rate=1.0, stop_after=2))
    fitted = flow.fit(rows)
    assert fitted.model.getNumTrees < 12
    assert specs.stop_round([5.0, 3.0, 4.0, 3.5, 1.0], 2) == 2 and specs.stop_round([5.0, 3.0, 4.0, 2.0], 2) == 4
