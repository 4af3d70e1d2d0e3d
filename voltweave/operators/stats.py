"""The tables behind the charts: correlations, histograms, densities, quartile boxes, profiles."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from voltweave.functions.normal import normal_quantile
from voltweave.functions.sql import literal, quoted, text_literal
from voltweave.operators.aggregates import daily_mean, daily_median
from voltweave.operators.columns import numeric_columns
from voltweave.operators.joins import natural_left_join
from voltweave.operators.order import row_index
from voltweave.operators.quantiles import quantile_values, quantiles, quantiles_long
from voltweave.sources.staging import stage


# --- correlation ---------------------------------------------------------------------------------

def student_p(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Two-sided Student t probability, by the continued fraction of the incomplete beta function."""
    t, df = np.asarray(t, dtype=float), np.asarray(df, dtype=float)
    x = df / (df + t * t)
    a, b = df / 2, np.full_like(df, 0.5)
    swap = x >= (a + 1) / (a + b + 2)
    a, b, x = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    gamma = np.vectorize(math.lgamma, otypes=[float])
    with np.errstate(all="ignore"):
        front = np.exp(gamma(a + b) - gamma(a) - gamma(b) + a * np.log(x) + b * np.log1p(-x)) / a
        tiny = 1e-300
        c, d = np.ones_like(x), 1 - (a + b) * x / (a + 1)
        d = 1 / np.where(np.abs(d) < tiny, tiny, d)
        h = d.copy()
        for m in range(1, 300):
            for step in (
                m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
            ):
                d = 1 + step * d
                c = 1 + step / c
                d = 1 / np.where(np.abs(d) < tiny, tiny, d)
                c = np.where(np.abs(c) < tiny, tiny, c)
                h = h * d * c
        beta = front * h
    return np.clip(np.where(swap, 1 - beta, beta), 0.0, 1.0)


@F.pandas_udf(DoubleType())
def student_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(student_p(t.to_numpy(dtype=float), df.to_numpy(dtype=float)))


def pair_sums(df: DataFrame, cols: list[str]) -> DataFrame:
    """Sums over the rows where both columns are present, per ordered pair ``i, j``.

    Columns are shifted by their means first, which keeps the sums of products well conditioned.
    """
    centre = df.selectExpr(*[f"avg(double({quoted(name)})) AS x{i}" for i, name in enumerate(cols)]).first()
    shifted = df.selectExpr(*[
        f"double({quoted(name)}) - {literal(centre[i] or 0.0)} AS x{i}" for i, name in enumerate(cols)
    ])
    width = len(cols)
    schema = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"

    def reduce_rows(batches):
        total = np.zeros((4, width, width))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            here = (~np.isnan(x)).astype(float)
            x = np.where(here > 0, x, 0.0)
            total += np.stack([here.T @ here, x.T @ here, (x * x).T @ here, x.T @ x])
        i, j = (grid.ravel() for grid in np.indices((width, width)))
        n, sx, sxx, sxy = (part.ravel() for part in total)
        sy, syy = total[1].T.ravel(), total[2].T.ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype("int32")), pa.array(j.astype("int32")),
             *[pa.array(part) for part in (n, sx, sy, sxx, syy, sxy)]],
            names=["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"],
        )

    parts = shifted.mapInArrow(reduce_rows, schema)
    return parts.groupBy("i", "j").agg(*[
        F.sum(name).alias(name) for name in ("n", "sx", "sy", "sxx", "syy", "sxy")
    ])


def correlation_table(df: DataFrame, cols: list[str] | None = None, p_adjust: str = "bonferroni") -> DataFrame:
    """Pearson r of all ordered pairs (self pairs included), with n, t and adjusted p.

    Each pair uses the rows where both columns are present. Every task reduces its rows to one
    matrix of pair sums, so the shuffle carries one row per pair and task. The probabilities are
    computed on the result, which has one row per pair.
    """
    if p_adjust not in ("bonferroni", "none"):
        raise ValueError(f"unknown adjustment {p_adjust!r}")
    cols = cols or numeric_columns(df)
    width = len(cols)
    sums = pair_sums(df, cols)
    mean_i, mean_j = F.try_divide("sx", "n"), F.try_divide("sy", "n")
    var_i, var_j = F.col("sxx") - F.col("sx") * mean_i, F.col("syy") - F.col("sy") * mean_j
    r = F.try_divide(F.col("sxy") - F.col("sx") * mean_j, F.sqrt(var_i) * F.sqrt(var_j))
    name = F.array(*[F.lit(col) for col in cols])
    table = sums.select(
        F.element_at(name, F.col("i") + 1).alias("Parameter1"),
        F.element_at(name, F.col("j") + 1).alias("Parameter2"),
        F.when(F.col("i") == F.col("j"), 1.0).when(
            r.isNotNull(), F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0))
        ).alias("r"),
        F.col("n").cast("long").alias("n_Obs"),
    )
    dof = (F.col("n_Obs") - 2).cast("double")
    t = F.try_divide(F.col("r") * F.sqrt(dof), F.sqrt(F.lit(1.0) - F.col("r") * F.col("r")))
    scored = table.select(
        "*", F.when(dof > 0, dof).alias("df_error"), F.when(F.abs("r") < 1, t).alias("t")
    )
    raw = F.when(F.abs("r") >= 1, 0.0).when(F.col("t").isNotNull(), student_p_value("t", "df_error"))
    factor = width * (width - 1) // 2 if p_adjust == "bonferroni" else 1
    return scored.withColumn("p", F.least(raw * F.lit(float(max(factor, 1))), F.lit(1.0)))


# --- histograms and densities --------------------------------------------------------------------

def _value_range(df: DataFrame, col: str) -> tuple[float, float] | None:
    row = df.agg(F.min(col).cast("double"), F.max(col).cast("double")).first()
    return None if row[0] is None else (row[0], row[1])


def histogram(df: DataFrame, col: str, bins: int = 30, by: str | None = None) -> DataFrame:
    """Count and density per equal-width bin over the common range; density is per ``by`` group."""
    ends = _value_range(df, col)
    low, high = ends if ends else (0.0, 0.0)
    width = (high - low) / bins or 1.0
    groups = [by] if by else []
    bin_no = F.least(F.floor((F.col(col) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.where(F.col(col).isNotNull()).groupBy(*groups, bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # After the count there are at most ``bins`` rows per group.
    total = F.sum("n").over(Window.partitionBy(*groups))
    return counts.select(
        *groups,
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("x_min"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("x_max"),
        "n",
        (F.col("n") / (total * F.lit(width))).alias("density"),
    )


def bandwidth(n: Column, sd: Column, iqr: Column) -> Column:
    """Rule-of-thumb kernel width: 0.9 * min(sd, IQR/1.34) * n^(-1/5)."""
    spread = F.least(sd, iqr / F.lit(1.34))
    usable = F.when(spread > 0, spread).when(sd > 0, sd).otherwise(F.lit(1.0))
    return F.lit(0.9) * usable * F.pow(n.cast("double"), F.lit(-0.2))


def density(df: DataFrame, col: str, by: str | None = None, points: int = 512) -> DataFrame:
    """Gaussian kernel density on a regular grid three bandwidths beyond each group's range.

    Values are first split linearly between their two neighbours on the grid (one aggregation, at
    most ``points`` rows per group); the kernel is then summed over the grid weights.
    """
    groups = [by] if by else []
    base = df.where(F.col(col).isNotNull()).select(*groups, F.col(col).cast("double").alias("x"))
    summary = base.groupBy(*groups).agg(
        F.count("x").alias("n"), F.stddev_samp("x").alias("sd"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    quartiles = quantiles(base, ["x"], {"q1": 0.25, "q3": 0.75}, groups)
    width = bandwidth(F.col("n"), F.coalesce("sd", F.lit(0.0)), F.col("x_q3") - F.col("x_q1"))
    if groups:
        described = natural_left_join(summary, quartiles, groups)
    else:
        learned = quartiles.first().asDict()
        described = summary.withColumns({name: F.lit(v).cast("double") for name, v in learned.items()})
    grid = described.withColumn("bw", width).select(
        *groups, "n", "bw", (F.col("low") - 3 * F.col("bw")).alias("start"),
        ((F.col("high") - F.col("low") + 6 * F.col("bw")) / F.lit(points - 1)).alias("step"),
    )
    if groups:
        placed = natural_left_join(base, stage(grid, "grid"), groups)
    else:
        row = grid.first()
        placed = base.withColumns({name: F.lit(row[name]) for name in ("n", "bw", "start", "step")}) if row else None
        if placed is None:
            return df.sparkSession.createDataFrame([], "x double, density double")
    offset = (F.col("x") - F.col("start")) / F.col("step")
    left = F.floor(offset).cast("int")
    share = offset - left
    halves = F.array(
        F.struct(left.alias("i"), (F.lit(1.0) - share).alias("w")), F.struct((left + 1).alias("i"), share.alias("w"))
    )
    keys = [*groups, "n", "bw", "start", "step"]
    weights = placed.select(*keys, F.explode(halves).alias("h")).groupBy(*keys, "h.i").agg(F.sum("h.w").alias("w"))
    # At most ``points`` weights per group: small enough to hold as one array.
    arrays = weights.groupBy(*keys).agg(F.collect_list(F.struct("i", "w")).alias("ws"))
    lines = arrays.select(*keys, "ws", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("g"))

    def add(acc: Column, item: Column) -> Column:
        z = (F.col("g") - item["i"]) * F.col("step") / F.col("bw")
        return acc + item["w"] * F.exp(F.lit(-0.5) * z * z)

    scale = F.col("n") * F.col("bw") * F.lit(math.sqrt(2 * math.pi))
    return lines.select(
        *groups,
        (F.col("start") + F.col("g") * F.col("step")).alias("x"),
        (F.aggregate("ws", F.lit(0.0), add) / scale).alias("density"),
    )


def log_axis(df: DataFrame, *cols: str) -> DataFrame:
    """The columns on a log10 axis; rows with a non-positive or null value drop out."""
    for name in cols:
        df = df.where(F.col(name) > 0)
    return df.withColumns({name: F.log10(name) for name in cols})


def box_stats(df: DataFrame, col: str, by: str | None = None) -> DataFrame:
    """Quartiles and whiskers (furthest values within 1.5 box lengths of the box)."""
    groups = [by] if by else []
    base = df.where(F.col(col).isNotNull()).select(*groups, F.col(col).cast("double").alias("x"))
    box = quantiles(base, ["x"], {"q1": 0.25, "median": 0.5, "q3": 0.75}, groups)
    if groups:
        placed = natural_left_join(base, stage(box, "box"), groups)
    else:
        learned = box.first().asDict()
        placed = base.withColumns({name: F.lit(v).cast("double") for name, v in learned.items()})
    reach = F.lit(1.5) * (F.col("x_q3") - F.col("x_q1"))
    inside = (F.col("x") >= F.col("x_q1") - reach) & (F.col("x") <= F.col("x_q3") + reach)
    return placed.groupBy(*groups, "x_q1", "x_median", "x_q3").agg(
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.sum((~inside).cast("long")).alias("n_outside"),
        F.count(F.lit(1)).alias("n"),
    ).withColumnsRenamed({"x_q1": "q1", "x_median": "median", "x_q3": "q3"})


def category_share(df: DataFrame, col: str, by: str) -> DataFrame:
    """Count per (category, group) and its share within the category; totals combine before they are joined back."""
    counts = stage(df.where(F.col(col).isNotNull()).groupBy(col, by).agg(F.count(F.lit(1)).alias("n")), "counts")
    totals = counts.groupBy(col).agg(F.sum("n").alias("__total"))
    return counts.join(totals, col).select(col, by, "n", (F.col("n") / F.col("__total")).alias("share"))


def trend(df: DataFrame, col: str = "POWER", date: str = "DATE") -> DataFrame:
    """Mean and median per date."""
    middle = daily_median(df, [col], date, names="median")
    return natural_left_join(daily_mean(df, [col], date, names="mean"), middle, [date])


def qq_points(df: DataFrame, col: str, key: str = "ID") -> DataFrame:
    """Sample value against normal quantile for every row, with the line through the quartiles."""
    base = df.where(F.col(col).isNotNull()).select(key, F.col(col).cast("double").alias("sample"))
    ranked = stage(row_index(base, ["sample", key], name="__row"), "ranked")
    n = ranked.count()
    shift = 0.5 if n > 10 else 0.375
    q1, q3 = quantile_values(base, "sample", [0.25, 0.75])
    points = ranked.withColumn(
        "theoretical", normal_quantile((F.col("__row") + 1 - F.lit(shift)) / F.lit(n + 1 - 2 * shift))
    )
    if not n:
        return points.select(key, "theoretical", "sample", F.lit(None).cast("double").alias("line"))
    z = 0.6744897501960817  # fixed value: normal upper quartile
    slope = (q3 - q1) / (2 * z)
    line = F.lit(q1 + slope * z) + F.lit(slope) * F.col("theoretical")
    return points.select(key, "theoretical", "sample", line.alias("line"))


# --- profiles ------------------------------------------------------------------------------------

def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row per numeric column: count, mean, std, min, quartiles (interpolated), max."""
    cols = cols or numeric_columns(df)
    rows = ", ".join(
        f"struct({text_literal(name)} AS variable, count({quoted(name)}) AS count, double(avg({quoted(name)})) AS mean, "
        f"double(stddev_samp({quoted(name)})) AS std, double(min({quoted(name)})) AS min, double(max({quoted(name)})) AS max)"
        for name in cols
    )
    base = df.selectExpr(f"array({rows}) AS r").selectExpr("inline(r)")
    return natural_left_join(base, quartile_rows(df, cols), ["variable"])


def quartile_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column with its three quartiles."""
    long = quantiles_long(df, cols, [0.25, 0.5, 0.75])
    return long.groupBy("variable").agg(*[
        F.expr(f"max(CASE WHEN prob = {p}D THEN value END) AS q{int(p * 100)}") for p in (0.25, 0.5, 0.75)
    ])


def profile(df: DataFrame, bins: int = 8) -> DataFrame:
    """Per column: missing, completeness and, by type, numeric summary with a small histogram, or
    text lengths, empties, blanks and distinct count."""
    numbers = numeric_columns(df)
    texts = [name for name, kind in df.dtypes if kind == "string"]
    cols = [name for name in df.columns if name in numbers or name in texts]
    n = F.count(F.lit(1))
    aggs: list[Column] = [n.alias("n_rows")]
    for i, name in enumerate(cols):
        c = F.col(name)
        aggs.append(F.count(c).alias(f"{i}_count"))
        if name in numbers:
            aggs += [F.avg(c).alias(f"{i}_mean"), F.stddev_samp(c).alias(f"{i}_sd"),
                     F.min(c).cast("double").alias(f"{i}_p0"), F.max(c).cast("double").alias(f"{i}_p100")]
        else:
            aggs += [F.min(F.length(c)).alias(f"{i}_min_length"), F.max(F.length(c)).alias(f"{i}_max_length"),
                     F.sum((c == "").cast("long")).alias(f"{i}_empty"),
                     F.sum(c.rlike(r"^\s+$").cast("long")).alias(f"{i}_whitespace")]
    summary = stage(df.agg(*aggs), "profile")

    def part(i: int, name: str, field: str, kind: str) -> Column:
        known = f"{i}_{field}" in summary.columns
        return (F.col(f"{i}_{field}") if known else F.lit(None)).cast(kind).alias(field)

    rows = F.array(*[
        F.struct(
            F.lit(name).alias("variable"),
            F.lit("numeric" if name in numbers else "character").alias("kind"),
            (F.col("n_rows") - F.col(f"{i}_count")).alias("n_missing"),
            (F.col(f"{i}_count") / F.col("n_rows")).alias("complete_rate"),
            *[part(i, name, field, "double") for field in ("mean", "sd", "p0", "p100")],
            *[part(i, name, field, "long") for field in ("min_length", "max_length", "empty", "whitespace")],
        )
        for i, name in enumerate(cols)
    ])
    base = summary.select(F.explode(rows).alias("r")).select("r.*")
    # Distinct counts: one row per distinct (column, value), so a frequent value is combined first.
    # Texts travel as their SHA-256, which keeps long ones out of the shuffle.
    distinct = (
        df.select(F.explode(F.array(*[
            F.struct(F.lit(name).alias("variable"), F.unhex(F.sha2(name, 256)).alias("value")) for name in texts
        ])).alias("t")).where("t.value is not null").select("t.*").distinct()
        .groupBy("variable").agg(F.count(F.lit(1)).alias("n_unique"))
    ) if texts else None
    out = natural_left_join(base, quartile_rows(df, numbers), ["variable"]) if numbers else base
    if distinct is not None:
        out = natural_left_join(out, distinct, ["variable"])
    return natural_left_join(out, mini_histograms(df, numbers, bins), ["variable"]) if numbers else out


def mini_histograms(df: DataFrame, cols: list[str], bins: int = 8) -> DataFrame:
    """Counts of ``bins`` equal-width bins per column, as an array; two passes for all columns."""
    ends = df.agg(*[F.min(c).cast("double").alias(f"low_{i}") for i, c in enumerate(cols)],
                  *[F.max(c).cast("double").alias(f"high_{i}") for i, c in enumerate(cols)]).first()
    entries = []
    for i, name in enumerate(cols):
        low, high = ends[f"low_{i}"], ends[f"high_{i}"]
        if low is None:
            continue
        width = (high - low) / bins or 1.0
        number = F.least(F.floor((F.col(name) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
        entries.append(F.when(F.col(name).isNotNull(), F.struct(F.lit(name).alias("variable"), number.alias("bin"))))
    if not entries:
        return df.sparkSession.createDataFrame([], "variable string, hist array<bigint>")
    counts = (
        df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
        .groupBy("variable", "bin").agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy("variable").agg(F.array(*[
        F.coalesce(F.sum(F.when(F.col("bin") == b, F.col("n"))), F.lit(0)) for b in range(bins)
    ]).alias("hist"))


# --- model diagnostics ---------------------------------------------------------------------------

def residuals(pred: DataFrame, truth: str = "POWER", estimate: str = "pred") -> DataFrame:
    return pred.withColumn("residual", F.col(estimate) - F.col(truth))


def pred_vs_truth(
    pred: DataFrame, readings: DataFrame | None = None, key: str = "ID", truth: str = "POWER", estimate: str = "pred"
) -> DataFrame:
    """Truth and prediction per reading, joined by id when they live in two tables."""
    if readings is not None:
        pred = natural_left_join(readings.select(key, truth), pred.select(key, estimate), [key])
    return pred.select(key, truth, estimate)


def pred_trend(pred: DataFrame, date: str = "DATE", truth: str = "POWER", estimate: str = "pred") -> DataFrame:
    """Mean truth and mean prediction per date."""
    return pred.groupBy(date).agg(F.avg(truth).alias("truth_mean"), F.avg(estimate).alias("pred_mean"))


def rank_plot_table(results: DataFrame, metric: str = "rmse") -> DataFrame:
    """Workflows ranked by mean metric, with a one-standard-error range."""
    scored = results.where(F.col("metric") == metric).groupBy("wflow_id").agg(
        F.avg("value").alias("mean"),
        F.count("value").alias("n"),
        (F.stddev_samp("value") / F.sqrt(F.count("value"))).alias("std_err"),
    )
    ordered = Window.orderBy("mean", "wflow_id")  # one row per workflow
    return scored.select(
        F.rank().over(ordered).alias("rank"), "wflow_id", "mean", "n", "std_err",
        (F.col("mean") - F.col("std_err")).alias("low"), (F.col("mean") + F.col("std_err")).alias("high"),
    )
