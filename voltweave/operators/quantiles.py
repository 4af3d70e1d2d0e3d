"""Exact quantiles (linear interpolation) that never hold a group in one task.

``percentile`` and ``median`` keep every distinct value of a group in one aggregation buffer. Here
two passes are used instead. The first keeps a bounded sketch per group and brackets each wanted
rank between two approximate quantiles. The second counts what lies below the bracket (one number
per group, combined before the shuffle) and ranks only the values inside it, which are about
``4 / accuracy`` of a large group. Small groups are ranked whole. The result is exact: the sketch's
rank error is at most half the distance the bracket leaves on each side. Where a bracket may still hold
more than ``RANKED`` distinct values, it is narrowed first: its values are counted in ``BINS`` sub-intervals, and
only those that hold the wanted ranks stay, until what is left to rank has a fixed bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltweave.functions.sql import literal, quoted, text_literal
from voltweave.operators.joins import natural_left_join
from voltweave.sources.staging import stage

ACCURACY = 10_000
RANKED = 100_000
BINS = 4096


def _greatest(values: list[str]) -> str:
    return values[0] if len(values) == 1 else f"greatest({', '.join(values)})"


def _narrowed(counts: DataFrame, by: list[str], rank: str, most: int) -> DataFrame:
    """``counts`` (by, v, n, q, x, c; a null x stands for all below) with at most ``most`` values per group, if possible.

    A group of more is counted in ``BINS`` equal parts of its range. Parts below the wanted ranks are added to
    the null row, parts above go. A range of neighbouring numbers cannot be cut further and holds few.
    """
    group = [*by, "v", "n", "q"]
    keys = [quoted(name) for name in group]
    before = None
    while True:
        counts = stage(counts, "bracket")
        sizes = counts.groupBy(*group).agg(
            F.expr("count(x) AS values"), F.expr("min(x) AS low"), F.expr("max(x) AS high"), F.expr("coalesce(sum(CASE WHEN x IS NULL THEN c END), 0) AS under"))
        sizes = stage(sizes, "sizes")
        largest = sizes.agg(F.max("values")).first()[0] or 0
        if largest <= most or largest == before:
            return counts
        before = largest
        # Groups are few next to their values; the join is broadcast where their stored size allows.
        placed = natural_left_join(counts, sizes, group).selectExpr(
            *keys, "x", "c", "under", "values",
            f"CASE WHEN x IS NOT NULL AND values > {most} THEN least(int((x / 2 - low / 2) / (high / 2 - low / 2) * {BINS}), {BINS - 1}) END AS bin")
        bins = placed.where("bin IS NOT NULL").groupBy(*group, "under", "bin").agg(F.expr("sum(c) AS c"))
        # At most BINS rows per group: this window is bounded.
        upto = bins.selectExpr(*keys, "bin", "c", f"under + sum(c) OVER (PARTITION BY {', '.join(keys)} ORDER BY bin) AS upto", f"{rank} AS rank")
        side = upto.selectExpr(*keys, "bin", "CASE WHEN upto <= floor(rank) THEN -1 WHEN upto - c > ceil(rank) THEN 1 ELSE 0 END AS side")
        judged = natural_left_join(placed.drop("under", "values"), stage(side, "bins"), [*group, "bin"])
        counts = judged.where("side IS NULL OR side < 1").selectExpr(*keys, "CASE WHEN side < 0 THEN NULL ELSE x END AS x", "c").groupBy(
            *group, "x").agg(F.expr("sum(c) AS c"))


def quantiles_long(
    df: DataFrame, cols: list[str], probs: list[float], by: list[str] | None = None, accuracy: int = ACCURACY, most: int = RANKED
) -> DataFrame:
    """One row per group, column and probability: ``by..., variable, prob, n, value``."""
    by = by or []
    slack = 2.0 / accuracy
    edges = [edge for p in probs for edge in (max(p - slack, 0.0), min(p + slack, 1.0))]
    keys = [quoted(name) for name in by]
    fields = range(len(cols))
    base = df.selectExpr(*keys, *[f"double({quoted(name)}) AS x{i}" for i, name in enumerate(cols)])

    points = f"array({', '.join(literal(edge) for edge in edges)})"
    sketch = base.groupBy(*by).agg(*[
        F.expr(f"struct(count(x{i}) AS n, percentile_approx(x{i}, {points}, {accuracy}) AS e) AS s{i}") for i in fields
    ])
    if by:
        sketch = stage(sketch, "sketch")
        largest = sketch.selectExpr(f"max({_greatest([f's{i}.n' for i in fields])})").first()[0] or 0
        joined = natural_left_join(base, sketch, by)
        cells = [f"struct({i} AS v, x{i} AS x, s{i}.n AS n, s{i}.e AS e)" for i in fields]
    else:
        # One row of learned edges: read once and used as literals.
        learned, joined = sketch.first(), base
        largest = max((learned[f"s{i}"]["n"] for i in fields), default=0)
        cells = []
        for i in fields:
            n, found = learned[f"s{i}"]["n"], learned[f"s{i}"]["e"] or []
            values = ", ".join(literal(edge) for edge in found)
            cells.append(f"struct({i} AS v, x{i} AS x, {n}L AS n, cast(array({values}) AS array<double>) AS e)")
    long = joined.selectExpr(*keys, f"inline(array({', '.join(cells)}))").where("x IS NOT NULL")

    whole = f"n <= {5 * accuracy}"  # up to this size a group is ranked without a bracket
    parts = []
    for j, p in enumerate(probs):
        below = f"NOT {whole} AND x < e[{2 * j}]" if p - slack > 0 else "false"
        above = f"NOT {whole} AND x > e[{2 * j + 1}]" if p + slack < 1 else "false"
        parts.append(f"CASE WHEN NOT ({above}) THEN struct({j} AS q, CASE WHEN NOT ({below}) THEN x END AS x) END")
    pieces = long.selectExpr(*keys, "v", "n", f"inline(array_compact(array({', '.join(parts)}))) AS (q, x)")
    counts = pieces.groupBy(*by, "v", "n", "q", "x").agg(F.expr("count(1) AS c"))
    rank = f"(n - 1) * element_at(array({', '.join(literal(p) for p in probs)}), q + 1)"
    if max(6 * largest // accuracy, min(largest, 5 * accuracy)) > most:  # what a bracket may hold
        counts = _narrowed(counts, by, rank, most)

    group = ", ".join([*keys, "v", "n", "q"])
    ranked = counts.selectExpr(
        "*",
        f"sum(c) OVER (PARTITION BY {group} ORDER BY x ASC NULLS FIRST ROWS UNBOUNDED PRECEDING) AS upto",
        f"{rank} AS rank",
    )
    picked = ranked.groupBy(*by, "v", "n", "q", "rank").agg(
        F.expr("min(CASE WHEN upto > floor(rank) THEN x END) AS low"),
        F.expr("min(CASE WHEN upto > ceil(rank) THEN x END) AS high"),
    )
    return picked.selectExpr(
        *keys,
        f"element_at(array({', '.join(text_literal(col) for col in cols)}), v + 1) AS variable",
        f"element_at(array({', '.join(literal(p) for p in probs)}), q + 1) AS prob",
        "n",
        "low + (high - low) * (rank - floor(rank)) AS value",
    )


def quantiles(
    df: DataFrame,
    cols: list[str],
    probs: dict[str, float],
    by: list[str] | None = None,
    names: str = "{col}_{fn}",
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per group, one column per (column, probability name)."""
    by = by or []
    long = quantiles_long(df, cols, list(probs.values()), by, accuracy)
    return long.groupBy(*by).agg(*[
        F.expr(
            f"max(CASE WHEN variable = {text_literal(col)} AND prob = {literal(p)} THEN value END) "
            f"AS {quoted(names.format(col=col, fn=fn))}"
        )
        for col in cols
        for fn, p in probs.items()
    ])


def quantile_values(df: DataFrame, col: str, probs: list[float], accuracy: int = ACCURACY) -> list[float]:
    """Learned cut points of one column, as numbers (one per probability)."""
    rows = quantiles_long(df, [col], probs, accuracy=accuracy).collect()
    found = {row["prob"]: row["value"] for row in rows}
    return [found.get(float(p)) for p in probs]
