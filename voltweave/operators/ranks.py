"""Ranks of many columns at once, ties sharing their average rank, with no column in one task.

Equal values are counted by the map tasks first, so a tie is one row however long it is. The distinct values of
all columns are range-sorted together; running counts inside a sort partition plus the totals of the partitions
before it give the rank of every value. Frequent values (a list of fixed length, all values of a column that has
few) are looked up where the row is; only the others are shuffled and meet their ranks by column and value, so no
key of that join has more than a small share of the rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltweave.functions.sql import quoted
from voltweave.sources.staging import stage

COUNTED = 1 << 15  # distinct values of a column that a map task holds before it passes their counts on
FREQUENT = 1 << 21  # values of all columns together that are looked up from a broadcast table
TASK_CELLS = 1 << 19  # values and ranks of single cells in a task, on average
TASK_NUMBERS = 1 << 23  # numbers of whole rows in a task, on average


def _counter(width: int):
    """Rows of (v, x, n): the counts of the values of every column, those of a task combined as far as it may hold them."""

    def run(batches):
        kept = [(np.empty(0), np.empty(0, dtype=np.int64)) for _ in range(width)]

        def counts(v: int) -> pa.RecordBatch:
            x, n = kept[v]
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(x), v, dtype=np.int32)), pa.array(x), pa.array(n)], names=["v", "x", "n"])

        for batch in batches:
            for v in range(width):
                x, n = np.unique(batch.column(f"x{v}").drop_null().to_numpy(zero_copy_only=False), return_counts=True)
                both, total = kept[v]
                at = np.searchsorted(both, x)
                known = np.append(both, np.nan)[at] == x
                total[at[known]] += n[known]
                if not known.all():
                    both, total = np.insert(both, at[~known], x[~known]), np.insert(total, at[~known], n[~known])
                kept[v] = both, total
                if len(both) > COUNTED:
                    yield counts(v)
                    kept[v] = np.empty(0), np.empty(0, dtype=np.int64)
        for v in range(width):
            yield counts(v)

    return run


def _lookup(shared, wide: list[int], width: int):
    """The row with the ranks of its frequent values, and the values of the ``wide`` columns that have none yet."""

    def run(batches):
        values, ranks, first = shared.value
        for batch in batches:
            found, left = [], []
            for v in range(width):
                x = batch.column(f"x{v}").to_numpy(zero_copy_only=False).astype(float)  # null: NaN
                own = values[first[v]:first[v + 1]]
                at = np.minimum(np.searchsorted(own, x), max(len(own) - 1, 0))
                hit = own[at] == x if len(own) else np.zeros(len(x), dtype=bool)
                rank = np.full(len(x), np.nan)
                rank[hit] = ranks[first[v] + at[hit]]
                found.append(pa.array(rank, mask=~hit))
                if v in wide:
                    left.append(pa.array(x, mask=hit | np.isnan(x)))
            names = ["row", *(f"r{v}" for v in range(width)), *(f"x{v}" for v in wide)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *found, *left], names=names)

    return run


def _running(batches):
    """Rows of (v, x, n) in order, with the rows of the same column before them in this partition."""
    own, last, count = TaskContext.get().partitionId(), -1, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        v, n = batch.column("v").to_numpy(), batch.column("n").to_numpy()
        upto = np.cumsum(n) - n
        starts = np.concatenate([[0], np.flatnonzero(np.diff(v)) + 1])
        sizes = np.diff([*starts, len(v)])
        before = upto - np.repeat(upto[starts], sizes)
        if v[0] == last:
            before[:sizes[0]] += count
        last, count = int(v[-1]), int(before[-1] + n[-1])
        part = pa.array(np.full(len(v), own, dtype=np.int64))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before), part], names=["v", "x", "n", "before", "part"])


def value_ranks(counts: DataFrame) -> DataFrame:
    """``v``, ``x``, ``n`` and average ``rank`` (from 1) of every distinct value ``x`` of every variable number ``v``, which comes ``n`` times."""
    ordered = counts.groupBy("v", "x").agg(F.sum("n").alias("n")).repartitionByRange("v", "x").sortWithinPartitions("v", "x")
    stored = stage(ordered.mapInArrow(_running, "v int, x double, n long, before long, part long"), "counts")
    # A row per sort partition and column in it: bounded by partitions + columns.
    totals = stored.groupBy("v", "part").agg(F.sum("n").alias("total"))
    earlier = Window.partitionBy("v").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("v", "part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset"))
    placed = stored.join(F.broadcast(offsets), ["v", "part"])
    return placed.select("v", "x", "n", (F.col("offset") + F.col("before") + (F.col("n") + 1) / 2).alias("rank"))


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def tied_ranks(df: DataFrame, cols: list[str]) -> DataFrame:
    """The ranks of ``cols``, column by column, in columns of the same names; null and NaN have none.

    A column's ranks count all rows where that column is present. Rows without any value are left out.
    """
    width = len(cols)
    typed = df.selectExpr(*[f"nanvl(double({quoted(c)}), NULL) + 0D AS x{i}" for i, c in enumerate(cols)])  # -0 and 0 are one value
    present = f"coalesce({', '.join(f'x{i}' for i in range(width))}, NULL) IS NOT NULL"
    typed = stage(typed.where(present).withColumn("row", F.monotonically_increasing_id()), "typed")
    counts = typed.drop("row").mapInArrow(_counter(width), "v int, x double, n long")
    ranks = stage(value_ranks(counts), "ranks")
    sizes = {r["v"]: (r["values"], r["total"]) for r in ranks.groupBy("v").agg(F.count("*").alias("values"), F.sum("n").alias("total")).collect()}
    order = sorted(sizes, key=lambda v: (sizes[v][0], v))
    upto = np.cumsum([sizes[v][0] for v in order])
    wide = sorted(v for v, n in zip(order, upto) if n > FREQUENT)  # columns beyond what fits, those with most values
    # Of each of them the values that more than one in ``most`` rows have: fewer than ``most``.
    most = max(FREQUENT // width, 1)
    frequent = " OR ".join(["v NOT IN (" + ", ".join(map(str, [-1, *wide])) + ")", *[f"(v = {v} AND n > {sizes[v][1] // most})" for v in wide]])
    known = ranks.where(frequent).select("v", "x", "rank").toArrow().sort_by([("v", "ascending"), ("x", "ascending")])
    first = np.searchsorted(known.column("v").to_numpy(), np.arange(width + 1))
    shared = df.sparkSession.sparkContext.broadcast((known.column("x").to_numpy(), known.column("rank").to_numpy(), first))
    schema = ", ".join(["row long", *(f"r{v} double" for v in range(width)), *(f"x{v} double" for v in wide)])
    looked = typed.mapInArrow(_lookup(shared, wide, width), schema)
    if not wide:
        return looked.selectExpr(*[f"r{i} AS {quoted(c)}" for i, c in enumerate(cols)])
    looked = stage(looked, "frequent-ranks")
    cells = ", ".join(f"struct({v} AS v, x{v} AS x)" for v in wide)
    rest = looked.selectExpr("row", f"inline(array({cells}))").where("x IS NOT NULL")
    # Tasks grow in number with the rows, not in size.
    least = partitions(df)
    cell_parts = max(least, sum(sizes[v][1] for v in wide) // TASK_CELLS)
    row_parts = max(least, looked.count() * (width + len(wide)) // TASK_NUMBERS)
    met = rest.repartition(cell_parts, "v", "x").join(ranks.where(f"NOT ({frequent})").select("v", "x", "rank"), ["v", "x"])
    by_row = met.repartition(max(cell_parts, row_parts), "row").groupBy("row").agg(*[F.expr(f"max(CASE WHEN v = {v} THEN rank END)").alias(f"m{v}") for v in wide])
    whole = looked.repartition(max(cell_parts, row_parts), "row").join(by_row, "row", "left").selectExpr(
        *[f"coalesce(r{i}, m{i}) AS {quoted(c)}" if i in wide else f"r{i} AS {quoted(c)}" for i, c in enumerate(cols)])
    return stage(whole, "all-ranks")
