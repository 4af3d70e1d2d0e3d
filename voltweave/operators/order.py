"""Sorting, positions and chunked windows over a global order.

``row_index`` numbers rows 0, 1, 2, ... in a total order without ever putting the table into one
task: a range-partitioned sort is written once, its partitions are counted, and each partition gets
the offset of those before it. ``ordered_chunks`` builds on it: windows that look a fixed number of
rows back or ahead run per chunk of the order, each chunk carrying copies of the few border rows
it needs, so even one huge group is processed in many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltweave.sources.staging import stage

TOP_K_LIMIT = 100_000
CHUNK_ROWS = 50_000


def sort_keys(cols: list[str], desc: bool | list[bool] = False) -> list[Column]:
    flags = desc if isinstance(desc, list) else [desc] * len(cols)
    return [
        F.col(name).desc_nulls_last() if down else F.col(name).asc_nulls_last() for name, down in zip(cols, flags)
    ]


def sort(df: DataFrame, cols: list[str], desc: bool | list[bool] = False) -> DataFrame:
    """Global order, nulls last in both directions."""
    return df.orderBy(*sort_keys(cols, desc))


def top_k(df: DataFrame, cols: list[str], k: int, desc: bool | list[bool] = False) -> DataFrame:
    """First ``k`` rows of the order; every task keeps ``k`` rows before they meet."""
    return df.orderBy(*sort_keys(cols, desc)).limit(k)


def row_index(
    df: DataFrame, cols: list[str], desc: bool | list[bool] = False, name: str = "row", partitions: int | None = None
) -> DataFrame:
    """Add the 0-based position in the order given by ``cols``, which must be unique row keys."""
    keys = sort_keys(cols, desc)
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    numbered = ranged.sortWithinPartitions(*keys).select(
        "*",
        F.spark_partition_id().alias("__part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__pos"),
    )
    stored = stage(numbered, "ordered")
    # One row per sort partition: bounded by the shuffle partition count, whatever the data size.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    joined = stored.join(F.broadcast(offsets), "__part")
    return joined.select(*df.columns, (F.col("__pos") + F.col("__offset")).alias(name))


def ordered_chunks(
    df: DataFrame,
    cols: list[str],
    before: int = 0,
    after: int = 0,
    chunk_rows: int = CHUNK_ROWS,
    desc: bool | list[bool] = False,
) -> DataFrame:
    """Rows of the order cut into chunks, with ``before``/``after`` border rows copied in.

    Adds ``row`` (position), ``chunk`` and ``border`` (true for a copied row). Run a window with
    ``partitionBy("chunk", ...).orderBy("row")``, then drop border rows.
    """
    if max(before, after) > chunk_rows:
        raise ValueError("chunk_rows must be at least as large as the border")
    indexed = row_index(df, cols, desc)
    row, size = F.col("row"), F.lit(chunk_rows)
    home = F.floor(row / size)
    place = F.pmod(row, size)
    homes = F.array_compact(F.array(
        F.struct(home.alias("chunk"), F.lit(False).alias("border")),
        F.when(place >= size - before, F.struct((home + 1).alias("chunk"), F.lit(True).alias("border"))),
        F.when((place < after) & (home > 0), F.struct((home - 1).alias("chunk"), F.lit(True).alias("border"))),
    ))
    return indexed.withColumn("__home", F.explode(homes)).select(
        *df.columns, "row", F.col("__home.chunk").alias("chunk"), F.col("__home.border").alias("border")
    )


def slice_positions(
    df: DataFrame, cols: list[str], positions: list[int], desc: bool | list[bool] = False
) -> DataFrame:
    """Rows at 1-based ``positions`` of the order, with a ``position`` column."""
    last = max(positions)
    if last <= TOP_K_LIMIT:
        head = top_k(df, cols, last, desc)
        ranked = head.withColumn("position", F.row_number().over(Window.orderBy(*sort_keys(cols, desc))).cast("long"))
    else:
        ranked = row_index(df, cols, desc, "__row").withColumn("position", F.col("__row") + 1)
    return ranked.where(F.col("position").isin(positions)).select(*df.columns, "position")


def slice_range(df: DataFrame, start: int, stop: int, cols: list[str], desc: bool | list[bool] = False) -> DataFrame:
    """Rows at 0-based positions ``start`` up to, not including, ``stop``."""
    if stop <= TOP_K_LIMIT:
        return df.orderBy(*sort_keys(cols, desc)).offset(start).limit(stop - start)
    row = F.col("__row")
    return row_index(df, cols, desc, "__row").where((row >= start) & (row < stop)).drop("__row")


def drop_head(df: DataFrame, n: int, cols: list[str], desc: bool | list[bool] = False) -> DataFrame:
    """Everything but the first ``n`` rows of the order."""
    return row_index(df, cols, desc, "__row").where(F.col("__row") >= n).drop("__row")
