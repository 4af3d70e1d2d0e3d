"""Strata, hold-out splits and folds that do not depend on row order or partitioning.

Every row gets a number from a hash of its id and the seed. A split takes the rows below an exact
quantile of that number within each stratum, so sizes are exact and nothing is sorted. The hash is
52 bits of MD5: wide enough to be free of ties in practice.

The quantiles are found by radix selection: rows are counted by stratum and the leading bits of the hash, then,
inside the cells that hold a cut, by the bits that follow, until such a cell holds few rows. Two scans of a
table that has nothing but hash and stratum do for millions of rows, and each further one for 4096 times as many,
whatever the number of folds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltweave.operators.quantiles import quantile_values
from voltweave.sources.staging import stage

# Fixed value: default seed.
SEED = 54147

HASH_BITS = 52
DIGIT_BITS = 12
FEW_ROWS = 4096


def row_hash(key: Column, seed: int = SEED) -> Column:
    """52-bit number that depends on the row id and the seed only."""
    text = F.concat_ws(":", F.lit(str(seed)), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def stratum_of(col: str | Column, cuts: list[float]) -> Column:
    """1-based bin of a numeric column; values equal to a cut go to the lower bin; null -> 0."""
    value = F.col(col) if isinstance(col, str) else col
    bins = F.lit(1)
    for cut in cuts:
        bins = bins + (value > F.lit(cut)).cast("int")
    return F.coalesce(bins, F.lit(0))


def strata(df: DataFrame, col: str, breaks: int = 4, name: str = "stratum") -> DataFrame:
    """Quantile bins of a numeric or date column."""
    if dict(df.dtypes)[col] == "date":
        numbered = df.withColumn("__day", F.unix_date(col).cast("double"))
        return strata(numbered, "__day", breaks, name).drop("__day")
    cuts = quantile_values(df, col, [i / breaks for i in range(1, breaks)])
    return df.withColumn(name, stratum_of(col, sorted({cut for cut in cuts if cut is not None})))


def hash_cuts(hashed: DataFrame, probs: list[float], few: int = FEW_ROWS) -> dict[int, list[float]]:
    """Per ``stratum`` the values of ``hash`` at the positions floor(p * (n - 1)) of its order, for each p.

    What is collected per pass is a row per stratum and cell of ``DIGIT_BITS`` bits, for each cut at most.
    """
    shift = HASH_BITS - DIGIT_BITS
    cells = hashed.groupBy("stratum", F.shiftright("hash", shift).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    counts: dict[int, list[tuple[int, int]]] = {}
    for row in cells.collect():
        counts.setdefault(row["stratum"], []).append((row["cell"], row["n"]))
    # Per cut: the cell that holds it, its place among the rows of that cell, their number.
    wanted = {(s, i): _cell_of(sorted(found), int(p * (sum(n for _, n in found) - 1))) for s, found in counts.items() for i, p in enumerate(probs)}
    while shift and wanted:
        large = max(n for *_, n in wanted.values()) > few
        step = min(DIGIT_BITS, shift) if large else shift
        known = {(s, cell) for (s, _), (cell, *_) in wanted.items()}
        inside = F.struct("stratum", F.shiftright("hash", shift).alias("cell")).isin(
            [F.struct(F.lit(s).alias("stratum"), F.lit(c).cast("long").alias("cell")) for s, c in sorted(known)])
        shift -= step
        finer = hashed.where(inside).groupBy("stratum", F.shiftright("hash", shift).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
        split: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for row in finer.collect():
            split.setdefault((row["stratum"], row["cell"] >> step), []).append((row["cell"], row["n"]))
        wanted = {(s, i): _cell_of(sorted(split[s, cell]), place) for (s, i), (cell, place, _) in wanted.items()}
    return {s: [float(wanted[s, i][0]) for i in range(len(probs))] for s in counts}


def _cell_of(cells: list[tuple[int, int]], place: int) -> tuple[int, int, int]:
    """The cell that holds the row at ``place``, the place inside, the rows of the cell."""
    for cell, n in cells:
        if place < n:
            return cell, place, n
        place -= n
    raise ValueError("no such row")


def _narrow(df: DataFrame, by: str | None, key: str, seed: int, breaks: int) -> tuple[DataFrame, Column]:
    """(hash and stratum of every row, stored; the stratum as an expression on ``df``)."""
    measure = F.lit(None) if by is None else F.unix_date(by) if dict(df.dtypes)[by] == "date" else F.col(by)
    measure = measure.cast("double")
    stored = stage(df.select(row_hash(F.col(key), seed).alias("hash"), measure.alias("by")), "hashes")
    if by is None:
        return stored.select("hash", F.lit(0).alias("stratum")), F.lit(0)
    cuts = sorted({cut for cut in quantile_values(stored, "by", [i / breaks for i in range(1, breaks)]) if cut is not None})
    return stored.select("hash", stratum_of(F.col("by"), cuts).alias("stratum")), stratum_of(measure, cuts)


def per_stratum(cuts: dict[int, list[float]], stratum: Column, make) -> Column:
    expr = F.lit(None)
    for value, found in sorted(cuts.items()):
        expr = F.when(stratum == F.lit(value), make(found)).otherwise(expr)
    return expr


def initial_split(
    df: DataFrame,
    prop: float = 0.75,
    by: str | None = "POWER",
    seed: int = SEED,
    key: str = "ID",
    breaks: int = 4,
    name: str = "is_train",
) -> DataFrame:
    """Add a 0/1 column that marks a ``prop`` share of every stratum as training rows."""
    narrow, stratum = _narrow(df, by, key, seed, breaks)
    cuts = hash_cuts(narrow, [prop])
    hashed = df.withColumns({"__hash": row_hash(F.col(key), seed), "__stratum": stratum})
    flag = per_stratum(cuts, F.col("__stratum"), lambda found: (F.col("__hash") <= F.lit(found[0])).cast("int"))
    return hashed.withColumn(name, flag).drop("__hash", "__stratum")


def training(df: DataFrame, name: str = "is_train") -> DataFrame:
    return df.where(F.col(name) == 1).drop(name)


def testing(df: DataFrame, name: str = "is_train") -> DataFrame:
    return df.where(F.col(name) == 0).drop(name)


def vfold(
    df: DataFrame,
    v: int = 10,
    by: str | None = "POWER",
    seed: int = SEED,
    key: str = "ID",
    breaks: int = 4,
    exact: bool = True,
    name: str = "fold",
) -> DataFrame:
    """Add a fold number 0 .. v-1.

    ``exact`` balances every stratum to within a row by cutting at hash quantiles. Otherwise the
    fold is the hash modulo ``v``: balanced in expectation, and free of any pass over the data.
    """
    if not exact:
        return df.withColumn(name, F.pmod(row_hash(F.col(key), seed), F.lit(v)).cast("int"))
    narrow, stratum = _narrow(df, by, key, seed, breaks)
    cuts = hash_cuts(narrow, [i / v for i in range(1, v)])
    hashed = df.withColumns({"__hash": row_hash(F.col(key), seed), "__stratum": stratum})

    def fold(found: list[float]) -> Column:
        number = F.lit(0)
        for cut in found:
            number = number + (F.col("__hash") > F.lit(cut)).cast("int")
        return number

    return hashed.withColumn(name, per_stratum(cuts, F.col("__stratum"), fold)).drop("__hash", "__stratum")


def kfold(df: DataFrame, k: int = 5, seed: int = 42, key: str = "ID", name: str = "fold") -> DataFrame:
    """Shuffled folds without strata."""
    return vfold(df, k, None, seed, key, exact=True, name=name)


def scatter_sample(
    df: DataFrame, x: str, y: str = "POWER", fraction: float | None = None, seed: int = SEED, key: str = "ID"
) -> DataFrame:
    """(x, y) pairs for a scatter chart; all of them unless a fraction is asked for."""
    out = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    if fraction is not None:
        out = out.where(row_hash(F.col(key), seed) < F.lit(fraction * float(1 << 52)))
    return out.select(x, y)
