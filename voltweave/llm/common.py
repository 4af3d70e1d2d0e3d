"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
FILTER_BITS = 1 << 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; other letters keep their case."""
    return F.translate(text, UPPER, LOWER)


def held_out(doc_id: Column, folds: int) -> Column:
    """True for the rows whose crc32 of the id as text is divisible by ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded_slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``most_bytes`` text bytes (one longer row stays whole)."""
    if batch.num_rows == 0:
        return
    lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    run = np.cumsum(lengths.astype(np.int64)) // most_bytes
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for start, stop in zip(cuts, cuts[1:]):
        yield batch.slice(start, stop - start)


def pieces_of(values: np.ndarray, owners: np.ndarray, parts: np.ndarray, n_parts: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Group parallel arrays by ``parts``; returns (part, values, owners) for the parts that have rows."""
    order = np.argsort(parts, kind="stable")
    bounds = np.searchsorted(parts[order], np.arange(n_parts + 1))
    values, owners = values[order], owners[order]
    return [(p, values[a:b], owners[a:b]) for p, (a, b) in enumerate(zip(bounds, bounds[1:])) if b > a]


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of many runs, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


KEPT: list[dict] = []  # caches that outlive a task in a worker


def release_memory(drop_caches: bool = False) -> None:
    """Give freed memory back to the system: Python workers are reused, and what they keep is missing in later stages.

    ``drop_caches``: also what other operators have left in the worker for their own later tasks.
    """
    if drop_caches:
        for cache in KEPT:
            cache.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def flag_maybe(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` with a column ``maybe``: false where the long column ``key`` is certainly not among those of ``keys``.

    A bit filter of fixed size (``FILTER_BITS``): wide rows that a join would drop are not shuffled. Where the
    keys outgrow it, it drops less; the join that follows decides.
    """
    words = keys.select(F.pmod("key", F.lit(FILTER_BITS)).alias("bit")).groupBy(F.expr("bit div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).collect()  # at most FILTER_BITS / 64 rows
    filled = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    for r in words:
        filled[r["word"]] = r["bits"]
    shared = rows.sparkSession.sparkContext.broadcast(filled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column("key").to_numpy() % FILTER_BITS
            hit = (shared.value[bit // 64] >> (bit % 64)) & 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hit.astype(bool))], names=[*batch.schema.names, "maybe"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("maybe", BooleanType())]))
