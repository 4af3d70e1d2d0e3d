"""Named intermediate tables.

An intermediate result that several later plans need is written once as Parquet and read back. Two
things follow: a lost executor only costs the tasks it held, because the table lives in shared
storage, and the table has a *known size*, so Spark picks a broadcast join exactly when the file
size is below ``spark.sql.autoBroadcastJoinThreshold`` and a shuffled join otherwise. Nothing in
this package hints a broadcast for a side whose size depends on the data.

Stored tables stay until they are removed: those made inside a ``scratch`` block go at its end,
``remove`` deletes any.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_scratch: list[list[str]] = []


def staging_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="voltweave-")
    return _local_roots[app]


def materialise(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write ``df`` as Parquet at ``path`` and return the table read from there."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, name: str = "table") -> DataFrame:
    """``materialise`` under a fresh folder of the session's shared staging root."""
    path = f"{staging_root(df.sparkSession)}/voltweave/{name}-{uuid.uuid4().hex}"
    if _scratch:
        _scratch[-1].append(path)
    return materialise(df, path)


@contextlib.contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside the block leave no shuffle files; otherwise these stay until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete stored tables through the file system they are in; missing ones are no error."""
    hadoop = spark._jsc.hadoopConfiguration()
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(hadoop).delete(where, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside the block are deleted at its end; write or collect results before that."""
    _scratch.append([])
    try:
        yield
    finally:
        remove(spark, _scratch.pop())
