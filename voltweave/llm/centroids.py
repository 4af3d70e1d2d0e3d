"""Lloyd's clustering with the columns of the vectors dealt out in blocks, in whole numbers throughout.

Vectors are stored once as column blocks: a row holds the columns of one shard for a chunk of vectors. In
a round every block adds up its partial squared distances to the slices of the centroids that belong to
its shard; the partial distances of a chunk meet by key, are added, and the smallest sum wins. The
assignments go back to the blocks, whose sums by cluster give each shard the next slice of its own. What
travels is a number per vector and centroid, never a vector; the driver holds centroids only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltweave.sources.staging import stage

SHARD_COLUMNS = 16
CHUNK_ROWS = 4096
LARGEST = 1 << 27  # of a component: squared distances of 64 components stay within a long
BLOCKS = "chunk long, shard int, ids array<long>, block binary"
LABELLED = "chunk long, labels binary, distances binary"


def whole_numbers(vectors: DataFrame, dims: int, scale: int, column: str = "embedding") -> DataFrame:
    """vec_id and ``v``, the components as floor(scale * x), of the vectors of ``dims`` finite components.

    Vectors that are null, of another length, or hold a null or non-finite component are left out. A component
    beyond ``LARGEST`` is an error: its squared distances may not fit a long.
    """
    x = F.transform(column, lambda c: c.cast("double"))
    typed = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(F.size("x") == dims)
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = typed.where(finite)
    bounded = F.forall("x", lambda c: F.abs(c * scale) < LARGEST)
    return kept.select("vec_id", F.when(bounded, F.transform("x", lambda c: F.floor(c * scale).cast("int"))).otherwise(
        F.raise_error(F.lit("a component is too large for exact distances")).cast("array<int>")).alias("v"))


def _blocks(dims: int):
    """Chunks of at most ``CHUNK_ROWS`` vectors, a row per shard; ids go with the first shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 33
        for batch in batches:
            for a in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(a, CHUNK_ROWS)
                matrix = part.column("v").flatten().to_numpy(zero_copy_only=False).astype("<i4").reshape(-1, dims)
                shards = range(0, dims, SHARD_COLUMNS)
                yield pa.RecordBatch.from_arrays([
                    pa.array([chunk] * len(shards), pa.int64()), pa.array(range(len(shards)), pa.int32()),
                    pa.array([part.column("vec_id").to_pylist()] + [None] * (len(shards) - 1), pa.list_(pa.int64())),
                    pa.array([np.ascontiguousarray(matrix[:, s:s + SHARD_COLUMNS]).tobytes() for s in shards], pa.binary()),
                ], names=["chunk", "shard", "ids", "block"])
                chunk += 1

    return run


def _columns(shard: int, dims: int) -> slice:
    return slice(shard * SHARD_COLUMNS, min((shard + 1) * SHARD_COLUMNS, dims))


def _partial_distances(centroids: np.ndarray):
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for shard, block in zip(batch.column("shard").to_pylist(), batch.column("block").to_pylist()):
                slices = centroids[:, _columns(shard, dims)]
                own = np.frombuffer(block, dtype="<i4").reshape(-1, slices.shape[1]).astype(np.int64)
                made.append(np.stack([((own - c) ** 2).sum(axis=1) for c in slices]).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(made, pa.binary())], names=["chunk", "partial"])

    return run


def _nearest(k: int):
    """Adds the partial distances of a chunk's shards (a fixed number) and takes the smallest; ties to the smaller number."""

    def run(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, dtype="<i8") for b in rows.column("partial").to_pylist()).reshape(k, -1)
        labels = total.argmin(axis=0)
        return pa.table([rows.column("chunk").slice(0, 1), pa.array([labels.astype("<i4").tobytes()], pa.binary()),
                         pa.array([total.min(axis=0).astype("<i8").tobytes()], pa.binary())], names=["chunk", "labels", "distances"])

    return run


def _block_sums(k: int, dims: int):
    """Per batch: sums by cluster and column of the shards it holds, and the numbers of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, counts = np.zeros((k, dims), dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
            for shard, block, labels in zip(*(batch.column(c).to_pylist() for c in ("shard", "block", "labels"))):
                at = _columns(shard, dims)
                own = np.frombuffer(block, dtype="<i4").reshape(-1, at.stop - at.start).astype(np.int64)
                label = np.frombuffer(labels, dtype="<i4")
                np.add.at(sums[:, at], label, own)
                counts[:, at] += np.bincount(label, minlength=k)[:, None]
            cluster, dim = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array((dim // SHARD_COLUMNS).astype(np.int32)), pa.array(cluster.astype(np.int32)), pa.array(dim.astype(np.int32)),
                 pa.array(sums[cluster, dim]), pa.array(counts[cluster, dim])], names=["shard", "cluster", "dim", "total", "n"])

    return run


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, labels, distances in zip(*(batch.column(c) for c in ("ids", "labels", "distances"))):
            yield pa.RecordBatch.from_arrays(
                [ids.values, pa.array(np.frombuffer(labels.as_py(), dtype="<i4")), pa.array(np.frombuffer(distances.as_py(), dtype="<i8"))],
                names=["vec_id", "cluster", "distance"])


def assign(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``LABELLED``: per chunk the number of the nearest centroid of every vector, and the squared distance."""
    partial = blocks.select("chunk", "shard", "block").mapInArrow(_partial_distances(centroids), "chunk long, partial binary")
    return stage(partial.groupBy("chunk").applyInArrow(_nearest(len(centroids)), LABELLED), "labels")


def moved(blocks: DataFrame, labelled: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids with every slice replaced by its shard's floor(sum / count); empty clusters keep theirs."""
    k, dims = centroids.shape
    joined = blocks.select("chunk", "shard", "block").join(labelled.select("chunk", "labels"), "chunk").drop("chunk")
    sums = joined.mapInArrow(_block_sums(k, dims), "shard int, cluster int, dim int, total long, n long")
    sums = sums.groupBy("shard", "cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    mean = F.expr("(total - pmod(total, cast(n as decimal(38,0)))) div n").cast("long")
    out = centroids.copy()
    for row in sums.select("cluster", "dim", mean.alias("mean")).collect():  # at most k x dims rows
        out[row["cluster"], row["dim"]] = row["mean"]
    return out


def first_centroids(vectors: DataFrame, k: int) -> np.ndarray:
    """The ``k`` vectors of smallest sha256 of ``1:<vec_id>``; rows of one vec_id by components. A null vec_id starts none."""
    named = vectors.where("vec_id IS NOT NULL").select(F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256).alias("h"), "v")
    return np.array([r["v"] for r in named.orderBy("h", "v").limit(k).collect()], dtype=np.int64)  # k rows


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that ``whole_numbers`` keeps.

    Repeated rows are vectors of their own; where fewer than ``k`` vectors have an id there are fewer centroids,
    and without any (an empty table) no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    numbers = whole_numbers(vectors, dims, scale)
    centroids = first_centroids(numbers, k)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    blocks = stage(numbers.mapInArrow(_blocks(dims), BLOCKS), "blocks")
    for _ in range(rounds):
        centroids = moved(blocks, assign(blocks, centroids), centroids)
    labelled = assign(blocks, centroids)
    members = stage(blocks.where("shard = 0").select("chunk", "ids").join(labelled, "chunk").select("ids", "labels", "distances").mapInArrow(
        _members, "vec_id long, cluster int, distance long"), "members")
    inertia = {r["cluster"]: int(r["s"]) for r in members.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # at most k rows
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of = F.col("cluster") + 1
    return members.select(
        "vec_id", "cluster", "distance", F.element_at(F.array(*[F.lit(inertia.get(c, 0)).cast("long") for c in range(len(centroids))]), of).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"), F.element_at(F.array(*[F.lit(d) for d in digests]), of).alias("centroid_sha256"))


def _cluster_sql(k: int, rounds: int, dims: int, scale: int) -> str:
    parts = [f"""kept AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS r, [floor({scale} * x::double)::bigint for x in embedding] AS v
 FROM embeddings WHERE len(embedding) = {dims} AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = {dims})""",
             f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM
 (SELECT sha256('1:' || vec_id::varchar) AS h, v FROM kept WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {k}))"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min([d, c]) AS best FROM
 (SELECT r, vec_id, x.v AS v, c, list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(x.v, y.v)])::bigint AS d FROM kept x, c{i} y) GROUP BY r)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT c, coalesce(n.v, o.v) AS v FROM c{i} o LEFT JOIN
 (SELECT c, list(m ORDER BY j) AS v FROM (SELECT c, j, (sum(x)::hugeint - ((sum(x)::hugeint % count(*)) + count(*)) % count(*))::hugeint // count(*) AS m FROM
  (SELECT best[2] AS c, unnest(v) AS x, unnest(range({dims})) AS j FROM a{i}) GROUP BY c, j) GROUP BY c) n USING (c))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, best[2]::int AS cluster, best[1]::bigint AS distance, (sum(best[1]) OVER (PARTITION BY best[2]))::bigint AS cluster_inertia,
 (sum(best[1]) OVER ())::bigint AS inertia, sha256(array_to_string(y.v, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} y ON y.c = best[2]"""


CLUSTER_SQL = _cluster_sql(16, 3, 64, 64)
