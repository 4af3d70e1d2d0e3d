"""Approximate nearest neighbours by inner product, with a hierarchical k-means tree.

The tree is fitted on a bounded sample and holds every vector in one leaf. A query walks it best bin
first: a priority queue of nodes by the distance of their centres, opened nearest first, gives the order
in which it would visit the leaves. How many leaves are visited is calibrated: queries with known exact
neighbours widen the visit until the wanted recall is reached. A query whose leaves hold too few rows goes on
until they hold enough. Inner products become distances by one
more coordinate that brings all vectors to the same norm.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from voltweave.sources.staging import stage

SAMPLE = 20_000  # vectors that the tree is fitted on, by the hash of their id
BRANCHES = 8
LEAF_ROWS = 1024  # rows a leaf should have
CALIBRATION = 256  # queries with exact neighbours
RECALL = 0.94  # wanted on them; 0.9 is promised
GROUP_ROWS = 8192  # rows of neighbouring leaves that a task holds
BLOCK_QUERIES = 2048  # queries that meet them there


class Tree:
    """Centres of all nodes with their children; leaves are numbered. Bounded by the sample, not by the data."""

    def __init__(self, sample: np.ndarray, norm: float, leaves: int):
        self.norm = norm
        x = self.lift(sample)
        self.centres = [x.mean(axis=0) if len(x) else np.zeros(x.shape[1])]
        self.children: list[list[int]] = [[]]
        rows = {0: np.arange(len(x))}
        heap = [(-len(x), 0)]
        count = 1
        rng = np.random.default_rng(11)
        while heap and count < leaves:
            size, node = heapq.heappop(heap)
            if -size < 2 * BRANCHES:
                break
            own = rows.pop(node)
            centres, of = _kmeans(x[own], BRANCHES, rng)
            if len(np.unique(of)) < 2:
                continue
            for k in np.unique(of):
                child = len(self.centres)
                self.centres.append(centres[k])
                self.children.append([])
                self.children[node].append(child)
                rows[child] = own[of == k]
                heapq.heappush(heap, (-len(rows[child]), child))
            count += len(self.children[node]) - 1
        self.centres = np.array(self.centres)
        self.leaf_nodes = [n for n, c in enumerate(self.children) if not c]
        self.leaf_of = {n: k for k, n in enumerate(self.leaf_nodes)}

    def groups(self, sizes: np.ndarray, rows: int) -> np.ndarray:
        """A group number for each leaf: leaves side by side in the tree, about ``rows`` rows together."""
        out, held, number, stack = np.zeros(len(sizes), dtype=np.int64), 0, 0, [0]
        while stack:
            node = stack.pop()
            stack += self.children[node]
            if not self.children[node]:
                leaf = self.leaf_of[node]
                if held and held + sizes[leaf] > rows:
                    held, number = 0, number + 1
                out[leaf], held = number, held + sizes[leaf]
        return out

    def lift(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """One coordinate more: rows come to norm 1; queries get 0 there, so that near means a large product."""
        if query:
            return np.hstack([x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300), np.zeros((len(x), 1))])
        x = x / self.norm
        return np.hstack([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1, keepdims=True)))])

    def _distances(self, lifted: np.ndarray) -> np.ndarray:
        return (self.centres**2).sum(axis=1) - 2 * lifted @ self.centres.T

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row: down the nearest child."""
        far = self._distances(self.lift(x))
        at = np.zeros(len(x), dtype=np.int64)
        for node in range(len(self.children)):  # children come after their parents
            below = self.children[node]
            own = np.flatnonzero(at == node) if below else ()
            if len(own):
                at[own] = np.array(below)[np.argmin(far[np.ix_(own, below)], axis=1)]
        return np.array([self.leaf_of[n] for n in at], dtype=np.int64)

    def visits(self, x: np.ndarray, least: int, sizes: np.ndarray, rows: int) -> list[list[int]]:
        """The first leaves of each query, best bin first: ``least`` of them, and more until they hold ``rows`` rows."""
        made = []
        for far in self._distances(self.lift(x, query=True)):
            queue, order, held = [(far[0], 0)], [], 0
            while queue and (len(order) < least or held < rows):
                _, node = heapq.heappop(queue)
                if not self.children[node]:
                    order.append(self.leaf_of[node])
                    held += sizes[order[-1]]
                for child in self.children[node]:
                    heapq.heappush(queue, (far[child], child))
            made.append(order)
        return made


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centres = x[rng.choice(len(x), k, replace=False)]
    of = np.zeros(len(x), dtype=np.int64)
    for _ in range(rounds):
        new = np.argmin((centres**2).sum(axis=1) - 2 * x @ centres.T, axis=1)
        if (new == of).all() and _:
            break
        of = new
        for j in range(k):
            if (of == j).any():
                centres[j] = x[of == j].mean(axis=0)
    return centres, of


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v as packed float64) of the rows that take part: an id, and a vector without null or non-finite
    components that is not zero and as long as most are (ties: the longer). Rows of equal id are one: the smallest vector.
    """
    v = F.col(vector_col)
    fine = rows.where(F.col(id_col).isNotNull() & v.isNotNull()).where(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    one = fine.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(v.cast(ArrayType(FloatType()) if isinstance(rows.schema[vector_col].dataType.elementType, FloatType) else "array<double>")).alias("v"))
    packed = stage(one.mapInArrow(_packer, "id long, size int, v binary"), "vectors")
    sizes = packed.groupBy("size").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    return packed.where(F.col("size") == (sizes[0] if sizes else 0)).select("id", "v")


def _packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column("v")
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<f8")
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), pa.array(sizes.astype(np.int32)), pa.array([flat[e - s:e].tobytes() for s, e in zip(sizes, ends)], pa.binary())],
            names=["id", "size", "v"])


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(len(column), width)


def _best(ids: np.ndarray, rows: np.ndarray, query_id: int, query: np.ndarray, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of one block, ids ascending within it. Rough products choose, exact sums decide and break ties."""
    other = ids != query_id
    if not other.all():
        rough = np.where(other, rough, -np.inf)
    if len(ids) > k:
        slack = 1e-9 * (np.abs(rough[np.isfinite(rough)]).max(initial=0.0) + np.abs(query).sum() * 1e-3)
        near = np.flatnonzero(rough >= np.partition(rough, -k)[-k] - slack)
        near = near[other[near]]
    else:
        near = np.flatnonzero(other)
    exact = (rows[near] * query).sum(axis=1)
    order = np.lexsort((ids[near], -exact))[:k]
    return ids[near][order], exact[order]


FOUND = "query_id long, vec_id long, score double, leaf int"


def _top(found: DataFrame, k: int) -> DataFrame:
    """Each query's k nearest with their rank; a query has at most k rows per block it met."""
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def exact_neighbours(index: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """Exact neighbours of a bounded query set against all rows, in blocks."""
    shared = index.sparkSession.sparkContext.broadcast((ids, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qid, q = shared.value
        best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.empty(0, dtype=np.int64), np.empty(0), np.empty(0, dtype=np.int64))] * len(qid)
        for b in batches:
            if not b.num_rows:
                continue
            own, leaf, rows = b.column("id").to_numpy(), b.column("leaf").to_numpy(), _matrix(b.column("v"), q.shape[1])
            order = np.argsort(own)
            own, leaf, rows = own[order], leaf[order], rows[order]
            for j, rough in enumerate(q @ rows.T):
                near, score = _best(own, rows, qid[j], q[j], rough, k)
                merged = np.concatenate([best[j][0], near]), np.concatenate([best[j][1], score]), np.concatenate([best[j][2], leaf[np.searchsorted(own, near)]])
                keep = np.lexsort((merged[0], -merged[1]))[:k]
                best[j] = merged[0][keep], merged[1][keep], merged[2][keep]
        n = [len(x[0]) for x in best]
        if sum(n):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(qid, n)), *(pa.array(np.concatenate([x[i] for x in best])) for i in (0, 1)),
                 pa.array(np.concatenate([x[2] for x in best]).astype(np.int32))], names=["query_id", "vec_id", "score", "leaf"])

    return _top(index.select("id", "leaf", "v").mapInArrow(run, FOUND), k)


def calibrated_visits(index: DataFrame, tree: Tree, is_query: Column, k: int, width: int, recall: float = RECALL,
                      most: int = CALIBRATION) -> int:
    """Leaves to visit: widened until ``recall`` of the exact neighbours of ``most`` queries lies in the leaves visited."""
    drawn = index.where(is_query).select("id", "v").orderBy(F.xxhash64("id", F.lit(3)), "id").limit(most).collect()
    ids = np.array([r["id"] for r in drawn], dtype=np.int64)
    queries = np.array([np.frombuffer(r["v"], "<f8") for r in drawn]).reshape(len(drawn), width)
    if not len(ids):
        return 1
    true = exact_neighbours(index, ids, queries, k).select("query_id", "leaf").collect()  # k rows for each of ``most`` queries
    orders = {q: {leaf: n for n, leaf in enumerate(order)} for q, order in zip(ids.tolist(), tree.visits(queries, len(tree.leaf_nodes), np.zeros(len(tree.leaf_nodes), dtype=np.int64), 0))}
    places = np.array([orders[r["query_id"]][r["leaf"]] for r in true])
    visits = 1
    while len(places) and (places < visits).mean() < recall:
        visits += 1
    return visits


def search(rows: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           recall: float = RECALL, sample: int = SAMPLE, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Neighbours of the rows for which ``is_query`` (over the column ``id``) holds: query_id, rank, vec_id, score.

    Every usable row is a candidate of every query but itself; ties go to the smaller id. See ``usable`` for
    what takes part. Fewer than k candidates are all returned; without queries or rows the result is empty.
    """
    spark = rows.sparkSession
    vectors = usable(rows, id_col, vector_col)
    total = vectors.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not total:
        return empty
    drawn = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    fitted = np.array([np.frombuffer(r["v"], "<f8") for r in drawn])
    width = fitted.shape[1]
    norm = vectors.mapInArrow(lambda bs: (pa.RecordBatch.from_arrays(
        [pa.array([float(np.linalg.norm(_matrix(b.column("v"), width), axis=1).max(initial=0.0))])], names=["m"]) for b in bs if b.num_rows),
        "m double").agg(F.max("m")).first()[0]
    tree = Tree(fitted, norm, max(1, min(-(-total // leaf_rows), sample // (4 * BRANCHES))))
    shared = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                leaf = shared.value.leaf(_matrix(b.column("v"), width))
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(leaf.astype(np.int32)), b.column("v")], names=["id", "leaf", "v"])

    index = stage(vectors.select("id", "v").mapInArrow(place, "id long, leaf int, v binary"), "index")
    visits = calibrated_visits(index, tree, is_query, k, width, recall)
    leaf_sizes = np.zeros(len(tree.leaf_nodes), dtype=np.int64)
    for row in index.groupBy("leaf").count().collect():  # leaves are bounded by the sample
        leaf_sizes[row["leaf"]] = row["count"]

    group_of = tree.groups(leaf_sizes, GROUP_ROWS)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            orders = shared.value.visits(_matrix(b.column("v"), width), visits, leaf_sizes, k + 1)  # itself and k others
            rows_, groups, leaves, first = [], [], [], []
            for i, order in enumerate(orders):
                own: dict[int, list[int]] = {}
                for leaf in order:
                    own.setdefault(int(group_of[leaf]), []).append(leaf)
                rows_ += [i] * len(own)
                groups += own.keys()
                leaves += own.values()
                first += [g == int(group_of[order[0]]) for g in own]
            at = pa.array(rows_)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(at), b.column("v").take(at), pa.array(groups, pa.int32()), pa.array(leaves, pa.list_(pa.int32())), pa.array(first)],
                names=["query_id", "q", "grp", "leaves", "first"])

    # A row per query and group of neighbouring leaves; a large group, and one that many queries visit, is dealt in blocks.
    walked = stage(index.where(is_query).select("id", "v").mapInArrow(walk, "query_id long, q binary, grp int, leaves array<int>, first boolean"), "walks")
    numbers = F.array(*[F.lit(int(g)) for g in group_of])  # leaves are bounded in number
    grouped = index.withColumn("grp", numbers[F.col("leaf")])

    def blocks_of(queries: DataFrame) -> DataFrame:
        sizes = grouped.groupBy("grp").agg(F.count("*").alias("n")).join(queries.groupBy("grp").agg(F.count("*").alias("m")), "grp")
        return F.broadcast(stage(sizes.select(
            "grp", F.ceil(F.col("n") / GROUP_ROWS).cast("int").alias("row_blocks"), F.ceil(F.col("m") / BLOCK_QUERIES).cast("int").alias("query_blocks")), "groups"))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("leaf", pa.int32())])
        if not a.num_rows or not b.num_rows:
            return schema.empty_table()
        ids, leaf, rows_ = a.column("id").to_numpy(), a.column("leaf").to_numpy(), _matrix(a.column("v"), width)
        order = np.argsort(ids)
        ids, leaf, rows_ = ids[order], leaf[order], rows_[order]
        qid, q, least = b.column("query_id").to_numpy(), _matrix(b.column("q"), width), b.column("least").to_numpy()
        visited = np.zeros((len(qid), len(group_of)), dtype=bool)
        lists = b.column("leaves").combine_chunks()
        visited[np.repeat(np.arange(len(qid)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()] = True
        got = []
        for s in range(0, len(qid), 256):
            for j, rough in enumerate(q[s:s + 256] @ rows_.T, s):
                seen = visited[j][leaf]
                near, score = _best(ids[seen], rows_[seen], qid[j], q[j], rough[seen], k)
                got.append((near[score >= least[j]], score[score >= least[j]]))
        n = [len(x[0]) for x in got]
        return pa.table([np.repeat(qid, n), np.concatenate([x[0] for x in got]), np.concatenate([x[1] for x in got]),
                         np.zeros(sum(n), dtype=np.int32)], schema=schema)

    def wave(queries: DataFrame) -> DataFrame:
        """The k best of every query in every block it meets, those below its ``least`` left out."""
        blocks, keys = blocks_of(queries), ["grp", "row_block", "query_block"]

        def dealt(side: DataFrame, key: str, own: str, other: str) -> DataFrame:
            named = side.join(blocks, "grp").withColumn(own[:-1], F.pmod(F.xxhash64(key), F.col(own)).cast("int"))
            return named.withColumn(other[:-1], F.explode(F.sequence(F.lit(0), F.col(other) - 1)))

        left = dealt(grouped, "id", "row_blocks", "query_blocks").select(*keys, "id", "leaf", "v")
        right = dealt(queries, "query_id", "query_blocks", "row_blocks").select(*keys, "query_id", "q", "leaves", "least")
        return stage(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, FOUND), "found")

    # The group with the nearest leaf gives each query a k-th score; from the others only what reaches it comes back.
    near = wave(walked.where("first").withColumn("least", F.lit(float("-inf"))))
    least = _top(near, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    rest = walked.where("not first").join(least, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    return _top(near.unionByName(wave(rest)), k).select("query_id", "rank", "vec_id", "score")
