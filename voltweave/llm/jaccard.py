"""Jaccard join of documents on word shingles, with a token-group matrix.

Exact for a similarity given in percent. Equal sets are one node. A linked pair shares enough of the
smallest hashes of both sets (``need``), so each set publishes only that head. Nodes whose head is not
shared enough with anyone are done. The others are partitioned into groups of similar sets: the group of
a node is the leader that most of its shared tokens point to. The matrix of (token, group) bounds how much
a node can overlap a group; only groups that reach the bound are opened, in blocks: a block's token union
bounds the overlap once more, with whole sets, before its members are compared. Links are reduced to a
forest per block, and components follow from the forest. A member that is linked with its leader needs
no comparison inside its group but with those that are not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltweave.llm.common import bounded_slices, expand, flag_maybe, partitions, pieces_of, release_memory
from voltweave.llm.text_arrays import LOWERED, flat_bytes, mix, run_hashes, shingle_hashes, word_bounds
from voltweave.sources.staging import stage

SLICE_BYTES = 1 << 20
SEEN = 100_000  # sets that a task remembers, so as to publish copies once; more are published again
BLOCK_SETS = 1024
LARGE_BLOCK = 1 << 18  # tokens of a block after which memory is given back
HEAD_PART = 4  # one in so many tokens of a head must be met: larger heads, tighter bounds
NO_ID = 2**63 - 1  # stands for a null doc_id in joins
SKETCH = "kind int, bucket int, doc_id long, row long, n long, d long, blob binary"
GATHERED_NAMES = ["kind", "doc_id", "row", "n", "d", "token"]
GATHERED = "kind int, doc_id long, row long, n long, d long, token long"


def least_overlap(n, percent: int):
    """Fewest common tokens of a set of ``n`` with any set it is linked with."""
    return -(-percent * n // 100)


def need(n, percent: int):
    """Tokens that the heads of two linked sets share at least, for the smaller size ``n`` of the two."""
    return np.minimum(np.maximum(1, n // HEAD_PART), least_overlap(n, percent))


def head(n, percent: int):
    """Length of the head of a set of ``n``: what a link may miss, and ``need`` more."""
    return n - least_overlap(n, percent) + need(n, percent)


def _need_sql(n: str, percent: int) -> str:
    """``need`` for the smallest size a set linked with one of ``n`` can have."""
    m = f"(({percent} * {n} + 99) div 100)"
    return f"least(greatest(1, {m} div {HEAD_PART}), ({percent} * {m} + 99) div 100)"


def text_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = flat_bytes(texts)
    data = LOWERED[data]
    starts, ends, text_of = word_bounds(data, offsets)
    h, at = shingle_hashes(run_hashes(data, starts, ends), text_of, len(texts), k)
    return [np.unique(h[a:b]) for a, b in zip(at, at[1:])]


def _digest(tokens: np.ndarray) -> int:
    return int(mix(tokens).sum(dtype=np.uint64).view(np.int64))


def _sketcher(k: int, percent: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory(drop_caches=True)
        seen: set[int] = set()
        rows = 0
        for batch in batches:
            for part in bounded_slices(batch, "text", SLICE_BYTES):
                if len(seen) > SEEN:
                    seen.clear()
                sets = text_sets(part.column("text"), k)
                digests = [_digest(s) for s in sets]
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                fresh = []
                for i, d in enumerate(digests):  # copies within a task publish once
                    if sizes[i] and d not in seen:
                        seen.add(d)
                        fresh.append(i)
                heads = [sets[i][:head(sizes[i], percent)] for i in fresh]
                tokens = np.concatenate(heads) if heads else np.empty(0, dtype=np.uint64)
                owners = np.repeat(np.array([digests[i] for i in fresh], dtype=np.int64), [len(h) for h in heads])
                blobs = pieces_of(tokens, owners, (tokens % np.uint64(buckets)).astype(np.int64), buckets)
                n, m = len(sets), len(blobs)
                none = [None] * m
                yield pa.RecordBatch.from_arrays([
                    pa.array([0] * n + [1] * m, pa.int32()),
                    # Documents are dealt in turn: copies of one text, or texts without words, are not kept together.
                    pa.array([(rows + i) % buckets for i in range(n)] + [b for b, _, _ in blobs], pa.int32()),
                    pa.array(part.column("doc_id").to_pylist() + none, pa.int64()), pa.array(part.column("row").to_pylist() + none, pa.int64()),
                    pa.array(sizes.tolist() + none, pa.int64()), pa.array(digests + none, pa.int64()),
                    pa.array([None] * n + [t.tobytes() + o.tobytes() for _, t, o in blobs], pa.binary()),
                ], names=["kind", "bucket", "doc_id", "row", "n", "d", "blob"])
                rows += n
        release_memory(drop_caches=True)

    return run


def _shared_tokens(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Of the tokens published to one bucket those of two nodes or more."""
    halves = [len(b) // 2 for b in blobs]
    t = np.concatenate([np.frombuffer(b[:h], dtype=np.uint64) for b, h in zip(blobs, halves)])
    o = np.concatenate([np.frombuffer(b[h:], dtype=np.int64) for b, h in zip(blobs, halves)])
    order = np.lexsort((o, t))
    t, o = t[order], o[order]
    once = np.ones(len(t), dtype=bool)
    once[1:] = (t[1:] != t[:-1]) | (o[1:] != o[:-1])
    t, o = t[once], o[once]
    same = np.zeros(len(t) + 1, dtype=bool)
    same[1:-1] = t[1:] == t[:-1]
    shared = same[1:] | same[:-1]
    t, o = t[shared], o[shared]
    for a in range(0, len(t), 50_000):
        n = len(t[a:a + 50_000])
        empty = pa.nulls(n, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(n, dtype=np.int32)), empty, empty, empty, pa.array(o[a:a + 50_000]), pa.array(t[a:a + 50_000].view(np.int64))],
            names=GATHERED_NAMES)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of buckets: rows of documents pass, the tokens of a bucket are settled when it ends."""
    at, blobs = -1, []
    for batch in batches:
        docs = batch.filter(pa.compute.equal(batch.column("kind"), 0))
        yield pa.RecordBatch.from_arrays([*(docs.column(c) for c in GATHERED_NAMES[:-1]), pa.nulls(docs.num_rows, pa.int64())], names=GATHERED_NAMES)
        made = batch.filter(pa.compute.equal(batch.column("kind"), 1))
        for bucket, blob in zip(made.column("bucket").to_pylist(), made.column("blob").to_pylist()):
            if bucket != at and blobs:
                yield from _shared_tokens(blobs)
                blobs = []
            at = bucket
            blobs.append(blob)
    if blobs:
        yield from _shared_tokens(blobs)
    release_memory(drop_caches=True)


def _whole_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bounded_slices(batch, "text", SLICE_BYTES):
                sets = text_sets(part.column("text"), k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["d", "tokens"])
        release_memory(drop_caches=True)

    return run


def _tokens(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=np.uint64)


def _leader_overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        common = [len(np.intersect1d(_tokens(x), _tokens(y), assume_unique=True))
                  for x, y in zip(b.column("tokens").to_pylist(), b.column("leader_tokens").to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column("d"), b.column("n"), b.column("lead"), b.column("leader_n"), pa.array(common, pa.int64())],
                                         names=["d", "n", "lead", "leader_n", "common"])
    release_memory(drop_caches=True)


def _opener(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(members: pa.Table, queries: pa.Table) -> pa.Table:
        if not members.num_rows or not queries.num_rows:
            return schema.empty_table()
        ids, sets = members.column("d").to_numpy(), [_tokens(x) for x in members.column("tokens").to_pylist()]
        linked, sizes = members.column("linked").to_numpy(zero_copy_only=False), np.array([len(s) for s in sets])
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(flat, kind="stable")
        union, first, count = np.unique(flat[order], return_index=True, return_counts=True)  # the block's row of the matrix
        owner = owner[order]
        parent = {int(x): int(x) for x in [*ids, *queries.column("d").to_pylist()]}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        own = ids[linked]
        for x in own[1:]:  # all linked with the leader already
            parent[root(int(x))] = root(int(own[0]))
        edges = []
        for q, blob in zip(queries.column("d").to_pylist(), queries.column("tokens").to_pylist()):
            tokens = _tokens(blob)
            at = np.minimum(np.searchsorted(union, tokens), len(union) - 1)
            at = at[union[at] == tokens]
            if len(at) < least_overlap(len(tokens), percent):
                continue  # no member can overlap enough
            common = np.bincount(owner[expand(first[at], count[at])], minlength=len(sets))
            for j in np.flatnonzero(100 * common >= percent * (len(tokens) + sizes - common)):
                x, y = root(q), root(int(ids[j]))
                if x != y:
                    parent[x] = y
                    edges.append((q, int(ids[j])))
        if len(flat) > LARGE_BLOCK:  # the worker stays after its last group
            del sets, flat, owner, order, union, first, count
            release_memory()
        return pa.table(list(zip(*edges)) or [[], []], schema=schema)

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of an edge. Labels jump, so rounds grow with
    the logarithm of the longest path."""
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = stage(lower.join(jump, "label").select("node", "old", F.least("label", "next").alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.where("label != old").isEmpty():
            return labels


def linked_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Every row of ``docs``: doc_id, row (hash of its text), n_shingles, component_id, class_id.

    A set is the distinct runs of ``k`` words of the lower-cased text; fewer words are one run; a text
    without words is empty and linked with nothing. Two rows link when 100 * intersection >= percent * union.
    component_id is the smallest doc_id reachable, class_id the smallest with the very same set; null ids
    count only where there is no other. Repeated rows are equal sets. An empty table gives no rows.
    """
    spark = docs.sparkSession
    buckets = 16 * partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    sketched = rows.mapInArrow(_sketcher(k, percent, buckets), SKETCH).repartition(partitions(spark), "bucket").sortWithinPartitions("bucket")
    gathered = stage(sketched.mapInArrow(_gather, GATHERED), "heads")
    documents = gathered.where("kind = 0")
    sets = stage(documents.where("n > 0").groupBy("d", "n").agg(F.min("doc_id").alias("rep")), "sets")
    posts = gathered.where("kind = 1").select("token", "d")

    def shared_enough(tokens: DataFrame) -> DataFrame:
        counts = tokens.groupBy("d").agg(F.count("*").alias("c"))
        return counts.join(sets, "d").where(f"c >= {_need_sql('n', percent)}")

    first = shared_enough(posts).select("d")
    posts = stage(posts.join(first, "d", "left_semi"), "tokens")
    leads = posts.groupBy("token").agg(F.min("d").alias("lead"), F.count("*").alias("df")).where("df > 1").select("token", "lead")
    posts = stage(posts.join(leads, "token"), "tokens")
    heads = shared_enough(posts).join(posts.groupBy("d").agg(F.mode("lead", True).alias("lead")), "d")
    heads = stage(heads.select("d", "n", "rep", "c", "lead"), "nodes")

    key = F.coalesce("doc_id", F.lit(NO_ID)).alias("key")
    wanted = heads.select(F.col("rep").alias("doc_id")).select(key).distinct()
    texts = flag_maybe(rows.select(key, "text"), wanted).where("maybe").join(wanted, "key", "left_semi").select("text")
    full = texts.mapInArrow(_whole_sets(k), "d long, tokens binary").join(heads.select("d", "n", "lead"), "d")
    full = stage(full.dropDuplicates(["d"]), "whole-sets")

    followers = full.where("d != lead").alias("x").join(
        full.select(F.col("d").alias("leader"), F.col("n").alias("leader_n"), F.col("tokens").alias("leader_tokens")), F.col("lead") == F.col("leader"))
    overlaps = followers.select("d", "n", "lead", "leader_n", "tokens", "leader_tokens").mapInArrow(
        _leader_overlaps, "d long, n long, lead long, leader_n long, common long")
    with_leader = stage(overlaps.where(f"100 * common >= {percent} * (n + leader_n - common)").select("d", "lead"), "leader-links")
    nodes = stage(heads.select("d", "n", "lead", "c").join(with_leader.select("d", F.lit(True).alias("linked")), "d", "left").select(
        "d", "n", F.col("lead").alias("g"), F.coalesce("linked", F.col("d") == F.col("lead")).alias("linked")), "grouped")

    posted = stage(posts.select("token", "d").join(nodes.select("d", "n", "g"), "d"), "posted")
    matrix = posted.groupBy("token", "g").agg(F.lit(1).alias("one")).select("token", "g")
    wide = matrix.groupBy("token").agg(F.count("*").alias("gf")).where("gf > 1")
    mixed = stage(posted.join(wide, "token").withColumn("c", F.expr("count(*) over (partition by d)")).withColumn(
        "place", F.expr("row_number() over (partition by d order by gf, token)")), "mixed")
    # ``need`` shared tokens or more: one of them is left when all but the rarest c - need + 1 are put aside.
    rare = mixed.where(f"place <= c - {_need_sql('n', percent)} + 1")
    columns = stage(matrix.join(wide.select("token"), "token", "left_semi"), "matrix")
    pairs = rare.select("token", "d", "g").join(columns.select("token", F.col("g").alias("other")), "token").where("other < g").select("d", "other").distinct()
    bounded = pairs.join(mixed.select("d", "token", "n"), "d").join(columns.select("token", F.col("g").alias("other")), ["token", "other"])
    crossing = bounded.groupBy("d", "n", "other").agg(F.count("*").alias("overlap")).where(f"overlap >= {_need_sql('n', percent)}")
    sizes = nodes.groupBy("g").agg(F.count("*").alias("members"), F.min("n").alias("least"), F.max("n").alias("most"))
    queries = crossing.select("d", "n", F.col("other").alias("g")).unionByName(nodes.where("not linked").select("d", "n", "g"))
    fitting = stage(queries.join(sizes, "g").where(f"100 * most >= {percent} * n and 100 * n >= {percent} * least"), "queries")
    asked = fitting.groupBy("g").agg(F.count("*").alias("asked"), F.first("members").alias("members")).select(
        "g", F.ceil(F.col("members") / BLOCK_SETS).cast("int").alias("member_blocks"), F.ceil(F.col("asked") / BLOCK_SETS).cast("int").alias("query_blocks"))

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        named = side.join(asked, "g").withColumn(own[:-1], F.pmod(F.xxhash64("d"), F.col(own)).cast("int"))
        return named.withColumn(other[:-1], F.explode(F.sequence(F.lit(0), F.col(other) - 1)))

    keys = ["g", "member_block", "query_block"]
    whole = full.select("d", "tokens")
    left = dealt(nodes.select("d", "g", "linked"), "member_blocks", "query_blocks").join(whole, "d").select(*[F.col(c).alias(c) for c in (*keys, "d", "linked", "tokens")])
    right = dealt(fitting.select("d", "g"), "query_blocks", "member_blocks").join(whole, "d").select(*[F.col(c).alias(c) for c in (*keys, "d", "tokens")])
    opened = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_opener(percent), "a long, b long")
    edges = with_leader.select(F.col("d").alias("a"), F.col("lead").alias("b")).unionByName(opened)
    labels = components(edges)
    named = labels.join(sets.select(F.col("d").alias("node"), "rep"), "node").withColumnRenamed("rep", "own")
    smallest = named.groupBy("label").agg(F.min("own").alias("component"))
    classes = sets.join(labels.withColumnRenamed("node", "d"), "d", "left").join(smallest, "label", "left").select(
        "d", "rep", F.coalesce("component", "rep").alias("component"))
    return documents.select("doc_id", "row", F.col("n").alias("n_shingles"), "d").join(stage(classes, "classes"), "d", "left").select(
        "doc_id", "row", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("rep")).alias("class_id"))


def one_per_component(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The document with the smallest doc_id of each component, columns unchanged.

    Documents without words stay, repeated rows of one document become one. Rows with a null doc_id stay
    only where their component has no other id, once per text.
    """
    found = linked_components(docs, k, percent).where("doc_id <=> component_id").select("doc_id", "row")
    stay = stage(found.groupBy("doc_id", "row").agg(F.count("*").alias("times")), "stay")
    same = [F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")), F.xxhash64("d.text").eqNullSafe(F.col("s.row"))]
    kept = docs.alias("d").join(stay.alias("s"), same)
    names = [F.col(f"d.`{c}`") for c in docs.columns]
    single = kept.where("s.times = 1").select(*names)
    return single.unionByName(kept.where("s.times > 1").select(*names).dropDuplicates(["doc_id", "text"]))
