"""Audit of interacting text filters: what each filter removes in every order of applying them.

A document fails some of the filters; the set of those is its mask. In an order of filters it is removed
at the smallest position among the filters it fails: the minimum, over filters, of a mask matrix (0 where
a mask fails a filter, infinite elsewhere) plus the positions of an order (its inverse permutation). That
min-plus product of masks and orders is all the audit needs. Documents are counted by part and mask
before anything meets, so a part has at most 2 ** filters rows, each scattered by its removal step with
its counts as weights.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from voltweave.sources.staging import stage

FILTERS = "ABCDE"
FEWEST_WORDS = 100
DISTINCT_PERCENT = 80
CAPITALS_PERCENT = 10
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
MARKS = b"#$%&*|"
AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def text_mask(text: str) -> int:
    """Bits 0 to 3: too few words, too few distinct words, too many capitals, a mark of ``MARKS``."""
    data = text.encode()
    words = data.split()  # bytes are split at \x20 and \x09-\x0D, no other white space
    return (
        (len(words) < FEWEST_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
        | (100 * (len(data) - len(data.translate(None, CAPITALS))) > CAPITALS_PERCENT * len(text)) << 2
        | (len(data.translate(None, MARKS)) < len(data)) << 3
    )


@F.pandas_udf(IntegerType())
def text_masks(texts: pd.Series) -> pd.Series:
    return texts.map(text_mask).astype("int32")


def masked_documents(docs: DataFrame) -> DataFrame:
    """doc_id, part and mask of every row. Bit 4: a smaller doc_id has the same text.

    A null text is empty, a null lang the empty part. A null doc_id is neither smaller nor larger than
    another, so its row never fails by bit 4; of repeated rows of one doc_id none is the copy of another.
    Equal texts are found by SHA-256; texts are not shuffled.
    """
    text = F.coalesce("text", F.lit(""))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    own = stage(read.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), text_masks("text").alias("mask")), "masks")
    firsts = own.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    # A text's group may hold a third of the rows, a pair of text and id does not: no hot key in this join.
    copied = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return own.join(firsts, ["doc_id", "digest"], "left").select(
        "doc_id", "part", F.col("mask").bitwiseOR(F.when(copied, 16).otherwise(0)).alias("mask"))


def removal_steps(masks: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """(masks x orders) min-plus product: the step, from 0, that removes a mask; the number of filters where none does."""
    n = positions.shape[1]
    bits = masks[:, None] >> np.arange(n) & 1
    cost = np.where(bits == 1, 0, n)
    return np.minimum((cost[:, None, :] + positions[None, :, :]).min(axis=2), n)


def _scatter(filters: str):
    n = len(filters)
    orders = np.array(list(permutations(range(n))))
    positions = np.argsort(orders, axis=1)
    names = ["".join(filters[f] for f in order) for order in orders]

    def run(rows: pa.Table) -> pa.Table:
        masks = rows.column("mask").to_numpy()
        steps = removal_steps(masks, positions)
        cells = np.arange(len(orders)) * (n + 1) + steps

        def scattered(weights: np.ndarray) -> np.ndarray:
            out = np.zeros(len(orders) * (n + 1), dtype=np.int64)
            np.add.at(out, cells, np.broadcast_to(weights[:, None], cells.shape))
            return out.reshape(len(orders), n + 1)[:, :n]

        count = rows.column("n").to_numpy()
        removed = scattered(count)
        failing = ((masks[:, None] >> np.arange(n) & 1) * count[:, None]).sum(axis=0)
        alone = np.array([count[masks == 1 << f].sum() for f in range(n)])
        shapley = np.take_along_axis(removed, positions, axis=1).sum(axis=0)  # by filter, over all orders
        columns = [
            count.sum() - removed.cumsum(axis=1), removed, failing[orders] - removed, alone[orders],
            scattered(rows.column("good").to_numpy()), scattered(rows.column("toxic").to_numpy()), shapley[orders],
        ]
        return pa.table(
            [pa.array([rows.column("part")[0].as_py()] * removed.size), pa.array(np.repeat(names, n).tolist()),
             pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders))), *(pa.array(c.ravel().astype(np.int64)) for c in columns)],
            names=[c.split()[0] for c in AUDIT.split(", ")])

    return run


def audit(masked: DataFrame, good: Column, toxic: Column, filters: str = FILTERS) -> DataFrame:
    """Rows of ``AUDIT`` for every part, order of ``filters`` and step, from rows of part and mask (bit f: fails filter f).

    ``good`` and ``toxic`` are conditions on a row (null counts as false). Every row counts, repeated ones
    too. An empty table gives no rows.
    """
    counts = masked.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(good).alias("good"), F.count_if(toxic).alias("toxic"))
    return counts.groupBy("part").applyInArrow(_scatter(filters), AUDIT)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five text filters by lang; a document is good or toxic where any row of ``labels`` says so.

    Labels of a null doc_id and documents without labels count as neither. Other columns are not read.
    """
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.expr("quality = 1")).alias("good"), F.max(F.expr("toxic = 1")).alias("toxic"))
    return audit(masked_documents(docs).join(marks, "doc_id", "left"), F.col("good"), F.col("toxic"))


REPORT_SQL = r"""
WITH read AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
 split AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM read),
 marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
           FROM labels GROUP BY doc_id),
 masked AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, len(w) < 100 AS a,
             100 * len(list_distinct(w)) < 80 * len(w) AS b, 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c,
             regexp_matches(t, '[#$%&*|]') AS d, coalesce(s.doc_id > first, false) AS e
            FROM split s LEFT JOIN marks m ON m.doc_id = s.doc_id),
 counted AS (SELECT part, a, b, c, d, e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masked GROUP BY ALL),
 letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
 orders AS (SELECT p.l || q.l || r.l || s.l || t.l AS o FROM letters p, letters q, letters r, letters s, letters t
            WHERE len(list_distinct([p.l, q.l, r.l, s.l, t.l])) = 5),
 removals AS (SELECT part, o, n, good, toxic, a, b, c, d, e, a::int + b::int + c::int + d::int + e::int AS failed,
               least(CASE WHEN a THEN strpos(o, 'A') ELSE 9 END, CASE WHEN b THEN strpos(o, 'B') ELSE 9 END,
                     CASE WHEN c THEN strpos(o, 'C') ELSE 9 END, CASE WHEN d THEN strpos(o, 'D') ELSE 9 END,
                     CASE WHEN e THEN strpos(o, 'E') ELSE 9 END) AS gone FROM counted, orders),
 steps AS (SELECT *, CASE substr(o, step, 1) WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS hit
           FROM removals, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
 made AS (SELECT part, o AS filter_order, step, sum(CASE WHEN gone > step THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN gone = step THEN n ELSE 0 END) AS removed, sum(CASE WHEN hit AND gone < step THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN hit AND failed = 1 THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN gone = step THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN gone = step THEN toxic ELSE 0 END) AS toxic_lost
          FROM steps GROUP BY part, o, step)
SELECT part, filter_order, step::int AS step, kept::bigint AS kept, removed::bigint AS removed, redundant::bigint AS redundant,
 unique_fails::bigint AS unique_fails, good_lost::bigint AS good_lost, toxic_lost::bigint AS toxic_lost,
 (sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)))::bigint AS shapley FROM made
"""
