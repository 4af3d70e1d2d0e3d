"""Benchmark decontamination with a distributed positional inverted index.

A term is a pair of neighbouring words (for one-word items, the word itself), as its 64-bit hash. The
index stores the postings (document, position, term) of the whole corpus for the terms that benchmark
items have. A phrase of n words is fixed by the terms at its even places and its last place. Its
candidates come from the rarest of them by corpus count; the lists of the others, shifted by their
places, are then intersected with the candidates in one join. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltweave.llm.common import ascii_lower
from voltweave.sources.staging import stage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
ROW = ["doc_id", "__row"]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), 0)


def row_key(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text, and the text: rows alike in both have the same result."""
    return docs.select(F.col("doc_id"), F.xxhash64("text").alias("__row"), "text")


def phrases(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(phrases with the terms that fix them, the items that hold each phrase).

    An item of ``window`` words or more has every run of ``window`` words as a phrase, a shorter one is a
    phrase itself, one without words has none.
    """
    cut = items.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    spans = cut.select(
        "item_id", "words", F.least(F.size("words"), F.lit(window)).alias("n"),
    ).withColumn("first", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("n") + 1)))
    runs = spans.select("item_id", "n", F.slice("words", F.col("first"), F.col("n")).alias("run"))
    runs = runs.withColumn("phrase", F.xxhash64(F.array_join("run", " ")))
    holders = stage(runs.select("phrase", "item_id").distinct(), "phrase-items")
    places = F.expr("array_distinct(concat(filter(sequence(0, n - 1), i -> i % 2 = 0 and i < n - 1), array(greatest(n - 2, 0))))")
    terms = runs.dropDuplicates(["phrase"]).withColumn("place", F.explode(places)).select(
        "phrase", "n", "place", (F.col("n") == 1).alias("single"),
        F.expr("if(n = 1, xxhash64(run[place]), xxhash64(run[place], run[place + 1]))").alias("term"),
    )
    return stage(terms, "phrase-terms"), holders


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The index: doc_id, __row, position and term, for every place in ``docs`` that holds a term of ``terms``."""
    cut = row_key(docs).select(*ROW, words_of(F.col("text")).alias("words"))
    pairs = F.expr("zip_with(slice(words, 1, greatest(size(words) - 1, 0)), slice(words, 2, greatest(size(words) - 1, 0)),"
                   " (a, b) -> xxhash64(a, b))")
    found = cut.select(*ROW, F.posexplode(pairs).alias("position", "term"))
    known = terms.where(~F.col("single")).select("term").distinct()
    made = found.join(known, "term", "left_semi")
    if not terms.where("single").isEmpty():
        alone = cut.select(*ROW, F.posexplode(F.expr("transform(words, w -> xxhash64(w))")).alias("position", "term"))
        made = made.unionByName(alone.join(terms.where("single").select("term").distinct(), "term", "left_semi"))
    return stage(made.select(*ROW, "position", "term"), "postings")


def phrase_matches(index: DataFrame, terms: DataFrame) -> DataFrame:
    """Every exact occurrence: doc_id, __row, start, n, phrase."""
    counts = index.groupBy("term").agg(F.count("*").alias("df"))
    ranked = terms.join(counts, "term", "left").groupBy("phrase").agg(
        F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "place", "term", "n")).alias("rarest"), F.count("*").alias("size"),
    ).where("rarest.df > 0")  # a term that is nowhere rules the phrase out
    # Narrow, so that it is broadcast as long as it is small; a frequent term then meets it without a shuffle.
    ranked = stage(ranked.select("phrase", "rarest.term", "rarest.place", "rarest.n", "size"), "rarest")
    candidates = index.join(ranked, "term").select(
        *ROW, (F.col("position") - F.col("place")).alias("start"), "phrase", "n", "size", F.col("place").alias("known")).where("start >= 0")
    others = terms.select("phrase", "place", "term")
    wanted = candidates.join(others, "phrase").where("place != known or size = 1").select(
        *ROW, "start", "phrase", "n", "size", "place", "term", (F.col("start") + F.col("place")).alias("position"))
    same = [F.col(f"w.{c}").eqNullSafe(F.col(f"i.{c}")) for c in ROW] + [F.col(f"w.{c}") == F.col(f"i.{c}") for c in ("position", "term")]
    met = wanted.alias("w").join(index.alias("i"), same, "left_semi")
    # The places found, as bits, so that repeated rows of a document count once.
    return met.groupBy(*ROW, "start", "phrase", "n", "size").agg(
        F.bit_or(F.expr("shiftleft(1L, place)")).alias("places")
    ).where(F.bit_count("places") >= F.greatest(F.col("size") - 1, F.lit(1))).select(*ROW, "start", "n", "phrase")


def proximity_matches(index: DataFrame, terms: DataFrame, slack: int = 4, share: float = 0.6) -> DataFrame:
    """Loose occurrences: documents where at least ``share`` of a phrase's terms lie within ``slack`` places of
    where an occurrence would have them. doc_id, __row, phrase, near (terms found), of.
    """
    sizes = terms.groupBy("phrase").agg(F.count("*").alias("of"))
    shifted = index.join(terms, "term").select(*ROW, "phrase", "place", (F.col("position") - F.col("place")).alias("start"))
    # Two grids, half a cell apart: starts within ``slack`` of each other share a cell of one of them.
    cells = F.explode(F.array(F.floor(F.col("start") / (2 * slack)) * 2, F.floor((F.col("start") + slack) / (2 * slack)) * 2 + 1))
    near = shifted.withColumn("cell", cells).groupBy(*ROW, "phrase", "cell").agg(F.countDistinct("place").alias("near"))
    return near.groupBy(*ROW, "phrase").agg(F.max("near").alias("near")).join(sizes, "phrase").where(
        F.col("near") >= F.greatest(F.lit(1.0), share * F.col("of"))).select(*ROW, "phrase", "near", "of")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, __row (hash of its text), n_hit and the sorted item ids; only documents that are hit.

    Rows alike in doc_id and text give one row here. A null text has no words; items without words and
    an empty benchmark hit nothing. An item without id hits words but is not named.
    """
    terms, holders = phrases(items, window)
    index = postings(docs, terms)
    hits = stage(phrase_matches(index, terms), "matches")
    covered = hits.select(*ROW, F.explode(F.expr("sequence(start, start + n - 1)")).alias("position")).distinct()
    n_hit = covered.groupBy(*ROW).agg(F.count("*").alias("n_hit"))
    found = hits.select(*ROW, "phrase").distinct().join(holders, "phrase").select(*ROW, F.col("item_id").cast("string").alias("item")).distinct()
    named = found.groupBy(*ROW).agg(F.array_sort(F.collect_list("item")).alias("items"))
    same = [F.col(f"h.{c}").eqNullSafe(F.col(f"n.{c}")) for c in ROW]
    return stage(n_hit.alias("h").join(named.alias("n"), same).select("h.doc_id", "h.__row", "n_hit", "items"), "contamination")


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    counted = docs.select("doc_id", "text", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    narrow = counted.select("doc_id", F.xxhash64("text").alias("__row"), "n_words")
    hit = contamination(docs, items, window)
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"h.{c}")) for c in ROW]
    items_of = F.coalesce("h.items", F.array().cast("array<string>"))
    n_hit = F.coalesce(F.col("h.n_hit"), F.lit(0))
    return narrow.alias("d").join(hit.alias("h"), same, "left").select(
        "d.doc_id", "d.n_words", n_hit.alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_of, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that share no phrase with the benchmark, columns unchanged."""
    hit = contamination(docs, items, window)
    same = [F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")), F.xxhash64("d.text").eqNullSafe(F.col("h.__row"))]
    return docs.alias("d").join(hit.select("doc_id", "__row").alias("h"), same, "left_anti")


REPORT_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT item_id, least(len(w), 10) AS n, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM b WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS phrase FROM p),
places AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM q) WHERE len(w) >= n),
runs AS (SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS phrase FROM places),
hits AS (SELECT r, s, q.n, item_id FROM runs JOIN q USING (n, phrase)),
covered AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS x FROM hits) GROUP BY r),
named AS (SELECT r, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""
