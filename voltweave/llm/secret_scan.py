"""Secret scan with corpus-wide ownership of every candidate.

Three fixed patterns and one for opaque strings give candidates with their places. The hash of each
candidate value is counted over the whole corpus by distinct owner and repository. A value that many
owners share is an example that was copied; one that few own looks live. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltweave.llm.common import ascii_lower
from voltweave.sources.staging import stage

# The base patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # AKIA and more, at least 18 in all
HEX = r"[0-9a-f]{16,}"
OPAQUE = r"[A-Za-z0-9+/_-]{24,}"

KINDS = ["assign", "access", "hex", "opaque"]
ROW = ["doc_id", "__row"]


def _places(rows: DataFrame, kind: str, pattern: str, group: int) -> DataFrame:
    """One row per match: __row, kind, match number, characters since the last match, its length, its value."""
    text = F.col("text")
    found = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), 0).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), group).alias("value"),
    )
    return rows.select(*ROW, "owner", "repository", F.posexplode(found).alias("k", "m")).where("m.hit is not null").select(
        *ROW, "owner", "repository", F.lit(KINDS.index(kind)).alias("kind"), "k", F.length("m.gap").alias("gap"),
        F.length("m.hit").alias("size"), F.col("m.value").alias("value"))


def candidates(docs: DataFrame, owner: str = "source", repository: str = "lang") -> DataFrame:
    """Every candidate: doc_id, __row (hash of the text), owner, repository, kind, start, end, value_hash.

    A repository is known by owner and name. Rows alike in doc_id and text give their candidates once for
    each owner. Places count code points, the end is exclusive. Values as short as the patterns exclude
    are dropped after matching, so that they still hide what they overlap.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("__row"), F.coalesce("text", F.lit("")).alias("text"),
                       F.col(owner).cast("string").alias("owner"), F.concat_ws("/", owner, repository).alias("repository"))
    low = ascii_lower(F.col("text"))
    spoken = F.lit(False)
    for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
        spoken = spoken | F.contains(low, F.lit(word))
    found = [
        _places(rows.where(spoken), "assign", ASSIGN, 2),
        _places(rows.where(F.contains("text", F.lit("AKIA"))), "access", ACCESS, 0),
        _places(rows.where(F.col("text").rlike(HEX)), "hex", HEX, 0),
        _places(rows.where(F.col("text").rlike(OPAQUE)), "opaque", OPAQUE, 0),
    ]
    one = found[0]
    for more in found[1:]:
        one = one.unionByName(more)
    # Only lengths and values of matches are shuffled, by document and kind.
    one = one.dropDuplicates([*ROW, "owner", "repository", "kind", "k"])
    placed = one.withColumn("end", F.expr(
        "sum(gap + size) over (partition by doc_id, __row, owner, repository, kind order by k)"))
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Z]") & F.col("value").rlike("[a-z]")
    kept = F.when(F.col("kind") == 0, F.length("value") >= 12).when(F.col("kind") == 3, mixed).otherwise(True)
    return placed.where(kept).select(*ROW, "owner", "repository", "kind", (F.col("end") - F.col("size")).alias("start"), "end",
                                     F.sha2(F.col("value").cast("binary"), 256).alias("value_hash"))


def ownership(found: DataFrame) -> DataFrame:
    """Per candidate hash: n_owners and n_repositories over the whole corpus. Owners combine before the shuffle,
    so a value in a third of all documents is a few rows per task."""
    pairs = found.select("value_hash", F.coalesce("owner", F.lit("")).alias("owner"), "repository").distinct()
    return pairs.groupBy("value_hash", "owner").agg(F.count("*").alias("r")).groupBy("value_hash").agg(
        F.sum("r").alias("n_repositories"), F.count("*").alias("n_owners"))


def spans(docs: DataFrame, owner: str = "source", repository: str = "lang", widely: int = 5) -> DataFrame:
    """Spans of all documents that have any: doc_id, __row, and an array of (start, kind, end, n_owners, live).

    ``live`` is true for values of fewer than ``widely`` owners. Opaque strings are kept only if live
    and outside the base spans; base spans always stay.
    """
    found = stage(candidates(docs, owner, repository), "candidates")
    known = found.join(ownership(found), "value_hash")
    rows = known.select(*ROW, "start", "kind", "end", "n_owners", (F.col("n_owners") < widely).alias("live")).where("kind < 3 or live")
    grouped = rows.groupBy(*ROW).agg(F.array_sort(F.collect_set(F.struct("start", "kind", "end", "n_owners", "live"))).alias("all"))
    free = "s -> s.kind < 3 or not exists(all, b -> b.kind < 3 and b.start < s.end and s.start < b.end)"
    return grouped.select(*ROW, F.expr(f"filter(all, {free})").alias("spans"))


def _joined(spans_column: Column) -> Column:
    return F.array_join(F.transform(spans_column, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, owner: str = "source", repository: str = "lang", widely: int = 5) -> DataFrame:
    """Every row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live (base spans that look live)."""
    found = stage(spans(docs, owner, repository, widely), "spans")
    narrow = docs.select("doc_id", F.xxhash64("text").alias("__row"))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ROW]
    joined = narrow.alias("d").join(found.alias("s"), same, "left").withColumn(
        "all", F.coalesce("s.spans", F.expr("array()").cast(found.schema["spans"].dataType)))
    count = [F.expr(f"cast(size(filter(all, s -> s.kind = {k})) as long)").alias(f"n_{KINDS[k]}") for k in range(3)]
    base = _joined(F.filter("all", lambda s: s["kind"] < 3))
    return joined.select(
        "d.doc_id", *count, F.sha2(base.cast("binary"), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans"),
        F.size(F.filter("all", lambda s: s["live"] & (s["kind"] < 3))).cast("long").alias("n_live"),
    )


def redacted(docs: DataFrame, owner: str = "source", repository: str = "lang", widely: int = 5, mask: str = "*") -> DataFrame:
    """``docs`` with every span that looks live overwritten by ``mask``, character by character; lengths stay.

    Copied examples stay as they are. A null text stays null. Column names, types and order are kept.
    """
    found = stage(spans(docs, owner, repository, widely), "spans")
    live = found.select(*ROW, F.filter("spans", lambda s: s["live"]).alias("spans")).where(F.size("spans") > 0)
    same = [F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")), F.xxhash64("d.text").eqNullSafe(F.col("s.__row"))]
    masked = F.aggregate(F.col("s.spans"), F.col("d.text"), lambda text, s: F.overlay(
        text, F.repeat(F.lit(mask), (s["end"] - s["start"]).cast("int")), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    joined = docs.alias("d").join(live.alias("s"), same, "left")
    return joined.select(*[
        F.when(F.col("s.spans").isNotNull(), masked).otherwise(F.col("d.text")).alias("text") if name == "text" else F.col(f"d.`{name}`")
        for name in docs.columns])


def _branch_sql(kind: int, pattern: str, value: str, keep: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"""SELECT r, doc_id, owner, {kind} AS kind, k, length(gaps[k]) AS gap, length(hits[k]) AS size, {value} AS value, {keep} AS keep
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS k FROM (
    SELECT r, doc_id, owner, string_split_regex(text, '{quoted}') AS gaps, regexp_extract_all(text, '{quoted}') AS hits,
      regexp_extract_all(text, '{quoted}', {2 if kind == 0 else 0}) AS vals FROM d))"""


REPORT_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner FROM documents),
found AS ({' UNION ALL '.join([
    _branch_sql(0, ASSIGN, 'vals[k]', 'length(vals[k]) >= 12'), _branch_sql(1, ACCESS, 'vals[k]', 'true'),
    _branch_sql(2, HEX, 'vals[k]', 'true'),
    _branch_sql(3, OPAQUE, 'vals[k]', "regexp_matches(vals[k], '[0-9]') AND regexp_matches(vals[k], '[A-Z]') AND regexp_matches(vals[k], '[a-z]')"),
])}),
placed AS (SELECT *, CAST(sum(gap + size) OVER (PARTITION BY r, kind ORDER BY k) AS BIGINT) AS stop FROM found),
kept AS (SELECT *, stop - size AS start FROM placed WHERE keep),
owned AS (SELECT value, count(DISTINCT owner) AS n_owners FROM kept GROUP BY value),
known AS (SELECT DISTINCT r, kind, start, stop, n_owners < 5 AS live FROM kept JOIN owned USING (value)),
chosen AS (SELECT * FROM known a WHERE kind < 3 OR (live AND NOT EXISTS (
  SELECT 1 FROM known b WHERE b.r = a.r AND b.kind < 3 AND b.start < a.stop AND a.start < b.stop))),
named AS (SELECT *, ['assign', 'access', 'hex', 'opaque'][kind + 1] || ':' || start || ':' || stop AS span FROM chosen),
per AS (SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY start, kind) AS spans,
  count(*) FILTER (live AND kind < 3) AS n_live FROM named GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live
FROM d LEFT JOIN per USING (r)
"""
