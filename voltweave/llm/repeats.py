"""Removal of byte strings that repeat an earlier place of the corpus.

Every string of ``length`` bytes that also starts earlier is found exactly, without one record per byte.
A content-chosen sample takes the part of a difference cover: of the grams inside such a string, the
one with the smallest hash is its sample, so equal strings have equal samples at equal distance. Strings
that share a sample form a span. Sorting the samples by gram, then by span, names them: a gram that occurs
once rules its strings out; spans that are equal as a whole repeat as a whole, but for the first. What is
left, the first of each span whose gram has several spans, is compared string by string.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltweave.llm.common import bounded_slices, expand, flag_maybe, partitions, pieces_of
from voltweave.llm.text_arrays import BASE, BYTE_CODES, flat_bytes, mix
from voltweave.sources.staging import stage

SLICE_BYTES = 2 << 20
SEEN = 400_000  # spans or strings a task remembers, to settle copies before the shuffle
NO_ID = np.iinfo(np.int64).max  # documents without an id come last
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
PLACE = np.dtype([("group", "<u8"), ("name", "<u8"), ("doc", "<i8"), ("key", "<i8"), ("start", "<i4"), ("more", "<i4")])
RUNS = "kind int, doc long, key long, start long, more long"

_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


class Hashes:
    """Hashes of any substring of a slice of bytes, from prefix sums."""

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(_powers[0]) < n:
            for k, base in enumerate((BASE, INVERSE)):
                _powers[k] = np.cumprod(np.concatenate([np.ones(1, dtype=np.uint64), np.full(n, base, dtype=np.uint64)]))
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(BYTE_CODES[data] * _powers[0][:n - 1], dtype=np.uint64)])

    def of(self, start: np.ndarray, size) -> np.ndarray:
        return mix((self.sums[start + size] - self.sums[start]) * _powers[1][start])

    def all(self, size: int) -> np.ndarray:
        """Of every place where ``size`` bytes follow."""
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * _powers[1][:n])


def spans(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(gram hash, span hash, first start, starts more, text number): the strings of a slice by their sample."""
    none = (np.empty(0, dtype=np.uint64),) * 2 + (np.empty(0, dtype=np.int64),) * 3
    if len(data) < length:
        return none
    h = Hashes(data)
    grams = h.all(gram)
    mask = np.uint64((1 << 24) - 1)
    if len(grams) > mask:
        raise ValueError("slice too long")
    low = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)  # of equal hashes the first, so the choice depends on content alone
    width, span = length - gram + 1, 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if width > span:
        low = np.minimum(low[:len(low) - (width - span)], low[width - span:])
    ends = np.zeros(len(data) + 1, dtype=np.int32)
    long = np.diff(offsets) >= length
    np.add.at(ends, offsets[:-1][long], 1)
    np.add.at(ends, offsets[1:][long] - length + 1, -1)
    p = np.flatnonzero(np.cumsum(ends[:-1]))
    if not len(p):
        return none
    sample = (low[p] & mask).astype(np.int64)
    cut = np.ones(len(p), dtype=bool)
    cut[1:] = (sample[1:] != sample[:-1]) | (p[1:] != p[:-1] + 1)
    first = np.flatnonzero(cut)
    last = np.concatenate([first[1:], [len(p)]]) - 1
    lo, more, at = p[first], p[last] - p[first], sample[first]
    name = mix(h.of(lo, more + length) + (at - lo).astype(np.uint64) * BASE + more.astype(np.uint64))
    return grams[at], name, lo, more, np.searchsorted(offsets, lo, "right") - 1


class Settled:
    """What a task has sent out by name, with its place; later copies are settled on the spot."""

    def __init__(self):
        self.first: dict[int, tuple[int, int]] = {}

    def repeats(self, names: np.ndarray, docs: np.ndarray, starts: np.ndarray) -> np.ndarray:
        out = np.zeros(len(names), dtype=bool)
        first = self.first
        for i, (name, place) in enumerate(zip(names.tolist(), zip(docs.tolist(), starts.tolist()))):
            known = first.get(name)
            if known is None or place < known:
                first[name] = place
            elif place > known:
                out[i] = True
        if len(first) > SEEN:
            first.clear()
        return out


def _emit(rows: np.ndarray, repeated: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Places to name as blobs by bucket of their group, and settled repeats as runs."""
    named, runs = rows[~repeated], rows[repeated]
    dealt = pieces_of(named, named["start"], (named["group"] % np.uint64(buckets)).astype(np.int64), buckets)
    n, m = len(runs), len(dealt)
    blobs = [b"".join(np.ascontiguousarray(part[f]).tobytes() for f in PLACE.names) for _, part, _ in dealt]

    def longs(field: str) -> pa.Array:
        return pa.array(runs[field].astype(np.int64).tolist() + [None] * m, pa.int64())

    return pa.RecordBatch.from_arrays(
        [pa.array([i % buckets for i in range(n)] + [b for b, _, _ in dealt], pa.int32()), longs("doc"), longs("key"), longs("start"), longs("more"),
         pa.array([None] * n + blobs, pa.binary())], names=["bucket", "doc", "key", "start", "more", "blob"])


SENT = "bucket int, doc long, key long, start long, more long, blob binary"


def _columns(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return part.column("doc_id").fill_null(NO_ID).to_numpy(), part.column("key").to_numpy()


def _span_sender(length: int, gram: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settled = Settled()
        for batch in batches:
            for part in bounded_slices(batch, "text", SLICE_BYTES):
                docs, keys = _columns(part)
                data, offsets = flat_bytes(part.column("text"))
                for lo, hi, back in _stretches(offsets, length):  # a very long text comes in overlapping stretches
                    own = offsets[lo:hi + 1] if back is None else np.array([back[0], back[1]])
                    group, name, start, more, text = spans(data[own[0]:own[-1]], own - own[0], length, gram)
                    text = text + lo
                    rows = np.empty(len(group), dtype=PLACE)
                    rows["group"], rows["name"], rows["doc"], rows["key"] = group, name, docs[text], keys[text]
                    rows["start"], rows["more"] = start + own[0] - offsets[text], more
                    yield _emit(rows, settled.repeats(name, rows["doc"], rows["start"]), buckets)

    return run


def _stretches(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, tuple[int, int] | None]]:
    """Runs of whole texts, or (for a text over 8 MB) its stretches with ``length`` - 1 bytes in common."""
    most = 8 << 20
    lo = 0
    for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
        if b - a > most:
            if i > lo:
                yield lo, i, None
            for x in range(int(a), int(b) - length + 1, most):
                yield i, i + 1, (x, min(int(b), x + most + length - 1))
            lo = i + 1
    if lo < len(offsets) - 1:
        yield lo, len(offsets) - 1, None


def _namer(exact: bool):
    """Name what came to a partition: sort by group, name and place. With ``exact`` a name is a string itself;
    otherwise firsts of names whose group has others go on as kind 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list[np.ndarray]] = {f: [] for f in PLACE.names}
        names = ["kind", "doc", "key", "start", "more"]
        for batch in batches:
            runs = batch.filter(batch.column("blob").is_null())
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(runs.num_rows, dtype=np.int32)), *(runs.column(c) for c in names[1:])], names=names)
            for blob in batch.column("blob").drop_null().to_pylist():
                n, at = len(blob) // PLACE.itemsize, 0
                for f in PLACE.names:
                    kind = PLACE[f]
                    parts[f].append(np.frombuffer(blob, dtype=kind, count=n, offset=at))
                    at += n * kind.itemsize
        if not parts["doc"]:
            return
        c = {f: np.concatenate(v) for f, v in parts.items()}
        order = np.lexsort((c["start"], c["doc"], c["name"], c["group"]))
        c = {f: v[order] for f, v in c.items()}
        n = len(order)
        new_group = np.ones(n, dtype=bool)
        new_group[1:] = c["group"][1:] != c["group"][:-1]
        new_name = new_group.copy()
        new_name[1:] |= c["name"][1:] != c["name"][:-1]
        leader = np.maximum.accumulate(np.where(new_name, np.arange(n), 0))
        repeat = (c["doc"] != c["doc"][leader]) | (c["start"] != c["start"][leader])
        kind = np.where(repeat, 0, -1)
        if not exact:
            group = np.cumsum(new_group) - 1
            several = np.bincount(group, weights=new_name) > 1
            kind[~repeat & several[group]] = 1
        keep = np.flatnonzero(kind >= 0)
        made = pa.RecordBatch.from_arrays([pa.array(kind[keep].astype(np.int32)), *(pa.array(c[f][keep].astype(np.int64)) for f in names[1:])], names=names)
        for a in range(0, len(keep), 50_000):
            yield made.slice(a, 50_000)

    return run


def _string_sender(length: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settled = Settled()
        for batch in batches:
            for part in bounded_slices(batch, "text", SLICE_BYTES):
                docs, keys = _columns(part)
                data, offsets = flat_bytes(part.column("text"))
                if not len(data):
                    continue
                h = Hashes(data)
                starts, more = part.column("starts"), part.column("mores")
                text = np.repeat(np.arange(part.num_rows), starts.value_lengths().to_numpy())
                first = starts.flatten().to_numpy() + offsets[text]
                sizes = more.flatten().to_numpy() + 1
                for a in range(0, len(first), 20_000):
                    places = expand(first[a:a + 20_000], sizes[a:a + 20_000])
                    of = np.repeat(text[a:a + 20_000], sizes[a:a + 20_000])
                    rows = np.empty(len(places), dtype=PLACE)
                    name = h.of(places, length)
                    rows["group"] = rows["name"] = name
                    rows["doc"], rows["key"], rows["start"], rows["more"] = docs[of], keys[of], places - offsets[of], 0
                    yield _emit(rows, settled.repeats(name, rows["doc"], rows["start"]), buckets)

    return run


def repeated_runs(rows: DataFrame, length: int = 100, gram: int = 32) -> DataFrame:
    """(doc, key, start, more): runs of starts whose strings also start earlier. ``rows`` has doc_id, key, text."""
    buckets = partitions(rows.sparkSession)
    sent = rows.mapInArrow(_span_sender(length, gram, buckets), SENT).repartition(buckets, "bucket")
    named = stage(sent.mapInArrow(_namer(False), RUNS), "spans")
    open_ = named.where("kind = 1").groupBy("key").agg(F.collect_set(F.struct("start", "more")).alias("s"))
    open_ = stage(open_.select("key", F.col("s.start").alias("starts"), F.col("s.more").alias("mores")), "open-spans")
    texts = flag_maybe(rows, open_).where("maybe").select("doc_id", "key", "text").join(open_, "key").select("doc_id", "key", "text", "starts", "mores")
    strings = texts.mapInArrow(_string_sender(length, buckets), SENT).repartition(buckets, "bucket").mapInArrow(_namer(True), RUNS)
    both = named.where("kind = 0").unionByName(strings.where("kind = 0"))
    return stage(both.select("doc", "key", "start", "more"), "runs")


def _remover(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text, starts, mores in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist(), batch.column("mores").to_pylist()):
                raw = np.frombuffer(text.encode(), dtype=np.uint8)
                delta = np.zeros(len(raw) + 1, dtype=np.int32)
                lo = np.array(starts or [], dtype=np.int64)
                np.add.at(delta, lo, 1)
                np.add.at(delta, lo + np.array(mores or [], dtype=np.int64) + length, -1)
                gone = np.cumsum(delta[:-1]) > 0
                begins = gone & ~np.concatenate([[False], gone[:-1]])
                made.append((len(raw), int(gone.sum()), int(begins.sum()), raw[~gone].tobytes()))
            n, removed, spans_, kept = zip(*made) if made else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans_, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def without_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """Every row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes).

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a smaller doc_id, or at
    a smaller place of the same. Rows of one doc_id count as one document, so equal rows do not remove each
    other; a null id comes last. A null text is empty; shorter texts stay whole. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    runs = repeated_runs(rows, length)
    per = stage(runs.groupBy("key").agg(F.collect_set(F.struct("start", "more")).alias("s")).select(
        "key", F.col("s.start").alias("starts"), F.col("s.more").alias("mores")), "removals")
    flagged = flag_maybe(rows, per)
    size = F.octet_length("text").cast("long")
    zero = F.lit(0).cast("long")
    same = flagged.where("not maybe").select("doc_id", size.alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.col("text").cast("binary").alias("kept"))
    cut = flagged.where("maybe").select("doc_id", "key", "text").join(per, "key", "left").select("doc_id", "text", "starts", "mores").mapInArrow(
        _remover(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return same.unionByName(cut)


def report(docs: DataFrame, length: int = 100) -> DataFrame:
    """``without_repeats`` with the sha256 of what is kept in place of the bytes."""
    return without_repeats(docs, length).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
