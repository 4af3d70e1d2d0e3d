"""Hierarchical Pitman-Yor language model of word pairs, with Chinese-restaurant seating sampled by Gibbs.

Every word is a context with a restaurant of its own, for the word that follows it; the first word of a text
follows the end token. All of them share one parent, the restaurant of single words, whose base is uniform over
the training vocabulary and one unknown word. Cells (a word in a context) are dealt to buckets by the hash of the
word: a table of a word in any context is a customer of the same word in the parent. A bucket seats its cells on its
own and takes the totals of other buckets in proportion, a context's never above its customers; the totals used
for probabilities are exact sums. Words of more than ``bucket_tokens`` / 8 tokens are dealt over all buckets by pair.
The number of buckets follows from the training tokens, so scores do not depend on the cluster or its settings.
A bucket is seated once and its seatings are stored; predictive probabilities are averaged over them.

Pairs are shuffled twice: counted, to be seated, and with the places of their texts, to be scored. In between the
totals of contexts are added by context and sent back to the buckets that have them.
Frequent contexts are shuffled and stored as two bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltweave.llm.common import bounded_slices, expand, held_out, partitions, pieces_of, release_memory
from voltweave.llm.text_arrays import LOWERED, flat_bytes, mix, run_hashes, word_bounds
from voltweave.sources.staging import dropped_shuffles, stage

FREQUENT = 65_536
CONTEXT = (0.6, 8.0)  # discount and strength of the context restaurants
PARENT = (0.7, 64.0)  # of their parent
BURN_IN, SAMPLES, STEPS = 2, 3, 4  # sweeps before the first seating kept, seatings kept, groups that leave and are re-seated in a sweep
PART = 8  # cells that are at most 1/8 of all are seated by themselves
BLOCK = 16  # of a cell with n customers, max(1, n / BLOCK) are seated at once
FOLDS = 10
BUCKET_TOKENS = 1 << 20  # training tokens per bucket of words, on average
SLICE_BYTES = 1 << 20
CHUNK_TOKENS, CHUNK_TEXTS = 1 << 21, 1 << 16  # tokens and texts whose pairs are shuffled together, at most about
CHUNK_ROWS = 100_000  # pairs that are scored at once
KEY_ROWS = 1 << 18  # tokens whose sort keys are made at once
END = np.uint64(0x5EED0FE2D0C5)
CONTEXT_BITS = np.uint64(2**48 - 1)  # of a word's hash, name its context


def text_tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hash, context, number of the text) of all tokens; every text ends with the end token.

    The context is the word before, by 48 bits of its hash; that of a first word is the end token.
    """
    data, offsets = flat_bytes(texts)
    data = LOWERED[data]
    starts, ends, text_of = word_bounds(data, offsets)
    n = len(texts)
    counts = np.bincount(text_of, minlength=n) + 1
    last = np.cumsum(counts) - 1
    words = np.full(int(counts.sum()), END, dtype=np.uint64)
    inner = np.ones(len(words), dtype=bool)
    inner[last] = False
    words[inner] = run_hashes(data, starts, ends)
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[:1] = END
    return words, before & CONTEXT_BITS, np.repeat(np.arange(n), counts)


def _spread(start: np.ndarray, tables: np.ndarray, amount: np.ndarray, size: np.ndarray, discount: float, draw) -> tuple[np.ndarray, np.ndarray]:
    """Deal ``amount`` of each range of tables to its single tables by halving: ``draw(amount, left, right)`` goes left.

    A table weighs its size less ``discount``. Only tables of ranges with a choice are looked at.
    """
    choice = tables > 1
    alone, choice = np.flatnonzero(~choice), np.flatnonzero(choice)
    at, got = [start[alone]], [amount[alone]]
    start, tables, amount = start[choice], tables[choice], amount[choice]
    last = np.cumsum(tables)
    first = last - tables
    place = np.arange(last[-1] if len(last) else 0) + np.repeat(start - first, tables)
    weight = size[place] - discount
    total = np.zeros(len(place) + 1, dtype=weight.dtype)
    np.cumsum(weight, out=total[1:])
    while len(amount):
        middle = (first + last) // 2
        if (middle == first).any():
            single, more = np.flatnonzero(middle == first), np.flatnonzero(middle > first)
            at.append(place[first[single]])
            got.append(amount[single])
            first, last, middle, amount = first[more], last[more], middle[more], amount[more]
        cut = total[middle]
        left = draw(amount, cut - total[first], total[last] - cut)
        amount = np.concatenate([left, amount - left])
        some = np.flatnonzero(amount)
        first, last, amount = np.concatenate([first, middle])[some], np.concatenate([middle, last])[some], amount[some]
    return np.concatenate(at), np.concatenate(got)


class Seating:
    """Tables of many restaurants' dishes (cells), kept together by cell. ``old`` counts who has not moved in a sweep."""

    def __init__(self, customers: np.ndarray):
        self.n = customers.astype(np.int64)
        self.t = np.minimum(self.n, 1)
        self.size = self.n[self.n > 0]
        self.old = np.zeros(len(self.size), dtype=np.int64)

    def _first(self) -> np.ndarray:
        return np.cumsum(self.t) - self.t

    def _close(self) -> np.ndarray:
        """Tables without customers go; their number per cell."""
        empty = self.size == 0
        if not empty.any():
            return np.zeros(len(self.t), dtype=np.int64)
        closed = np.bincount(np.repeat(np.arange(len(self.t)), self.t)[empty], minlength=len(self.t))
        self.size, self.old = self.size[~empty], self.old[~empty]
        self.t -= closed
        return closed

    def part(self, cells: np.ndarray) -> Seating:
        """A seating of some cells, ascending; ``put`` takes it back."""
        made = Seating(self.n[cells])
        made.t = self.t[cells]
        at = expand(self._first()[cells], made.t)
        made.size, made.old = self.size[at], self.old[at]
        return made

    def put(self, cells: np.ndarray, part: Seating) -> None:
        """Take back what ``part`` has made of its cells."""
        first, n = self._first(), self.t.copy()
        inside = np.ones(len(self.size), dtype=bool)
        inside[expand(first[cells], n[cells])] = False
        self.n[cells], self.t[cells] = part.n, part.t
        theirs = expand(self._first()[cells], part.t)
        total = int(self.t.sum())
        ours = np.ones(total, dtype=bool)
        ours[theirs] = False
        size, old = np.empty(total, dtype=np.int64), np.empty(total, dtype=np.int64)
        size[theirs], old[theirs] = part.size, part.old
        size[ours], old[ours] = self.size[inside], self.old[inside]
        self.size, self.old = size, old

    def thin(self, part: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
        """Each customer who has not moved leaves with probability ``part``: (who left, tables closed) per cell."""
        gone = ((rng.random(len(self.old)) < part) & (self.old > 0)).astype(np.int64)
        several = np.flatnonzero(self.old > 1)
        gone[several] = rng.binomial(self.old[several], part)
        self.old -= gone
        self.size -= gone
        left = np.bincount(np.repeat(np.arange(len(self.t)), self.t), weights=gone, minlength=len(self.t)).astype(np.int64)
        self.n -= left
        return left, self._close()

    def remove(self, cells: np.ndarray, by: np.ndarray, rng: np.random.Generator) -> None:
        """``by`` random customers leave each of ``cells``. An emptied cell has no table."""
        def draw(amount: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
            return rng.hypergeometric(left, right, amount)

        at, gone = _spread(self._first()[cells], self.t[cells], by, self.size, 0, draw)
        self.size[at] -= gone
        self.n[cells] -= by
        self._close()

    def add(self, cells: np.ndarray, by: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
        """``by`` customers join each of ``cells``; ``weight`` is that of a new table. Tables opened per cell.

        They are few beside those seated, or one: the chance to open is that of their middle one.
        """
        n, t = self.n[cells], self.t[cells]
        chance = np.where(n > 0, weight / (n + (by - 1) / 2 - discount * t + weight), 1.0)
        opened = (rng.random(len(cells)) < chance).astype(np.int64)
        several = np.flatnonzero(by > 1)
        if len(several):
            opened[several] = rng.binomial(by[several], chance[several])
        joins = by - opened
        some = joins > 0

        def draw(amount: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
            go = (rng.random(len(amount)) * (left + right) < left).astype(np.int64)
            more = np.flatnonzero(amount > 1)  # each joiner makes its table heavier for the next
            if len(more):
                go[more] = rng.binomial(amount[more], rng.beta(left[more], right[more]))
            return go

        first = self._first()[cells]
        at, got = _spread(first[some], t[some], joins[some], self.size, discount, draw)
        self.size[at] += got
        if opened.any():
            place = np.repeat(first + t, opened)
            place += np.arange(len(place))
            stay = np.ones(len(self.size) + len(place), dtype=bool)
            stay[place] = False
            size, old = np.empty(len(stay), dtype=np.int64), np.empty(len(stay), dtype=np.int64)
            size[place], old[place] = 1, 0
            size[stay], old[stay] = self.size, self.old
            self.size, self.old = size, old
            self.t[cells] += opened
        self.n[cells] += by
        return opened


def seatings(
    word: np.ndarray, cls: np.ndarray, count: np.ndarray, n_words: int, share: float, vocabulary: int, seed: int,
    times: np.ndarray | None = None, bound: np.ndarray | None = None,
):
    """Sample seatings of one bucket's cells (word number, context number, customers).

    All customers are seated by the restaurant rule, and each of them leaves and is seated anew once in a
    sweep, in ``STEPS`` random groups. Customers join a cell one by one, or ``1 / BLOCK`` of those seated at a time.
    The only customer of a cell always has one table there: it leaves and re-enters the parent alone.
    ``share`` is the part of the vocabulary in this bucket: totals of other buckets are taken in proportion.
    ``times`` is above 1 for words that so many buckets share; ``bound`` is the most tables a context can have.
    Yields (tables per cell, customers per word at the parent, tables per word at the parent).
    """
    rng = np.random.default_rng(seed)
    (d, theta), (d0, theta0) = CONTEXT, PARENT
    contexts = int(cls.max()) + 1 if len(cls) else 0
    times = np.ones(n_words) if times is None else times
    bound = np.full(contexts, np.inf) if bound is None else bound
    scale = np.where(times > 1, times, 1 / share)
    single = count == 1
    alone = np.bincount(word[single], minlength=n_words)  # lone customers at the parent
    several = np.flatnonzero(~single)
    room_word, room_cls, room_count = word[several], cls[several], count[several]
    rooms = Seating(np.minimum(room_count, 1))
    parent = Seating(np.zeros(n_words, dtype=np.int64))
    tables = np.bincount(cls[single], weights=scale[word[single]], minlength=contexts)  # of each context, in all buckets

    def base_weight() -> float:
        return (theta0 + d0 * (parent.t * scale).sum()) / (vocabulary + 1)

    def join(at: Seating, cells: np.ndarray, by: np.ndarray, add, names: np.ndarray | None = None) -> None:
        """Blocks of ``by`` customers, as large as those already seated allow; ``names`` are the cells of ``at`` in all.

        When few cells are left and many blocks to come, these go on by themselves: rounds cost what they seat.
        """
        while len(cells):
            if at is not parent and PART * len(cells) < len(at.n) and by.max() > 8 * (1 + at.n[cells].max() // BLOCK):
                part = at.part(cells)
                join(part, np.arange(len(cells)), by, add, cells if names is None else names[cells])
                at.put(cells, part)
                return
            block = np.minimum(by, np.maximum(1, at.n[cells] // BLOCK))
            add(at, cells, cells if names is None else names[cells], block)
            by = by - block
            more = np.flatnonzero(by)
            cells, by = cells[more], by[more]

    def at_parent(at: Seating, words: np.ndarray, _, by: np.ndarray) -> None:
        at.add(words, by, base_weight() / times[words], d0, rng)

    def change_parent(by: np.ndarray) -> None:
        """``by`` customers of each word come to the parent (or, below 0, leave it)."""
        down, up = np.flatnonzero(by < 0), np.flatnonzero(by > 0)
        if len(down):
            parent.remove(down, -by[down], rng)
        join(parent, up, by[up], at_parent)

    def settle(cells: np.ndarray, change: np.ndarray) -> None:
        """Tables that opened (or, below 0, closed) in ``cells`` come to the parent (or leave it)."""
        np.add.at(tables, room_cls[cells], change * scale[room_word[cells]])
        change_parent(np.bincount(room_word[cells], weights=change, minlength=n_words).astype(np.int64))

    def in_room(at: Seating, cells: np.ndarray, names: np.ndarray, by: np.ndarray) -> None:
        w, c = room_word[names], room_cls[names]
        p = (times[w] * (parent.n[w] - d0 * parent.t[w]) + base_weight()) / (theta0 + (parent.n * scale).sum())
        opened = at.add(cells, by, (theta + d * np.minimum(tables[c], bound[c])) * p, d, rng)
        some = np.flatnonzero(opened)
        settle(names[some], opened[some])

    change_parent(alone)
    settle(np.arange(len(several)), rooms.t)
    join(rooms, np.arange(len(several)), room_count - 1, in_room)
    for sweep in range(BURN_IN + SAMPLES):
        rooms.old, waiting = rooms.size.copy(), alone.copy()
        for step in range(STEPS):
            gone = rng.binomial(waiting, 1 / (STEPS - step))
            waiting -= gone
            change_parent(-gone)
            left, closed = rooms.thin(1 / (STEPS - step), rng)
            settle(np.flatnonzero(closed), -closed[closed > 0])
            change_parent(gone)
            cells = np.flatnonzero(left)
            join(rooms, cells, left[cells], in_room)
        if sweep >= BURN_IN:
            made = np.ones(len(word), dtype=np.int64)
            made[several] = rooms.t
            yield made, parent.n.copy(), parent.t.copy()


def _word_counts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            words, at = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
            return words, np.bincount(at, weights=np.concatenate([c for _, c in held]), minlength=len(words)).astype(np.int64)

        def out() -> pa.RecordBatch:
            words, counts = merged()
            held.clear()
            rows = pieces_of(words, counts, (words % np.uint64(buckets)).astype(np.int64), buckets)
            return pa.RecordBatch.from_arrays([pa.array([b for b, _, _ in rows], pa.int32()),
                                               pa.array([w.tobytes() + c.tobytes() for _, w, c in rows], pa.binary())], names=["bucket", "blob"])

        for batch in batches:
            for part in bounded_slices(batch, "text", SLICE_BYTES):
                words, counts = np.unique(text_tokens(part.column("text"))[0], return_counts=True)
                held.append((words, counts))
                if sum(len(w) for w, _ in held) > 1_500_000:
                    held[:] = [merged()]
                    if len(held[0][0]) > 700_000:
                        yield out()
        if held:
            yield out()

    return run


def _halves(blobs: list[bytes], kind: str) -> tuple[np.ndarray, np.ndarray]:
    a = [np.frombuffer(b[:len(b) // 2], dtype=np.uint64) for b in blobs]
    b = [np.frombuffer(b[len(b) // 2:], dtype=kind) for b in blobs]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.empty(0, dtype=np.uint64), np.empty(0, dtype=kind))


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blobs = [b for batch in batches for b in batch.column("blob").to_pylist()]
    if blobs:
        w, c = _halves(blobs, "<i8")
        words, at = np.unique(w, return_inverse=True)
        counts = np.bincount(at, weights=c).astype(np.int64)
        made = pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], names=["word", "count"])
        for a in range(0, len(words), 50_000):
            yield made.slice(a, 50_000)


OCCURRENCE = np.dtype([("word", "<u8"), ("cls", "<u8"), ("train", "<i8")])  # a word, its context and their training tokens
CELL = np.dtype([("k", "<i4"), ("cls", "<u8"), ("count", "<i8")])  # the same of a word that all buckets share, by its place
ROW = "bucket long, kind int, chunk long, blobs array<binary>"
SEATINGS, TOTALS, PAIRS, TEXTS, REQUEST, SHARED = range(6)  # kinds of rows, in the order in which a bucket reads them


def _rows(rows: list[tuple[int, int, int, list[bytes]]]) -> pa.RecordBatch:
    bucket, kind, chunk, blobs = zip(*rows) if rows else ((),) * 4
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(kind, pa.int32()), pa.array(chunk, pa.int64()),
                                       pa.array(blobs, pa.list_(pa.binary()))], names=["bucket", "kind", "chunk", "blobs"])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, list[bytes]]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(batch.column(c)[i].as_py() for c in range(4))


def _six(values: np.ndarray) -> bytes:
    """Contexts as six bytes each."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unsix(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(blob, dtype=np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


class Contexts:
    """Contexts as bytes: two for one of the frequent ``listed`` (ascending, the first 65,536 of them), six for any other."""

    def __init__(self, listed: np.ndarray):
        self.listed = listed[:1 << 16]
        self.slot = np.zeros(1 << 20, dtype=np.uint16)  # by the last bits; of several listed contexts there, the others take six bytes
        self.slot[self.listed & np.uint64((1 << 20) - 1)] = np.arange(len(self.listed))

    def pack(self, values: np.ndarray) -> bytes:
        if not len(self.listed):
            return b"\0" + _six(values)
        place = self.slot[values & np.uint64((1 << 20) - 1)]
        known = self.listed[place] == values
        return b"\1" + len(values).to_bytes(8, "little") + np.packbits(known).tobytes() + place[known].astype("<u2").tobytes() + _six(values[~known])

    def unpack(self, blob: bytes) -> np.ndarray:
        if not blob[0]:
            return _unsix(blob[1:])
        n = int.from_bytes(blob[1:9], "little")
        first = 9 + -(-n // 8)
        known = np.unpackbits(np.frombuffer(blob, dtype=np.uint8, count=first - 9, offset=9), count=n).view(bool)
        listed = int(known.sum())
        made = np.empty(n, dtype=np.uint64)
        made[known] = self.listed[np.frombuffer(blob, dtype="<u2", count=listed, offset=first)]
        made[~known] = _unsix(blob[first + 2 * listed:])
        return made


ANY = Contexts(np.empty(0, dtype=np.uint64))  # six bytes each


def _small(values: np.ndarray) -> bytes:
    """Counts, with the number of bytes that the largest needs before them.

    Where most are small: 0, their number, a byte each and those from 255 on after them.
    """
    width = max(-(-(int(values.max()).bit_length() if len(values) else 0) // 8), 1)
    if width > 1:
        large = values >= 255
        if 10 + len(values) + width * int(large.sum()) < 1 + width * len(values):
            return b"\0" + len(values).to_bytes(8, "little") + np.minimum(values, 255).astype(np.uint8).tobytes() + _small(values[large])
    if width in (1, 2, 4, 8):
        return bytes([width]) + values.astype(f"<u{width}").tobytes()
    return bytes([width]) + np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unsmall(blob: bytes) -> np.ndarray:
    width = blob[0]
    if not width:
        n = int.from_bytes(blob[1:9], "little")
        made = np.frombuffer(blob, dtype=np.uint8, count=n, offset=9).astype(np.int64)
        made[made == 255] = _unsmall(blob[9 + n:])
        return made
    if width in (1, 2, 4, 8):
        return np.frombuffer(blob, dtype=f"<u{width}", offset=1).astype(np.int64)
    wide = np.zeros(((len(blob) - 1) // width, 8), dtype=np.uint8)
    wide[:, :width] = np.frombuffer(blob, dtype=np.uint8, offset=1).reshape(-1, width)
    return wide.view("<i8").ravel()


def _place(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Place of each of ``of`` in ascending ``values``, -1 where it is not among them."""
    if not len(values):
        return np.full(len(of), -1)
    at = np.minimum(np.searchsorted(values, of), len(values) - 1)
    return np.where(values[at] == of, at, -1)


def _packed_pairs(word: np.ndarray, cls: np.ndarray, count: np.ndarray, contexts: Contexts) -> list[bytes]:
    """Pairs that stand by word: each word once."""
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    return [word[first].tobytes(), _small(np.diff(np.append(first, len(word)))), contexts.pack(cls), _small(count)]


def _pairs(words: bytes, sizes: bytes, cls: bytes, count: bytes, contexts: Contexts = ANY) -> np.ndarray:
    c = contexts.unpack(cls)
    made = np.empty(len(c), dtype=OCCURRENCE)
    made["word"], made["cls"], made["train"] = np.repeat(np.frombuffer(words, dtype="<u8"), _unsmall(sizes)), c, _unsmall(count)
    return made


def _chunks(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[list[pa.Array], np.ndarray, np.ndarray]]:
    """(columns, words, number of the text) of some texts at a time; the texts themselves are not kept.

    A word's context is the word before, as every text ends with the end token; that of the first word is the end token.
    """
    held: list = []
    tokens = texts = 0

    def together():
        first = np.cumsum([0, *(len(c[0]) for c, _, _ in held)])
        made = ([pa.concat_arrays([c[k] for c, _, _ in held]) for k in range(len(columns))], np.concatenate([w for _, w, _ in held]),
                np.concatenate([t + f.astype(np.int32) for (_, _, t), f in zip(held, first)]))
        held.clear()
        return made

    for batch in batches:
        for part in bounded_slices(batch, "text", SLICE_BYTES):
            for a in range(0, part.num_rows, CHUNK_TEXTS):
                some = part.slice(a, CHUNK_TEXTS)
                words, _, text_of = text_tokens(some.column("text"))
                if held and (tokens + len(words) > CHUNK_TOKENS or texts + some.num_rows > CHUNK_TEXTS):
                    yield together()
                    tokens = texts = 0
                held.append(([pa.concat_arrays([some.column(c).take(pa.array(np.arange(some.num_rows)))]) for c in columns], words, text_of.astype(np.int32)))
                tokens, texts = tokens + len(words), texts + some.num_rows
    if held:
        yield together()


def _dealt_pairs(words: np.ndarray, shared: np.ndarray, buckets: int):
    """(order of the tokens, first token of each pair in it, bucket, word and context of each pair), by bucket, word and context.

    Words and contexts are sorted by as many bits as fit; a pair that is cut by others of the same bits comes more than once.
    """
    free = 64 - max(buckets - 1, 1).bit_length()
    half = min(free // 2, 48)
    key = np.empty_like(words)
    for a in range(0, len(words), KEY_ROWS):  # bounded temporaries
        w = words[a:a + KEY_ROWS]
        cls = np.concatenate([words[a - 1:a] if a else [END], w[:-1]]) & CONTEXT_BITS
        own = w % np.uint64(buckets)
        both = np.flatnonzero(_place(shared, w) >= 0)
        own[both] = mix(w[both] ^ mix(cls[both])) % np.uint64(buckets)
        key[a:a + KEY_ROWS] = own << np.uint64(free) | w >> np.uint64(64 - free + half) << np.uint64(half) | cls >> np.uint64(48 - half)
    order = np.argsort(key)
    bucket = (key >> np.uint64(free))
    del key
    w = words[order]
    changed = np.ones(len(order), dtype=bool)
    changed[1:] = w[1:] != w[:-1]
    del w
    c = words[order - 1] & CONTEXT_BITS
    c[order == 0] = END & CONTEXT_BITS
    changed[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(changed)  # a pair is in one bucket
    return order, first, bucket[order[first]].astype(np.int64), words[order[first]], c[first]


NONE = np.empty(0, dtype=np.uint64)


def _counter(shared: np.ndarray, buckets: int, listed: np.ndarray = NONE):
    """Map side of the seating: pairs with their training tokens (0 where only held-out texts have them)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts = Contexts(listed)
        for (train,), words, text_of in _chunks(batches, "train"):
            order, first, bucket, w, c = _dealt_pairs(words, shared, buckets)
            trained = train.to_numpy(zero_copy_only=False)[text_of]
            count = np.add.reduceat(trained[order], first, dtype=np.int64)
            del words, text_of, order, first, trained
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            yield _rows([(b, PAIRS, 0, _packed_pairs(w[x:y], c[x:y], count[x:y], contexts)) for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x])
            del w, c, count, bucket
        release_memory()

    return run


def _dealer(shared: np.ndarray, buckets: int, listed: np.ndarray):
    """Map side of the scoring: pairs with their texts, and the texts themselves by number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, contexts = TaskContext.get().partitionId(), Contexts(listed)
        for number, ((ids, train), words, text_of) in enumerate(_chunks(batches, "doc_id", "train")):
            chunk = task << 32 | number
            order, first, bucket, w, c = _dealt_pairs(words, shared, buckets)
            text = text_of.astype("<u2")[order]
            sizes, ends = np.diff(np.append(first, len(order))), np.append(first, len(order))
            del words, order, first
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            yield _rows([(b, PAIRS, chunk, [*_packed_pairs(w[x:y], c[x:y], sizes[x:y], contexts), text[ends[x]:ends[y]].tobytes()])
                         for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x])
            n = np.bincount(text_of, minlength=len(ids))
            yield _rows([(chunk % buckets, TEXTS, chunk, [ids.is_valid().to_numpy(zero_copy_only=False).tobytes(), ids.fill_null(0).to_numpy().tobytes(),
                                                          train.to_numpy(zero_copy_only=False).tobytes(), n.astype("<i8").tobytes()])])
            del w, c, text, text_of, sizes, ends, bucket
        release_memory()

    return run


class Bucket:
    """The words of one bucket, their cells (word and context) with customers, and the seatings of these."""

    def __init__(self, words: np.ndarray, contexts: np.ndarray, key: np.ndarray, count: np.ndarray, samples: list):
        self.words, self.contexts, self.key, self.count, self.samples = words, contexts, key, count, samples
        self.word, self.cls = key // max(len(contexts), 1), key % max(len(contexts), 1)

    def totals(self) -> np.ndarray:
        """Per seating and context (the parent last): customers and tables."""
        n = len(self.contexts)
        made = np.zeros((SAMPLES, n + 1, 2), dtype=np.int64)
        for s, (t, m, mt) in enumerate(self.samples):
            made[s, :n, 0] = np.bincount(self.cls, weights=self.count, minlength=n)
            made[s, :n, 1] = np.bincount(self.cls, weights=t, minlength=n)
            made[s, n] = m.sum(), mt.sum()
        return made

    def stored(self, contexts: Contexts = ANY) -> list[bytes]:
        """Words, contexts, cells by word, their customers and tables, parents as bytes; ``restored`` reads them.

        Cells of one customer have one table: tables are stored for the others, and customers where they are several.
        """
        several = self.count > 1
        return [self.words.tobytes(), contexts.pack(self.contexts), _small(np.bincount(self.word, minlength=len(self.words))), _small(self.cls),
                np.packbits(several).tobytes(), _small(self.count[several]),
                *(_small(x) for t, m, mt in self.samples for x in (t[several], m, mt))]


def restored(
    words: bytes, contexts: bytes, sizes: bytes, cls: bytes, several: bytes, count: bytes, *samples: bytes, coded: Contexts = ANY,
) -> Bucket:
    own, known = np.frombuffer(words, dtype=np.uint64), coded.unpack(contexts)
    key = np.repeat(np.arange(len(own)), _unsmall(sizes)) * len(known) + _unsmall(cls)
    at = np.flatnonzero(np.unpackbits(np.frombuffer(several, dtype=np.uint8), count=len(key)))

    def filled(values: np.ndarray) -> np.ndarray:
        made = np.ones(len(key), dtype=np.int64)
        made[at] = values
        return made

    read = [_unsmall(x) for x in samples]
    return Bucket(own, known, key, filled(_unsmall(count)), [(filled(t), m, mt) for t, m, mt in zip(read[::3], read[1::3], read[2::3])])


def seated(
    rows: np.ndarray, cells: np.ndarray, shared: np.ndarray, vocabulary: int, number: int, buckets: int, most=None,
) -> Bucket:
    """Seat a bucket: ``rows`` are pairs of its own words, ``cells`` those of the words that all buckets share.

    ``most`` gives the customers a context has at most in all buckets.
    """
    word = np.concatenate([rows["word"], shared[cells["k"]]])
    cls, count = np.concatenate([rows["cls"], cells["cls"]]), np.concatenate([rows["train"], cells["count"]]).astype(np.int64)
    trained = count > 0
    words, contexts = np.union1d(word[trained], shared), np.unique(cls)
    key = np.searchsorted(words, word[trained]) * len(contexts) + np.searchsorted(contexts, cls[trained])
    order = np.argsort(key)
    key, count = key[order], count[trained][order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, dtype=np.int64)
    made = Bucket(words, contexts, key[first], np.add.reduceat(count, first) if len(key) else count, [])
    if len(words):
        common = _place(shared, words) >= 0
        share = max((~common).sum(), 1) / max(vocabulary - len(shared), 1)
        bound = None if most is None else most(contexts)
        made.samples = list(seatings(made.word, made.cls, made.count, len(words), share, vocabulary, number, np.where(common, buckets, 1), bound))
    return made


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
    """Rows of a sorted partition: (bucket, its chunks and blobs)."""
    bucket, held = None, []
    for b, _, chunk, blobs in _read(batches):
        if b != bucket and held:
            yield bucket, held
            held = []
        bucket = b
        held.append((chunk, blobs))
    if held:
        yield bucket, held


def _seater(shared: np.ndarray, counted: tuple[np.ndarray, np.ndarray, int], vocabulary: int, buckets: int):
    """Reduce side: each bucket is seated once; its seatings are one row."""
    words, counts, others = counted

    def most(contexts: np.ndarray) -> np.ndarray:
        at = _place(words, contexts)
        return np.where(at >= 0, counts[at] if len(counts) else 0, others).astype(float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts = Contexts(words)
        for b, held in _by_bucket(batches):
            pairs = np.concatenate([_pairs(*blobs, contexts) for _, blobs in held])
            held.clear()
            k = _place(shared, pairs["word"])
            common = pairs[k >= 0]
            cells = np.empty(len(common), dtype=CELL)
            cells["k"], cells["cls"], cells["count"] = k[k >= 0], common["cls"], common["train"]
            made = seated(pairs[k < 0], cells, shared, vocabulary, b, buckets, most)
            yield _rows([(b, SEATINGS, 0, made.stored(contexts))])
            if made.samples:
                parents = np.zeros((SAMPLES, len(shared) + 1, 2), dtype=np.int64)
                own = _place(made.words, shared)
                for s, (_, m, mt) in enumerate(made.samples):
                    parents[s, :-1] = np.where(own[:, None] >= 0, np.stack([m, mt], axis=1)[own], 0)
                    parents[s, -1] = m.sum(), mt.sum()
                yield _rows([(b, SHARED, 0, [parents.tobytes()])])
            del pairs, common, cells, made
            release_memory()

    return run


def _asker(listed: np.ndarray, buckets: int):
    """Totals of the contexts of stored buckets, a row for each part of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts = Contexts(listed)
        for b, _, _, blobs in _read(batches):
            made = restored(*blobs, coded=contexts)
            totals = made.totals()
            part = (made.contexts % np.uint64(buckets)).astype(np.int64)
            yield _rows([(p, REQUEST, b, [contexts.pack(c), *(_small(x) for x in (totals[0, at, 0], *totals[:, at, 1]))])
                         for p, c, at in pieces_of(made.contexts, np.arange(len(part)), part, buckets)])
        release_memory()

    return run


def _add_contexts(listed: np.ndarray):
    """Totals of the contexts of a part, for each bucket that asked and in its order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = Contexts(listed)
        for part, held in _by_bucket(batches):
            asked = [(b, coded.unpack(blobs[0]), np.stack([_unsmall(x) for x in blobs[1:]])) for b, blobs in held]
            contexts, at = np.unique(np.concatenate([c for _, c, _ in asked]), return_inverse=True)
            values = np.concatenate([v for _, _, v in asked], axis=1)
            total = np.stack([np.bincount(at, weights=v, minlength=len(contexts)) for v in values]).astype(np.int64)
            ends = np.cumsum([len(c) for _, c, _ in asked])
            yield _rows([(b, TOTALS, part, [_small(x) for x in total[:, at[end - len(c):end]]]) for (b, c, _), end in zip(asked, ends)])

    return run


def _add_parents(n_shared: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((SAMPLES, n_shared + 1, 2), dtype=np.int64)
        for _, _, _, blobs in _read(batches):
            total += np.frombuffer(blobs[0], dtype=np.int64).reshape(total.shape)
        s, k = (x.ravel() for x in np.indices(total.shape[:2]))
        yield pa.RecordBatch.from_arrays([pa.array(s, pa.int32()), pa.array(k, pa.int32()), pa.array(total[..., 0].ravel()), pa.array(total[..., 1].ravel())],
                                         names=["sample", "k", "customers", "tables"])

    return run


def _predict(made: Bucket, totals: np.ndarray, vocabulary: int, word: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Averaged predictive probability of (word number or -1 for an unknown word, context).

    ``totals`` are those of the bucket's contexts; others have none and leave the word to the parent.
    """
    (d, theta), (d0, theta0) = CONTEXT, PARENT
    context = _place(made.contexts, cls.astype(np.uint64))
    at = _place(made.key, word * len(made.contexts) + context)
    hit = (at >= 0) & (word >= 0) & (context >= 0)
    total = np.zeros(len(word))
    for s in range(SAMPLES):
        m, mt = totals[s, -1]
        n, t = np.where(context >= 0, totals[s, context].T, 0)
        parent = np.full(len(word), (theta0 + d0 * mt) / (vocabulary + 1))
        own = 0.0
        if made.samples:
            tables, wm, wt = made.samples[s]
            parent += np.where(word >= 0, wm[word] - d0 * wt[word], 0.0)
            own = np.where(hit, made.count[at] - d * tables[at], 0.0) if len(made.key) else 0.0
        total += (own + (theta + d * t) * parent / (theta0 + m)) / (theta + n)
    return total / SAMPLES


SUMS = "chunk long, kind int, blobs array<binary>"
HELD_TEXTS = 1 << 20  # texts whose sums a task holds
BATCH_BYTES = 4 << 20  # of an Arrow batch: without this bound, all blobs of a partition would be one


def _scorer(shared: np.ndarray, shared_counts: np.ndarray, parents: np.ndarray, vocabulary: int, tokens: int, buckets: int, listed: np.ndarray):
    """Sums over the pairs of a bucket by text; a bucket reads its seatings, then totals, then pairs chunk by chunk."""

    def packed(rows: list[tuple[int, int, list[bytes]]]) -> pa.RecordBatch:
        chunk, kind, blobs = zip(*rows) if rows else ((),) * 3
        return pa.RecordBatch.from_arrays([pa.array(chunk, pa.int64()), pa.array(kind, pa.int32()), pa.array(blobs, pa.list_(pa.binary()))],
                                          names=["chunk", "kind", "blobs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        contexts = Contexts(listed)

        def out() -> pa.RecordBatch:
            rows = [(c, PAIRS, [_small(x[0]), x[1].tobytes(), x[2].tobytes()]) for c, x in sums.items()]
            sums.clear()
            return packed(rows)

        for b, kind, chunk, blobs in _read(batches):
            if kind == SEATINGS:
                made = restored(*blobs, coded=contexts)
                part = (made.contexts % np.uint64(buckets)).astype(np.int64)
                totals = np.zeros((SAMPLES, len(made.contexts) + 1, 2))
                totals[:, -1] = parents[:, -1]
                of_word = np.bincount(made.word, weights=made.count, minlength=len(made.words))
                common = _place(made.words, shared)
                here = common >= 0
                of_word[common[here]] = shared_counts[here]
                for s, (_, m, mt) in enumerate(made.samples):
                    m[common[here]], mt[common[here]] = parents[s, :-1][here].T
            elif kind == TOTALS:
                n, *t = (_unsmall(x) for x in blobs)
                at = np.flatnonzero(part == chunk)
                for s in range(SAMPLES):
                    totals[s, at] = np.stack([n, t[s]], axis=1)
            elif kind == PAIRS:
                pairs, text = _pairs(*blobs[:4], contexts), np.frombuffer(blobs[4], dtype="<u2")
                word = _place(made.words, pairs["word"])
                base = np.log10((np.where(word >= 0, of_word[word] if len(of_word) else 0, 0) + 0.1) / (tokens + 0.1 * (vocabulary + 1)))
                score = np.empty(len(pairs))
                for a in range(0, len(pairs), CHUNK_ROWS):
                    score[a:a + CHUNK_ROWS] = np.log10(_predict(made, totals, vocabulary, word[a:a + CHUNK_ROWS], pairs["cls"][a:a + CHUNK_ROWS]))
                size, n = pairs["train"], int(text.max()) + 1
                found = np.stack([np.bincount(text, weights=np.repeat(x, size), minlength=n) for x in ((word >= 0).astype(float), base, score)])
                old = sums.get(chunk, np.zeros((3, 0)))
                if old.shape[1] < n:
                    old = np.pad(old, ((0, 0), (0, n - old.shape[1])))
                old[:, :n] += found
                sums[chunk] = old
                if sum(x.shape[1] for x in sums.values()) > HELD_TEXTS:
                    yield out()
            else:
                yield packed([(chunk, kind, blobs)])
        yield out()
        release_memory()

    return run


def _add_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of each chunk with the sums of all buckets."""
    chunk, texts, sums = None, None, []

    def out() -> Iterator[pa.RecordBatch]:
        valid, ids, train = (np.frombuffer(x, dtype=t) for x, t in zip(texts, ("?", "<i8", "?")))
        total = np.zeros((3, len(ids)))
        for known, *logs in sums:
            for row, x in zip(total, (_unsmall(known), *(np.frombuffer(y, dtype="<f8") for y in logs))):
                row[:len(x)] += x
        made = pa.RecordBatch.from_arrays(
            [pa.array(ids, mask=~valid), pa.array(train), pa.array(np.frombuffer(texts[3], dtype="<i8")), pa.array(total[0].astype(np.int64)),
             pa.array(total[1]), pa.array(total[2])], names=["doc_id", "train", "n_tokens", "known", "base", "score"])
        for a in range(0, len(ids), 50_000):
            yield made.slice(a, 50_000)

    for batch in batches:
        for i in range(batch.num_rows):
            c, kind, blobs = (batch.column(x)[i].as_py() for x in range(3))
            if c != chunk and texts is not None:
                yield from out()
                texts, sums = None, []
            chunk = c
            if kind == TEXTS:
                texts = blobs
            else:
                sums.append(blobs)
    if texts is not None:
        yield from out()


def score_texts(docs: DataFrame, frequent_words: int = FREQUENT, bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """Every row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    A row whose crc32 of doc_id is divisible by ten is held out; the others are trained on, repeated rows
    as often as they come. A null or empty text is its end token. Without training rows everything is
    unknown. An empty table gives no rows. Scores follow from the rows and the arguments alone. The counts of
    ``frequent_words`` words bound the tables of their contexts while several buckets are seated.
    Arrow batches of the session hold at most about ``BATCH_BYTES`` from then on.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    tasks = partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       (~held_out(F.col("doc_id"), FOLDS)).alias("train"))
    counted = rows.where("train").select("text").mapInArrow(_word_counts(4 * tasks), "bucket int, blob binary").repartition(tasks, "bucket")
    with dropped_shuffles(spark):
        counts = stage(counted.mapInArrow(_add_counts, "word long, count long"), "word-counts")
    vocabulary, tokens = counts.agg(F.count("*"), F.coalesce(F.sum("count"), F.lit(0))).first()

    def listed(some: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        found = some.toArrow()
        words = found.column("word").to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(words)
        return words[order], found.column("count").to_numpy()[order]

    buckets = -(-tokens // bucket_tokens) or 1
    # Lists of bounded length: at most 8 shared words per bucket.
    shared, shared_counts = listed(counts.where(F.col("count") > bucket_tokens // 8)) if buckets > 1 else (np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64))
    top, top_counts = listed(counts.orderBy(F.desc("count"), "word").limit(frequent_words))
    contexts, at = np.unique(top & CONTEXT_BITS, return_inverse=True)
    bounds = contexts, np.bincount(at, weights=top_counts, minlength=len(contexts)), int(top_counts.min()) if len(top_counts) else 0

    def gathered(some: DataFrame) -> DataFrame:
        return some.repartition(tasks, "bucket").sortWithinPartitions("bucket", "kind", "chunk")

    listed = bounds[0]
    pairs = gathered(rows.select("text", "train").mapInArrow(_counter(shared, buckets, listed), ROW))
    with dropped_shuffles(spark):
        seats = stage(pairs.mapInArrow(_seater(shared, bounds, vocabulary, buckets), ROW), "seatings")
    sums = seats.where(F.col("kind") == SHARED).mapInArrow(_add_parents(len(shared)), "sample int, k int, customers long, tables long").groupBy(
        "sample", "k").agg(F.sum("customers").alias("n"), F.sum("tables").alias("t")).collect()  # a row per seating and shared word
    parents = np.zeros((SAMPLES, len(shared) + 1, 2))
    for r in sums:
        parents[r["sample"], r["k"]] = r["n"], r["t"]
    seats = seats.where(F.col("kind") == SEATINGS)
    with dropped_shuffles(spark):
        totals = stage(gathered(seats.mapInArrow(_asker(listed, buckets), ROW)).mapInArrow(_add_contexts(listed), ROW), "totals")
    dealt = rows.mapInArrow(_dealer(shared, buckets, listed), ROW)
    scored = gathered(seats.unionAll(totals).unionAll(dealt)).mapInArrow(
        _scorer(shared, shared_counts, parents, vocabulary, tokens, buckets, listed), SUMS)
    both = scored.repartition(tasks, "chunk").sortWithinPartitions("chunk").mapInArrow(
        _add_texts, "doc_id long, train boolean, n_tokens long, known long, base double, score double")
    return both.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", F.col("known").alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
