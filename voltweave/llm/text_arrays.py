"""Texts of an Arrow batch as flat numpy arrays: bytes, words, word hashes and shingles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_rng = np.random.default_rng(20240607)
BYTE_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BLOCK_BYTES = 64
PLACE_CODES = BYTE_CODES * np.cumprod(np.full((BLOCK_BYTES, 1), BASE, dtype=np.uint64), axis=0)  # of a byte at a place of its run

LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts, offsets of the texts); a null text is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, number of the text) of all maximal runs of non-separators within a text."""
    if not len(data):
        return (np.empty(0, dtype=np.int64),) * 3
    inside = ~separator[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] = inside[edges]
    stops[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(offsets, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of bytes; runs ascend and do not overlap.

    Longer runs are hashed in blocks: sums over powers cancel in regular sequences of two bytes (Thue-Morse) from 1,024 bytes on.
    """
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    sizes = ends - starts
    if int(sizes.max()) <= BLOCK_BYTES:
        return _block_hashes(data, starts, ends)
    blocks = -(-sizes // BLOCK_BYTES)
    first = np.cumsum(blocks) - blocks
    place = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    begins = np.repeat(starts, blocks) + place * BLOCK_BYTES
    h = _block_hashes(data, begins, np.minimum(begins + BLOCK_BYTES, np.repeat(ends, blocks)))
    joined = mix(np.add.reduceat(mix(h + place.astype(np.uint64) * BASE), first) + sizes.astype(np.uint64))
    return np.where(blocks > 1, joined, h[first])


def _block_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of runs of at most ``BLOCK_BYTES`` bytes: longest first, so that those that have a byte at a place come first."""
    sizes = ends - starts
    order = np.argsort(sizes.astype(np.uint8), kind="stable")[::-1]
    sizes, at = sizes[order], starts[order]
    h = np.zeros(len(sizes), dtype=np.uint64)
    for place, n in enumerate(len(sizes) - np.cumsum(np.bincount(sizes))[:-1]):
        h[:n] += PLACE_CODES[place][data[at[:n] + place]]
    made = np.empty_like(h)
    made[order] = mix(h + sizes.astype(np.uint64))
    return made


def shingle_hashes(words: np.ndarray, text_of: np.ndarray, n_texts: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets) of the runs of ``k`` words of every text; a text of fewer words, but not none, has one run."""
    counts = np.bincount(text_of, minlength=n_texts)
    firsts = np.cumsum(counts) - counts
    runs = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    offsets = np.concatenate([[0], np.cumsum(runs)])
    starts = np.arange(int(offsets[-1])) + np.repeat(firsts - offsets[:-1], runs)
    sizes = np.repeat(np.minimum(counts, k), runs)
    h = sizes.astype(np.uint64)
    padded = np.concatenate([words, np.zeros(k, dtype=np.uint64)])
    for j in range(k):
        step = mix(h * BASE + padded[starts + j])
        h = step if j == 0 else np.where(sizes > j, step, h)
    return h, offsets
