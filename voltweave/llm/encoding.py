"""Encoding many texts with a public tokenizer file, each distinct piece of text once per worker.

A text is cut before every space that follows a non-space character. Neither pre-tokenizer of the
supported files lets a token reach across such a place, so the ids of a text are the ids of its pieces
in order. Pieces repeat a lot; a bounded cache in the worker keeps their ids. Texts in which the cut
is not certain (doubled white space before a space, control separators, special-token strings) are
cut more carefully or given to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from voltweave.llm.common import KEPT, expand, release_memory

# White space by Unicode, in front of a space; such texts are cut by WORDS instead.
UNSURE = "^ |[\\t\\n\\x0b\\f\\r \\x85\\xa0  -     　] "
WHOLE = "[\\x1c-\\x1f]|<\\|"
WORDS = re.compile(r"\s*\S+|\s+")

CACHE_PIECES = 500_000

# A space between the last character of one piece and the first of the next, both visible: such pieces stay apart when joined.
APART = "(?s)\\A [^\\s\\pZ\\pC](.*[^\\s\\pZ\\pC])?\\z"
JOINED, AT_ONCE = 200, 32  # pieces that the library gets as one text, such texts in a call

# How byte-level files split a text, and the characters that stand for bytes in their vocabulary.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in SHOWN)}
# Pieces of these characters alone: no combining marks, no exotic spaces, lower case by character. For them the
# pattern of the file gives the same in any engine; others go through the library's normaliser and splitter.
PLAIN = re.compile("[\\x00-\\x1b !-~À-ɏ]*\\Z")


def _pattern(tokenizer) -> tuple[regex.Pattern | None, bool]:
    """(pattern that splits a piece, whether it is lower-cased first) of the kinds of file that are known."""
    # The parts alone: reading the whole file again would take a hundred MB for a moment.
    made = {name: json.loads(part.__getstate__()) for name in ("normalizer", "pre_tokenizer") if (part := getattr(tokenizer, name)) is not None}
    norm, cut = made.get("normalizer"), made.get("pre_tokenizer") or {}
    if norm is None and cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]:
        return regex.compile(BYTE_LEVEL), False
    steps, norms = cut.get("pretokenizers", []), [n["type"] for n in (norm or {}).get("normalizers", [])]
    if [p["type"] for p in steps] == ["Split", "ByteLevel"] and norms == ["NFC", "Replace", "Lowercase"]:
        split, level = steps
        spaces = norm["normalizers"][1] == {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
        if spaces and split["behavior"] == "Removed" and split["invert"] and not level["use_regex"] and not level["add_prefix_space"]:
            return regex.compile(split["pattern"]["Regex"]), True
    return None, False

_encoders: dict[tuple[str, int], CachedEncoder] = {}
KEPT.append(_encoders)


class CachedEncoder:
    """Ids of texts by the tokenizers library.

    Two bounded caches outlive a batch: ids of pieces (an Arrow array with numpy offsets, so known pieces
    are looked up without Python code) and ids of the pre-tokens they consist of.
    """

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.normalizer, self.cutter, self.model = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer, self.tokenizer.model
        self.pattern, self.lower = _pattern(self.tokenizer)
        # Tokens of the byte-level kind stand for bytes one by one: lengths tell where a piece ends among the ids of joined ones.
        self.token_bytes = None
        if self.pattern is not None and not self.lower:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.token_bytes = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
            self.token_bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.most = cache_pieces
        self.clock = 0
        self.words: dict[str, bytes] = {}  # by pre-token as in the text, and as the vocabulary shows it
        self.shown: dict[str, bytes] = {}
        self._keep(pa.array([], pa.large_string()), np.empty(0, "<u4"), np.empty(0, np.int64), np.empty(0, np.int64))

    def _keep(self, known: pa.Array, pool: np.ndarray, sizes: np.ndarray, used: np.ndarray) -> None:
        self.known, self.pool, self.sizes, self.used = known, pool, sizes, used
        self.starts = np.cumsum(sizes) - sizes

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece: its pre-tokens, each through the library's model once."""
        if self.pattern is not None and PLAIN.match(piece):
            words = self.pattern.findall(piece.lower() if self.lower else piece)
            shown = False
        else:
            words = [w for w, _ in self.cutter.pre_tokenize_str(self.normalizer.normalize_str(piece) if self.normalizer else piece)]
            shown = True
        made = []
        for word in words:
            cache = self.shown if shown else self.words
            ids = cache.get(word)
            if ids is None:
                text = word if shown else word.encode().decode("latin-1").translate(BYTE_CHARS)
                ids = array("I", [t.id for t in self.model.tokenize(text)]).tobytes()
                if len(cache) >= self.most // 4:
                    cache.clear()
                cache[word] = ids
            made.append(ids)
        return made[0] if len(made) == 1 else b"".join(made)

    def _joined(self, pieces: list[str], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """(ids, ids per piece) of pieces that end at the bytes ``ends`` of their sequence; None where a token lies across two."""
        texts = ["".join(pieces[a:a + JOINED]) for a in range(0, len(pieces), JOINED)]
        made = [np.array(e.ids, dtype="<u4") for a in range(0, len(texts), AT_ONCE)
                for e in self.tokenizer.encode_batch_fast(texts[a:a + AT_ONCE], add_special_tokens=False)]
        ids = np.concatenate(made) if made else np.empty(0, "<u4")
        if len(ids) and int(ids.max()) >= len(self.token_bytes):
            return None
        place = np.concatenate([[0], np.cumsum(self.token_bytes[ids])])
        last = np.searchsorted(place, ends)
        if not np.array_equal(place[np.minimum(last, len(ids))], ends) or (len(ends) and last[-1] != len(ids)):
            return None
        return ids, np.diff(last, prepend=0)

    def _fresh(self, pieces: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
        """(places of the pieces in what follows, pieces, ids, ids per piece)."""
        pieces = pieces.cast(pa.large_string())
        order, joined = np.arange(len(pieces)), 0
        ids, sizes = [], []
        if self.token_bytes is not None:
            apart = pc.match_substring_regex(pieces, APART).to_numpy(zero_copy_only=False)
            order, joined = np.argsort(~apart, kind="stable"), int(apart.sum())
            pieces = pieces.take(pa.array(order))
            found = self._joined(pieces[:joined].to_pylist(), np.cumsum(pc.binary_length(pieces[:joined]).to_numpy()))
            if found is None:
                joined = 0
            else:
                ids, sizes = [found[0]], [found[1]]
        made = [self._piece(p) for p in pieces[joined:].to_pylist()]
        ids.append(np.frombuffer(b"".join(made), dtype="<u4"))
        sizes.append(np.fromiter(map(len, made), dtype=np.int64, count=len(made)) >> 2)
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        return place, pieces, np.concatenate(ids), np.concatenate(sizes)

    def pieces(self, pieces: pa.Array) -> np.ndarray:
        """Numbers of distinct pieces in the cache, after adding those that were missing."""
        self.clock += 1
        at = pc.index_in(pieces, value_set=self.known)
        missing = pc.is_null(at)
        fresh = pieces.filter(missing)
        at = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        self.used[at[at >= 0]] = self.clock
        if len(fresh):
            place, fresh, ids, sizes = self._fresh(fresh)
            at[missing.to_numpy(zero_copy_only=False)] = place + len(self.known)
            self._keep(
                pa.concat_arrays([self.known, fresh]), np.concatenate([self.pool, ids]), np.concatenate([self.sizes, sizes]),
                np.concatenate([self.used, np.full(len(fresh), self.clock)]),
            )
        return at

    def _trim(self) -> None:
        """Over the bound, the three quarters that were used last stay; freed Arrow memory goes back."""
        if len(self.known) > self.most:
            stay = np.sort(np.argsort(self.used, kind="stable")[-(self.most * 3 // 4):])
            pool = self.pool[expand(self.starts[stay], self.sizes[stay])]
            self._keep(self.known.take(pa.array(stay)), pool, self.sizes[stay], self.used[stay])
        pa.default_memory_pool().release_unused()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, offsets of the texts); a null text is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = pc.match_substring_regex(texts, WHOLE).to_numpy(zero_copy_only=False)
        unsure = pc.match_substring_regex(texts, UNSURE).to_numpy(zero_copy_only=False)
        plain = ~whole & ~unsure
        special = {int(i): self._hard(texts[i].as_py(), bool(whole[i])) for i in np.flatnonzero(~plain)}
        emptied = pc.if_else(pa.array(plain), texts, "") if special else texts
        split = pc.split_pattern(emptied, " ")
        parts, bounds = split.flatten(), split.offsets.to_numpy()
        bounds = bounds - bounds[0]
        first = np.zeros(len(parts), dtype=bool)
        first[bounds[:-1]] = True
        lead, lead_codes = _dictionary(parts.filter(pa.array(first)))
        rest, rest_codes = _dictionary(parts.filter(pa.array(~first)))
        distinct = pa.concat_arrays([lead, pc.binary_join_element_wise(pa.scalar("", pa.large_string()), rest, pa.scalar(" ", pa.large_string()))])
        # A first piece and a later one are never equal: later ones begin with a space, such texts are not plain.
        at = self.pieces(distinct)
        units = np.empty(len(parts), dtype=np.int32)
        units[first] = at[:len(lead)][lead_codes]
        units[~first] = at[len(lead):][rest_codes]
        sizes, starts, pool = self.sizes.astype(np.int32), self.starts, self.pool
        lengths = sizes[units]
        ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        offsets = ends[bounds]
        out = np.empty(int(ends[-1]), dtype="<u4")
        for a in range(0, len(units), 500_000):  # bounded temporaries
            n = lengths[a:a + 500_000]
            shift = starts[units[a:a + 500_000]] - (np.cumsum(n, dtype=np.int64) - n)
            out[ends[a]:ends[min(a + 500_000, len(units))]] = pool[np.arange(int(n.sum())) + np.repeat(shift, n)]
        self._trim()
        if special:
            out, offsets = _insert(out, offsets, special)
        return out, offsets

    def _hard(self, text: str, whole: bool) -> np.ndarray:
        made = self._library(text) if whole else b"".join(map(self._piece, WORDS.findall(text)))
        return np.frombuffer(made, dtype="<u4")


def _dictionary(parts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    coded = parts.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)


def _insert(out: np.ndarray, offsets: np.ndarray, special: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    parts, sizes, at = [], np.diff(offsets), 0
    for i, ids in sorted(special.items()):
        parts += [out[at:offsets[i]], ids]
        at, sizes[i] = offsets[i + 1], len(ids)
    parts.append(out[at:])
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])


def encoder(path: str, cache_pieces: int = CACHE_PIECES) -> CachedEncoder:
    """The worker's encoder of a file; Python workers are reused, so its cache outlives a task."""
    key = (path, cache_pieces)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = CachedEncoder(path, cache_pieces)
        release_memory()  # what reading the file took
    return _encoders[key]
