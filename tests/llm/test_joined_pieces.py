"""New pieces go to the library many at a time, and their ids are those of the whole texts."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from voltweave.llm import encoding
from voltweave.llm.encoding import CachedEncoder

BYTE = public_tokenizers.path("byte_bpe_50k.json")


class _Counted:
    def __init__(self, model):
        self.model, self.calls = model, 0

    def tokenize(self, text):
        self.calls += 1
        return self.model.tokenize(text)


def _texts(rng, n: int) -> list[str]:
    letters = list("abcdefghijklmnop'.,é中́ ​\t\n<|8")
    return [" ".join("".join(rng.choice(letters, int(rng.integers(0, 9)))) for _ in range(int(rng.integers(0, 40)))) for _ in range(n)]


def test_new_pieces_are_not_encoded_one_by_one():
    tool = CachedEncoder(BYTE)
    tool.model = _Counted(tool.model)
    texts = [" ".join(f"word{k}x{j}," for j in range(100)) for k in range(20)]
    ids, offsets = tool.encode(pa.array(texts))
    assert tool.model.calls < 200  # the first words of texts; 2,000 words are new
    library = Tokenizer.from_file(BYTE)
    for text, a, b in zip(texts, offsets, offsets[1:]):
        assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(4))
def test_joined_pieces_have_the_ids_of_the_library(seed, monkeypatch):
    monkeypatch.setattr(encoding, "JOINED", (1, 3, 50, 200)[seed])
    texts = _texts(np.random.default_rng(seed), 300)
    library = Tokenizer.from_file(BYTE)
    tool = CachedEncoder(BYTE, 500)
    for part in (texts[:150], texts[150:]):
        ids, offsets = tool.encode(pa.array([*part, None]))
        for text, a, b in zip([*part, ""], offsets, offsets[1:]):
            assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_token_across_two_pieces_is_noticed():
    tool = CachedEncoder(BYTE)
    assert tool._joined(["ab", "cd"], np.array([1, 4])) is None or tool._joined(["a", "bcd"], np.array([3, 4])) is None
    ids, sizes = tool._joined([" ab", " cd"], np.array([3, 6]))
    assert ids.tolist() == tool.tokenizer.encode(" ab cd", add_special_tokens=False).ids and sizes.sum() == len(ids)
