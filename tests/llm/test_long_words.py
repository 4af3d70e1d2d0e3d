"""Regular long words keep their hashes apart."""

import numpy as np
import pyarrow as pa

from voltweave.llm import jaccard
from voltweave.llm.text_arrays import BLOCK_BYTES, flat_bytes, run_hashes, word_bounds


def regular(length):
    """Two words whose bytes swap by the parity of the binary digits of their place (Thue-Morse)."""
    word = "".join("ab"[i.bit_count() % 2] for i in range(length))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_regular_words_are_not_linked(spark):
    a, b = regular(2048)
    texts = [f"one two three {a} five", f"one two three {b} five", f"One two three {a.upper()} five", a, b]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.linked_components(frame, 4, 85).collect()}
    assert got == {0: (2, 0), 1: (2, 1), 2: (2, 0), 3: (1, 3), 4: (1, 4)}


def test_hash_of_a_word_does_not_depend_on_its_neighbours():
    words = [w[:n] for n in (1, BLOCK_BYTES - 1, BLOCK_BYTES, BLOCK_BYTES + 1, 3 * BLOCK_BYTES, 1024, 4096) for w in regular(max(n, 2))]

    def hashes(text):
        data, offsets = flat_bytes(pa.array([text]))
        starts, ends, _ = word_bounds(data, offsets)
        return run_hashes(data, starts, ends)

    together = hashes(" ".join(words))
    assert np.array_equal(together, np.concatenate([hashes(w) for w in words]))
    assert len(set(together.tolist())) == len(set(words))
