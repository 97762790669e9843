import random

import numpy as np
import pyarrow as pa

from skytally.llm.tokens import NOT_ALPHANUMERIC, hashed_words, parts_of
from tests.llm.helpers import ODD, words


def test_equal_words_have_equal_hashes_and_others_not():
    texts = [r[1] for r in ODD] + ["".join(random.Random(i).choices("aAbB \t\n.é", k=50)) for i in range(200)]
    hashes, offsets = hashed_words(pa.array(texts, pa.string()))
    every = [words(t) for t in texts]
    assert np.diff(offsets).tolist() == [len(w) for w in every]
    seen = {}
    for word, value in zip((w for ws in every for w in ws), hashes.tolist()):
        assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_slices_and_separators():
    column = pa.array(["a b", "c,d e", None, "f"]).slice(1, 3)
    hashes, offsets = hashed_words(column, NOT_ALPHANUMERIC)
    assert offsets.tolist() == [0, 3, 3, 4]
    assert hashes[0] == hashed_words(pa.array(["c"]))[0][0]
    assert len(hashed_words(pa.array([], pa.string()))[0]) == 0


def test_parts_hold_all_rows():
    texts = ["abc", None, "", "d" * 500, "e", "f" * 60, "g" * 60, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(len(texts)))], ["text", "i"])
    parts = list(parts_of(iter([batch, batch.slice(0, 0)]), "text", 100))
    assert [i for b in parts for i in b.column("i").to_pylist()] == list(range(len(texts))) and len(parts) > 2
