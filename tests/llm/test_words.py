import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from gridtide.llm import words as W


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b\x1c\x85 AZ", max_size=30)), max_size=8), st.integers(1, 40))
def test_words_of_any_texts(texts, limit):
    hasher, got = W.Hasher(), []
    for b in W.blocks(pa.array(texts, pa.string()), lower=True, limit=limit):
        for i in range(b.rows):
            a, z = b.bounds[i], b.bounds[i + 1]
            got.append([bytes(b.data[s:e]).decode() for s, e in zip(b.starts[a:z], b.ends[a:z])])
        assert len(hasher(b.data, b.starts, b.ends)) == len(b.starts)
    low = str.maketrans("AZ", "az")
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) for t in texts]


def test_hashes_depend_on_the_bytes_alone():
    texts = ["alpha beta gamma", "x alpha", "beta" + " q" * 200_000 + " gamma alpha"]
    hasher, seen = W.Hasher(), {}
    for b in W.blocks(pa.array(texts), limit=10):
        for s, e, h in zip(b.starts, b.ends, hasher(b.data, b.starts, b.ends)):
            assert seen.setdefault(bytes(b.data[s:e]), h) == h
    assert len(set(seen.values())) == len(seen)


def test_runs_stay_in_their_row():
    hashes, bounds = np.arange(6, dtype=np.uint64), np.array([0, 2, 2, 6])
    _, whole = W.runs(hashes, bounds, 3)
    assert whole.tolist() == [False, False, True, True]
