"""What the workers hold of a benchmark."""

from __future__ import annotations

import pickle

from stateloom.llm.decontamination import Index


def test_an_index_is_small_also_with_items_of_many_sizes():
    texts = [" ".join(f"w{n}x{k}" for k in range(n)).encode() for n in range(1, 61)]
    index = Index(list(range(len(texts))), texts)
    assert len(index.sized) == 60
    assert len(pickle.dumps(index)) < 8 << 20
    found = index.find(texts)
    assert {(t, i) for t, i, *_ in found} >= {(k, k) for k in range(len(texts))}
