"""The shared arrays of words."""

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from stateloom.llm.words import ALNUM, TOKEN, Words, ngram_hashes, shingles

TEXTS = st.lists(st.text(alphabet="aBz09 \t\n.-_é中{", max_size=30), min_size=1, max_size=5)
LOWER = {c: c + 32 for c in range(65, 91)}


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_patterns(texts):
    for kind, pattern in ((TOKEN, r"[^\x20\x09-\x0D]+"), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        words = Words([t.encode() for t in texts], kind)
        want = [re.findall(pattern, t.translate(LOWER)) for t in texts]
        assert words.counts.tolist() == [len(w) for w in want]
        flat = [w.encode() for own in want for w in own]
        assert [words.word(i) for i in range(len(words))] == flat
        h = words.hashes()
        assert len(set(zip(flat, h.tolist()))) == len(set(flat)) == len(set(h.tolist()))


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_shingles_are_told_apart(texts):
    grams, owner = shingles(Words([t.encode() for t in texts]), 3)
    want = []
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOWER))
        own = [tuple(w[k : k + 3]) for k in range(len(w) - 2)] or ([tuple(w)] if w else [])
        want += [(i, g) for g in own]
    assert sorted(owner.tolist()) == sorted(i for i, _ in want)
    assert len(set(zip(owner.tolist(), grams.tolist()))) == len(set(want))


def test_order_of_words_matters():
    a, b = (Words([t]).hashes() for t in (b"x y z", b"z y x"))
    assert ngram_hashes(a, 3)[0] != ngram_hashes(b, 3)[0]
    assert np.array_equal(np.sort(a), np.sort(b))
