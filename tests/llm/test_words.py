"""Word hashes against plain regular expressions."""

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from jobsight.llm import words as W

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LETTER = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abAB zZ\t\n\x0b\x1f\x00\x7f.@[`{09éÉ \U0001f600"), max_size=40), max_size=6))
def test_equal_words_equal_hashes(texts):
    for values, pattern in ((W.BY_SPACE, SPACE), (W.BY_LETTER, LETTER)):
        seen = {}
        got = list(W.hash_words(texts, values))
        assert len(got) == len(texts)
        for text, hashes in zip(texts, got):
            plain = pattern.findall(text.translate(LOWER))
            assert len(plain) == len(hashes)
            for w, h in zip(plain, hashes):
                assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)


def test_long_texts_are_cut_at_separators(monkeypatch):
    texts = ["word%d next " % (i % 7) * (i * 5) for i in range(40)] + ["x" * 500, None, ""]
    whole = list(W.hash_words(texts, W.BY_SPACE))
    monkeypatch.setattr(W, "PIECE", 64)
    for a, b in zip(whole, W.hash_words(texts, W.BY_SPACE)):
        assert np.array_equal(a, b)
