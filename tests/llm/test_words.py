import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from namelens.llm.words import window_hashes, words_of

TEXTS = st.lists(st.text(alphabet=" \t\n\x0b\x0c\rabé日\x85\xa0", max_size=30), min_size=1, max_size=5)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_are_the_runs_between_spaces(texts):
    words = words_of([t.encode() for t in texts])
    for i, text in enumerate(texts):
        assert [w.decode() for w in words.texts(i)] == re.findall(r"[^\x20\x09-\x0D]+", text)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_equal_words_and_only_they_have_equal_hashes(texts):
    words = words_of([t.encode() for t in texts])
    pieces = [w for i in range(len(texts)) for w in words.texts(i)]
    by_hash = dict(zip(words.hashes.tolist(), pieces))
    assert all(by_hash[h] == p for h, p in zip(words.hashes.tolist(), pieces))
    assert len(by_hash) == len(set(pieces))


def test_windows_are_told_apart_by_their_words_alone():
    words = words_of([b"a b c a b c", b"b c a"])
    own = words.hashes
    threes = window_hashes(own[:6], 3)
    assert threes[0] == threes[3]
    assert window_hashes(own[6:], 3)[0] == threes[1]
    assert len(np.unique(threes)) == 3
    assert len(window_hashes(own[:2], 3)) == 0
