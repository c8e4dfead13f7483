import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from namelens.llm.bpe import Vocabulary, decode, default_tokenizer, encode

from .conftest import LONG

TOKENIZER = default_tokenizer()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def own():
    with open(TOKENIZER) as file:
        return Vocabulary(file.read())


@settings(max_examples=150, deadline=None)
@given(text=st.text(st.characters(exclude_categories=["Cs"]), max_size=60) | st.text("ab's \n<|endoftext|>é日", max_size=60))
def test_like_the_library(own, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == want
    assert own.decode(want) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(ids=st.lists(st.integers(0, 50256), max_size=20))
def test_any_ids_decode_like_the_library(own, library, ids):
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000 + "\n" * 500, "é" * 900, "x <|endoftext|><|endoftext|> y", "0123456789" * 50])
def test_long_fragments(own, library, text):
    assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_no_token_crosses_a_forced_cut(own):
    word = "日本é🙂x".encode() * 3
    (parts,) = own.fragments([word])
    assert b"".join(parts) == word and len(parts) > 1
    assert all(not own.joined[a[-1], b[0]] for a, b in zip(parts, parts[1:]))


def test_awkward_rows(awkward, nothing, library):
    found = encode(awkward, TOKENIZER, decoded="decoded")
    assert found.columns == [c for c in awkward.columns if c != "ids"] + ["ids", "decoded"]
    got = found.collect()
    assert len(got) == awkward.count()
    for r in got:
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == (r.text or "")
    again = decode(found.drop("decoded"), TOKENIZER).collect()
    assert sorted(r.decoded for r in again) == sorted(r.text or "" for r in got)
    assert any(r.text == LONG for r in got)
    assert encode(nothing, TOKENIZER).collect() == []
