"""Many texts at once against the library's call with each."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import AddedToken, Tokenizer

from tests.llm.conftest import documents
from tilewright.llm import pieces, tokens

pytest.importorskip("public_tokenizers")
LIBRARY = Tokenizer.from_file(tokens.default_path())
ENCODER = tokens.Encoder(tokens.default_path())
PARTS = [
    "<|endoftext|>", "<|endoftext", "|>", " ", "  ", "\n", "\t", "\x00", "\x1c", " ", " ", "́", "​", "'s", "'", "s", "a", " the", " of", " Wörd", "é", "ſ", "×", "÷",
    "Ã", " ÷x", "中", " 中文", "я", "1", "²", ".", ",", ".\nThe", " l" + "o" * 21 + "ng", " l" + "o" * 22 + "ng", " x" * 9, "\U0001f600", "don't", " we'll", " |", "\r\n", "Ŀ", " Ŀa",
]


def as_lists(found):
    ids, edges = found
    return [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:], strict=True)]


def library(texts, own=LIBRARY):
    return [own.encode(text, add_special_tokens=False).ids + [9] for text in texts]


TEXTS = st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), max_size=8)


@settings(max_examples=1500, deadline=None)
@given(TEXTS)
def test_many_is_the_library(texts):
    assert as_lists(ENCODER.many(pa.array(texts, pa.string()), 9)) == library(texts)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(0, 3), st.sampled_from([pa.string(), pa.large_string()]))
def test_slices(texts, first, kind):
    assert as_lists(ENCODER.many(pa.array(texts, kind).slice(first), 9)) == library(texts[first:])


@pytest.mark.parametrize("remembered", [0, 1, 40, None])
def test_any_memory_gives_the_same_ids(monkeypatch, remembered):
    monkeypatch.setattr(pieces, "AT_ONCE", 3_000)
    monkeypatch.setattr(pieces, "LONG_TEXT", 20_000)
    texts = [text or "" for _, text in documents()] + ["one two " * 9_000, "x" * 30_000]
    own = tokens.Encoder(tokens.default_path(), remembered)
    for _ in range(2):
        assert as_lists(own.many(pa.array(texts), 9)) == library(texts)
    assert remembered is None or own.pieces.remembered <= remembered


def test_pieces_that_meet_at_one_place(monkeypatch):
    monkeypatch.setattr(pieces, "_MIX", np.zeros(4, np.uint64))  # all hash alike: more than are looked at
    own = tokens.Encoder(tokens.default_path())
    texts = [f"a {a}{b}, {b}{a}{a}; {b}" for a in "abcdef" for b in "xyz"]
    for _ in range(2):
        assert as_lists(own.many(pa.array(texts), 9)) == library(texts)


@pytest.mark.parametrize("added", [["<x>"], ["<x y>"], [AddedToken("<x>", lstrip=True)]])
def test_other_added_tokens(tmp_path, added):
    other = Tokenizer.from_file(tokens.default_path())
    other.add_tokens(added)
    other.save(str(tmp_path / "other.json"))
    own = tokens.Encoder(str(tmp_path / "other.json"))
    texts = ["a <x> b", "a <x", "y> b", "the <x y> of", " <x><x>", "", "the of"]
    assert as_lists(own.many(pa.array(texts), 9)) == library(texts, other)
