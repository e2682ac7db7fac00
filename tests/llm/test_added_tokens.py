"""The encoder against the library as the contract calls it, with added tokens in the texts."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import AddedToken, Tokenizer

from tilewright.llm import memory, orc_tokens, packing, tokens

pytest.importorskip("public_tokenizers")
LIBRARY = Tokenizer.from_file(tokens.default_path())
ENCODER = tokens.Encoder(tokens.default_path())
PARTS = ["<|endoftext|>", "<|endoftext|", "|>", "<", " ", "a", "b's", "\n", "  ", "é", "wörd", "end,", " "]


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_added_tokens(text):
    assert np.frombuffer(ENCODER(text), "<u4").tolist() == ids(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([*PARTS, "<x>", "<x>y"]), max_size=14).map("".join))
def test_added_tokens_that_take_what_is_beside_them(text):
    library = Tokenizer.from_file(tokens.default_path())
    library.add_tokens([AddedToken("<x>", lstrip=True), AddedToken("<x>y")])
    own = tokens.Encoder.__new__(tokens.Encoder)
    own.__dict__ |= ENCODER.__dict__ | {"tokenizer": library, "added": ["<|endoftext|>", "<x>", "<x>y"], "cut_added": None}
    assert np.frombuffer(own(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_queries(frame):
    rows = [(1, "a<|endoftext|>b"), (2, "<|endoftext|>"), (3, " x <|endoftext|> y<|endoftext|><|endoftext|>"), (4, "plain")]
    expect = {k: len(ids(t)) + 1 for k, t in rows}
    assert {r.doc_id: r.length for r in packing.pack_documents(frame(rows)).collect()} == expect
    assert {r.doc_id: r.n_tokens for r in orc_tokens.token_files(frame(rows)).collect()} == expect
    assert expect[1] == 4


def test_one_memory_at_a_time():
    memory.word_hashes(["a", "b"])
    first = memory.held("other", dict)
    first["x"] = 1
    assert memory.held("other", dict) == {"x": 1} and list(memory._held) == ["other"]
