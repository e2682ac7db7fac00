"""Operators 4 and 10, and the encoder under both."""

import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import documents, same
from tilewright.llm import orc_tokens, packing, tokens

pytest.importorskip("public_tokenizers")
LIBRARY = Tokenizer.from_file(tokens.default_path())
LIBRARY.encode_special_tokens = True
ENCODER = tokens.Encoder(tokens.default_path())


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab 's.,\n\t1é²\u00a0\u2003\x1c中<|endoftext|>ſ"), max_size=40))
def test_encoder_is_the_library(text):
    assert np.frombuffer(ENCODER(text), "<u4").tolist() == library_ids(text)


def test_encoder_with_full_memory(monkeypatch):
    monkeypatch.setattr(tokens, "MOST_PARTS", 3)
    monkeypatch.setattr(tokens, "MOST_WORDS", 2)
    own = tokens.Encoder(tokens.default_path())
    for _, text in documents():
        assert np.frombuffer(own(text or ""), "<u4").tolist() == library_ids(text)
    assert len(own.parts) <= 3 and len(own.words) <= 2


def sequences_needed(lengths, capacity):
    free, n = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect_left(free, length)
        room = free.pop(at) if at < len(free) else capacity
        n += room == capacity and at >= len(free)
        if room - length:
            insort(free, room - length)
    return n


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 60).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=120))))
def test_plan(case):
    capacity, lengths = case
    plan = packing.plan_slots(Counter(lengths), capacity)
    used, ranks = defaultdict(list), defaultdict(list)
    for length, low, high, sequence, copies, offset in plan:
        for rank in range(low, high):
            ranks[length].append(rank)
            used[sequence + (rank - low) // copies].append((offset + (rank - low) % copies * length, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in Counter(lengths).items()}
    assert sorted(used) == list(range(len(used)))
    for held in used.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    free, n = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect_left(free, length)
        if at < len(free):
            room = free.pop(at)
        else:
            room, n = capacity, n + 1
        if room > length:
            insort(free, room - length)
    assert len(used) == n


def test_pack(frame):
    rows = documents()
    found = packing.pack_documents(frame(rows), capacity=128).collect()
    expect = []
    for doc_id, text in rows:
        ids = np.array(library_ids(text) + [2], "<u4")
        first = (len(ids) - 1) % 128 + 1
        edges = [0, *range(first, len(ids) + 1, 128)]
        expect += [(doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    same([r[:5] for r in found], expect)
    held = defaultdict(list)
    for r in found:
        held[r.sequence_id].append((r.offset, r.length))
    for own in held.values():
        own.sort()
        assert [o for o, _ in own] == list(np.cumsum([0] + [n for _, n in own])[:-1]) and sum(n for _, n in own) <= 128
    assert len(held) <= 1.02 * sum(e[3] for e in expect) / 128 + 1


def test_orc(spark, frame, tmp_path):
    rows = documents()
    path = str(tmp_path / "ids")
    found = orc_tokens.token_files(frame(rows), path).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode())))
    start, expect = 0, []
    for doc_id, text in order:
        ids = np.array(library_ids(text) + [0], "<u4")
        expect.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    same(found, expect)
    one = orc_tokens.read_token_files(spark, path).where("doc_id = 11").collect()
    assert [r.ids for r in one] == [library_ids(t) + [0] for d, t in rows if d == 11]
    # each file holds one range, in order
    files = spark.read.orc(path).groupBy("file").agg({"doc_id": "min", "first": "min"}).collect()
    assert all(r["min(first)"] == 0 for r in files)


def test_empty(frame):
    assert packing.pack_documents(frame([])).collect() == []
    assert orc_tokens.token_files(frame([])).collect() == []


def test_a_small_memory_gives_the_same_ids():
    path = tokens.default_path()
    small, large = tokens.Encoder(path, 2), tokens.Encoder(path)
    for text in ("one two, three four. five two", "six two, seven  eight\n nine one"):
        for _ in range(2):
            assert small(text) == large(text)
    assert len(small.parts) <= 2 and len(small.words) <= 2
