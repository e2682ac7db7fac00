"""Tiling beside its definition, tie by tie, and on passages that stand very often."""

import random
import tracemalloc

import numpy as np
import pytest

from tests.llm.conftest import CLASHING, prose, same
from tests.llm.test_secrets_quality_tiling import tiled
from tilewright.llm import tiling


@pytest.mark.parametrize("block", [4, 50, 1 << 19])
def test_tiles_are_those_of_the_definition(block):
    rng = random.Random(16)
    for _ in range(80):
        vocabulary = rng.choice([1, 2, 3, 12, 200])
        item = prose(rng, rng.randrange(5, 25), vocabulary)
        words = item.split()
        k = len(words) // 2
        doc = prose(rng, rng.randrange(0, 20), vocabulary) + " " + " ".join(rng.choice([words[k:] + words[:k], words[:k], words[1:], []])) + " " + prose(rng, 10, vocabulary)
        runs = tiling.Seeds([(1, item)], 3).runs(tiling.word_hashes(doc), block=block)
        assert tiling.tiles(runs.get(0, []), len(words), 3) == tiled(item, doc, 3)[0], (item, doc)


def test_items_that_cannot_reach_the_coverage_are_left_out_only_then():
    rng = random.Random(3)
    for _ in range(60):
        items = [(k, prose(rng, rng.randrange(3, 25), 8)) for k in range(6)]
        doc = tiling.word_hashes(prose(rng, 40, 8))
        seeds, part = tiling.Seeds(items, 3), rng.choice([0.3, 0.5, 0.9, 1.0])
        every = {k: sum(n for n, *_ in tiling.tiles(runs, len(seeds.items[k][1]), 3)) / len(seeds.items[k][1]) for k, runs in seeds.runs(doc).items()}
        found = {item: own for item, own, _ in tiling._marked(seeds, doc, part)}
        assert found == {seeds.items[k][0]: own for k, own in every.items() if own >= part}


def test_equal_hashes_of_different_words(monkeypatch):
    monkeypatch.setattr(tiling, "_BASE", 0)  # a window's hash is then its last word's
    seeds = tiling.Seeds([(1, "a b c d e f"), (2, "x y c d e f")], 3)
    assert seeds.runs(tiling.word_hashes("q a b c d e z y c d"))[0] == [(5, 0, 1)]


def test_a_phrase_that_stands_everywhere_is_bounded():
    rng = random.Random(1)
    phrase = "one two three four five six"
    items = [(k, " ".join([phrase] * 20 + [prose(rng, 120, 10**6)])) for k in range(500)]
    seeds, words = tiling.Seeds(items, 5), tiling.word_hashes(" ".join([phrase] * 2500))
    few = tiling.Seeds(items[:3], 5)
    tracemalloc.start()
    assert list(tiling._marked(seeds, words, 0.9)) == []  # 100 million meetings, none of which can reach it
    found = list(tiling._marked(few, words, 0.5))
    assert tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
    assert [(item, part, marked[0]) for item, part, marked in found] == [(k, 0.5, (120, 0, 0)) for k in range(3)]


def test_short_items(frame, spark):
    bench = spark.createDataFrame([(1, "too short"), (2, "word"), (3, ""), (4, None), (5, "too short"), (None, "a b c d"), (1, "too short")], "item_id long, text string")
    docs = [(1, "this is Too  SHORT!"), (2, "too, long short"), (3, "WORD"), (4, None), (5, ""), (None, "x a b c d e"), (3, "WORD")]
    got = tiling.contaminated_pairs(frame(docs), bench, short=True).collect()
    same([(r.doc_id, r.item_id) for r in got], [(1, 1), (1, 5), (3, 2), (3, 2), (None, None)])
    assert {r.coverage for r in got} == {1.0}
    kept = tiling.without_leaks(frame(docs), bench, short=True)
    assert kept.columns == ["doc_id", "text", *CLASHING]
    same([(r.doc_id, r.text) for r in kept.collect()], [docs[1], docs[3], docs[4]])
    assert tiling.without_leaks(frame(docs), bench).count() == len(docs)


def test_a_benchmark_in_chunks(frame, spark, monkeypatch):
    rng = random.Random(5)
    items = [(k, prose(rng, 30, 5000)) for k in range(9)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(k, prose(rng, 9) + " " + items[k][1]) for k in range(9)] + [(100 + k, prose(rng, 30, 5000)) for k in range(9)]
    whole = tiling.contaminated_pairs(frame(docs), bench).collect()
    monkeypatch.setattr(tiling, "CHUNK_WORDS", 60)
    same(tiling.contaminated_pairs(frame(docs), bench).collect(), whole)
    assert {r.doc_id for r in whole} == set(range(9)) == set(range(109)) - {r[0] for r in tiling.without_leaks(frame(docs), bench).select("doc_id").collect()} - set(range(9, 100))


def test_word_hashes_are_those_of_the_words():
    one, two = tiling.word_hashes("A b, C"), tiling.word_hashes("a  B c!")
    assert len(one) == 3 and np.array_equal(one, two)
