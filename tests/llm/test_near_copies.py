"""Near copies of the pipeline's stage against brute force."""

import random

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.conftest import documents, groups, prose, same
from tilewright.llm import near_copies, simhash


def changed(rng, text, n):
    words = text.split()
    for k in rng.sample(range(len(words)), n):
        words[k] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


def alike(a, b, least=0.8):
    a, b = ({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := (t or "").casefold().split()) else set() for t in (a, b))
    return a == b or len(a & b) >= least * len(a | b)


def expected(rows):
    bits = [simhash.fingerprint(t or "") for _, t in rows]
    near = [(a, b) for a in range(len(rows)) for b in range(a) if (bits[a] ^ bits[b]).bit_count() <= 4 or alike(rows[a][1], rows[b][1])]
    found, least = groups(len(rows), near), {}
    for (doc_id, _), g in zip(rows, found):
        least[g] = min((x for x in (least.get(g), doc_id) if x is not None), default=None)
    return [r for r, g in zip(rows, found) if r[0] is None or r[0] == least[g]]


@pytest.mark.parametrize("block", [1_024, 4])
def test_keep_first(frame, block):
    rng = random.Random(4)
    rows = documents(n=40)
    base = [prose(rng, 150, 4000) for _ in range(30)]
    rows += [(1000 + k, t) for k, t in enumerate(base)]
    rows += [(2000 + 10 * k + j, changed(rng, t, rng.choice([1, 2, 3, 4, 6, 9]))) for k, t in enumerate(base) for j in range(3)]
    rows += [(3000 + j, changed(rng, base[0], 2).upper()) for j in range(40)]
    rows += [(1001, prose(rng, 150, 4000)), (1001, changed(rng, base[0], 2)), (None, changed(rng, base[2], 1))]
    kept = near_copies.keep_first(frame(rows), block)
    assert kept.columns == frame(rows).columns
    same([(r.doc_id, r.text) for r in kept.collect()], expected(rows))
    assert near_copies.keep_first(frame([]), block).collect() == []


def test_stage_catches_near_copies(spark):
    rng = random.Random(9)
    base = [(k, prose(rng, 200, 4000)) for k in range(20)]
    near = [(100 + k, changed(rng, t, 4)) for k, t in base]  # similarity 0.81 or more
    df = spark.createDataFrame(base + near, "doc_id long, text string")
    assert {r[0] for r in corpus_pipeline.drop_near_copies(spark, df, "").select("doc_id").collect()} == set(range(20))


def test_pairs_at_the_bound_share_a_band():
    rng = np.random.default_rng(2)
    for _ in range(200):
        both, a, b = (rng.integers(0, 2**64, n, dtype=np.uint64) for n in (160, 20, 20))
        assert set(near_copies.bands(np.concatenate([both, a]))) & set(near_copies.bands(np.concatenate([both, b])))
