"""The classifier beside a plain FTRL-proximal: one weight at a time, in dictionaries."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tilewright.llm import quality


def plain_scores(examples, texts, s):
    z, n = {}, {}

    def weight(i):
        if i not in z:
            return 0.0
        return 0.0 if abs(z[i]) <= s.l1 else -(z[i] - math.copysign(s.l1, z[i])) / ((s.beta + math.sqrt(n[i])) / s.alpha + s.l2)

    def counts(text):
        ids = quality.ngram_ids(text, s.bits).tolist()
        return {i: k * (s.scale / max(1, len(ids))) for i, k in Counter(ids).items()} | {1 << s.bits: 1.0}

    for text, y in examples * s.epochs:
        x = {i: float(np.float32(v)) for i, v in counts(text).items()}
        w = {i: weight(i) for i in x}
        p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w[i] * x[i] for i in x)))))
        for i, v in x.items():
            g = (p - y) * v
            before = n.get(i, 0.0)
            z[i] = z.get(i, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / s.alpha * w[i]
            n[i] = before + g * g
    return [1 / (1 + math.exp(-sum(weight(i) * v for i, v in counts(t or "").items()))) for t in texts]


@pytest.mark.parametrize("l1", [0.0, 0.05])
def test_scores_are_those_of_plain_ftrl(frame, spark, l1):
    rng, settings = random.Random(12), quality.Settings(bits=14, l1=l1)
    rows = [(k, prose(rng, rng.randrange(1, 40), 60 + 40 * (k % 2))) for k in range(160)] + [(3, "a text of its own"), (3, "a text of its own"), (500, None), (501, "")]
    labels = [(k, k % 2) for k in range(0, 160, 2)] + [(k, k % 2) for k in range(1, 120, 2)] + [(9, 1), (9, 0), (None, 1), (700, 1)]
    df = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {(r.doc_id, r.held_out): r.score for r in quality.score_documents(frame(rows), df, settings=settings).collect()}
    order = {(r[0], r[1]): r[2] for r in df.select("doc_id", "quality", F.xxhash64("doc_id", "quality")).collect()}
    least = {}
    for k, t in rows:
        least[k] = min(least.get(k, t or ""), t or "")
    held = lambda k: zlib.crc32(str(k).encode()) % 4 == 2
    learnt = sorted((order[k, y], y, least[k]) for k, y in labels if k is not None and k in least and not held(k))
    expect = plain_scores([(t, y) for _, y, t in learnt], [t for _, t in rows], settings)
    for (k, _), score in zip(rows, expect):
        if k != 3:
            assert got[k, held(k)] == pytest.approx(score, abs=1e-6)


def test_copies_under_one_id_are_learnt_from_once(frame, spark):
    rng = random.Random(2)
    rows = [(k, prose(rng, 20, 50)) for k in range(40)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    once = {r.doc_id: r.score for r in quality.score_documents(frame(rows), labels).collect()}
    often = {r.doc_id: r.score for r in quality.score_documents(frame(rows + [rows[5]] * 50), labels).collect()}
    assert once == often
