"""Shards of a table in which one row stands very often."""

import random

import pytest

from tests.llm.conftest import prose
from tilewright.llm import sharding


@pytest.mark.parametrize("repeated", [(None, "the same text again"), (7, ""), (None, None)])
def test_repeated_rows_are_spread(spark, repeated):
    rng = random.Random(2)
    rows = [(k, prose(rng, 8)) for k in range(4_000)] + [repeated] * 4_000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sharding.shard_documents(docs, slots=512).collect()
    loads, slots, dealt = [0] * 16, [[] for _ in range(16)], {}
    for r in found:
        loads[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        dealt[r.virtual_slot] = dealt.get(r.virtual_slot, 0) + 1
    assert len(found) == len(rows) and max(loads) - min(loads) <= 0.01 * sum(loads) / 16 + 200
    assert all(sorted(own) == list(range(len(own))) for own in slots)
    assert max(dealt.values()) <= 4 * len(rows) / 512
