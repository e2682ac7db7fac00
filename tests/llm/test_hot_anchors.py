"""Operator 8 where one short string stands in many texts."""

import random
import string

import numpy as np
import pytest

from tests.llm.conftest import same
from tests.llm.test_near_duplicates import windows
from tilewright.llm import radix_dedup


@pytest.fixture(scope="module")
def anchor():
    """A string with so small a hash that it is the anchor of all windows with it."""
    data = np.random.default_rng(1).integers(97, 123, 1 << 18).astype(np.uint8)
    at = int(radix_dedup._hashes(data).argmin())
    return data[at : at + radix_dedup.DIGIT].tobytes().decode()


def letters(rng, n):
    return "".join(rng.choices(string.ascii_letters, k=n))


def written(spark):
    """Bytes of shuffles by stage."""
    context = spark.sparkContext._jsc.sc()
    context.listenerBus().waitUntilEmpty()
    none = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    stages = spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(context.statusStore().stageList(None, False, False, none, None))
    return {s.stageId(): s.shuffleWriteBytes() for s in stages}


def test_windows_of_a_hot_anchor_at_every_place(frame, anchor):
    rng = random.Random(4)
    rows = [(k, letters(rng, 40) + anchor + letters(rng, 40)) for k in range(60)]
    for before in range(radix_dedup.SIDE + 1):  # one window repeated, and hardly more
        text = rows[before][1]
        rows.append((100 + before, letters(rng, 45) + text[40 - before : 90 - before] + letters(rng, 5)))
    side = letters(rng, 30)  # hot halves, with other bytes beyond
    for cut in (0, 3, 14, 15, 16, 17, 29):
        rows += [(200 + 10 * cut + k, letters(rng, 20) + side[cut:] + anchor + letters(rng, 40)) for k in range(4)]
        rows += [(600 + 10 * cut + k, letters(rng, 40) + anchor + side[cut:] + letters(rng, 20)) for k in range(4)]
        rows += [(1000 + 10 * cut + k, side[cut:] + anchor + side[: 30 - k] + letters(rng, 20)) for k in range(4)]
    rng.shuffle(rows)
    expected = windows(rows)
    assert sum(n for _, _, n, _, _ in expected) > 31 * 50
    for hot in (2, 5, 50, 10_000):
        same(radix_dedup.remove_repeats(frame(rows), hot).collect(), expected)


def test_hot_anchors_move_little_more_than_others(spark, frame, anchor):
    rng = random.Random(6)
    rows = [(k, letters(rng, 40) + anchor + letters(rng, 40)) for k in range(3000)]

    def moved(hot):
        before = set(written(spark))
        assert radix_dedup.remove_repeats(frame(rows), hot).where("n_removed > 0").count() == 0
        return sum(n for k, n in written(spark).items() if k not in before)

    assert moved(1000) < 2 * moved(10_000)


def test_many_runs_go_to_their_texts_in_turns(spark, frame, monkeypatch, tmp_path):
    rng = random.Random(8)
    shared = [letters(rng, 70) for _ in range(40)]
    rows = [(k, letters(rng, 3000) + rng.choice(shared) + letters(rng, 9)) for k in range(200)]
    monkeypatch.setattr(radix_dedup, "BROADCAST_NUMBERS", 400)
    expected, moved = windows(rows), {}
    frame(rows).write.parquet(str(tmp_path / "texts"))  # read again in each turn, without a shuffle
    docs = spark.read.parquet(str(tmp_path / "texts"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:  # as for tables too large for Spark's own broadcasts
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for turns in (100, 1):
            monkeypatch.setattr(radix_dedup, "RUN_TURNS", turns, raising=False)
            before = set(written(spark))
            same(radix_dedup.remove_repeats(docs).collect(), expected)
            moved[turns] = sum(n for k, n in written(spark).items() if k not in before)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert moved[1] - moved[100] > 300_000  # with 600,000 bytes of text
