"""Operators 3 and 9."""

import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import documents, same
from tilewright.llm import sharding, url_cascade


def test_shards(frame, spark, tmp_path):
    rows = [r for r in documents(n=400) if len(r[1] or "") < 10_000]
    found = sharding.shard_documents(frame(rows), map_path=str(tmp_path / "map")).collect()
    size = lambda t: len((t or "").encode()) + 1
    same([(r.doc_id, r["size"], r.text_crc32) for r in found], [(d, size(t), zlib.crc32((t or "").encode())) for d, t in rows])
    loads = dict.fromkeys(range(16), 0)
    for r in found:
        loads[r.shard] += r["size"]
        assert r.law == "bytes" and r.grown_shard is None
    for shard in range(16):
        own = sorted(r.slot for r in found if r.shard == shard)
        assert own == list(range(len(own)))
    assert max(loads.values()) - min(loads.values()) <= 0.02 * sum(loads.values()) / 16
    plan = sharding.SlotMap.load(spark, str(tmp_path / "map"))
    assert plan.version == 1 and all(plan.owner[r.virtual_slot] == r.shard for r in found)
    again = sharding.shard_documents(frame(rows)).collect()
    same([(r.doc_id, r.shard, r.text_crc32) for r in again], [(r.doc_id, r.shard, r.text_crc32) for r in found])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=64, max_size=64))
def test_rebalance_moves_few(sizes):
    first = sharding.SlotMap.initial(4, 64)
    loads = lambda plan: [sum(s for k, s in enumerate(sizes) if plan.owner[k] == shard) for shard in range(plan.shards)]
    even = first.rebalanced(dict(enumerate(sizes)))
    assert max(loads(even)) - min(loads(even)) <= max(max(loads(first)) - min(loads(first)), 0) and max(loads(even)) - min(loads(even)) <= max(sizes)
    assert even.rebalanced(dict(enumerate(sizes))).owner == even.owner or max(loads(even)) > min(loads(even))
    grown = even.rebalanced(dict(enumerate(sizes)), shards=5)
    assert max(loads(grown)) - min(loads(grown)) <= max(sizes) and grown.version == 2
    assert sharding.SlotMap(0, 5, even.owner + (4,) * 8).rebalanced({}, shards=4).shards == 4


def test_no_shards_for_nothing(frame):
    assert sharding.shard_documents(frame([])).collect() == []


def judge(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.S).groups()
    host = host.translate({k: k + 32 for k in range(65, 91)})
    fits = [(h + p, v) for h, p, v in url_cascade.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, "allow"))
    return host, path, rule, verdict


URLS = [
    None, "", "no scheme", "http://", "https://Example.ORG/es/x?y#z", "http://a.b.example.org/en/12", "http://example.org/en/2", "http://notexample.org/es/",
    "ftp://x.com/de/", "x://COM/fr/1", "http://x.com/fr", "http://x.com?/fr/", "http://org", "http://.org/", "http://a..org/#", "http://ÉXAMPLE.org/", "http://x.com/de/" + "a" * 5000,
    "http://" + "a." * 3000 + "org/", "a://b://c.org/", "http://x.com/de/\nq", "http://example.org./es/",
]


def test_urls(spark):
    rng = random.Random(2)
    urls = URLS + [f"http://{rng.choice(['a.', ''])}{rng.choice(['x', 'example', 'free-bets'])}.{rng.choice(['org', 'com', 'net'])}/{rng.choice(['es', 'fr', 'de', 'en'])}/{rng.randrange(300)}" for _ in range(300)]
    rows = list(enumerate(urls)) + [(5, URLS[4]), (None, URLS[5])]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' as host", "'y' as path", "1 as rule", "2 as keys")
    same(url_cascade.filter_urls(df).collect(), [(k, *judge(u)) for k, u in rows])
    assert url_cascade.filter_urls(df.limit(0)).collect() == []
    assert {r.verdict for r in url_cascade.filter_urls(df, rules=()).collect()} == {"allow"}


@pytest.mark.parametrize("listed", [0, 1, 40, 900, 3000])
def test_cascade_is_exact(spark, listed):
    universe = spark.range(3000).selectExpr("concat('k', id) as key")
    own = spark.range(listed).selectExpr("concat('k', id * 7 % 3000) as key").unionByName(spark.createDataFrame([(None,)], "key string"))
    cascade = url_cascade.build_cascade(own, universe)
    hashes = universe.select("key", *(c.alias(n) for c, n in zip(url_cascade.hashed(universe["key"]), "ab"))).collect()
    inside = {f"k{k * 7 % 3000}" for k in range(listed)}
    assert {r.key for r in hashes if (r.a, r.b) in cascade} == inside
    assert cascade.n_bits <= max(1024, 12 * 3000)
