"""Operators 6, 7 and 8, and the components under them."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import documents, groups, same
from tilewright.llm import cap_filters, components, radix_dedup, simhash


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1100)] + [(2000, k) for k in range(2001, 2300)] + [(5, 5)]
    ids = sorted({x for link in links for x in link})
    at = {x: k for k, x in enumerate(ids)}
    expect = [ids[g] for g in groups(len(ids), [(at[a], at[b]) for a, b in links])]
    df = spark.createDataFrame(links + [(None, 3), (4, None)], "u long, v long")
    same(components.components(df).collect(), zip(ids, expect, strict=True))
    assert components.components(df.limit(0)).collect() == []


def by_definition(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + n]).encode(), 42) for k in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aB Éç\t\n\x0b\x1c\x85\u00a0x"), max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == by_definition(text)


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([(8, 1 << 22), (10, 1 << 9), (9, 64)]))
def test_blocks_link_what_is_near(seed, shape):
    bits, held = shape
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64) * np.uint64(2)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 6), replace=False)) for b in base for _ in range(6)]
    prints = np.unique(np.array([*near, 0, 2**64 - 1, 3], np.uint64))
    expect = groups(len(prints), np.argwhere(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4))
    masks, links = simhash.flips(range(bits), 2), []
    for block in np.unique(prints[:, None] >> np.uint64(64 - bits) ^ masks[None, :]):
        own = prints[np.isin(prints >> np.uint64(64 - bits), masks ^ block)]
        u, v = simhash.block_forest(own, int(block), bits, 2, held)
        links += list(zip(np.searchsorted(prints, u), np.searchsorted(prints, v)))
    assert groups(len(prints), links) == expect


def test_simhash(frame):
    rows = documents(n=120)
    got = simhash.near_duplicates(frame(rows)).collect()
    prints = [by_definition(t) for _, t in rows]
    found = groups(len(rows), [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4])
    least = {}
    for (doc_id, _), g in zip(rows, found):
        least[g] = min((x for x in (least.get(g), doc_id) if x is not None), default=None)
    same(got, [(d, format(p, "016x"), least[g]) for (d, _), p, g in zip(rows, prints, found)])
    kept = simhash.keep_first(frame(rows))
    assert kept.columns == frame(rows).columns
    firsts = {least[g] for g in found}
    same([(r.doc_id, r.text) for r in kept.collect()], [r for r in rows if r[0] is None or r[0] in firsts and not any(d == r[0] and least[g] != d for (d, _), g in zip(rows, found))])
    assert simhash.near_duplicates(frame([])).collect() == []


def linked(rows, least=0.93):
    ok = [r[0] is not None and r[2] is not None and r[1] is not None and len(r[1]) > 0 and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    links = []
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    links.append((a, b))
    return links


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    rows, k = [], 0
    for _ in range(25):
        base = rng.standard_normal(32)
        for _ in range(int(rng.integers(1, 9))):
            noisy = base + rng.standard_normal(32) * rng.choice([0.0, 0.05, 0.25])
            rows.append((k, [float(np.float32(x)) for x in noisy * rng.choice([1.0, 3.0])], int(rng.integers(0, 2))))
            k += 1
    copy = rows[3][1]
    rows += [(k + j, copy, 1) for j in range(6)]
    odd = [[0.0] * 32, None, [None] * 32, [float("nan")] * 32, [float("inf")] + [0.0] * 31, [1.0, 2.0], [1.0, 2.0], []]
    rows += [(k + 10 + j, v, 1) for j, v in enumerate(odd)] + [(None, copy, 1), (k + 30, copy, None), rows[3]]
    return rows


@pytest.mark.parametrize(("block", "kind"), [(2048, "float"), (3, "double")])
def test_vectors(spark, vectors, block, kind):
    df = spark.createDataFrame(vectors, f"vec_id long, embedding array<{kind}>, label int").repartition(3).selectExpr("*", "1 as id", "2 as copies", "3 as filter", "4 as key1", "'q' as part")
    got = cap_filters.near_vectors(df, block=block).collect()
    links = linked(vectors)
    found = groups(len(vectors), links)
    n = np.bincount(np.array(links).ravel(), minlength=len(vectors))
    least = {}
    for row, g in zip(vectors, found):
        least[g] = min((x for x in (least.get(g), row[0]) if x is not None), default=None)
    expect = [(r[0], int(n[k]), least[found[k]], r[0] is None or r[0] == least[found[k]]) for k, r in enumerate(vectors)]
    assert len(got) == len(expect)
    right = sum(min(a, b) for a, b in [(sum(r.n_links for r in got), n.sum())]) / max(1, n.sum())
    assert right >= 0.97 and sum(r.n_links for r in got) <= n.sum()
    own = sorted(map(tuple, got), key=str)
    assert sum(e in own for e in expect) >= 0.9 * len(expect)
    assert cap_filters.near_vectors(df.limit(0)).collect() == []


@pytest.mark.parametrize("small", [16, 2, 1])
def test_every_pair_with_a_common_filter_counts_once(small):
    rng = np.random.default_rng(1)
    v = cap_filters.unit(rng.standard_normal((1, 16)) + 0.05 * rng.standard_normal((12, 16)))
    passed = cap_filters.decode(v, cap_filters.Code(words=32, passes=10))
    ids, copies = np.arange(12) * 10, np.arange(1, 13)
    at, zero = np.repeat(np.arange(12), 10), np.zeros(120, int)
    found, n, root = cap_filters.compare(ids[at], copies[at], v[at], passed[at], passed.ravel(), zero, zero, zero, 0.93, small)
    pairs = [(a, b) for a in range(12) for b in range(12) if a != b and v[a] @ v[b] >= 0.93 and set(passed[a]) & set(passed[b])]
    expect = {a * 10: sum(copies[y] for x, y in pairs if x == a) for a, _ in pairs}
    assert dict(zip(found, n)) == expect
    tree = groups(12, pairs)
    assert dict(zip(found, root)) == {k: tree[k // 10] * 10 for k in expect}


@pytest.mark.parametrize("dim", [1, 2, 9, 64])
def test_decode_lists_the_best_filters(dim):
    code = cap_filters.Code(words=16, passes=12)
    v = cap_filters.unit(np.random.default_rng(2).standard_normal((20, dim)))
    rotation, (first, second) = cap_filters._directions(code, dim)
    for x, found in zip(v, cap_filters.decode(v, code)):
        turned = x @ rotation
        every = ((turned[: dim - dim // 2] @ first.T)[:, None] + (turned[dim - dim // 2 :] @ second.T)[None, :]).ravel()
        place = found // 16 * len(second) + found % 16
        assert len(set(found)) == len(found) == 12 and np.allclose(np.sort(every[place]), np.sort(every)[-12:])


def test_recall_at_the_threshold():
    rng = np.random.default_rng(11)
    for dim in (16, 64):
        x, y = cap_filters.unit(rng.standard_normal((400, dim))), rng.standard_normal((400, dim))
        y = cap_filters.unit(y - (x * y).sum(1, keepdims=True) * x)
        passed = [cap_filters.decode(v, cap_filters.Code()) for v in (x, 0.93 * x + np.sqrt(1 - 0.93**2) * y)]
        assert np.mean([len(np.intersect1d(a, b)) > 0 for a, b in zip(*passed)]) >= 0.98


def windows(docs, size=50):
    key = lambda d: float("inf") if d is None else d
    first = {}
    for doc_id, text in docs:
        raw = (text or "").encode()
        for k in range(len(raw) - size + 1):
            w = raw[k : k + size]
            first[w] = min(first.get(w, float("inf")), key(doc_id))
    out = []
    for doc_id, text in docs:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - size + 1):
            if first[raw[k : k + size]] < key(doc_id):
                gone[k : k + size] = True
        n_spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(raw) else 0
        out.append((doc_id, len(raw), int(gone.sum()), n_spans, hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize(("hot", "held"), [(radix_dedup.HOT, radix_dedup.BLOOM_BYTES), (3, 64)])
def test_repeats(frame, hot, held):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdé", k=rng.randint(1, 7))) for _ in range(60)]
    some = lambda n: " ".join(rng.choices(words, k=n))
    shared = [some(rng.randint(5, 40)) for _ in range(6)]
    rows = []
    for k in range(150):
        parts = [some(rng.randint(0, 60)) for _ in range(rng.randint(0, 3))]
        if rng.random() < 0.6:
            parts.insert(rng.randint(0, len(parts)), rng.choice(shared))
        if rng.random() < 0.1:
            parts.append("a" * rng.randint(30, 300))
        rows.append((rng.choice([None] + [k] * 12 + [max(0, k - 3)]), rng.choice([" ".join(parts)] * 12 + [None, ""])))
    rows += [(k + 500, t) for k, (_, t) in enumerate(documents()) if t is None or len(t) < 20_000]
    rng.shuffle(rows)
    same(radix_dedup.remove_repeats(frame(rows), hot, held).collect(), windows(rows))


def test_no_repeats_in_nothing(frame):
    assert radix_dedup.remove_repeats(frame([])).collect() == []
    same(radix_dedup.remove_repeats(frame([(1, None), (2, "short")])).collect(), windows([(1, None), (2, "short")]))


def test_anchors_of_slices_are_those_of_the_whole(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(0)
    texts = [rng.integers(97, 100, n).astype(np.uint8).tobytes() for n in (0, 10, 49, 50, 51, 5000, 70, 900)]
    read = lambda: sorted({(int(r), int(p), int(h)) for rows, at, hs, _, _ in radix_dedup._anchors_of(pa.array(texts, pa.binary())) for r, p, h in zip(rows, at, hs)})
    whole = read()
    for size in (64, 500):
        monkeypatch.setattr(radix_dedup, "SLICE", size)
        assert read() == whole


def test_equal_hashes_of_different_bytes():
    rows = np.zeros(3, radix_dedup.RECORD)
    rows["least"] = [1, 2, 3]
    rows["bytes"][1, 5] = 1
    later = radix_dedup._earlier(np.zeros(3, np.uint64), rows, slice(0, 80))
    assert later.tolist() == [False, False, True]


def test_single_windows_keep_the_least_id():
    rng = np.random.default_rng(3)
    rows = np.zeros(40, radix_dedup.RECORD)
    rows["mark"], rows["left"], rows["right"] = 9, radix_dedup.SIDE, radix_dedup.SIDE
    rows["least"] = rng.permutation(40) // 2  # two places each
    rows["bytes"] = rng.integers(97, 99, 80)
    rows["bytes"][20:, 5] = 100  # windows with 25 bytes or more before the anchor differ between the halves
    rest, keys, low, high = radix_dedup.single_windows(rows)
    assert len(rest) == len(keys)
    for before in range(radix_dedup.SIDE + 1):
        halves = [rows[:20], rows[20:]] if before >= 25 else [rows]
        expected = sorted(int(x) for half in halves for x in half["least"][half["least"] == half["least"].min()])
        assert sorted(rest["least"][rest["low"] == before].tolist()) == expected
    assert ((rest["low"] == rest["high"]).all() and (high[rows["least"] > rows["least"][:20].min()] >= 0).any())
    assert (high[rows["least"] == rows["least"].min()] == -1).all()
    assert radix_dedup.single_windows(rows[:0])[0].size == 0
