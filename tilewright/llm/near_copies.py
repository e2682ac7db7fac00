"""Near copies for filtering stages: texts whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more.

SimHash with few bits is too narrow for that: such pairs are up to 14 bits apart,
and no ball of that radius can be listed. So texts meet by bands of a MinHash
signature (a pair at 0.8 misses all bands once in four million), what meets is
gathered, and each gathered group is compared exactly by its shingles. A large group
is cut into parts: each is compared within itself and with a few hubs of the group,
which links nearly all of a group of near copies; only members that this leaves
apart from others they share a band with go to the other parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm import common, components, sieve, simhash

WORDS, SIMILARITY = 5, 0.8

#: Bands of a signature and values in a band.
BANDS, ROWS = 50, 6

#: Members of a group that one task compares with each other, all at once; larger groups are cut into parts of that
#: size, and up to HUBS members that share bands with most others are compared with every part.
BLOCK, HUBS = 1_024, 16

_BASE = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(11)
_FACTORS = _rng.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32)[:, None] * np.uint32(2) + np.uint32(1)
_MASKS = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)[:, None]


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The set of 64-bit hashes of all runs of `words` case-folded words, ascending; a shorter text is one run."""
    parts = text.casefold().split()
    if not parts:
        return np.array([], np.uint64)
    if len(parts) < words:
        return np.array([xxhash.xxh64_intdigest(" ".join(parts))], np.uint64)
    single = np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))
    n = len(parts) - words + 1
    out = np.zeros(n, np.uint64)
    for k in range(words):
        out = (out ^ single[k : k + n]) * _BASE
        out ^= out >> np.uint64(29)
    return np.unique(out)


def bands(own: np.ndarray, block: int = 2_048) -> list[int]:
    """A value for each band of the MinHash signature of the set `own`; none for the empty set."""
    if not len(own):
        return []
    short = (own >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 2**32 - 1, np.uint32)
    for a in range(0, len(short), block):
        np.minimum(least, ((short[a : a + block] ^ _MASKS) * _FACTORS).min(axis=1), out=least)
    values = least.reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(values[k].tobytes(), k) - 2**63 for k in range(BANDS)]


def similar(sets: list[np.ndarray], groups: np.ndarray, apart: np.ndarray, least: float = SIMILARITY) -> list[tuple[int, int]]:
    """Links whose components, joined with `groups`, are those of all pairs with a Jaccard similarity of `least` or more.

    groups: a number for each set; those with the same number are known to be linked.
    Only pairs with a set that `apart` marks are looked at. Of two such sets, the
    rarest shingles, all but `least` of each, have one in common.
    """
    sizes = np.array([len(own) for own in sets])
    names, code, n = np.unique(np.concatenate([*sets, np.array([], np.uint64)]), return_inverse=True, return_counts=True)
    rank = np.empty(len(names), np.int64)
    rank[np.argsort(n, kind="stable")] = np.arange(len(names))
    ranked = [np.sort(own) for own in np.split(rank[code], np.cumsum(sizes)[:-1])]
    seen: dict[int, list[int]] = {}
    root, marked, out = groups.copy(), np.zeros(len(names), bool), []
    for i, own in enumerate(ranked):
        met: set[int] = set()
        for name in own[: len(own) - ceil(least * len(own) - 1e-9) + 1].tolist():
            before = seen.setdefault(name, [])
            met.update(before)
            before.append(i)
        near = np.array(sorted(met), np.int64)
        near = near[apart[near] | apart[i]]
        near = near[np.minimum(sizes[near], len(own)) >= least * np.maximum(sizes[near], len(own)) - 1e-9]
        near = near[root[near] != root[i]]
        marked[own] = True
        while len(near):
            j, near = near[0], near[1:]
            both = int(marked[ranked[j]].sum())
            if both / (len(own) + int(sizes[j]) - both) >= least:
                root[root == root[j]] = root[i]
                out.append((i, int(j)))
                near = near[root[near] != root[i]]
        marked[own] = False
    return out


def _keys(docs: DataFrame) -> DataFrame:
    """Two 64-bit hashes of the text, null as empty, beside all columns."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({"__t1": F.xxhash64(text), "__t2": F.xxhash64(F.lit(1), text)})


def _compared(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """Links (u, v) that `similar` finds among the rows of `placed` with the same (component, part).

    placed: id, component, part, root, apart, and the hashes __m1 and __m2 of a text of `docs`; stored.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.array([shingles(text.as_py()).tobytes() for text in batch["text"]], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["t1"], batch["t2"], own], ["t1", "t2", "own"])

    def link(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy()
        own = [np.frombuffer(own.as_py(), np.uint64) for own in table["own"]]
        groups = np.unique(table["root"].to_numpy(), return_inverse=True)[1]
        found = similar(own, groups, table["apart"].to_numpy(zero_copy_only=False))
        at = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"u": ids[at[:, 0]], "v": ids[at[:, 1]]})

    # a row a text, so that copies of a text become one set before sets are dealt out
    one = placed.groupBy("__m1", "__m2").agg(F.collect_list(F.struct("id", "component", "part", "root", "apart")).alias("places"))
    texts = _keys(docs.select(F.coalesce("text", F.lit("")).alias("text")))
    texts = texts.where(sieve.may_be(docs, sieve.sieve(placed, "__m1", "__m2"), "__t1", "__t2"))
    texts = texts.select(F.col("__t1").alias("t1"), F.col("__t2").alias("t2"), "text").mapInArrow(sets, "t1 long, t2 long, own binary")
    texts = texts.groupBy("t1", "t2").agg(F.first("own").alias("own"))
    dealt = texts.join(one, (texts["t1"] == one["__m1"]) & (texts["t2"] == one["__m2"])).select(F.explode("places").alias("p"), "own").select("p.*", "own")
    return dealt.groupBy("component", "part").applyInArrow(link, "u long, v long")


def _similar_links(docs: DataFrame, distinct: DataFrame, block: int) -> DataFrame:
    """Links (u, v) of `distinct` (id, t1, t2, bands), whose texts stand in `docs`, by their shingles."""
    met = distinct.select("id", F.explode("bands").alias("band"))
    shared = common.saved_small(met.groupBy("band").agg(F.min("id").alias("v"), F.count("*").alias("n")).where("n > 1").select(F.col("band").alias("__band"), "v", "n"))
    stars = met.join(shared, met["band"] == shared["__band"]).select(F.col("id").alias("u"), "v").distinct()
    group = common.saved_small(components.components(stars))
    parts = group.groupBy("component").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    member = distinct.select("id", F.col("t1").alias("__m1"), F.col("t2").alias("__m2")).join(group, "id").join(parts, "component")
    member = common.saved_small(member.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")))

    # hubs: of each group's first members by band, those of the fullest bands
    hubs = shared.join(member.where("parts > 1"), F.col("v") == F.col("id")).groupBy("component", F.pmod(F.xxhash64("v"), F.lit(HUBS))).agg(F.max_by("v", "n").alias("__hub"))
    placed = member.join(hubs.select("__hub"), F.col("id") == F.col("__hub"), "left")
    everywhere = F.sequence(F.lit(0), F.col("parts") - 1)
    columns = ["id", "component", "part", "root", "apart", "__m1", "__m2"]
    placed = placed.withColumn("part", F.explode(F.when(F.col("__hub").isNull(), F.array("part")).otherwise(everywhere)))
    placed = common.saved_small(placed.withColumns({"root": F.col("id"), "apart": F.lit(True)}).select(columns))
    near = common.saved_small(_compared(docs, placed))

    # members of large groups that share a band with one they aren't linked to yet
    large = member.where("parts > 1")
    known = components.components(near).select(F.col("id").alias("__id"), F.col("component").alias("__root"))
    large = common.saved_small(large.join(known, F.col("id") == F.col("__id"), "left").withColumn("root", F.coalesce("__root", "id")).drop("__id", "__root"))
    met = met.join(large.select(F.col("id").alias("__id"), "root"), F.col("id") == F.col("__id"))
    mixed = met.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select(F.col("band").alias("__band"))
    open_ids = met.join(mixed, met["band"] == mixed["__band"]).select("__id").distinct()
    open_rows = common.saved_small(large.join(open_ids, F.col("id") == F.col("__id"), "left_semi"))
    if open_rows.isEmpty():
        return near
    most = open_rows.groupBy("component", "root").count().groupBy("component").agg(F.max_by("root", F.struct("count", "root")).alias("__most"))
    most = most.withColumnRenamed("component", "__component")
    placed = open_rows.join(most, F.col("component") == F.col("__component")).withColumn("apart", F.col("root") != F.col("__most"))
    placed = placed.withColumn("part", F.explode(F.when(F.col("apart"), everywhere).otherwise(F.array("part")))).select(columns)
    return near.unionByName(_compared(docs, common.saved_small(placed)))


def keep_first(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """`docs` without the near copies of documents with smaller ids; all columns stay.

    Near copies are texts with a Jaccard similarity of SIMILARITY or more over their
    sets of WORDS-word shingles, and also what operator 6 links; a group is what
    such links reach. Of a group the rows with its smallest doc_id stay, and those
    without a doc_id. Null and empty texts are one text; a doc_id that repeats is
    judged row by row, by its text; repeated rows go or stay together; texts of any
    length are taken whole. An empty table has no rows.
    """

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            bits = np.array([simhash.fingerprint(text) for text in texts], np.uint64).view(np.int64)
            own = pa.array([bands(shingles(text)) for text in texts], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["__t1"], batch["__t2"], pa.array(bits), own], ["doc_id", "t1", "t2", "bits", "bands"])

    rows = _keys(common.doc_texts(docs)).mapInArrow(signed, "doc_id long, t1 long, t2 long, bits long, bands array<long>")
    rows = common.saved_small(rows)
    distinct = rows.groupBy("t1", "t2").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"), F.first("bits").alias("bits"), F.first("bands").alias("bands"))
    distinct = common.saved_small(distinct.withColumn("id", F.monotonically_increasing_id()))
    first = common.saved_small(distinct.groupBy("bits").agg(F.min("id").alias("first")))
    balls = common.saved_small(simhash.links(first.select("bits"), first.count()))
    ends = [first.select(F.col("bits").alias(f"__{x}"), F.col("first").alias(x)) for x in ("x", "y")]
    balls = balls.join(ends[0], F.col("u") == F.col("__x")).join(ends[1], F.col("v") == F.col("__y")).select(F.col("x").alias("u"), F.col("y").alias("v"))
    equal = distinct.join(first, "bits").where(F.col("id") != F.col("first")).select(F.col("id").alias("u"), F.col("first").alias("v"))
    links = common.saved_small(_similar_links(docs, distinct, block).unionByName(balls).unionByName(equal))
    found = common.saved_small(components.components(links))
    owner = common.saved_small(distinct.select("id", "t1", "t2", "least", "n").join(found, "id", "left").select("t1", "t2", "least", "n", F.coalesce("component", "id").alias("root")))
    best = common.saved_small(owner.groupBy("root").agg(F.min("least").alias("stays"), F.count("*").alias("__n")))
    named = sieve.joined(owner.select("root", "t1", "t2", F.col("n").alias("__copies")), best, "root", owner.count())
    named = common.saved_small(named.select("t1", "t2", "stays", F.col("__copies").alias("__n")))
    gone = sieve.joined(rows.select("doc_id", "t1", "t2"), named, ["t1", "t2"], rows.count()).where(F.col("doc_id") != F.col("stays"))
    gone = common.saved_small(gone.select(F.col("doc_id").alias("__id"), F.col("t1").alias("__g1"), F.col("t2").alias("__g2")).distinct())
    keyed = _keys(docs)
    return sieve.without(keyed, gone, F.col("doc_id").cast("long"), F.col("__t1"), F.col("__t2")).drop("__t1", "__t2")
