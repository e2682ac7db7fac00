"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 4 bits both have a variant at most 2 flips
away that is the same value. So every fingerprint stands for all its variants
within 2 flips; variants meet by value, pairs that meet are deduplicated and
verified, and no pair within 4 is missed.

The variants of a fingerprint are known from it, so they are not written out to be
shuffled: a fingerprint goes once to every block (leading bits of the variants)
that some variant of it falls into, and the task of the block makes its variants.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm import common, components, sieve

WORDS, DISTANCE = 4, 4

#: Leading bits that make a block: at least, and at most; and variants that a task holds at once.
LEAST_BITS, MOST_BITS, HELD = 8, 20, 1 << 22

_SPACE = b"\t\n\x0b\x0c\r "


def fingerprint(text: str, words: int = WORDS) -> int:
    """64 bits, each set if it is set in over half of the shingles' XXH64 (seed 42); 0 without words."""
    parts = text.encode().lower().split()  # of bytes: A-Z and these six white spaces only
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[: len(parts) - words] + 1]).tolist()
    view = memoryview(joined)
    digest = xxhash.xxh64_intdigest
    hashes = [digest(view[a:b], 42) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray, block: int = 1 << 15) -> int:
    """Bits set in over half of the values."""
    counts = np.zeros(64, np.int64)
    for a in range(0, len(hashes), block):
        counts += np.unpackbits(hashes[a : a + block].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and fingerprint (a long with the 64 bits) of every row of `docs`."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([fingerprint(text.as_py(), words) for text in batch["text"]], np.uint64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(bits.view(np.int64))], ["doc_id", "bits"])

    return common.doc_texts(docs).mapInArrow(hashed, "doc_id long, bits long")


def flips(bits: range, most: int) -> np.ndarray:
    """All masks of at most `most` of the given bits."""
    return np.array([sum(1 << b for b in own) for k in range(most + 1) for own in combinations(bits, k)], np.uint64)


def block_forest(prints: np.ndarray, block: int, bits: int, radius: int, held: int = HELD) -> tuple[np.ndarray, np.ndarray]:
    """Link fingerprints that share a variant in `block` (the value of the leading `bits`).

    Returns (member, least member that it hangs on) for members that hang on
    another: fewer rows than fingerprints. Variants are made in slices of the
    block by further bits, so that `held` of them are in memory at once.
    """
    prints = np.unique(prints)
    parent = np.arange(len(prints))
    more = 0
    while more < 64 - bits and (len(prints) * len(flips(range(64 - bits), min(radius, 1))) >> more) > held // 8:
        more += 1
    low = 64 - bits - more
    masks = [flips(range(low), left) for left in range(radius + 1)]
    for slice_ in range(1 << more):
        top = np.uint64(((block << more) | slice_) << low if low < 64 else 0)
        spent = np.bitwise_count((prints ^ top) >> np.uint64(low) if low < 64 else prints ^ prints).astype(np.int64)
        value, member = [], []
        for left in range(radius + 1):
            own = np.flatnonzero(spent == radius - left)
            if len(own):
                tail = prints[own] & np.uint64((1 << low) - 1 if low < 64 else 2**64 - 1)
                value.append((tail[:, None] ^ masks[left][None, :]).ravel())
                member.append(np.repeat(own, len(masks[left])))
        if not value:
            continue
        value, member = np.concatenate(value), np.concatenate(member)
        order = np.argsort(value)
        value, member = value[order], member[order]
        same = np.flatnonzero(value[1:] == value[:-1])
        if len(same):
            links = np.unique(np.stack([member[same], member[same + 1]], 1), axis=0)
            near = np.bitwise_count(prints[links[:, 0]] ^ prints[links[:, 1]]) <= 2 * radius  # verified, pair by pair
            hang(parent, links[near])
    root = roots(parent)
    hung = np.flatnonzero(root != np.arange(len(prints)))
    return prints[hung], prints[root[hung]]


def roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return up
        parent = up


def hang(parent: np.ndarray, links: np.ndarray) -> None:
    """Join the trees that links connect, in place, larger root under smaller."""
    a, b = links[:, 0], links[:, 1]
    while True:
        parent[:] = roots(parent)
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))


def links(prints: DataFrame, n: int, distance: int = DISTANCE) -> DataFrame:
    """Links (u, v) whose components are those of all pairs of `prints` (bits) within `distance` (even)."""
    radius = distance // 2
    per = len(flips(range(64), radius))
    bits = min(MOST_BITS, max(LEAST_BITS, (n * per // HELD).bit_length()))
    masks = F.array(*[F.lit(int(mask)) for mask in flips(range(bits), radius)])
    lead = F.shiftrightunsigned("bits", 64 - bits)
    dealt = prints.select("bits", F.explode(F.transform(masks, lambda mask: lead.bitwiseXOR(mask))).alias("block"))

    def forest(group: pa.Table) -> pa.Table:
        block = group["block"][0].as_py()
        u, v = block_forest(group["bits"].to_numpy().view(np.uint64), block, bits, radius)
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    return dealt.groupBy("block").applyInArrow(forest, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """Fingerprint every text of `docs` (doc_id, text) and link those at most `distance` bits apart.

    doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id that
    links reach, itself included). Texts without words, null too, have fingerprint
    zero and link like any other. Rows with null ids have no part in the minimum;
    a component of such rows alone has a null id. Repeated rows stay. An empty
    table has no rows. Other columns are ignored.

    Equal fingerprints are one from the start, whatever the number of copies; what
    follows sees distinct values only, and joins back by value at the end, a value
    or group of very many rows in parts. Texts of any length are taken whole.
    """
    rows = common.saved(fingerprints(docs, words))
    distinct = common.saved(rows.groupBy("bits").agg(F.min("doc_id").alias("least"), F.count("*").alias("__n")))
    total = distinct.count()
    found = components.components(common.saved(links(distinct.select("bits"), total, distance)))
    owner = distinct.join(common.saved(found), distinct["bits"] == F.col("id"), "left").withColumn("root", F.coalesce("component", "bits"))
    owner = common.saved(owner.select("bits", "root", "least", "__n"))
    best = common.saved(owner.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("__n")))
    named = sieve.joined(owner.select("root", "bits", F.col("__n").alias("__copies")), best, "root", total)
    named = common.saved(named.select("bits", "component_id", F.col("__copies").alias("__n")))
    return sieve.joined(rows, named, "bits", rows.count()).select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """One document of each group: the rows of `docs` whose doc_id is its component's, with all columns.

    A doc_id that repeats in the table stays as often as it stands there; rows
    without a doc_id can't be told apart and stay.
    """
    found = near_duplicates(docs, words, distance)
    drop = common.saved(found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct())
    return common.without_ids(docs, drop)
