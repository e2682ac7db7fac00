"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector passes it if their inner product exceeds the
vector's threshold, set so that each passes as many. Directions are a structured random product code: after a random
rotation the vector is cut in blocks, each block has a random code of its own, and
every combination of block codewords is a direction. Sorted block products list
all directions that a vector passes without trying every one. Vectors meet by
filter, and a pair that meets is verified in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.llm import common, components
from tilewright.llm.simhash import hang, roots

#: Members of a bucket that one task compares with each other; larger ones are dealt out by pairs of blocks.
BLOCK = 2_048

#: Rows for which a cell of buckets is meant: buckets are mostly too small to be a task's call each.
CELL = 2_048

#: Part of the pairs at the least cosine that share a filter, by trial, for a code to be taken; and pairs in a trial.
RECALL, TRIAL = 0.997, 2_000


@dataclass(frozen=True)
class Code:
    """`words` codewords in each of two blocks; a vector passes its `passes` best of their words**2 combinations."""

    words: int = 256
    passes: int = 24
    seed: int = 7

    @staticmethod
    def for_vectors(n: int, passes: int = 24, held: int = 16) -> Code:
        """A code by which `n` vectors of one label fill buckets of `held` on average: its words grow as the root of `n`."""
        return Code(words=min(46_000, max(256, math.ceil(math.sqrt(passes * n / held)))), passes=passes)


@lru_cache(maxsize=4)
def _directions(code: Code, dim: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rotation and the unit codewords of the blocks."""
    rng = np.random.default_rng((code.seed, dim))
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    blocks = []
    for size in (dim - dim // 2, dim // 2):
        words = rng.standard_normal((code.words, size))
        blocks.append(words / np.linalg.norm(words, axis=1, keepdims=True) if size else np.zeros((1, 0)))
    return rotation, blocks


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in doubles; lengths neither overflow nor vanish."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def decode(vectors: np.ndarray, code: Code) -> np.ndarray:
    """The numbers of the filters that each unit vector passes, ascending, a row per vector.

    Of two sorted lists of block products, the pair of ranks (i, j) can only be
    among the best n sums if (i + 1) * (j + 1) <= n: few pairs are looked at.
    """
    rotation, (first, second) = _directions(code, vectors.shape[1])
    turned = vectors @ rotation
    products = turned[:, : first.shape[1]] @ first.T, turned[:, first.shape[1] :] @ second.T
    best = [np.argsort(-p, axis=1, kind="stable")[:, : code.passes] for p in products]
    left, right = (np.take_along_axis(p, o, 1) for p, o in zip(products, best, strict=True))
    i, j = np.nonzero(np.outer(np.arange(1, left.shape[1] + 1), np.arange(1, right.shape[1] + 1)) <= code.passes)
    kept = np.argsort(-(left[:, i] + right[:, j]), axis=1, kind="stable")[:, : code.passes]
    numbers = best[0][:, i] * code.words + best[1][:, j]
    return np.sort(np.take_along_axis(numbers, kept, 1), axis=1).astype(np.int32)


def trial(code: Code, dim: int, least: float, n: int = TRIAL, seed: int = 1, strip: int = 50) -> float:
    """Part of `n` random pairs of `dim` dimensions at cosine `least` exactly that share a filter of `code`."""
    if dim < 2:
        return 1.0
    rng, met = np.random.default_rng((seed, dim)), 0
    for begin in range(0, n, strip):
        a, b = unit(rng.standard_normal((min(strip, n - begin), dim))), rng.standard_normal((min(strip, n - begin), dim))
        b = least * a + math.sqrt(max(0.0, 1 - least * least)) * unit(b - (a * b).sum(axis=1, keepdims=True) * a)
        met += sum(len(np.intersect1d(x, y)) > 0 for x, y in zip(decode(a, code), decode(b, code), strict=True))
    return met / n


def fitted(n: int, dim: int, least: float) -> Code:
    """The code for `n` vectors of one label with RECALL at cosine `least`.

    Where the code by size falls short, passes are raised; where that isn't enough,
    words are halved, at last to the one filter that all vectors pass.
    """
    code = Code.for_vectors(n)
    words, passes = code.words, code.passes
    while words > 1:
        for more in (1, 2, 4):
            code = Code(words=words, passes=passes * more)
            if trial(code, dim, least) >= RECALL:
                return code
        words //= 2
    return Code(words=1, passes=1)


def _small_pairs(first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places inside runs that begin at `first` and hold `sizes` places."""
    left, right = [np.array([], np.int64)], [np.array([], np.int64)]
    for size in np.unique(sizes):
        i, j = np.triu_indices(size, 1)
        own = first[sizes == size][:, None]
        left.append((own + i).ravel())
        right.append((own + j).ravel())
    return np.concatenate(left), np.concatenate(right)


def _verified_small(vectors: np.ndarray, passed: np.ndarray, number: np.ndarray, i: np.ndarray, j: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs of rows those that are near, and whether this filter is the first that both pass."""
    near = np.concatenate([np.flatnonzero(np.einsum("ij,ij->i", vectors[i[k : k + 8192]], vectors[j[k : k + 8192]]) >= least) + k for k in range(0, len(i), 8192)] or [i])
    i, j = i[near], j[near]
    new = np.empty(len(i), bool)
    for k in range(0, len(i), 8192):
        a, b = passed[i[k : k + 8192]], passed[j[k : k + 8192]]
        common = (a[:, :, None] == b[:, None, :]).any(axis=2)
        new[k : k + 8192] = np.where(common, a, np.iinfo(np.int32).max).min(axis=1) == number[i[k : k + 8192]]
    return i, j, new


def _verified_large(vectors: np.ndarray, passed: np.ndarray, part: np.ndarray, parts: tuple[int, int], number: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for all pairs of a bucket, or of two of its blocks, by matrix products in strips."""
    rows, columns = [], []
    for begin in range(0, len(vectors), 512):
        i, j = np.nonzero(vectors[begin : begin + 512] @ vectors.T >= least)
        i += begin
        ok = (i < j) if parts[0] == parts[1] else (part[i] == parts[0]) & (part[j] == parts[1])
        rows.append(i[ok])
        columns.append(j[ok])
    i, j = np.concatenate(rows), np.concatenate(columns)
    earlier = np.where(passed < number, passed, -1)
    names, at = np.unique(earlier, return_inverse=True)
    seen = np.zeros((len(vectors), len(names)), np.float32)
    np.put_along_axis(seen, at.reshape(earlier.shape), 1, axis=1)
    seen[:, names == -1] = 0
    new = np.empty(len(i), bool)
    for k in range(0, len(i), 1 << 14):
        new[k : k + (1 << 14)] = np.einsum("ij,ij->i", seen[i[k : k + (1 << 14)]], seen[j[k : k + (1 << 14)]]) == 0
    return i, j, new


def compare(ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray, passed: np.ndarray, number: np.ndarray, part: np.ndarray, low: np.ndarray, high: np.ndarray, least: float, small: int = 16) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Verify all pairs that share a bucket (number, low, high) and sum them up per vector.

    Returns (ids of linked vectors, vectors linked directly, counting a pair only
    in the first filter that both pass, the least id that links reach here).
    """
    order = np.lexsort((high, low, number))
    key = np.stack([number, low, high])[:, order]
    first = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))
    sizes = np.diff(np.append(first, len(order)))
    few = (sizes > 1) & (sizes <= small) & (key[1, first] == key[2, first])
    i, j = _small_pairs(first[few], sizes[few])
    found = [_verified_small(vectors, passed, number, order[i], order[j], least)]
    for begin, size in zip(first[(sizes > 1) & ~few], sizes[(sizes > 1) & ~few], strict=True):
        own = order[begin : begin + size]
        i, j, new = _verified_large(vectors[own], passed[own], part[own], (low[own[0]], high[own[0]]), number[own[0]], least)
        found.append((own[i], own[j], new))
    i, j, new = (np.concatenate([f[k] for f in found]) for k in range(3))
    names, at = np.unique(ids, return_inverse=True)
    n, parent = np.zeros(len(names), np.int64), np.arange(len(names))
    i, j, of_i, of_j = at[i], at[j], copies[i], copies[j]
    np.add.at(n, i[new], of_j[new])
    np.add.at(n, j[new], of_i[new])
    hang(parent, np.stack([i, j], 1))
    linked = np.unique(np.concatenate([i, j]))
    return names[linked], n[linked], names[roots(parent)[linked]]


def usable(vector: str = "embedding") -> Column:
    """Vectors that can link: not null, not empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(embeddings: DataFrame, least: float = 0.93, code: Code | None = None, block: int = BLOCK) -> DataFrame:
    """Link vectors of the same label whose cosine is `least` or more.

    embeddings: vec_id, embedding (array of float or double), label. Returns
    vec_id, n_links (other rows linked directly), component_id (the smallest
    vec_id that links reach, itself included) and kept (vec_id = component_id).

    Rows with a null label, vec_id or vector, a zero vector, or null or non-finite
    components link with nothing and are kept. Vectors of different lengths don't
    link. Equal vectors are one from the start and count as often as they stand
    there. No link is below `least`; a pair that passes no common filter is
    missed: some 1 % at most at `least` exactly, whatever the size and dimension,
    by the trial of random pairs that chooses the code. An empty table has no rows.
    Other columns are ignored.

    A bucket is a task's only up to `block` members; larger ones are dealt out by
    pairs of blocks. Only sums per member and a tree per bucket leave a task.
    """
    single = embeddings.schema["embedding"].dataType.simpleString() == "array<float>"
    vector = F.col("embedding") if single else F.col("embedding").cast("array<double>")
    wide = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), vector.alias("vector"))
    able = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & usable("vector")
    keys = [F.xxhash64("label", "vector").alias("key1"), F.xxhash64(F.lit(1), "vector", "label").alias("key2")]
    rows = common.saved(wide.select("vec_id", *keys, able.alias("able")))
    distinct = wide.where(able).groupBy("label", *keys).agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("vector").alias("vector"))
    distinct = common.saved(distinct.withColumn("id", F.monotonically_increasing_id()))
    most = distinct.groupBy("label", F.size("vector").alias("dim")).count().groupBy("dim").agg(F.max("count").alias("n")).collect()
    codes = {row.dim: code or fitted(row.n, row.dim, least) for row in most}
    cells = max((row.n * codes[row.dim].passes for row in most), default=0) // CELL + 1

    def pass_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["vector"]
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy()
            starts = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes):
                own = np.flatnonzero(sizes == dim)
                vectors = flat[starts[own][:, None] + np.arange(dim)]
                passed = decode(unit(vectors), codes[int(dim)])
                at = np.repeat(np.arange(len(own)), passed.shape[1])
                take = pa.array(own[at])
                raw, filters = [x.tobytes() for x in vectors], [x.tobytes() for x in passed]
                yield pa.RecordBatch.from_arrays(
                    [batch["label"].take(take), pa.array(np.full(len(at), dim), pa.int32()), pa.array(np.concatenate(passed), pa.int32()), batch["id"].take(take), batch["copies"].take(take),
                     pa.array([raw[k] for k in at], pa.binary()), pa.array([filters[k] for k in at], pa.binary())],
                    ["label", "dim", "filter", "id", "copies", "vector", "passed"],
                )

    label_type = wide.schema["label"].dataType.simpleString()
    bucket = ["label", "dim", "filter"]
    dealt = distinct.mapInArrow(pass_filters, f"label {label_type}, dim int, filter int, id long, copies long, vector binary, passed binary")
    large = common.saved(
        distinct.mapInArrow(pass_filters, f"label {label_type}, dim int, filter int, id long, copies long, vector binary, passed binary")
        .groupBy(*bucket).agg(F.count("*").alias("n")).where(F.col("n") > block)
        .select(*(F.col(c).alias(f"__{c}") for c in bucket), F.ceil(F.col("n") / block).cast("int").alias("__parts"))
    )
    large = common.bounded(large, 100_000)
    same = [dealt[c] == large[f"__{c}"] for c in bucket]
    part = F.pmod(F.xxhash64("id"), F.coalesce("__parts", F.lit(1))).cast("int")
    dealt = (
        dealt.join(large, same, "left").withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1)))
        .withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other")).drop(*large.columns)
    )

    dealt = dealt.withColumn("cell", F.pmod(F.xxhash64("filter", "low", "high"), F.lit(cells)))

    def link(group: pa.Table) -> pa.Table:
        vectors = unit(np.frombuffer(b"".join(group["vector"].to_pylist()), np.float32 if single else np.float64).reshape(group.num_rows, -1))
        passed = np.frombuffer(b"".join(group["passed"].to_pylist()), np.int32).reshape(group.num_rows, -1)
        ids, copies, number, part, low, high = (group[c].to_numpy() for c in ("id", "copies", "filter", "part", "low", "high"))
        found, n, root = compare(ids, copies, vectors, passed, number, part, low, high, least)
        return pa.table({"id": found, "n": n, "root": root})

    linked = common.saved(dealt.groupBy("label", "dim", "cell").applyInArrow(link, "id long, n long, root long"))
    sums = linked.groupBy("id").agg(F.sum("n").alias("n"))
    found = components.components(linked.select(F.col("id").alias("u"), F.col("root").alias("v")).distinct())
    owner = distinct.select("id", "key1", "key2", "copies", "least").join(sums, "id", "left").join(found, "id", "left")
    owner = common.saved(owner.select(F.col("key1").alias("__1"), F.col("key2").alias("__2"), (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "least", F.coalesce("component", "id").alias("root")))
    best = owner.groupBy("root").agg(F.min("least").alias("component_id"))
    named = owner.join(best, "root").select("__1", "__2", "n_links", "component_id")
    joined = rows.join(named, rows["able"] & (rows["key1"] == named["__1"]) & (rows["key2"] == named["__2"]), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
