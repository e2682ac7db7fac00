"""URL rules by Bloom filter cascades.

A cascade answers "is this key listed?" exactly for every key of a known
universe: level 0 is a Bloom filter of the listed keys, level 1 of the keys that
level 0 takes wrongly, level 2 of the listed keys that level 1 takes wrongly,
and so on until no key is taken wrongly. The universe is all the keys that the
corpus can ask for, so no join is needed to judge a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm import common

#: The rules that the query applies (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

#: Bits of one level up to which it is collected and broadcast: 64 MB.
MOST_BITS = 1 << 29


@dataclass(frozen=True)
class Level:
    bits: np.ndarray
    size: int
    hashes: int


def _positions(low: np.ndarray, high: np.ndarray, level: int, size: int, hashes: int) -> np.ndarray:
    """Bit positions (hashes x keys) of keys given as two 64-bit hashes; each level has its own."""
    out = np.empty((hashes, len(low)), np.int64)
    for k in range(hashes):
        mixed = low + np.uint64((level * 64 + k + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)) * (high | np.uint64(1))
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        out[k] = (mixed % np.uint64(size)).astype(np.int64)
    return out


def _passes(level: Level, number: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    at = _positions(low, high, number, level.size, level.hashes)
    return ((level.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)


class Cascade:
    """Exact membership over the universe that it was built with."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def __contains__(self, key: tuple[int, int]) -> bool:
        low, high = (np.array([x], np.int64).view(np.uint64) for x in key)
        return bool(self.contains(low, high)[0])

    def contains(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """A key is listed if the first level that refuses it has an odd number."""
        listed = np.full(len(low), len(self.levels) % 2 == 1)
        undecided = np.arange(len(low))
        for number, level in enumerate(self.levels):
            taken = _passes(level, number, low[undecided], high[undecided])
            listed[undecided[~taken]] = number % 2 == 1
            undecided = undecided[taken]
        return listed

    @property
    def n_bits(self) -> int:
        return sum(level.size for level in self.levels)


def _unsigned(column: pd.Series) -> np.ndarray:
    return column.to_numpy(np.int64).view(np.uint64)


def hashed(key: Column) -> tuple[Column, Column]:
    """A key as 128 bits."""
    return F.xxhash64(key), F.xxhash64(F.lit("second"), key)


def _level(keys: DataFrame, n: int, rate: float, number: int) -> Level:
    """A Bloom filter of `keys` (low, high); the executors hash, the driver gets set bits only."""
    hashes = max(1, round(math.log2(1 / rate)))
    size = max(64, math.ceil(n * hashes / math.log(2)))
    if size > MOST_BITS:
        raise ValueError(f"a level of {size} bits is over the bound of {MOST_BITS}; split the list")

    def set_bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = _positions(_unsigned(batch.low), _unsigned(batch.high), number, size, hashes)
            at = np.unique(at)
            words = at >> 6
            first = np.unique(words, return_index=True)[1]
            value = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first) if len(at) else at
            yield pd.DataFrame({"word": words[first], "value": value.astype(np.uint64).view(np.int64)})

    bits = np.zeros((size + 63) // 64, np.uint64)
    for row in keys.mapInPandas(set_bits, "word long, value long").groupBy("word").agg(F.bit_or("value")).collect():
        bits[row[0]] = np.array(row[1], np.int64).view(np.uint64)
    return Level(bits.view(np.uint8), size, hashes)


def _taken(keys: DataFrame, level: Level, number: int) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[_passes(shared.value, number, _unsigned(batch.low), _unsigned(batch.high))]

    return keys.mapInPandas(keep, "low long, high long")


def build_cascade(listed: DataFrame, universe: DataFrame, rate: float = 0.5) -> Cascade:
    """A cascade of the keys `listed` (column key), exact over `universe` (column key) and `listed`.

    Null keys are left out, repeated ones count once. An empty list gives a
    cascade without levels: nothing is listed. Only bit words reach the driver;
    their number is bounded by the list's size and `MOST_BITS`.
    """
    pairs = lambda df: df.where("key is not null").select(*(c.alias(n) for c, n in zip(hashed(F.col("key")), ("low", "high"), strict=True))).distinct()
    inside = common.saved(pairs(listed))
    n_inside = inside.count()
    if not n_inside:
        return Cascade([])
    outside = pairs(universe).join(common.bounded(inside), ["low", "high"], "left_anti")
    outside = common.saved(outside)
    n_outside = outside.count()
    first = min(0.5, n_inside / max(1, n_outside) * math.sqrt(0.5))
    levels: list[Level] = []
    encoded, other, n = inside, outside, n_inside
    while n:
        level = _level(encoded, n, rate if levels else first, len(levels))
        wrong = common.saved(_taken(other, level, len(levels)))
        levels.append(level)
        encoded, other, n = wrong, encoded, wrong.count()
    return Cascade(levels)


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """page_id, host and path of every url; null or without '://': both empty."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), rest.alias("__rest")).select(
        "page_id",
        common.ascii_lower(F.regexp_extract("__rest", r"^([^/?#]*)", 1)).alias("host"),
        F.regexp_extract("__rest", r"^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def candidate_keys(rules: tuple[tuple[str, str, str], ...]) -> Column:
    """The keys by which a rule of any of these shapes could fit a row's host and path."""
    depths = sorted({host.count(".") + 1 for host, _, _ in rules})
    lengths = sorted({len(path) for _, path, _ in rules})
    ends = [F.substring_index("host", ".", -depth) for depth in depths]
    # a host ending is a whole label's; a path's start must be as long as a rule's
    keys = [F.when(F.length("path") >= n, F.concat(end, F.substring("path", 1, n))) for end in ends for n in lengths]
    return F.array_distinct(F.array_compact(F.array(*keys)))


def filter_urls(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, default: str = "allow") -> DataFrame:
    """Judge every url: page_id, host, path, rule (null if none fits), verdict.

    A rule fits its host and all subdomains, if the path starts with the rule's
    path; the longest fitting rule wins. The keys of allowing and of blocking
    rules are in one cascade each, built over all keys of `pages`; a key in
    neither isn't listed, and a url with no listed key gets `default`.

    Null urls and urls without '://' have empty host and path, which no rule
    fits. Repeated rows stay. An empty table gives no rows. Other columns are
    ignored. Of rules for the same host and path the first counts.
    """
    spark: SparkSession = pages.sparkSession
    first: dict[str, str] = {}
    for host, path, verdict in rules:
        first.setdefault(host + path, verdict)
    rows = with_host_and_path(pages)
    if not first:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    asked = rows.withColumn("keys", candidate_keys(rules))
    universe = common.saved(asked.select(F.explode("keys").alias("key")).distinct())
    own = {
        verdict: build_cascade(
            spark.createDataFrame([(key,) for key, v in first.items() if v == verdict], "key string"), universe
        )
        for verdict in sorted(set(first.values()))
    }
    shared = spark.sparkContext.broadcast(own)

    @F.pandas_udf("array<string>")
    def verdicts(lows: pd.Series, highs: pd.Series) -> pd.Series:
        """The verdict of each listed key, null for the others."""
        counts = [len(x) for x in lows]
        low, high = (np.concatenate([*column, np.array([], np.int64)]).astype(np.int64).view(np.uint64) for column in (lows, highs))
        said = np.full(len(low), None, object)
        for verdict, cascade in shared.value.items():
            said[cascade.contains(low, high)] = verdict
        return pd.Series(np.split(said, np.cumsum(counts)[:-1])) if counts else pd.Series([], dtype=object)

    low, high = F.transform("keys", lambda key: hashed(key)[0]), F.transform("keys", lambda key: hashed(key)[1])
    longest = F.expr(
        "aggregate(zip_with(keys, __said, (k, v) -> if(v is null, null, struct(length(k) as n, k as rule, v as verdict))), "
        "cast(null as struct<n:int,rule:string,verdict:string>), "
        "(best, x) -> if(x is not null and (best is null or x.n > best.n), x, best))"
    )
    return asked.withColumn("__said", verdicts(low, high)).withColumn("__best", longest).select(
        "page_id", "host", "path", F.col("__best.rule").alias("rule"), F.coalesce("__best.verdict", F.lit(default)).alias("verdict")
    )
