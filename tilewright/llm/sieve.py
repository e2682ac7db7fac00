"""Bounded Bloom filters that tell in place which rows can be left alone.

Decisions on few rows of a wide table are made on narrow tables. Bringing them
back by a shuffle would move every row; a filter of their keys, of bounded size,
lets only the rows through that may be meant, and these are joined exactly. With
more keys than the bound is meant for, more rows pass: results never change.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.llm import common

#: Words (64 bits) of a filter at most: 16 MB; keys a word, and bits that a key sets in its one word. Some three rows
#: in a hundred pass by chance, up to 13 million keys.
MOST_WORDS, WORD_KEYS, KEY_BITS = 1 << 21, 6, 5

#: Parts of all rows that one task joins at most with one key's fact.
PARTS = 1_000


def hashed(*key: Column | str) -> tuple[Column, Column]:
    """A key of some columns, nulls among them, as two 64-bit hashes."""
    columns = [F.col(c) if isinstance(c, str) else c for c in key]
    columns += [c.isNull() for c in columns]
    return F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)


@dataclass(frozen=True)
class Sieve:
    words: np.ndarray

    def passes(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mask = np.zeros(len(low), np.uint64)
        for k in range(KEY_BITS):
            mask |= np.uint64(1) << (low >> np.uint64(6 * k) & np.uint64(63))
        return self.words[high.view(np.int64) % len(self.words)] & mask == mask


def sieve(keys: DataFrame, *key: Column | str) -> Sieve:
    """A filter of the values of `key` in `keys`, a stored table (it is read twice).

    Words are put together by an aggregate; the driver gets those that have any bit, MOST_WORDS at most.
    """
    n_words = min(MOST_WORDS, max(1, -(-keys.count() // WORD_KEYS)))
    low, high = hashed(*key)
    mask = F.lit(0).cast("long")
    for k in range(KEY_BITS):
        mask = mask.bitwiseOR(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(__low, {6 * k}) & 63 as int))"))
    rows = keys.select(low.alias("__low"), F.pmod(high, F.lit(n_words)).alias("word")).select("word", mask.alias("value"))
    table = rows.groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()
    words = np.zeros(n_words, np.uint64)
    words[table["word"].to_numpy()] = table["value"].to_numpy().view(np.uint64)
    return Sieve(words)


def _unsigned(column: pd.Series) -> np.ndarray:
    return column.to_numpy(np.int64).view(np.uint64)


def may_be(docs: DataFrame, own: Sieve, *key: Column | str) -> Column:
    """Whether a row's `key` may be one of the filter's: never false for one that is."""
    shared = docs.sparkSession.sparkContext.broadcast(own)

    @F.pandas_udf("boolean")
    def passes(low: pd.Series, high: pd.Series) -> pd.Series:
        return pd.Series(shared.value.passes(_unsigned(low), _unsigned(high)))

    return passes(*hashed(*key))


def joined(rows: DataFrame, facts: DataFrame, key: str | list[str], total: int) -> DataFrame:
    """Left join of `rows` to `facts`, whose `key` doesn't repeat and whose __n says how many rows have it.

    A key of more than one in PARTS of the `total` rows, of which there are fewer
    than PARTS, is split: its rows go to several tasks, with a copy of the fact each.
    """
    keys = [key] if isinstance(key, str) else key
    facts = facts.withColumn("__parts", F.ceil(F.col("__n") * PARTS / max(1, total)).cast("int"))
    hot = facts.where("__parts > 1").select(*[F.col(k).alias(f"__hot_{k}") for k in keys], F.col("__parts").alias("__hot_parts"))
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.coalesce("__hot_parts", F.lit(1))).cast("int")
    dealt = rows.join(F.broadcast(hot), [rows[k] == hot[f"__hot_{k}"] for k in keys], "left").withColumn("__part", part).drop(*hot.columns)
    copies = facts.withColumn("__part", F.explode(F.sequence(F.lit(0), F.greatest(F.col("__parts"), F.lit(1)) - 1))).drop("__n", "__parts")
    return dealt.join(copies, [*keys, "__part"], "left").drop("__part")


def without(docs: DataFrame, gone: DataFrame, *key: Column) -> DataFrame:
    """Rows of `docs` whose `key` is no row of `gone` (a stored table with a column for each; null equals null)."""
    names = [f"__gone{k}" for k in range(len(key))]
    own = gone.toDF(*names).distinct()
    marked = docs.withColumns({f"__key{k}": column for k, column in enumerate(key)})
    marked = marked.withColumn("__may", may_be(docs, sieve(gone, *gone.columns), *(f"__key{k}" for k in range(len(key)))))
    same = F.lit(True)
    for k, name in enumerate(names):
        same = same & marked[f"__key{k}"].eqNullSafe(own[name])
    left = marked.where("__may").join(own, same, "left_anti")
    return marked.where("not __may").unionByName(left).select(*docs.columns)
