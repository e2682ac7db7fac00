"""Quality classifier: logistic regression on hashed word n-grams.

Trained with follow-the-regularised-leader updates (FTRL-proximal) on a bounded
sample of labelled rows, one example at a time, in one task; scored everywhere as
sparse dot products of counts with the weights.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.llm import common, memory

#: Words are runs of letters and digits, or of other marks.
_WORD = re.compile(r"\w+|[^\w\s]+")

_PAIR = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """sample: labelled rows used at most, taken by the hash of their id (the bound of the training set)."""

    sample: int = 8_000
    epochs: int = 4
    bits: int = 18
    alpha: float = 0.1
    beta: float = 1.0
    l1: float = 0.0
    l2: float = 0.1
    scale: float = 24.0


@dataclass(frozen=True)
class Model:
    """weights has the bias last."""

    weights: np.ndarray
    settings: Settings


#: A word that stands again up to so many words later also counts as the n-gram "same word, k apart", whatever the word.
REPEATS = 3


def ngram_ids(text: str, bits: int) -> np.ndarray:
    """Hashed ids of all words, pairs of adjacent words, and repeats of a word."""
    one = np.array(memory.word_hashes(_WORD.findall(text)), np.uint64)
    two = (one[:-1] * _PAIR + one[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
    again = [np.full(int((one[k:] == one[:-k]).sum()), k * int(_PAIR) & (2**64 - 1), np.uint64) for k in range(1, REPEATS + 1)]
    return (np.concatenate([one, two, *again]) >> np.uint64(64 - bits)).astype(np.int64)


def _logit(model: Model, text: str) -> float:
    ids = ngram_ids(text, model.settings.bits)
    dot = model.weights[ids].sum() / len(ids) * model.settings.scale if len(ids) else 0.0
    return float(dot + model.weights[-1])


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Rows that nothing is learnt from; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Ftrl:
    """FTRL-proximal, per-coordinate, for one example of sparse counts at a time."""

    def __init__(self, settings: Settings):
        self.s = settings
        self.z = np.zeros((1 << settings.bits) + 1)
        self.n = np.zeros_like(self.z)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n, s = self.z[at], self.n[at], self.s
        return np.where(np.abs(z) <= s.l1, 0.0, -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
        self.z[at] += g - (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.s.alpha * w
        self.n[at] += g * g


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn `labels` (doc_id, quality 0 or 1) of rows that aren't held out from the texts of `docs`.

    Null ids, null or other labels are left out; a repeated label counts each time.
    Of several texts under one id the least is learnt from, once, so that the sample
    bounds the examples. Without any label all weights are zero: every
    score is 0.5. Texts become counts on the executors; the examples, in an order
    given by their ids' hashes and repeated per epoch, stream through one task; the
    driver gets the weights only.
    """
    spark = docs.sparkSession
    sample = (
        labels.select(F.col("doc_id").cast("long").alias("__id"), F.col("quality").cast("int").alias("y"))
        .where(F.col("__id").isNotNull() & F.col("y").isin(0, 1)).where(~held_out("__id"))
        .withColumn("order", F.xxhash64("__id", "y")).orderBy("order", "__id").limit(settings.sample)
    )
    sample = common.saved(sample)
    bias = 1 << settings.bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = [], []
            for text in batch["text"]:
                ids = ngram_ids(text.as_py(), settings.bits)
                own, n = np.unique(ids, return_counts=True)
                at.append(np.append(own, bias).astype("<u4").tobytes())
                x.append(np.append(n * (settings.scale / max(1, len(ids))), 1.0).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch["order"], batch["y"], pa.array(at, pa.binary()), pa.array(x, pa.binary())], ["order", "y", "at", "x"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ftrl = Ftrl(settings)
        for batch in batches:
            for y, at, x in zip(batch["y"].to_pylist(), batch["at"].to_pylist(), batch["x"].to_pylist(), strict=True):
                ftrl.learn(np.frombuffer(at, "<u4").astype(np.int64), np.frombuffer(x, "<f4").astype(np.float64), y)
        yield pa.RecordBatch.from_arrays([pa.array([ftrl.weights(slice(None)).astype("<f4").tobytes()], pa.binary())], ["weights"])

    texts = common.doc_texts(docs)
    examples = texts.join(F.broadcast(sample), texts["doc_id"] == sample["__id"]).groupBy("__id", "order", "y").agg(F.min("text").alias("text"))
    times = sample.groupBy("__id", "y").agg(F.count("*").cast("int").alias("times"))
    examples = examples.join(F.broadcast(times), ["__id", "y"]).select("text", "order", "y", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time"))
    epochs = F.explode(F.array(*map(F.lit, range(settings.epochs)))).alias("epoch")
    row = (
        examples.mapInArrow(count, "order long, y int, at binary, x binary").select(epochs, "*")
        .repartition(1).sortWithinPartitions("epoch", "order", "y", "at").mapInArrow(learn, "weights binary").first()
    )
    weights = np.frombuffer(row[0], "<f4") if row else np.zeros(bias + 1, np.float32)
    return Model(weights, settings)


def scorer(docs: DataFrame, model: Model):
    """A column function: the score (0 to 1) of a text; null counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        logits = np.array([_logit(shared.value, text or "") for text in texts], np.float64)
        return pd.Series(1 / (1 + np.exp(-np.clip(logits, -35, 35))))

    return score


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, settings: Settings = Settings()) -> DataFrame:
    """Score every text of `docs` (doc_id, text): doc_id, held_out, score, predicted.

    predicted is 1 where score >= threshold. Null and empty texts, and texts without
    words, score by the bias alone; texts of any length are scored whole. Rows stay as many as there are, repeated ones and null ids too.
    An empty table has no rows. Labels, language, source and ids are no inputs.
    """
    model = train(docs, labels, settings)
    texts = common.doc_texts(docs)
    scored = texts.select("doc_id", held_out().alias("held_out"), scorer(docs, model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, settings: Settings = Settings()) -> DataFrame:
    """The rows of `docs` that score `threshold` or more, with all their columns.

    Each row is judged by its text alone: null and repeated ids don't matter, and
    repeated rows go or stay together. Null and empty texts score by the bias alone,
    texts of any length are scored whole. An empty table has no rows.
    """
    common.small_batches(docs.sparkSession)
    return docs.where(scorer(docs, train(docs, labels, settings))("text") >= threshold)
