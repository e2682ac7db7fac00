"""Documents through five text operators, stage by stage.

Each stage takes the documents that the one before it kept, and its decisions take
effect: rows go, or texts change. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tilewright.llm import common, near_copies, packing, quality, secrets, tiling
from tilewright.runtime import prepare


#: Pieces of texts that a worker keeps token ids of while packing: earlier stages have left less room than operator 4 alone has.
REMEMBERED = 250_000


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that score under the threshold go."""
    return quality.keep_good(docs, prepare(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6, and pairs with 5-word similarity 0.8 or more: of each group of near copies the smallest id stays."""
    prepare(spark)
    return near_copies.keep_first(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that hold a benchmark item go."""
    return tiling.without_leaks(docs, prepare(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: secrets in the texts are replaced, all documents stay."""
    prepare(spark)
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: where each piece of each document goes."""
    prepare(spark)
    return packing.pack_documents(docs, remembered=REMEMBERED)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", drop_low_quality),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack_sequences),
]

#: SQL can't express the classifier or the tokenizer: the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each result written as Parquet and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = common.new_path(spark, "stage")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
