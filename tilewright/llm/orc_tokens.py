"""Token ids in ORC files.

Documents are range-partitioned and sorted by id, encoded, and written one file
a partition. Ids are integers in ORC's run-length encoding; row indexes and Bloom
filters on doc_id let a reader skip stripes and row groups, and any stripe can be
read by any task, since each row carries its place in its file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm import common, tokens

FILE_SCHEMA = "file int, doc_id long, first long, n_tokens int, ids array<int>"

#: Rows to an index entry and bytes to a stripe: a lookup reads little, a scan in long runs.
INDEX_ROWS, STRIPE_BYTES = 1_000, 32 << 20


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0, files: int | None = None) -> None:
    """Write the ids of every text of `docs` (doc_id, text), in ascending doc_id order, to `path`.

    Each file is one range of doc_id (nulls first; rows with the same id by their
    text's CRC), each row has file, doc_id, first (ids in the file before it),
    n_tokens and ids with `end_id` last. A null or empty text has `end_id` alone.
    `files` is the number of ranges, by default spark.sql.shuffle.partitions.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or tokens.default_path()
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file, first = tokens.encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                ids, edges = encoder.many(part["text"], end_id)
                n, before = np.diff(edges), first + edges[:-1]
                first += len(ids)
                offsets = pa.array(edges, pa.int32())
                values = pa.Array.from_buffers(pa.int32(), len(ids), [None, pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), file), pa.int32()), part["doc_id"], pa.array(before), pa.array(n, pa.int32()), pa.ListArray.from_arrays(offsets, values)],
                    ["file", "doc_id", "first", "n_tokens", "ids"],
                )

    texts = common.doc_texts(docs)
    crc = F.crc32(F.col("text").cast("binary"))
    (
        texts.repartitionByRange(files, "doc_id", crc)
        .sortWithinPartitions("doc_id", crc)
        .mapInArrow(encode, FILE_SCHEMA)
        .write.option("compression", "zstd")
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", str(INDEX_ROWS))
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids, from the files at `path`.

    Filters on doc_id reach the row indexes and Bloom filters. The offsets of the
    files, one row each, are read from the narrow columns and broadcast.
    """
    rows = spark.read.schema(FILE_SCHEMA).orc(path)
    sizes = sorted(rows.groupBy("file").agg(F.max(F.col("first") + F.col("n_tokens"))).collect())
    before = accumulate((n for _, n in sizes), initial=0)
    offsets = spark.createDataFrame([(f, b) for (f, _), b in zip(sizes, before, strict=False)], "__file int, __before long")
    return rows.join(F.broadcast(offsets), rows["file"] == offsets["__file"]).select(
        "doc_id", (F.col("__before") + F.col("first")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids"
    )


def with_crc32(rows: DataFrame) -> DataFrame:
    """The ids replaced by the unsigned CRC-32 of them as little-endian unsigned 32-bit integers."""

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["ids"]
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            edges = lists.offsets.to_numpy()
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["start"], batch["n_tokens"], pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return rows.mapInArrow(crc, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, path: str | None = None, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """Write the files, read them back, and return one row per document from them.

    doc_id, start, n_tokens (with the end id), ids_crc32. Repeated rows and rows
    with the same doc_id each have their own place; a null doc_id comes first. An
    empty table has no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    path = path or common.new_path(spark, "token-ids")
    write_token_files(docs, path, tokenizer, end_id)
    return with_crc32(read_token_files(spark, path))
