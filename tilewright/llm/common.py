"""What the text operators share: reading columns, shared storage, safe joins."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings for tables of long texts, unless the session has its own: bytes that a Python worker gets at once, and
#: rows that a Parquet reader decodes at once. With Spark's own (64 MB, 4,096 rows) an executor's JVM takes half as much again.
SMALL = {"spark.sql.execution.arrow.maxBytesPerBatch": "1m", "spark.sql.parquet.columnarReaderBatchSize": "512"}

#: Rows of a narrow table up to which `bounded` broadcasts it: 16 bytes a row, 64 MB.
BROADCAST_ROWS = 4_000_000

#: Rows in a file of `saved_small`, and files for each core that any table may have.
FILE_ROWS, CORE_FILES = 20_000, 2


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor sees; ``spark.checkpoint.dir`` names it.

    Only where that is unset and the session is a local one (tests, a laptop) a default is put in its place.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is unset: a cluster needs a folder that all executors see")
        context.setCheckpointDir(folder or "/tmp/checkpoints")
    return context._jsc.sc().getCheckpointDir().get()


def saved(df: DataFrame) -> DataFrame:
    """Checkpoint `df` to the shared folder and cut its lineage: for narrow tables."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def saved_small(df: DataFrame) -> DataFrame:
    """As `saved`, in as few files as the rows need: for tables of far fewer rows than the session's partitions are meant for.

    On a disk without Hadoop's native library each file costs an executor three processes
    more (chmod), and while one starts, the executor's memory counts twice. So rows are
    stored with the executors until they are counted; sessions with few partitions need none of that.
    """
    spark = df.sparkSession
    least = CORE_FILES * spark.sparkContext.defaultParallelism
    if int(spark.conf.get("spark.sql.shuffle.partitions")) <= least:
        return saved(df)
    held = df.persist(StorageLevel.DISK_ONLY)
    try:
        return saved(held.coalesce(max(least, held.count() // FILE_ROWS + 1)))
    finally:
        held.unpersist()


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh place for a table in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def doc_texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id as long and text, null text as empty; all other columns are left out."""
    small_batches(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        *more,
    )


def small_batches(spark: SparkSession) -> None:
    """Bound what is decoded or sent to a Python worker at once, where the session sets no bound."""
    for name, value in SMALL.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


def ascii_lower(column: Column) -> Column:
    """A-Z to lower case, all else as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bounded(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if a count shows at most `most` rows, else as it is.

    Call it on a checkpointed table: the count is an action.
    """
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def without_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of `docs` whose `key` isn't in `ids`, a stored table (null equals null); columns stay."""
    from tilewright.llm import sieve

    return sieve.without(docs, ids.select(F.col(ids.columns[0]).cast(docs.schema[key].dataType)), F.col(key))
