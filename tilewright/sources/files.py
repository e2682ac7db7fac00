"""Scans of files and lists: metadata first, contents only where they are asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright import schemas
from tilewright.functions import text
from tilewright.operators import gates


def scan_files(spark: SparkSession, root: str, extensions: tuple[str, ...] = text.RAW_EXTENSIONS) -> DataFrame:
    """Raw files under a folder: path, rel, name, ext, length, modified; sorted by rel. Contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length", "modificationTime")
    rel = F.regexp_replace(F.element_at(F.split("path", F.lit(f"{root.rstrip('/').split('://')[-1].lstrip('/')}/")), -1), "^/+", "")
    rows = found.withColumn("rel", rel).withColumn("ext", text.file_extension(F.col("rel")))
    kept = rows.where(gates.has_extension(F.col("rel"), extensions))
    return kept.select("path", "rel", text.file_name(F.col("rel")).alias("name"), "ext", "length", F.col("modificationTime").alias("modified")).orderBy("rel")


def scan_listing(spark: SparkSession, path: str, extensions: tuple[str, ...] = text.RAW_EXTENSIONS) -> DataFrame:
    """The same from a listing with one path per line, such as a version control system prints."""
    rows = spark.read.text(path).select(F.col("value").alias("rel"))
    return rows.where(gates.has_extension(F.col("rel"), extensions)).withColumn("ext", text.file_extension(F.col("rel"))).orderBy("rel")


def read_list(spark: SparkSession, path: str, inline_comments: bool = False) -> DataFrame:
    """Entries of a list file, without blanks and comments."""
    return spark.read.text(path).select(text.list_entry(F.col("value"), inline_comments).alias("entry")).where("entry is not null")


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_index(spark: SparkSession, path: str, required: bool = False) -> DataFrame:
    """A published index, one name per line. A missing one is empty, or an error where deleting depends on it."""
    if exists(spark, path):
        return spark.read.text(path).select(F.col("value").alias("name"))
    if required:
        raise FileNotFoundError(f"no published index at {path}: refusing to go on")
    return spark.createDataFrame([], "name string")


def release_assets(assets: DataFrame, prefix: str = "shards-") -> DataFrame:
    return assets.where(F.startswith("name", F.lit(prefix)))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of decisions; blank lines don't count, broken ones have nulls only."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.LEDGER)
    return spark.read.schema(schemas.LEDGER).json(path)


def append_ledger(rows: DataFrame, path: str) -> None:
    """Decisions of one batch, once the batch is done."""
    rows.write.mode("append").json(path)


def read_library(spark: SparkSession, url: str, table: str) -> DataFrame:
    """A table of a photo library over JDBC; the driver's jar is the caller's."""
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).load()


def category_id(site: DataFrame, slug: str) -> int:
    """The number of a category by its slug; site: categories (array of id and slug). An unknown one is an error."""
    row = site.select(F.explode("categories").alias("c")).where(F.col("c.slug") == slug).select("c.id").first()
    if row is None:
        raise ValueError(f"no category {slug!r}")
    return row[0]


def listed_topics(pages: DataFrame) -> DataFrame:
    """The topics of saved listing pages, in order: topic_id, title.

    pages: page, topics (array of id and title), more_topics_url. Pages count up to
    the first that is empty or names no further one.
    """
    last = F.when((F.size("topics") <= 0) | F.col("more_topics_url").isNull(), F.col("page"))
    end = pages.agg(F.min(last).alias("__end"))  # one row
    used = pages.join(F.broadcast(end), F.col("__end").isNull() | (F.col("page") <= F.col("__end")))
    return used.select("page", F.posexplode("topics").alias("place", "t")).orderBy("page", "place").select(F.col("t.id").alias("topic_id"), F.col("t.title").alias("title"))


def first_posts(topics: DataFrame) -> DataFrame:
    """topic_id, cooked and author of saved topics (topic_id, posts: array of cooked and username); an unnamed author is '?'."""
    post = F.get("posts", F.lit(0))
    return topics.select("topic_id", post["cooked"].alias("cooked"), F.coalesce(post["username"], F.lit("?")).alias("author"))


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    """Forum posts saved as JSON lines."""
    return spark.read.schema(schemas.TOPIC).json(path)
