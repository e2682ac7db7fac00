"""Bundles of shards: manifests, registry lines, publishing in batches, reuse of what is built."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions import text
from tilewright.operators import gates, packing
from tilewright.sources import files as file_source

#: The most shards of a contributor, and the manifest's format.
MOST_SHARDS, FORMAT = 1000, 1


def manifest(shards: DataFrame, handle: str, created: str, license: str, grant: str) -> DataFrame:
    """The manifest row of a bundle of valid shards (name, sha256, camera, n_tiles).

    Names get the contributor's prefix once; two shards of one name are an error.
    """
    if not shards.sparkSession.range(1).select(text.valid_handle(F.lit(handle))).first()[0]:
        raise ValueError(f"{handle!r} is no contributor's name")
    gates.require_count(shards, 1, MOST_SHARDS, "shards in a bundle")
    named = shards.withColumn("name", text.prefixed(F.lit(handle), F.col("name")))
    if named.groupBy("name").count().where("count > 1").limit(1).count():
        raise ValueError("two shards would have the same name")
    cameras = named.groupBy("camera").agg(F.sum("n_tiles").cast("long").alias("n"))
    cameras = cameras.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("camera", "n")))).alias("cameras"), F.sum("n").cast("int").alias("n_tiles"))
    listed = named.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "sha256")))).alias("files"), F.count("*").cast("int").alias("n_shards"))
    head = [F.lit(FORMAT).alias("format"), F.lit(handle).alias("handle"), F.lit(created).alias("created"), F.lit(license).alias("license"), F.lit(grant).alias("grant")]
    return listed.join(cameras).select(*head, "n_shards", "n_tiles", "cameras", "files")  # one row each


def registry_line(bundle: DataFrame, n_new: int, collected: str, source: str, sha256: str) -> DataFrame:
    """What the registry keeps of a collected bundle: tiles and cameras of all of it, shards of the new ones."""
    return bundle.select(
        F.lit(collected).alias("collected"), "handle", "created", F.lit(source).alias("source"), F.lit(sha256).alias("bundle_sha256"),
        F.lit(n_new).alias("n_shards_new"), "n_tiles", "cameras", "license",
    )


def append_registry(line: DataFrame, path: str) -> None:
    line.write.mode("append").json(path)


def publish(shards: DataFrame, upload: Callable[[int, DataFrame], None], index: str, cap: int = packing.MAX_BYTES) -> int:
    """Send shards (name, size, maybe private) in batches; a batch enters the index after its upload, so an interruption loses nothing.

    Returns the number of batches; each batch is one job, as its upload is.
    """
    if "private" in shards.columns:
        gates.require_public(shards)
    spark = shards.sparkSession
    new = shards.join(file_source.read_index(spark, index), "name", "left_anti")
    # batches follow the names, so each is a range of them, whatever the index holds by then
    ranges = packing.publish_batches(new, cap).groupBy("bin").agg(F.min("name"), F.max("name")).orderBy("bin").collect()
    for k, first, last in ranges:
        rows = new.where(F.col("name").between(first, last))
        upload(k, rows)
        rows.select(F.col("name").alias("value")).write.mode("append").text(index)
    return len(ranges)


def reused(spark: SparkSession, path: str, fingerprint: str, version: int, build: Callable[[], DataFrame]) -> DataFrame:
    """The table at `path` if it was built from the same files by the same version, else built anew."""
    stamp = f"{path}/stamp"
    if file_source.exists(spark, stamp) and spark.read.json(stamp).first().asDict() == {"fingerprint": fingerprint, "version": version}:
        return spark.read.parquet(f"{path}/rows")
    build().write.mode("overwrite").parquet(f"{path}/rows")
    spark.createDataFrame([(fingerprint, version)], "fingerprint string, version long").coalesce(1).write.mode("overwrite").json(stamp)
    return spark.read.parquet(f"{path}/rows")
