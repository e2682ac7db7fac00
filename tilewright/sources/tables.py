"""Calibration tables: noise profiles (nested JSON) and sensor levels (JSON or XML)."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright import schemas
from tilewright.functions import text
from tilewright.operators import lookup
from tilewright.sources import files

_SENSOR_XML = "_black DOUBLE, _white DOUBLE, _iso_list STRING, _iso_min DOUBLE, _iso_max DOUBLE"
_CAMERA_XML = f"_make STRING, _model STRING, _mode STRING, ID ARRAY<STRUCT<_make: STRING, _model: STRING, _VALUE: STRING>>, Sensor ARRAY<STRUCT<{_SENSOR_XML.replace(' DOUBLE', ': DOUBLE').replace(' STRING', ': STRING')}>>"


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Noise profiles, one row per camera and ISO."""
    return lookup.flatten_profiles(spark.read.schema(schemas.PROFILE_DB).option("multiLine", "true").json(path))


def read_levels(spark: SparkSession, path: str) -> DataFrame:
    """Sensor levels, one row per sensor, its place in its variant and the variant's in the list kept. A missing table is empty."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], schemas.LEVEL)
    table = spark.read.schema(schemas.LEVEL_JSON).option("multiLine", "true").json(path)
    variants = table.select(F.explode("cameras").alias("key", "variants")).select("key", F.posexplode("variants").alias("variant_ix", "v"))
    sensors = variants.select("key", "variant_ix", F.col("v.mode").alias("mode"), F.posexplode("v.sensors").alias("sensor_ix", "s"))
    return sensors.select("key", "variant_ix", "mode", "sensor_ix", *[F.col(f"s.{c}").alias(c) for c in ("black", "white", "iso_list", "iso_min", "iso_max")])


def read_camera_xml(spark: SparkSession, path: str) -> DataFrame:
    """Sensor levels from a camera list in XML.

    Sensors need black and white; cameras without such are left out. A camera is
    filed under its make and model, its first ID's make and model, and that ID's
    text, each once.
    """
    cameras = spark.read.format("xml").option("rowTag", "Camera").schema(_CAMERA_XML).load(path)
    return levels_from_cameras(cameras.withColumn("camera_ix", F.monotonically_increasing_id()))


def levels_from_cameras(cameras: DataFrame) -> DataFrame:
    """Level rows from parsed camera elements (with camera_ix in document order)."""
    name = lambda make, model: text.norm_key(F.concat_ws(" ", F.coalesce(make, F.lit("")), F.coalesce(model, F.lit(""))))
    first = F.get("ID", F.lit(0))
    keys = F.array(
        name(F.col("_make"), F.col("_model")),
        F.when(first.isNotNull(), name(first["_make"], first["_model"])),
        F.when(F.trim(first["_VALUE"]) != "", text.norm_key(first["_VALUE"])),
    )
    sensors = F.filter("Sensor", lambda s: s["_black"].isNotNull() & s["_white"].isNotNull())
    rows = cameras.withColumn("sensors", sensors).where(F.size("sensors") > 0)
    filed = rows.select("camera_ix", F.coalesce("_mode", F.lit("")).alias("mode"), "sensors", F.explode(F.array_distinct(F.filter(keys, lambda k: k != ""))).alias("key"))
    # a variant's number within its key, from the few cameras that share it
    order = F.array_sort(F.collect_list(F.struct("camera_ix", "mode", "sensors")))
    listed = filed.groupBy("key").agg(order.alias("variants")).select("key", F.posexplode("variants").alias("variant_ix", "v"))
    flat = listed.select("key", "variant_ix", F.col("v.mode").alias("mode"), F.posexplode("v.sensors").alias("sensor_ix", "s"))
    isos = F.transform(F.filter(F.split(F.trim("s._iso_list"), r"\s+"), lambda v: v != ""), lambda v: v.cast("double"))
    return flat.select(
        "key", "variant_ix", "mode", "sensor_ix", F.col("s._black").alias("black"), F.col("s._white").alias("white"),
        F.when(F.size(isos) > 0, isos).alias("iso_list"), F.col("s._iso_min").alias("iso_min"), F.col("s._iso_max").alias("iso_max"),
    )


def write_levels(levels: DataFrame, path: str, source: bytes | None = None) -> None:
    """The table in order, with the SHA-1 of what it was made from."""
    digest = F.lit(hashlib.sha1(source).hexdigest() if source is not None else None).cast("string").alias("source_sha1")
    levels.select("*", digest).orderBy("key", "variant_ix", "sensor_ix").write.mode("overwrite").parquet(path)


def refresh_profiles(spark: SparkSession, fresh: str, path: str, commit: str) -> int:
    """Put the profile table at `fresh` in the place of the one at `path`, if it can be read and holds profiles.

    It is loaded before anything is changed, then written under a name of its own;
    the pointer file with that name and the upstream `commit` is what readers
    follow, so a refresh that breaks off leaves the old table in force. Returns the rows.
    """
    rows = read_profiles(spark, fresh)
    n = rows.count()
    if not n or rows.where(F.col("iso").isNull() | (F.size("a") != 3) | (F.size("b") != 3)).limit(1).count():
        raise ValueError(f"{fresh} holds no profiles, or broken ones")
    place = f"{path}/{hashlib.sha1(commit.encode()).hexdigest()}"
    rows.write.mode("overwrite").parquet(place)
    spark.createDataFrame([(place, commit)], "place string, commit string").coalesce(1).write.mode("overwrite").json(f"{path}/current")
    return n


def current_profiles(spark: SparkSession, path: str) -> DataFrame:
    """The table in force of those that `refresh_profiles` has written."""
    return spark.read.parquet(spark.read.json(f"{path}/current").first()["place"])
