"""Entries of a photo library: joins by id and by path, and what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.functions import text


def library_entries(images: DataFrame, rolls: DataFrame) -> DataFrame:
    """Images with path, camera and ISO: inner join on the film roll."""
    folders = rolls.select(F.col("id").alias("__roll"), "folder")
    joined = images.join(folders, images["film_id"] == folders["__roll"])
    return joined.select(
        "id", F.concat_ws("/", "folder", "filename").alias("path"), text.camera_name(F.col("maker"), F.col("model")).alias("camera"), F.col("iso").cast("double").alias("iso")
    )


def first_by(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per key, the first by `order`; rows without a key all stay."""
    least = F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("__row")  # combines before the shuffle
    return rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(least).select("__row.*").unionByName(rows.where(F.col(key).isNull()))


def entries_by_id(ids: DataFrame, images: DataFrame, rolls: DataFrame) -> DataFrame:
    """Entries of the asked ids: found ones (ord 0) with one row per path, the lowest id; then unknown ids (ord 1) without a path.

    An id whose file another id has too is found, and gone as its repeat.
    """
    entries = library_entries(images, rolls)
    found = ids.distinct().join(entries, "id", "left")
    known = first_by(found.where("path is not null"), "path", "id").withColumn("ord", F.lit(0))
    return known.unionByName(found.where("path is null").withColumn("ord", F.lit(1)))


def ordered_union(*parts: DataFrame, key: str = "path", other: str = "rel") -> DataFrame:
    """Entries of several sources, one per path (or rel where there is no path), the earliest source's."""
    out = None
    for place, part in enumerate(parts):
        part = part.withColumn("source_ord", F.lit(place))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    least = F.min_by(F.struct(*out.columns), F.struct(F.col("source_ord"), F.col(other))).alias("__row")
    return out.groupBy(F.coalesce(F.col(key), F.col(other)).alias("__key")).agg(least).select("__row.*")
