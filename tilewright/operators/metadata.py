"""What is known of a file from several readers, the first that says anything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.functions import hashing, text


def positive(iso: Column) -> Column:
    """A decoder's ISO, null unless it is above zero."""
    return F.when(iso > 0, iso.cast("double"))


def named(make: Column, model: Column) -> Column:
    """Make and model as one name, null if both are missing or empty."""
    both = F.trim(F.concat(F.coalesce(make, F.lit("")), F.lit(" "), F.coalesce(model, F.lit(""))))
    return F.when((F.coalesce(make, F.lit("")) != "") | (F.coalesce(model, F.lit("")) != ""), both)


def file_entries(files: DataFrame) -> DataFrame:
    """Entries of files that no library lists: path, rel, camera, iso, reason.

    files: path, there (whether it exists), tiff_camera, decoder_iso, and what an
    extractor of tags says: make, model, tag_iso (null where there is none).
    The camera is the header's, else the tags'; the ISO is the decoder's, else the
    tags'. Without an ISO the file is rejected; with one but no camera it is 'unknown'.
    """
    camera = F.coalesce("tiff_camera", named(F.col("make"), F.col("model")))
    iso = F.coalesce(positive(F.col("decoder_iso")), F.when(F.col("tag_iso") != 0, F.col("tag_iso").cast("double")))
    there = F.coalesce("there", F.lit(False))
    return files.select(
        "path", hashing.file_key(F.col("path"), text.file_name(F.col("path"))).alias("rel"),
        F.when(there, F.when(iso.isNull(), camera).otherwise(F.coalesce(camera, F.lit("unknown")))).alias("camera"), F.when(there, iso).alias("iso"),
        F.when(~there, "file missing on disk").when(iso.isNull(), "no ISO in the file").alias("reason"),
    )
