"""Content and identity hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def md5_modulus(text: Column, buckets: int) -> Column:
    """The whole 128-bit MD5 modulo `buckets`, digit by digit."""
    digits = F.transform(F.split(F.md5(text.cast("binary")), ""), lambda d: F.conv(d, 16, 10).cast("int"))
    return F.aggregate(F.filter(digits, lambda d: d.isNotNull()), F.lit(0), lambda rest, d: (rest * 16 + d) % buckets)


def camera_split(camera: Column, buckets: int = 10) -> Column:
    """'val' for one bucket of cameras in `buckets`, 'train' for the others: a camera is never in both."""
    return F.when(md5_modulus(camera, buckets) == 0, "val").otherwise("train")


def seed_of(name: Column) -> Column:
    """A number by which a row's draws are seeded, whatever its place: the first 32 bits of the MD5."""
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("long")


def file_key(path: Column, name: Column) -> Column:
    """file/<8 digits of the path's SHA-1>/<name>."""
    return F.concat(F.lit("file/"), F.substring(F.sha1(path.cast("binary")), 1, 8), F.lit("/"), name)


def fingerprint(files: DataFrame, name: str = "name", size: str = "size", modified: str = "mtime_ns", by: str | None = None) -> DataFrame:
    """SHA-1 over the sorted lines name:size:mtime. Each group's list must fit a task: it is one line per file, not per row of data."""
    line = F.concat_ws(":", F.col(name), F.col(size).cast("string"), F.col(modified).cast("string"))
    lines = F.array_sort(F.collect_list(F.struct(F.col(name).alias("n"), F.concat(line, F.lit("\n")).alias("line"))))
    digest = F.sha1(F.array_join(F.transform(lines, lambda x: x["line"]), "").cast("binary")).alias("fingerprint")
    grouped = files.groupBy(by) if by else files.groupBy()
    return grouped.agg(digest, F.count("*").alias("n_files"))
