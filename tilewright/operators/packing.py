"""Greedy packing in order, with a reset: publish batches and compaction groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most bytes of a published batch, and below what a batch is small.
MAX_BYTES, SMALL_BYTES = 1800 << 20, 1500 << 20


def packed(files: DataFrame, order: list[str], size: str, cap: int, by: list[str] | None = None) -> DataFrame:
    """`files` with bin: a new one starts when the bin isn't empty and the next file would go over `cap`.

    The fold is sequential by its definition, within each group of `by`. It runs in
    the JVM over (size, order) structs of a group, one number per file, and builds
    the list of bin starts; files then find their bin by their place. What a group
    gathers is its file list, not data: 16 bytes a file.
    """
    by = by or []
    numbered = files.withColumn("__place", F.row_number().over(Window.partitionBy(*by or [F.lit(0)]).orderBy(*order)))
    sizes = F.transform(F.array_sort(F.collect_list(F.struct("__place", F.col(size).cast("long").alias("s")))), lambda x: x["s"])
    # starts grow by one per bin, not per file
    state = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("held"), F.lit(0).alias("place"), F.array().cast("array<int>").alias("starts"))

    def step(acc: Column, s: Column) -> Column:
        new = (acc["held"] == 0) | (acc["sum"] + s > cap)
        return F.struct(
            F.when(new, s).otherwise(acc["sum"] + s).alias("sum"),
            F.when(new, 1).otherwise(acc["held"] + 1).alias("held"),
            (acc["place"] + 1).alias("place"),
            F.when(new, F.array_append(acc["starts"], acc["place"] + 1)).otherwise(acc["starts"]).alias("starts"),
        )

    starts = F.aggregate(sizes, state, step, lambda acc: acc["starts"])
    grouped = numbered.groupBy(*by).agg(starts.alias("__starts"))
    bins = grouped.select(*by, F.posexplode("__starts").alias("bin", "__start"))
    next_start = F.lead("__start").over(Window.partitionBy(*by or [F.lit(0)]).orderBy("bin"))
    bins = bins.withColumn("__next", F.coalesce(next_start, F.lit(2**31 - 1)))
    inside = (F.col("__place") >= F.col("__start")) & (F.col("__place") < F.col("__next"))
    if not by:
        return numbered.join(F.broadcast(bins), inside).drop("__place", "__start", "__next")
    named = bins.select(*[F.col(c).alias(f"__by_{c}") for c in by], "bin", "__start", "__next")
    same = [F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in by]
    for condition in same:
        inside = inside & condition
    return numbered.join(named, inside).drop("__place", "__start", "__next", *[f"__by_{c}" for c in by])


def publish_batches(files: DataFrame, cap: int = MAX_BYTES, name: str = "name", size: str = "size") -> DataFrame:
    """Batches of new shards, in the order of their names."""
    return packed(files, [name], size, cap)


def compact_groups(assets: DataFrame, cap: int = MAX_BYTES, small: int = SMALL_BYTES, name: str = "name", size: str = "size", by: list[str] | None = None) -> DataFrame:
    """Groups of small batches to merge, in the order of size, then name; groups of one are left alone."""
    groups = packed(assets.where(F.col(size) < small), [size, name], size, cap, by).withColumnRenamed("bin", "grp")
    whole = Window.partitionBy(*by or [], "grp")
    return groups.withColumn("members", F.count("*").over(whole)).withColumn("group_bytes", F.sum(size).over(whole)).where("members >= 2")


def byte_offsets(tensors: DataFrame, order: list[str], size: str = "size", by: list[str] | None = None) -> DataFrame:
    """Where each blob begins in its file: the sizes before it."""
    before = Window.partitionBy(*by or [F.lit(0)]).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return tensors.withColumn("offset", F.coalesce(F.sum(size).over(before), F.lit(0)).cast("long"))
