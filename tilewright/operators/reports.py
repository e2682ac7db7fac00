"""Summaries of shards, cameras, coverage and contributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def validation_summary(shards: DataFrame, by: list[str] | None = None, reason: str = "reason", n_tiles: str = "n_tiles") -> DataFrame:
    """Valid and invalid shards, and tiles of the valid ones."""
    ok = F.col(reason).isNull()
    grouped = shards.groupBy(*by) if by else shards.groupBy()
    return grouped.agg(
        F.count_if(ok).alias("n_shards"), F.count_if(~ok).alias("n_invalid"), F.coalesce(F.sum(F.when(ok, F.col(n_tiles))), F.lit(0)).alias("n_tiles")
    )


def invalid_shards(shards: DataFrame, name: str = "name", reason: str = "reason") -> DataFrame:
    return shards.where(F.col(reason).isNotNull()).select(name, reason).orderBy(name)


def camera_report(shards: DataFrame, camera: str = "camera", n_tiles: str = "n_tiles", name: str = "name") -> DataFrame:
    """Tiles per camera, most first; ties in the order in which the cameras' first shards stand."""
    return shards.groupBy(camera).agg(F.sum(n_tiles).alias("n_tiles"), F.min(name).alias("first_shard")).orderBy(F.desc("n_tiles"), "first_shard")


def camera_map(shards: DataFrame, camera: str = "camera", n_tiles: str = "n_tiles") -> DataFrame:
    """One row with the map of tiles per camera: as many entries as cameras."""
    each = shards.groupBy(camera).agg(F.sum(n_tiles).cast("long").alias("n"))
    return each.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(camera, "n")))).alias("cameras"))


def coverage_report(resolved: DataFrame, from_table: str = "from_table", camera: str = "camera", n_tiles: str = "n_tiles") -> DataFrame:
    """Tiles and distinct cameras whose levels came from the table, and the others."""
    return resolved.groupBy(from_table).agg(F.sum(n_tiles).alias("n_tiles"), F.countDistinct(camera).alias("n_cameras"))


def status_counts(ledger: DataFrame, status: str = "status") -> DataFrame:
    return ledger.groupBy(status).agg(F.count("*").alias("n"))


def best_source(shards: DataFrame, folder: str = "folder") -> DataFrame:
    """The folder with most shards; ties by name."""
    return shards.groupBy(folder).agg(F.count("*").alias("n_shards")).orderBy(F.desc("n_shards"), folder).limit(1)


def variant_map(sensors: DataFrame) -> DataFrame:
    """Per key the ordered list of variants with their ordered sensors, from level rows."""
    sensor = F.struct("sensor_ix", "black", "white", "iso_list", "iso_min", "iso_max")
    variant = sensors.groupBy("key", "variant_ix", "mode").agg(F.array_sort(F.collect_list(sensor)).alias("sensors"))
    return variant.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("variant_ix", "mode", "sensors"))).alias("variants"))


def table_counts(levels: DataFrame) -> DataFrame:
    """Keys, variants and sensors of a level table."""
    return levels.agg(F.countDistinct("key").alias("n_keys"), F.countDistinct("key", "variant_ix").alias("n_variants"), F.count("*").alias("n_sensors"))


def registry_rollup(registry: DataFrame) -> DataFrame:
    """Tiles per contributor and camera over all collected bundles."""
    each = registry.select("handle", F.explode("cameras").alias("camera", "n"))
    return each.groupBy("handle", "camera").agg(F.sum("n").alias("n_tiles"), F.count("*").alias("n_bundles"))


def colour_histogram(rows: DataFrame, colour: str) -> DataFrame:
    """How often each colour stands in a pattern."""
    return rows.select(F.explode(colour).alias("colour")).groupBy("colour").agg(F.count("*").alias("n"))


def residual_stats(pairs: DataFrame, channel: str = "channel", residual: str = "residual") -> DataFrame:
    """Mean and population variance of residuals per channel."""
    return pairs.groupBy(channel).agg(F.avg(residual).alias("mean"), F.var_pop(residual).alias("variance"), F.count("*").alias("n"))


def parameter_count(tensors: DataFrame) -> DataFrame:
    n = F.aggregate(F.col("shape").cast("array<bigint>"), F.lit(1).cast("long"), lambda p, d: p * d)
    return tensors.agg(F.sum(n).alias("n_parameters"))
