"""Scoring tiles and keeping the best ones of each source."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilewright.functions import mosaic
from tilewright.operators import gates


def scored(tiles: DataFrame, values: str, height: int, width: int, threshold: float = 0.98) -> DataFrame:
    """`tiles` with clipped and texture of a normalized mosaic column, computed inside the row."""
    return tiles.withColumn("clipped", mosaic.clipped_fraction(F.col(values), threshold)).withColumn("texture", mosaic.texture(F.col(values), height, width))


def best_tiles(tiles: DataFrame, source: str, n: int, most_clipped: float = 0.02, least_texture: float = 1e-4) -> DataFrame:
    """Of each source the `n` most textured tiles that pass the gate, one per place (oy, ox).

    Ties go to the larger oy, then ox. Repeated places fall away before the rank;
    the rank's limit is pushed below the shuffle, so a large source moves `n` rows a
    task.
    """
    good = tiles.where(gates.tile_gate(F.col("clipped"), F.col("texture"), most_clipped, least_texture)).dropDuplicates([source, "oy", "ox"])
    order = Window.partitionBy(source).orderBy(F.desc("texture"), F.desc("oy"), F.desc("ox"))
    return good.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
