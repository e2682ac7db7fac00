"""Connected components of links, without ever gathering a neighbourhood.

Large-star and small-star steps in turn: every vertex hangs its neighbours on the
smallest one it knows. Each step is a minimum per vertex and a join, both of which
Spark splits where a vertex has very many links; links never grow in number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm import common

#: Links in a partition of a round's checkpoint: few links make few files, in the checkpoint and in the shuffles that read it.
PART_LINKS = 200_000


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (u, v), u > v. Large: larger neighbours of u go to u's minimum. Small: u and its smaller ones do."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(links: DataFrame, rounds: int = 64) -> DataFrame:
    """Rows (id, component) of all ids that `links` (u, v) names; component is the smallest id reachable.

    Links may stand either way round, repeat, or join an id to itself; rows with a
    null are left out. No links, no rows. Every round is checkpointed.
    """
    given = links.where("u is not null and v is not null")
    ids = given.select(F.col("u").alias("id")).unionByName(given.select(F.col("v").alias("id"))).distinct()
    now = given.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, state = common.saved(now), None
    parts = now.count() // PART_LINKS + 1  # links never grow in number
    for _ in range(rounds):
        now = common.saved(_star(common.saved(_star(now.coalesce(parts), large=True).coalesce(parts)), large=False).coalesce(parts))
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"links have not settled in {rounds} rounds")
    return ids.join(now, ids["id"] == now["u"], "left").select("id", F.coalesce("v", "id").alias("component"))
