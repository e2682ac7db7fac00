"""Sharding by fixed virtual slots.

Records hash into thousands of slots that never change. Bytes are added up per
slot, and a versioned map says which shard owns each slot. To rebalance, or to
add a shard, only the map is edited, so only the rows of the edited slots move.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tilewright.llm import common

SLOTS = 4096


@dataclass(frozen=True)
class SlotMap:
    """owner[slot] is a shard; version grows by one with each edit."""

    version: int
    shards: int
    owner: tuple[int, ...]

    @staticmethod
    def initial(shards: int, slots: int = SLOTS) -> SlotMap:
        return SlotMap(0, shards, tuple(slot % shards for slot in range(slots)))

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(self.version, self.shards, slot, shard) for slot, shard in enumerate(self.owner)]
        return spark.createDataFrame(rows, "version int, shards int, virtual_slot int, shard int")

    def save(self, spark: SparkSession, path: str) -> None:
        """Append this version to the map table at `path`."""
        self.frame(spark).coalesce(1).write.mode("append").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """The given version of the map at `path`, or the newest."""
        table = spark.read.parquet(path)
        if version is None:
            version = table.agg(F.max("version")).first()[0]
        rows = table.where(F.col("version") == version).orderBy("virtual_slot").collect()
        return SlotMap(version, rows[0].shards, tuple(row.shard for row in rows))

    def rebalanced(self, sizes: dict[int, int], shards: int | None = None, tolerance: float = 1e-4) -> SlotMap:
        """The next version: few slots change owner, loads come out near equal.

        Shards above the mean give up their largest slots that fit into their
        excess; these go, largest first, to the least loaded shard. Then single
        slots move or swap between the fullest and the emptiest shard while that
        narrows the gap.
        """
        shards = shards or self.shards
        owner, held, loads = list(self.owner), [set() for _ in range(shards)], [0] * shards
        free = []
        for slot, shard in enumerate(owner):
            if shard < shards:
                held[shard].add(slot)
                loads[shard] += sizes.get(slot, 0)
            else:
                free.append(slot)
        mean = sum(sizes.values()) / shards
        for shard in range(shards):
            for slot in sorted(held[shard], key=lambda s: (-sizes.get(s, 0), s)):
                if 0 < sizes.get(slot, 0) <= loads[shard] - mean:
                    held[shard].discard(slot)
                    loads[shard] -= sizes[slot]
                    free.append(slot)
        heap = [(load, shard) for shard, load in enumerate(loads)]
        heapq.heapify(heap)
        for slot in sorted(free, key=lambda s: (-sizes.get(s, 0), s)):
            load, shard = heapq.heappop(heap)
            held[shard].add(slot)
            loads[shard] = load + sizes.get(slot, 0)
            heapq.heappush(heap, (loads[shard], shard))
        for _ in range(64 * shards):
            full = max(range(shards), key=lambda s: (loads[s], s))
            low = min(range(shards), key=lambda s: (loads[s], s))
            gap = loads[full] - loads[low]
            if gap <= tolerance * mean:
                break
            mine = sorted((sizes[s], s) for s in held[full] if 0 < sizes.get(s, 0))
            theirs = [(0, -1), *sorted((sizes[s], s) for s in held[low] if 0 < sizes.get(s, 0))]
            best, k = None, 0
            for size, slot in mine:  # two sorted lists: the partner nearest to a difference of half the gap
                while k + 1 < len(theirs) and size - theirs[k + 1][0] >= gap / 2:
                    k += 1
                for other in theirs[max(0, k - 1) : k + 3]:
                    if 0 < size - other[0] < gap and (best is None or abs(size - other[0] - gap / 2) < best[0]):
                        best = abs(size - other[0] - gap / 2), size - other[0], slot, other[1]
            if best is None:
                break
            _, moved, slot, other = best
            held[full].discard(slot)
            held[low].add(slot)
            if other >= 0:
                held[low].discard(other)
                held[full].add(other)
            loads[full] -= moved
            loads[low] += moved
        for shard, slots in enumerate(held):
            for slot in slots:
                owner[slot] = shard
        return replace(self, version=self.version + 1, shards=shards, owner=tuple(owner))


def measured(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual_slot of every row; reads each text once."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    ).withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int"))


def slot_totals(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and rows of each virtual slot: at most as many rows as there are slots."""
    found = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    return {row.virtual_slot: (row.bytes, row.n) for row in found}


def spread_repeats(rows: DataFrame, totals: dict[int, tuple[int, int]], slots: int = SLOTS) -> DataFrame | None:
    """`rows` with the repeats of a row dealt out over all slots, where they are more than a quarter of a mean slot.

    Equal rows hash to one slot, which nothing could balance. Only slots over twice
    the mean, by bytes or rows, are looked at; there can be at most 8 x `slots` groups
    of such repeats, so they are broadcast. None if there are no such repeats.
    """
    mean_bytes, mean_rows = (sum(total[k] for total in totals.values()) / slots for k in (0, 1))
    large = [slot for slot, (size, n) in totals.items() if size > 2 * mean_bytes or n > 2 * mean_rows]
    if not large:
        return None
    key = ["doc_id", "text_crc32", "size"]
    much = (F.col("n") > 1) & ((F.col("n") * F.col("size") > mean_bytes / 4) | (F.col("n") > mean_rows / 4))
    hot = common.saved(rows.where(F.col("virtual_slot").isin(large)).groupBy(*key).agg(F.count("*").alias("n")).where(much).select(*(F.col(c).alias(f"__{c}") for c in key)))
    if hot.isEmpty():
        return None
    same = F.lit(True)
    for c in key:
        same = same & rows[c].eqNullSafe(hot[f"__{c}"])
    salted = F.pmod(F.xxhash64("doc_id", "text_crc32", F.monotonically_increasing_id()), F.lit(slots)).cast("int")
    dealt = rows.withColumn("__salted", salted).join(F.broadcast(hot), same, "left")
    return common.saved(dealt.withColumn("virtual_slot", F.when(F.col("__size").isNotNull(), F.col("__salted")).otherwise(F.col("virtual_slot"))).select(*rows.columns))


def shard_documents(docs: DataFrame, shards: int = 16, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """Put every row of `docs` (doc_id, text) into a shard of near equal bytes.

    Returns doc_id, size (UTF-8 bytes and one), text_crc32, law ('bytes'), shard,
    slot (the row's place in its shard, gapless from 0), grown_shard (null under
    this law), virtual_slot and map_version. The edited map is stored at
    `map_path` (default: the shared folder).

    Null or empty text has size 1 and CRC 0. A null doc_id is a value like any
    other. Rows that repeat each get a place of their own; among equal rows the
    order is arbitrary, and they are the same. Where repeats of one row would fill a
    slot, they are dealt out over all slots. An empty table gives no rows. Other
    columns are ignored. Texts of any length are measured whole; no shard can be
    smaller than its largest row.

    The only wide table that moves is 28 bytes a row, dealt out by slot; the map
    (as many rows as slots) is all that is collected or broadcast.
    """
    spark = docs.sparkSession
    rows = common.saved(measured(docs, slots))
    totals = slot_totals(rows)
    if (spread := spread_repeats(rows, totals, slots)) is not None:
        rows, totals = spread, slot_totals(spread)
    plan = SlotMap.initial(shards, slots).rebalanced({slot: size for slot, (size, _) in totals.items()})
    plan.save(spark, map_path or common.new_path(spark, "slot-map"))
    start, placed = [0] * shards, []
    for slot, shard in enumerate(plan.owner):
        placed.append((slot, shard, start[shard]))
        start[shard] += totals.get(slot, (0, 0))[1]
    places = spark.createDataFrame(placed, "virtual_slot int, shard int, __start long")
    order = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("__rank", F.row_number().over(order))
        .join(F.broadcast(places), "virtual_slot")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("__start") + F.col("__rank") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "virtual_slot",
            F.lit(plan.version).alias("map_version"),
        )
    )
